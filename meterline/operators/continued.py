"""Sessions and balances that go on from one batch to the next.

A log is loaded in batches (days, say), but a machine's sessions don't end
where a batch does. ``continue_sessions`` takes one batch of events and the
*carry* that the batches before it left, one row per machine: its last event,
whether that was a cash-out, how many sessions have started, the open session,
its balance and its last theme. It returns the batch's rows as if the whole log
had been one run, and the next carry:

* the carry seeds the first chunk of a machine's scan (``sessionize``), so
  starts, numbers, ids, gaps to the previous event and fills continue;
* rows of the open session continue its balance and its theme (the session id
  tells them from rows of sessions that start in this batch);
* only one thing is decided later: how long after a batch's last event the
  machine's next one came. ``closings`` are these late facts, at most one row
  per machine and batch, and ``with_closings`` puts them on the stored rows.

The carry is joined on the machine; the windows need the same partitioning, so
a batch is shuffled once (a hot machine's ranges apart). The carry has one row per machine, however long the log.
Machines without an event in the batch keep their carry.

A row that comes late (before the carry's last event) can't change what was
written; it is taken in order after the carry. ``late`` marks such rows.

Cases: no carry yet: as a first batch; an empty batch: the carry stays as it
is; NULL machines or customers are machines of their own; rows before a
machine's first session keep a NULL session over the border, and their
balance goes on; equal orders are told apart by the event id.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.exprs import MONEY, clamp_negative, whole_seconds
from meterline.operators.curate import running_balance
from meterline.operators.ordered import DEFAULT_TARGET_ROWS, FillForward, resolve_chunk, sort_struct
from meterline.operators.sessions import (
    C_OUT, C_SECS, C_SESSION, C_STARTS, ORDER, SESSIONIZED_COLUMNS, sessionize, state_expr,
)
from meterline.params import MOVEMENT, SessionParams
from meterline.session import ensure_checkpoint_dir

# The column that tells most rows apart first: a sort compares its first column's prefix.
MACHINE = ("egm_id", "customer")
KEYS = ("_egm", "_no_egm", "_customer", "_no_customer")
THEMES = ("theme_id", "theme_name")

CARRY = T.StructType([T.StructField(n, t) for n, t in (
    ("customer", T.StringType()), ("egm_id", T.StringType()), ("last_ts", T.TimestampNTZType()), ("last_secs", T.LongType()),
    ("event_id", T.LongType()), ("event_batch", T.StringType()), ("is_cash_out", T.BooleanType()),
    ("is_cash_in", T.BooleanType()), ("prev_gap", T.BooleanType()), ("starts", T.LongType()), ("session_id", T.StringType()),
    ("balance", T.DecimalType(18, 2)), ("theme_id", T.StringType()), ("theme_name", T.StringType()))])
CLOSING_COLUMNS = ["customer", "egm_id", "event_id", "event_batch", "next_delta", "next_gap", "session_state"]
CONTINUED_COLUMNS = [*SESSIONIZED_COLUMNS, "balance", "prev_theme_id", "late"]


class Continued(NamedTuple):
    rows: DataFrame      # CONTINUED_COLUMNS of the batch
    closings: DataFrame  # CLOSING_COLUMNS of events of earlier batches
    carry: DataFrame     # CARRY after the batch


def no_carry(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in CARRY.fields])


def _on_machine(left: DataFrame, right: DataFrame):
    """Null-safe equality of the machine; ``right``'s columns carry an underscore."""
    return [left[c].eqNullSafe(right[f"_{c}"]) for c in MACHINE]


def _keyed(df: DataFrame) -> DataFrame:
    """The machine as columns without NULLs: a join and a window on them need the same exchange (a null-safe join's differs)."""
    parts = zip(MACHINE, zip(KEYS[::2], KEYS[1::2]))
    return df.withColumns({n: e for c, (value, no) in parts
                           for n, e in ((value, F.coalesce(c, F.lit(""))), (no, F.col(c).isNull()))})


def _rows(events: DataFrame, carry: DataFrame, p: SessionParams, mapping, chunk_micros, target_rows: int) -> DataFrame:
    """The batch's rows, seeded with the carry."""
    held = {"last_secs": C_SECS, "is_cash_out": C_OUT, "starts": C_STARTS, "session_id": C_SESSION}
    names = {f.name: held.get(f.name, f"_c_{f.name}") for f in CARRY.fields if f.name not in MACHINE}
    cm = resolve_chunk(events, MACHINE, "tran_ts", chunk_micros, target_rows)
    known = _keyed(carry).select(*KEYS, *[F.col(c).alias(n) for c, n in names.items()], F.lit(True).alias("_c_known"))
    df = _keyed(events).join(known, list(KEYS), "left")
    entity = MACHINE if cm else KEYS
    kept = (*names.values(), "_c_known", *KEYS)
    df = sessionize(df, p, chunk_micros=cm, entity=entity, carried=kept)
    df = df.withColumn("payout", clamp_negative("payout"))
    fills = [FillForward(c, f"_f_{c}") for c in THEMES] + [FillForward("theme_id", "_f_prev", strict=True)]
    df = running_balance(df, mapping, out="balance", extra_ops=fills, chunk_micros=cm, keys=(*entity, "session_id"))
    goes_on = F.col("_c_known").isNotNull() & F.col("session_id").eqNullSafe(F.col(C_SESSION))
    return df.withColumns({
        "balance": F.when(goes_on & F.col("_c_balance").isNotNull(), F.coalesce("balance", F.lit(0)) + F.col("_c_balance"))
                    .otherwise(F.col("balance")).cast(MONEY),
        "prev_theme_id": F.coalesce("_f_prev", F.when(goes_on, F.col("_c_theme_id"))),
        **{c: F.coalesce(f"_f_{c}", F.when(goes_on, F.col(f"_c_{c}"))) for c in THEMES},
        "late": F.coalesce(F.col("tran_ts") < F.col("_c_last_ts"), F.lit(False)),
    })


def _machines(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Per machine of the batch: its first and last event, its starts, and what was carried to it (``was``)."""
    order = sort_struct(ORDER)
    last = F.struct(order.alias("k"), *[F.col(c) for c in (
        "tran_ts", "event_id", "batch_id", "is_cash_out", "is_cash_in", "prev_gap", "session_id", "balance", *THEMES)])
    seen = rows.groupBy(*MACHINE).agg(F.max(last).alias("last"), F.min(F.struct(order.alias("k"), F.col("tran_ts"))).alias("first"),
                                      F.count("session_start").alias("new_starts"))
    known = carry.select(*[F.col(c).alias(f"_{c}") for c in MACHINE], F.struct(*[f.name for f in CARRY.fields]).alias("was"))
    return seen.join(known, _on_machine(seen, known), "left")


def _closings(machines: DataFrame, p: SessionParams) -> DataFrame:
    delta = whole_seconds(F.col("first.tran_ts")) - F.col("was.last_secs")
    gap = F.coalesce(delta > p.gap_seconds, F.lit(False))
    return machines.where(F.col("was").isNotNull()).select(
        *MACHINE, F.col("was.event_id"), F.col("was.event_batch"), delta.alias("next_delta"), gap.alias("next_gap"),
        state_expr(F.col("was.is_cash_out"), gap, F.col("was.is_cash_in"), F.col("was.prev_gap")).alias("session_state"))


def _next_carry(machines: DataFrame, carry: DataFrame) -> DataFrame:
    new = machines.select(
        *MACHINE, F.col("last.tran_ts").alias("last_ts"), whole_seconds(F.col("last.tran_ts")).alias("last_secs"),
        F.col("last.event_id"), F.col("last.batch_id").alias("event_batch"), F.col("last.is_cash_out"), F.col("last.is_cash_in"),
        F.col("last.prev_gap"), (F.coalesce("was.starts", F.lit(0)) + F.col("new_starts")).cast("long").alias("starts"),
        F.col("last.session_id"), F.col("last.balance"), *[F.col(f"last.{c}") for c in THEMES])
    seen = machines.select(*[F.col(c).alias(f"_{c}") for c in MACHINE])
    return new.unionByName(carry.join(seen, _on_machine(carry, seen), "left_anti")).select(
        *[F.col(f.name).cast(f.dataType) for f in CARRY.fields])


def continue_sessions(events: DataFrame, carry: DataFrame, p: SessionParams = SessionParams(), mapping=MOVEMENT,
                      chunk_micros="auto", target_rows: int = DEFAULT_TARGET_ROWS, through=None) -> Continued:
    """One batch after the batches that ``carry`` stands for.

    ``through`` writes the batch's rows and reads them back, so that the
    carry and the closings are taken from what was written and the scan runs
    once; without it they are recomputed from the events.
    """
    rows = _rows(events, carry, p, mapping, chunk_micros, target_rows).select(*CONTINUED_COLUMNS)
    if through is not None:
        rows = through(rows)
    machines = _machines(rows, carry)
    if through is not None:  # the closings and the carry are both taken from it
        ensure_checkpoint_dir(events.sparkSession)
        machines = machines.checkpoint()
    return Continued(rows, _closings(machines, p).select(*CLOSING_COLUMNS), _next_carry(machines, carry))


def with_closings(rows: DataFrame, closings: DataFrame) -> DataFrame:
    """The rows with what later batches decided about them (all batches' closings; at most one per event)."""
    late = closings.select(*[F.col(c).alias(f"_{c}") for c in (*MACHINE, "event_id", "next_delta", "next_gap", "session_state")])
    on = [*_on_machine(rows, late), rows["event_id"] == late["_event_id"]]
    decided = F.col("_event_id").isNotNull()
    out = rows.join(late, on, "left")
    return out.select(*[F.when(decided, F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
                        if c in ("next_delta", "next_gap", "session_state") else F.col(c) for c in rows.columns])
