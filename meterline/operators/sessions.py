"""Sessionization of a machine's event log (time gap + credit state).

Per machine, in event order:
  next/prev second deltas -> gap flags (> gap, NULL -> false)
  cash-out: type in cash_out_types or meter below the floor; cash-in: type t
  state: cash-out and next gap -> 'session end'; cash-in and previous gap ->
         'potential session start'; else 'game continued'
  start: the previous row's state is 'session end'
  number: running count of starts; id: <egm>_<start time>_<number>
  session_id: the id of the latest start at or before the row.

``sessionize`` runs the whole chain with one full shuffle on (machine,
time chunk) and one small carry join, so a hot machine is spread over many
tasks. The step functions (``neighbor_times`` ... ``session_fill``) are the
same logic one operator at a time, each on the generic chunked scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.exprs import priority, seconds_between, session_id_expr, whole_seconds
from meterline.operators.ordered import (
    CHUNK, CNT, DEFAULT_TARGET_ROWS, GROUP, RN, FillForward, Lag, Lead, RunningSum,
    chunk_windows, ordered_scan, resolve_chunk, sort_cols, with_chunks,
)
from meterline.params import ENTITY, SessionParams

# Event order inside a machine: time, sequence (NULLs last), type priority,
# then the event id as the total tie-breaker.
ORDER = (("tran_ts", False), ("seq", True), ("sort_priority", False), ("event_id", False))

# Columns that seed a machine's first chunk: last second, cash-out flag, starts and session so far.
C_SECS, C_OUT, C_STARTS, C_SESSION = "_c_secs", "_c_out", "_c_starts", "_c_session"

# The state texts.
SESSION_END = "session end"
POTENTIAL_START = "potential session start"
CONTINUED = "game continued"
SESSION_START = "session start"

# The columns of the sessionized table, in its order.
SESSIONIZED_COLUMNS = [
    "egm_id", "rectype", "session_id", "tran_ts", "seq", "credit_meter", "tran_amt",
    "payout", "theme_id", "theme_name", "device_id", "denom_id", "paytable", "player_id",
    "area_id", "location", "currency_id", "customer", "batch_id", "sort_priority",
    "is_cash_out", "is_cash_in", "session_start", "session_state", "session_number",
    "next_delta", "prev_delta", "next_gap", "prev_gap", "unique_session_id", "event_id",
]


# --- Z1 ---------------------------------------------------------------------
def event_priority(df: DataFrame, p: SessionParams = SessionParams()) -> DataFrame:
    return df.withColumn("sort_priority", priority("rectype", p.priority, p.priority_default))


# --- Z2 ---------------------------------------------------------------------
def neighbor_times(df: DataFrame, chunk_micros="auto") -> DataFrame:
    """next_ts / prev_ts over the machine's event order."""
    return ordered_scan(df, ENTITY, ORDER, "tran_ts",
                        [Lead("tran_ts", "next_ts"), Lag("tran_ts", "prev_ts")],
                        chunk_micros=chunk_micros)


# --- Z3, Z4 -----------------------------------------------------------------
def time_deltas(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "next_delta": seconds_between("tran_ts", "next_ts"),
        "prev_delta": seconds_between("prev_ts", "tran_ts"),
    })


def threshold_flags(df: DataFrame, p: SessionParams = SessionParams()) -> DataFrame:
    return df.withColumns({
        "next_gap": F.coalesce(F.col("next_delta") > p.gap_seconds, F.lit(False)),
        "prev_gap": F.coalesce(F.col("prev_delta") > p.gap_seconds, F.lit(False)),
    })


# --- Z5 ---------------------------------------------------------------------
def cash_flags(df: DataFrame, p: SessionParams = SessionParams()) -> DataFrame:
    out = F.col("rectype").isin(*p.cash_out_types) | (F.col("credit_meter") < F.lit(p.credit_floor))
    return df.withColumns({
        "is_cash_out": F.coalesce(out, F.lit(False)),
        "is_cash_in": F.coalesce(F.col("rectype").isin(*p.cash_in_types), F.lit(False)),
    })


# --- Z6 ---------------------------------------------------------------------
def state_expr(out, nxt_gap, cin, prv_gap):
    return (F.when(out & nxt_gap, F.lit(SESSION_END))
            .when(cin & prv_gap, F.lit(POTENTIAL_START))
            .otherwise(F.lit(CONTINUED)))


def session_state(df: DataFrame) -> DataFrame:
    return df.withColumn("session_state", state_expr(F.col("is_cash_out"), F.col("next_gap"),
                                                     F.col("is_cash_in"), F.col("prev_gap")))


# --- Z7 ---------------------------------------------------------------------
def session_start(df: DataFrame, chunk_micros="auto") -> DataFrame:
    df = ordered_scan(df, ENTITY, ORDER, "tran_ts", [Lag("session_state", "_prev_state")],
                      chunk_micros=chunk_micros)
    return df.withColumn("session_start",
                         F.when(F.col("_prev_state") == SESSION_END, F.lit(SESSION_START))
                         .otherwise(F.lit(None).cast("string"))).drop("_prev_state")


# --- Z8 ---------------------------------------------------------------------
def session_number(df: DataFrame, chunk_micros="auto") -> DataFrame:
    """Running count of starts; set on start rows only."""
    df = df.withColumn("_is_start", F.col("session_start").isNotNull().cast("long"))
    df = ordered_scan(df, ENTITY, ORDER, "tran_ts", [RunningSum("_is_start", "_starts")],
                      chunk_micros=chunk_micros)
    return df.withColumn("session_number",
                         F.when(F.col("session_start").isNotNull(), F.col("_starts"))
                         .cast("long")).drop("_is_start", "_starts")


# --- Z9 ---------------------------------------------------------------------
def session_id(df: DataFrame, p: SessionParams = SessionParams()) -> DataFrame:
    """On start rows only (a bare concat_ws would skip the NULLs and give every row an id)."""
    return df.withColumn("unique_session_id",
                         F.when(F.col("session_number").isNotNull(),
                                session_id_expr("egm_id", "tran_ts", "session_number", p.ts_format)))


# --- Z10 --------------------------------------------------------------------
def session_fill(df: DataFrame, chunk_micros="auto") -> DataFrame:
    return ordered_scan(df, ENTITY, ORDER, "tran_ts",
                        [FillForward("unique_session_id", "session_id")],
                        chunk_micros=chunk_micros)


def sessionize_stepwise(events: DataFrame, p: SessionParams = SessionParams(),
                        chunk_micros="auto") -> DataFrame:
    """Z1-Z10 one operator at a time (several shuffles)."""
    df = event_priority(events, p)
    df = threshold_flags(time_deltas(neighbor_times(df, chunk_micros)), p)
    df = session_state(cash_flags(df, p))
    df = session_start(df, chunk_micros)
    df = session_id(session_number(df, chunk_micros), p)
    return session_fill(df, chunk_micros).select(*SESSIONIZED_COLUMNS)


# --- Z1-Z11 fused -----------------------------------------------------------
def sessionize(events: DataFrame, p: SessionParams = SessionParams(), chunk_micros="auto",
               target_rows: int = DEFAULT_TARGET_ROWS, entity=ENTITY, carried: tuple[str, ...] = ()) -> DataFrame:
    """The sessionized table (Z11 columns) with one full shuffle of the rows.

    A row's start flag only needs the previous row (its cash-out flag and
    its time), so inside a chunk everything but the first row is local.
    The chunk summary carries: last row's time and cash-out flag, first
    row's time, local start count and last local start time. From those a
    window over the chunks of a machine derives the first row's start
    flag, the starts before the chunk and the id of the last start before
    the chunk.

    ``carried``: columns that every row of a machine holds alike, the state
    that earlier batches left (see ``operators.continued``); it seeds the first
    chunk, and the columns are returned after the others.
    """
    gap = F.lit(p.gap_seconds)
    seed = {c: F.col(c) if carried else F.lit(None) for c in (C_SECS, C_OUT, C_STARTS, C_SESSION)}
    df = cash_flags(event_priority(events, p), p).withColumn("_secs", whole_seconds("tran_ts"))
    cm = resolve_chunk(df, entity, "tran_ts", chunk_micros, target_rows)
    base = with_chunks(df, entity, "tran_ts", cm, ORDER)
    wl, wc = chunk_windows(ORDER)
    if not cm:  # no key is hot: one window per machine
        wl = Window.partitionBy(*entity).orderBy(*sort_cols(ORDER))
    wall = wl.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wrun = wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rn, cnt = F.col(RN), F.col(CNT)

    # level 1: inside the chunk
    rows = base.withColumns({
        RN: F.row_number().over(wl), CNT: F.count(F.lit(1)).over(wall),
        "_p_secs": F.lag("_secs").over(wl), "_n_secs": F.lead("_secs").over(wl),
        "_p_out": F.lag("is_cash_out").over(wl),
        **({} if cm or not carried else {"_fm_secs": F.first("_secs").over(wall), "_f_ts": F.first("tran_ts").over(wall)}),
    })
    rows = rows.withColumn("_lstart", (rn > 1) & F.coalesce(
        F.col("_p_out") & ((F.col("_secs") - F.col("_p_secs")) > gap), F.lit(False)))
    rows = rows.withColumns({
        "_lcum": F.sum(F.col("_lstart").cast("long")).over(wrun),
        "_lstart_ts": F.last(F.when(F.col("_lstart"), F.col("tran_ts")), ignorenulls=True).over(wrun),
    })

    if not cm:
        first_secs, first_ts = ((F.col("_fm_secs"), F.col("_f_ts")) if carried else
                                (F.lit(None).cast("long"), F.lit(None).cast("timestamp_ntz")))
        out = rows.withColumns({
            "_pl_secs": seed[C_SECS].cast("long"), "_nf_secs": F.lit(None).cast("long"),
            "_first_start": F.coalesce(seed[C_OUT].cast("boolean") & ((first_secs - seed[C_SECS].cast("long")) > gap), F.lit(False)),
            "_before": F.coalesce(seed[C_STARTS], F.lit(0)).cast("long"), "_f_ts": first_ts,
            "_carry_id": seed[C_SESSION].cast("string")})
        return _stitched(out, p, carried)

    # level 2: per-chunk summary -> carries over the machine's chunks
    summary = rows.groupBy(GROUP, CHUNK).agg(
        F.max(F.when(rn == 1, F.col("_secs"))).alias("_f_secs"),
        F.max(F.when(rn == 1, F.col("tran_ts"))).alias("_f_ts"),
        F.max(F.when(rn == cnt, F.col("_secs"))).alias("_l_secs"),
        F.max(F.when(rn == cnt, F.col("is_cash_out"))).alias("_l_out"),
        F.sum(F.col("_lstart").cast("long")).alias("_n_loc"),
        F.max(F.when(F.col("_lstart"), F.col("tran_ts"))).alias("_loc_last_ts"),
        *[F.max(seed[c]).alias(f"_s{c}") for c in seed],
    )
    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    first_chunk = F.row_number().over(wc) == 1
    c = summary.withColumns({
        "_pl_secs": F.when(first_chunk, F.col(f"_s{C_SECS}").cast("long")).otherwise(F.lag("_l_secs").over(wc)),
        "_pl_out": F.when(first_chunk, F.col(f"_s{C_OUT}").cast("boolean")).otherwise(F.lag("_l_out").over(wc)),
        "_nf_secs": F.lead("_f_secs").over(wc),
    })
    c = c.withColumn("_first_start", F.coalesce(
        F.col("_pl_out") & ((F.col("_f_secs") - F.col("_pl_secs")) > gap), F.lit(False)))
    c = c.withColumn("_ch_starts", F.col("_n_loc") + F.col("_first_start").cast("long"))
    c = c.withColumn("_before", (F.coalesce(F.sum("_ch_starts").over(before), F.lit(0))
                                 + F.coalesce(F.col(f"_s{C_STARTS}"), F.lit(0))).cast("long"))
    c = c.withColumn("_ch_last_id", F.when(
        F.col("_ch_starts") > 0,
        session_id_expr(F.col(GROUP)["egm_id"],
                        F.coalesce(F.col("_loc_last_ts"), F.col("_f_ts")),
                        F.col("_before") + F.col("_ch_starts"), p.ts_format)))
    c = c.withColumn("_carry_id", F.coalesce(F.last("_ch_last_id", ignorenulls=True).over(before),
                                             F.col(f"_s{C_SESSION}").cast("string")))
    carry = c.select(GROUP, CHUNK, "_pl_secs", "_nf_secs", "_first_start", "_before",
                     "_f_ts", "_carry_id")

    return _stitched(rows.join(carry, [GROUP, CHUNK], "inner"), p, carried)


def _stitched(out: DataFrame, p: SessionParams, keep: tuple[str, ...] = ()) -> DataFrame:
    """Level 3: the session columns from the local ones and the carries."""
    rn, cnt = F.col(RN), F.col(CNT)
    prev_secs = F.when(rn == 1, F.col("_pl_secs")).otherwise(F.col("_p_secs"))
    next_secs = F.when(rn == cnt, F.col("_nf_secs")).otherwise(F.col("_n_secs"))
    is_start = F.when(rn == 1, F.col("_first_start")).otherwise(F.col("_lstart"))
    num = F.col("_before") + F.col("_first_start").cast("long") + F.col("_lcum")
    last_start_ts = F.coalesce(F.col("_lstart_ts"), F.when(F.col("_first_start"), F.col("_f_ts")))
    out = out.withColumns({
        "next_delta": (next_secs - F.col("_secs")),
        "prev_delta": (F.col("_secs") - prev_secs),
        "_start": is_start, "_num": num, "_ls_ts": last_start_ts,
    })
    out = threshold_flags(out, p)
    out = out.withColumns({
        "session_state": state_expr(F.col("is_cash_out"), F.col("next_gap"),
                                    F.col("is_cash_in"), F.col("prev_gap")),
        "session_start": F.when(F.col("_start"), F.lit(SESSION_START)).otherwise(F.lit(None).cast("string")),
        "session_number": F.when(F.col("_start"), F.col("_num")).cast("long"),
        "unique_session_id": F.when(F.col("_start"), session_id_expr("egm_id", "tran_ts", "_num", p.ts_format)),
        "session_id": F.when(F.col("_ls_ts").isNotNull(),
                             session_id_expr("egm_id", "_ls_ts", "_num", p.ts_format))
                       .otherwise(F.col("_carry_id")),
    })
    return out.select(*SESSIONIZED_COLUMNS, *keep)
