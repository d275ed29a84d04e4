"""Skew-safe ordered windows: lag, lead, running sums and forward fills.

A plain ``Window.partitionBy(machine)`` puts every row of one machine in
one task. If one machine (or one session, or one group of copies) holds a
third of all rows, that task sorts a third of the data. Here every ordered
window runs in two levels instead:

1. rows are split into *chunks*: (key, time bucket). A chunk is a
   contiguous slice of the key's order, because the order starts with the
   timestamp. Rows are hash-partitioned by (key, chunk) - one shuffle - and
   the window runs per chunk;
2. one summary row per chunk (first/last values, sums, last non-null) is
   aggregated, and a small window over the chunks of each key turns the
   summaries into carries (what the previous chunks contribute);
3. the carries are joined back on (key, chunk). The big side keeps its
   partitioning, so only the small carry table moves (AQE broadcasts it
   when its measured size allows).

Keys that hold at most ``target_rows`` rows stay in a single chunk, and a
frame without a hotter key runs as plain windows per key. Otherwise
(``plan_chunks``: one aggregate per key) the whole (key, order) sequence is cut into
ranges of about equal row counts by Spark's range partitioning on the *full*
order, whatever its types. Even times, bursts, one instant and one instant
with a text tie-breaker are cut alike; only rows equal in every order column
stay together. Keys are compared as one struct column, which is null-safe (a
NULL session of one machine is its own group).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.exprs import micros
from meterline.session import ensure_checkpoint_dir

GROUP = "_scan_g"
CHUNK = "_scan_k"
RN = "_scan_rn"
CNT = "_scan_cnt"
DEFAULT_TARGET_ROWS = 1_000_000

# order spec: sequence of (column name, nulls_last); all ascending.
OrderSpec = Sequence[tuple]


@dataclass(frozen=True)
class Lag:
    src: str
    out: str
    n: int = 1


@dataclass(frozen=True)
class Lead:
    src: str
    out: str
    n: int = 1


@dataclass(frozen=True)
class RunningSum:
    src: str
    out: str


@dataclass(frozen=True)
class FillForward:
    """Last non-null value up to the current row (``strict``: before it)."""

    src: str
    out: str
    strict: bool = False


@dataclass(frozen=True)
class RowNumber:
    out: str


def sort_cols(order: OrderSpec) -> list[Column]:
    return [F.col(c).asc_nulls_last() if nl else F.col(c).asc_nulls_first()
            for c, nl in order]


def sort_struct(order: OrderSpec) -> Column:
    """A struct whose natural ordering equals the window order."""
    fields = []
    for i, (c, nl) in enumerate(order):
        flag = F.col(c).isNull() if nl else F.col(c).isNotNull()
        fields += [flag.alias(f"f{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*fields)


@dataclass(frozen=True)
class ChunkSpec:
    """Cut the (key, order) sequence into ``ranges`` slices of about equal row counts.

    ``tasks``: how many range partitions they are dealt over. Fewer than
    ``ranges``: each is sorted and cut into slices of ``rows`` rows; None: one
    slice per partition.
    """

    ranges: int
    tasks: int | None = None
    rows: int | None = None


# Ranges are sized to two thirds of the target, since their bounds are sampled.
RANGE_SLACK = 1.5
# A range partition is a task: small ranges share one, so tasks follow the rows and not the target.
ROWS_PER_TASK = 100_000
LEAST_TASKS = 32


def plan_chunks(df: DataFrame, keys: Sequence[str], ts: str,
                target_rows: int = DEFAULT_TARGET_ROWS) -> ChunkSpec | None:
    """How to cut a frame in which some key holds more than ``target_rows`` rows; ``None``: no key does.

    One partial aggregate per key; a single row (rows in total, rows of the
    largest key) reaches the driver.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    r = per_key.agg(F.sum("n").alias("total"), F.max("n").alias("most")).first()
    if not r.total or r.most <= target_rows:
        return None
    ranges = math.ceil(RANGE_SLACK * r.total / target_rows)
    tasks = max(LEAST_TASKS, math.ceil(RANGE_SLACK * r.total / ROWS_PER_TASK))
    return ChunkSpec(ranges, tasks, target_rows) if tasks < ranges else ChunkSpec(ranges)


def resolve_chunk(df: DataFrame, keys, ts: str, chunk_micros, target_rows: int):
    if isinstance(chunk_micros, str) and chunk_micros == "auto":
        return plan_chunks(df, keys, ts, target_rows)
    return chunk_micros


def with_chunks(df: DataFrame, keys: Sequence[str], ts: str, chunk_micros,
                order: OrderSpec | None = None) -> DataFrame:
    """Add the key struct and the chunk id (None/0: one chunk; int: time buckets; ChunkSpec: ranges).

    A range's number grows with (key, order), so a chunk is a contiguous
    slice of its key's order. The numbered rows are checkpointed: rows and
    chunk summaries must see the same ranges, and the input is read once.
    """
    df = df.withColumn(GROUP, F.struct(*keys))
    if isinstance(chunk_micros, ChunkSpec):
        order = order or ((ts, False),)
        ensure_checkpoint_dir(df.sparkSession)
        by = [F.col(GROUP).asc(), *sort_cols(order)]
        dealt = df.repartitionByRange(chunk_micros.tasks or chunk_micros.ranges, *by)
        if not chunk_micros.rows:
            return dealt.withColumn(CHUNK, F.spark_partition_id().cast("long")).checkpoint(eager=True)
        # the id's lower 33 bits count a partition's rows; a slice is named after its first row
        return (dealt.sortWithinPartitions(*by).withColumn(CHUNK, F.monotonically_increasing_id())
                .withColumn(CHUNK, F.col(CHUNK) - F.col(CHUNK) % F.lit(1 << 33) % F.lit(chunk_micros.rows))
                .checkpoint(eager=True))
    k = F.lit(0).cast("long") if not chunk_micros else F.floor(micros(ts) / F.lit(int(chunk_micros))).cast("long")
    return df.withColumn(CHUNK, k)


def chunk_windows(order: OrderSpec):
    wl = Window.partitionBy(GROUP, CHUNK).orderBy(*sort_cols(order))
    wc = Window.partitionBy(GROUP).orderBy(F.col(CHUNK).asc_nulls_first())
    return wl, wc


def _join_carry(rows: DataFrame, carry: DataFrame) -> DataFrame:
    # left: every chunk has a carry row, and Catalyst can drop the whole scan
    # when none of its columns are used (outer join on a unique right side)
    return rows.join(carry, [GROUP, CHUNK], "left")


def _local(o, w) -> Column:
    """One op over the window ``w``."""
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if isinstance(o, Lag):
        return F.lag(o.src, o.n).over(w)
    if isinstance(o, Lead):
        return F.lead(o.src, o.n).over(w)
    if isinstance(o, RunningSum):
        return F.sum(o.src).over(run)
    if isinstance(o, FillForward):
        return F.last(o.src, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1) if o.strict else run)
    return F.row_number().over(w).cast("long")


def ordered_scan(df: DataFrame, keys: Sequence[str], order: OrderSpec, ts: str,
                 ops: Sequence, chunk_micros="auto",
                 target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Add one column per op, computed over ``keys`` in ``order``.

    ``order`` must start with ``ts`` ascending (nulls first) and should be
    total (end with a unique id) for deterministic results.
    """
    assert order[0][0] == ts and not order[0][1], "order must start with the chunk timestamp"
    cm = resolve_chunk(df, keys, ts, chunk_micros, target_rows)
    if not cm:  # no key is hot: plain windows per key, which share their shuffle with other scans
        w = Window.partitionBy(*keys).orderBy(*sort_cols(order))
        return df.withColumns({o.out: _local(o, w) for o in ops})
    base = with_chunks(df, keys, ts, cm, order)
    wl, wc = chunk_windows(order)
    wall = wl.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    multi = any(isinstance(o, (Lag, Lead)) and o.n > 1 for o in ops)

    # --- level 1: windows inside each chunk -------------------------------
    local = {RN: F.row_number().over(wl), CNT: F.count(F.lit(1)).over(wall)}
    local |= {f"_l_{o.out}": _local(o, wl) for o in ops if not isinstance(o, RowNumber)}
    rows = base.withColumns(local)

    # --- level 2: one summary row per chunk -------------------------------
    # Offsets of 1, sums and fills are plain aggregates over the chunk (no
    # sort); offsets > 1 take the first/last n rows from the windowed rows.
    sk = sort_struct(order)
    aggs = [F.count(F.lit(1)).alias("_n")]
    src = rows if multi else base
    for o in ops:
        if isinstance(o, (Lag, Lead)) and o.n > 1:
            pick = (F.col(CNT) - F.col(RN) < o.n) if isinstance(o, Lag) else (F.col(RN) <= o.n)
            arr = F.collect_list(F.when(pick, F.struct(F.col(RN).alias("p"), F.col(o.src).alias("v"))))
            aggs.append(F.transform(F.array_sort(arr), lambda s: s["v"]).alias(f"_a_{o.out}"))
        elif isinstance(o, Lag):
            aggs.append(F.max(F.struct(sk.alias("k"), F.col(o.src).alias("v")))["v"].alias(f"_a_{o.out}"))
        elif isinstance(o, Lead):
            aggs.append(F.min(F.struct(sk.alias("k"), F.col(o.src).alias("v")))["v"].alias(f"_a_{o.out}"))
        elif isinstance(o, RunningSum):
            aggs.append(F.sum(o.src).alias(f"_a_{o.out}"))
        elif isinstance(o, FillForward):
            aggs.append(F.max(F.when(F.col(o.src).isNotNull(),
                                     F.struct(sk.alias("k"), F.col(o.src).alias("v"))))["v"]
                        .alias(f"_a_{o.out}"))
    summary = src.groupBy(GROUP, CHUNK).agg(*aggs)

    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = {}
    for o in ops:
        a = F.col(f"_a_{o.out}")
        if isinstance(o, Lag):
            carry_cols[f"_c_{o.out}"] = (F.lag(a).over(wc) if o.n == 1 else
                                        F.flatten(F.collect_list(a).over(wc.rowsBetween(-o.n, -1))))
        elif isinstance(o, Lead):
            carry_cols[f"_c_{o.out}"] = (F.lead(a).over(wc) if o.n == 1 else
                                        F.flatten(F.collect_list(a).over(wc.rowsBetween(1, o.n))))
        elif isinstance(o, RunningSum):
            carry_cols[f"_c_{o.out}"] = F.sum(a).over(before)
        elif isinstance(o, FillForward):
            carry_cols[f"_c_{o.out}"] = F.last(a, ignorenulls=True).over(before)
        elif isinstance(o, RowNumber):
            carry_cols[f"_c_{o.out}"] = F.coalesce(F.sum("_n").over(before), F.lit(0))
    carry = summary.withColumns(carry_cols).select(GROUP, CHUNK, *carry_cols)

    # --- level 3: stitch the carries onto the rows ------------------------
    out = _join_carry(rows, carry)
    rn, cnt = F.col(RN), F.col(CNT)
    final = {}
    for o in ops:
        loc, c = F.col(f"_l_{o.out}"), F.col(f"_c_{o.out}")
        if isinstance(o, Lag):
            edge = c if o.n == 1 else F.try_element_at(c, (rn - o.n - 1).cast("int"))
            final[o.out] = F.when(rn > o.n, loc).otherwise(edge)
        elif isinstance(o, Lead):
            edge = c if o.n == 1 else F.try_element_at(c, (rn + o.n - cnt).cast("int"))
            final[o.out] = F.when(cnt - rn >= o.n, loc).otherwise(edge)
        elif isinstance(o, RunningSum):
            final[o.out] = F.coalesce(c + loc, c, loc)
        elif isinstance(o, FillForward):
            final[o.out] = F.coalesce(loc, c)
        elif isinstance(o, RowNumber):
            final[o.out] = (c + rn).cast("long")
    drop = [GROUP, CHUNK, RN, CNT] + [f"_l_{o.out}" for o in ops if not isinstance(o, RowNumber)] \
        + [f"_c_{o.out}" for o in ops]
    return out.withColumns(final).drop(*drop)


def first_in_group(df: DataFrame, keys: Sequence[str], order: OrderSpec,
                   values: Sequence[str], last: bool = False) -> DataFrame:
    """First (or last) row's ``values`` per group, as an aggregate.

    ``min``/``max`` of a struct led by the order key: partial aggregation
    on the map side, so a hot group costs one row per task, not a sort.
    """
    sk = sort_struct(order)
    s = F.struct(sk.alias("k"), *[F.col(v) for v in values])
    agg = (F.max(s) if last else F.min(s)).alias("_pick")
    return df.groupBy(*keys).agg(agg).select(*keys, *[F.col("_pick")[v].alias(v) for v in values])
