"""Landing tables -> one canonical event log (N1-N11).

Paired events (game start/end, secondary start/end) are tagged, padded and
unioned by name; payouts come from pairing a start with its end, and
amounts from meter differences at offset 2 (starts and ends alternate and
only one side carries the meter). Single-source events are declarative
projections. All windows run on the chunked scan, keyed by tenant, batch
and machine, so a hot machine is spread over many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.exprs import MONEY, priority
from meterline.operators.ordered import (
    DEFAULT_TARGET_ROWS, FillForward, Lag, Lead, ordered_scan, resolve_chunk, sort_cols,
)
from meterline.params import SECONDARY_PAIR_PRIORITY, WAGER_PAIR_PRIORITY
from meterline.schemas import CANONICAL, LANDING

# Optional source-row id (file path + row index) carried through every
# branch when present, so copies of one event loaded twice stay distinct.
ROW_ID = "_row_id"

# canonical columns except the batch id (added by N11)
EVENT_COLUMNS = [f.name for f in CANONICAL.fields if f.name != "batch_id"]
_TYPES = {f.name: f.dataType for f in CANONICAL.fields}
TENANT = ("customer", "batch_id")
# Window keys, the one that tells most rows apart first: a sort compares its first column's prefix.
MACHINE = ("egmid", *TENANT)

# --- Fixed values: landing column -> canonical column, per event type --------
# (event type, landing table, {canonical column: landing column})
PROJECTIONS = {
    "bonus_award_paid": ("bonusawardpaid_raw", {
        "egm_id": "egmid", "tran_ts": "eventdatetime", "seq": "bonuslogsequence",
        "credit_meter": "g2s_cashableinamt", "tran_amt": "g2s_playercashableamt"}),
    "n": ("notestacked_raw", {
        "egm_id": "egmid", "tran_ts": "eventdatetime", "seq": "noteacceptorlogsequence",
        "credit_meter": "g2s_currencyinamt", "tran_amt": "g2s_playercashableamt"}),
    "v": ("voucherissued_raw", {
        "egm_id": "egmid", "tran_ts": "eventdatetime", "seq": "transactionid",
        "credit_meter": "transferamt", "tran_amt": "voucheramt", "player_id": "playerid"}),
    "t": ("voucherredeemed_raw", {
        "egm_id": "egmid", "tran_ts": "eventdatetime", "seq": "transactionid",
        "credit_meter": "g2s_cashableinamt", "tran_amt": "g2s_playercashableamt", "player_id": "playerid"}),
    "game_changed": ("gamecomboactivated_raw", {
        "egm_id": "egmid", "theme_id": "themeid", "device_id": "deviceid", "denom_id": "denomid",
        "tran_ts": "eventdatetime", "tran_amt": "maxwagercredits", "paytable": "paytableid"}),
    "gppr": ("gameplayprofilereceived_raw", {
        "egm_id": "egmid", "device_id": "deviceid", "tran_ts": "eventdatetime",
        "tran_amt": "maxwagercredits"}),
    "gpsr": ("gameplaystatusreceived_raw", {
        "egm_id": "egmid", "theme_id": "themeid", "device_id": "deviceid", "tran_ts": "eventdatetime",
        "paytable": "paytableid"}),
    "cbpr": ("cabinetprofilereceived_raw", {
        "egm_id": "egmid", "tran_ts": "eventdatetime", "area_id": "areaid", "location": "location",
        "currency_id": "currencyid"}),
}
# player session start/end: two rows from one stm_raw row
STM_MAPPING = {"egm_id": "egmid", "theme_id": "slotthemeid", "theme_name": "slotthemename"}
STM_TIMES = (("pss", "sessionstartdate"), ("pse", "sessionenddate"))
CASH_TYPES = ("n", "v", "t")
MISC_TYPES = ("game_changed", "gppr", "gpsr", "cbpr")
# -----------------------------------------------------------------------------

WAGER_START_COLS = [f.name for f in LANDING["primarygamestarted_raw"].fields]
WAGER_END_COLS = [f.name for f in LANDING["gameended_raw"].fields]
SEC_START_COLS = [f.name for f in LANDING["secondarygamestarted_raw"].fields]
SEC_END_COLS = [f.name for f in LANDING["secondarygameended_raw"].fields]

# Orders of the paired-event windows: time first, then the tie-breakers that
# have a meaning. ``total_order`` adds the rest of the columns.
PAIR_ORDER = (("eventdatetime", False), ("sort_priority", False))
METER_ORDER = (("tran_ts", False), ("seq", True), ("sort_priority", False))
SECONDARY_ORDER = (("eventdatetime", False), ("sort_priority", False), ("id", True),
                   ("gameplaylogsequence", True), ("deviceid", True), ("denomid", True),
                   ("gcmdatetime", True), ("commserverid", True), ("g2s_secwageredamt", True),
                   ("g2s_secwonamt", True), ("g2s_secwoncnt", True), ("g2s_seclostcnt", True),
                   ("g2s_sectiedcnt", True))


def total_order(order, df: DataFrame) -> tuple:
    """``order`` plus every other column (the row id first): equal rows are then interchangeable."""
    named = {c for c, _ in order}
    rest = sorted((c for c in df.columns if c not in named), key=lambda c: (c != ROW_ID, c))
    return (*order, *((c, True) for c in rest))


def typed(name: str, c) -> "F.Column":
    return (F.lit(None) if c is None else (F.col(c) if isinstance(c, str) else c)).cast(_TYPES[name]).alias(name)


def to_canonical(df: DataFrame, mapping: dict, rectype, keep=("customer", "batch_id")) -> DataFrame:
    """Project a frame onto the canonical columns; unmapped ones are typed NULLs."""
    cols = []
    for name in EVENT_COLUMNS:
        if name == "rectype":
            cols.append((F.lit(rectype) if isinstance(rectype, str) else rectype).alias("rectype"))
        elif name in keep:
            cols.append(F.col(name))
        else:
            cols.append(typed(name, mapping.get(name)))
    extra = [F.col(ROW_ID)] if ROW_ID in df.columns else []
    return df.select(*cols, F.col("batch_id"), *extra)


def _with_row_id(cols, *frames):
    return list(cols) + ([ROW_ID] if all(ROW_ID in f.columns for f in frames) else [])


# --- N1 -----------------------------------------------------------------
def tag_pad_union(start: DataFrame, end: DataFrame, start_type: str, end_type: str,
                  start_cols, end_cols) -> DataFrame:
    """Tag both sides, pad the missing columns with typed NULLs, union by name."""
    s = start.select(*_with_row_id(start_cols, start, end)).withColumn("rectype", F.lit(start_type))
    e = end.select(*_with_row_id(end_cols, start, end)).withColumn("rectype", F.lit(end_type))
    return s.unionByName(e, allowMissingColumns=True)


# --- N2, N3 ---------------------------------------------------------------
def pair_payout(tagged: DataFrame, chunk_micros="auto") -> DataFrame:
    """payout = next cash of the same (machine, game sequence, device) - own cash."""
    df = tagged.withColumn("sort_priority", priority("rectype", WAGER_PAIR_PRIORITY, None))
    keys = ["gameplaylogsequence", *MACHINE, "deviceid"]
    df = ordered_scan(df, keys, total_order(PAIR_ORDER, df), "eventdatetime",
                      [Lead("g2s_playercashableamt", "_next_cash")], chunk_micros=chunk_micros)
    return df.withColumn("payout", (F.col("_next_cash") - F.col("g2s_playercashableamt")).cast(MONEY)) \
             .drop("_next_cash")


# --- N4 -----------------------------------------------------------------
def meter_delta_lag2(df: DataFrame, meter: str = "credit_meter", out: str = "tran_amt",
                     order=METER_ORDER, chunk_micros="auto") -> DataFrame:
    """``out = meter - meter two rows earlier`` over the machine's events."""
    df = ordered_scan(df, ["egm_id", *TENANT], total_order(order, df), order[0][0],
                      [Lag(meter, "_meter_2", 2)], chunk_micros=chunk_micros)
    return df.withColumn(out, (F.col(meter) - F.col("_meter_2")).cast(MONEY)).drop("_meter_2")


def meter_delta_prev_start(df: DataFrame, start_type: str = "w", meter: str = "credit_meter",
                           out: str = "tran_amt", order=METER_ORDER, chunk_micros="auto") -> DataFrame:
    """``out = meter - meter of the machine's previous start row``, on start rows only.

    The offset-2 form assumes starts and ends strictly alternate; this one
    does not. One scan: a strict forward fill of the start rows' meter.
    """
    df = df.withColumn("_start_meter", F.when(F.col("rectype") == start_type, F.col(meter)))
    df = ordered_scan(df, [*TENANT, "egm_id"], total_order(order, df), order[0][0],
                      [FillForward("_start_meter", "_prev_start", strict=True)], chunk_micros=chunk_micros)
    return df.withColumn(out, F.when(F.col("rectype") == start_type,
                                     (F.col(meter) - F.col("_prev_start")).cast(MONEY))) \
             .drop("_start_meter", "_prev_start")


# --- N5 -----------------------------------------------------------------
def wager_events(start: DataFrame, end: DataFrame, chunk_micros="auto") -> DataFrame:
    tagged = tag_pad_union(start, end, "w", "o", WAGER_START_COLS, WAGER_END_COLS)
    # size the time chunks once on the machine's raw events; the pairing
    # groups are subsets of a machine, so the same width bounds them too
    chunk_micros = resolve_chunk(tagged, [*TENANT, "egmid"], "eventdatetime", chunk_micros,
                                 DEFAULT_TARGET_ROWS)
    if not chunk_micros:  # no machine is hot: dealt by machine once, for the pairs' windows and the meters'
        tagged = tagged.repartition(*MACHINE)
    paired = pair_payout(tagged, chunk_micros)
    canon = to_canonical(paired, {
        "egm_id": "egmid", "device_id": "deviceid", "denom_id": "denomid", "tran_ts": "eventdatetime",
        "seq": "gameplaylogsequence", "credit_meter": "g2s_wageredcashableamt", "payout": "payout",
    }, F.col("rectype")).withColumn("sort_priority", priority("rectype", WAGER_PAIR_PRIORITY, None))
    return meter_delta_lag2(canon, chunk_micros=chunk_micros).select(
        *_with_row_id([*EVENT_COLUMNS, "batch_id"], canon))


# --- N6 -----------------------------------------------------------------
def dedup_events(df: DataFrame, cols) -> DataFrame:
    """Full-row distinct on the chosen columns (copies from repeated loads)."""
    return df.select(*cols).distinct()


def secondary_tagged(start: DataFrame, end: DataFrame, dedup=dedup_events) -> DataFrame:
    s, e = dedup(start, SEC_START_COLS), dedup(end, SEC_END_COLS)
    if ROW_ID in start.columns and ROW_ID in end.columns:
        # after the distinct a row is unique in its landing columns: id from them
        s = s.withColumn(ROW_ID, F.xxhash64(*SEC_START_COLS))
        e = e.withColumn(ROW_ID, F.xxhash64(*SEC_END_COLS))
    return tag_pad_union(s, e, "x", "y", SEC_START_COLS, SEC_END_COLS)


def first_of_equal(df: DataFrame, keys, order) -> DataFrame:
    """Full-row distinct inside a window over ``keys``; ``order`` names every other column, so equal rows have one rank."""
    w = Window.partitionBy(*keys).orderBy(*sort_cols(order))
    return (df.withColumns({"_rn": F.row_number().over(w), "_rank": F.rank().over(w)})
            .where(F.col("_rn") == F.col("_rank")).drop("_rn", "_rank"))


# --- N7 -----------------------------------------------------------------
def secondary_deltas(start: DataFrame, end: DataFrame, chunk_micros="auto") -> DataFrame:
    """x/y events: amount and payout are offset-2 differences of the start and end meters."""
    raw = start.select(*TENANT, "egmid", "eventdatetime").unionByName(
        end.select(*TENANT, "egmid", "eventdatetime"))
    chunk_micros = resolve_chunk(raw, [*TENANT, "egmid"], "eventdatetime", chunk_micros,
                                 DEFAULT_TARGET_ROWS)
    in_window = {} if chunk_micros else {"dedup": lambda df, cols: df.select(*cols)}
    df = secondary_tagged(start, end, **in_window).withColumn(
        "sort_priority", priority("rectype", SECONDARY_PAIR_PRIORITY, None))
    order = total_order(SECONDARY_ORDER, df)
    if in_window:  # no machine is hot: copies go in the scan's own shuffle and sort, not in two before it
        df = first_of_equal(df, MACHINE, order)
    df = ordered_scan(df, MACHINE, order, "eventdatetime",
                      [Lag("g2s_secwageredamt", "_wager_2", 2), Lag("g2s_secwonamt", "_won_2", 2)],
                      chunk_micros=chunk_micros)
    df = df.withColumns({
        "_amt": (F.col("g2s_secwageredamt") - F.col("_wager_2")).cast(MONEY),
        "_pay": (F.col("g2s_secwonamt") - F.col("_won_2")).cast(MONEY),
    })
    return to_canonical(df, {
        "egm_id": "egmid", "device_id": "deviceid", "denom_id": "denomid", "tran_ts": "eventdatetime",
        "seq": "gameplaylogsequence", "credit_meter": "g2s_secwageredamt", "tran_amt": "_amt",
        "payout": "_pay"}, F.col("rectype"))


# --- N8 -----------------------------------------------------------------
def canonical_projection(landing: dict, rectype: str) -> DataFrame:
    table, mapping = PROJECTIONS[rectype]
    return to_canonical(landing[table], mapping, rectype)


# --- N9 -----------------------------------------------------------------
def cash_events(landing: dict) -> DataFrame:
    return reduce(DataFrame.unionByName, [canonical_projection(landing, t) for t in CASH_TYPES])


def start_end_unpivot(stm: DataFrame) -> DataFrame:
    """One scan of the player-session table gives its start row and its end row."""
    pairs = F.array(*[F.struct(F.lit(t).alias("t"), F.col(c).alias("ts")) for t, c in STM_TIMES])
    df = stm.withColumn("_p", F.explode(pairs))
    return to_canonical(df, {**STM_MAPPING, "tran_ts": F.col("_p")["ts"]}, F.col("_p")["t"])


def misc_events(landing: dict) -> DataFrame:
    parts = [canonical_projection(landing, t) for t in MISC_TYPES]
    parts.insert(1, start_end_unpivot(landing["stm_raw"]))
    return reduce(DataFrame.unionByName, parts)


# --- N10, N11 -----------------------------------------------------------------
BRANCH_TYPES = {"wager": ("w", "o"), "secondary": ("x", "y"), "bonus": ("bonus_award_paid",),
                "cash": CASH_TYPES, "misc": ("game_changed", "pss", "pse", "gppr", "gpsr", "cbpr")}


def union_all_types(landing: dict, chunk_micros="auto", types=None) -> DataFrame:
    """Union of every branch; ``types`` builds only the branches producing those types.

    A filter on ``rectype`` removes the literal-tagged projection branches by
    itself (Catalyst folds them to empty), but cannot cross the windows of
    the paired branches, hence the explicit choice.
    """
    want = lambda b: types is None or bool(set(types) & set(BRANCH_TYPES[b]))
    builders = {
        "wager": lambda: wager_events(landing["primarygamestarted_raw"], landing["gameended_raw"], chunk_micros),
        "secondary": lambda: secondary_deltas(landing["secondarygamestarted_raw"],
                                              landing["secondarygameended_raw"], chunk_micros),
        "bonus": lambda: canonical_projection(landing, "bonus_award_paid"),
        "cash": lambda: cash_events(landing),
        "misc": lambda: misc_events(landing),
    }
    parts = [f() for b, f in builders.items() if want(b)]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return df if types is None else df.where(F.col("rectype").isin(*types))


def raw_event_log(landing: dict, batch_id: str | None = None, chunk_micros="auto", types=None) -> DataFrame:
    """The canonical log; ``batch_id`` stamps one batch, else the landing batch is kept."""
    df = union_all_types(landing, chunk_micros, types)
    if batch_id is not None:
        df = df.withColumn("batch_id", F.lit(batch_id))
    return df.select(*_with_row_id([f.name for f in CANONICAL.fields], df))
