"""Registered queries: key -> (spark, sf_dir) -> DataFrame.

Every query reads whole driver tables (or tables Spark derives from them)
and matches the SQL of the same key in ``meterline.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators import sessions as Z
from meterline.plans.adapters import DRIVER_SESSION, canonical_events, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


def canon(spark: SparkSession, sf: str) -> DataFrame:
    return canonical_events(table(spark, sf, "events"))


def chunk_width(spark: SparkSession, sf: str):
    """Time-chunk width for every ordered scan over the canonical log.

    Sized once on the base table per machine (keys and time only). Session
    windows see subsets of a machine's rows, so the width bounds them too.
    """
    from meterline.operators.ordered import plan_chunks
    from meterline.params import ENTITY
    key = (spark.sparkContext.applicationId, sf.rstrip("/"))
    if key not in _WIDTHS:
        _WIDTHS[key] = plan_chunks(canon(spark, sf), ENTITY, "tran_ts")
    return _WIDTHS[key]


# chunk widths already measured in this application, per input folder
_WIDTHS: dict = {}


def sessionized(spark: SparkSession, sf: str, chunk_micros="auto") -> DataFrame:
    if chunk_micros == "auto":
        chunk_micros = chunk_width(spark, sf)
    return Z.sessionize(canon(spark, sf), DRIVER_SESSION, chunk_micros=chunk_micros)


@register("sessionized")
def q_sessionized(spark, sf):
    return sessionized(spark, sf)


# --- Z1-Z10 one operator at a time ---------------------------------------
def _z_chain(spark, sf, upto: str):
    p = DRIVER_SESSION
    cm = chunk_width(spark, sf)
    df = Z.event_priority(canon(spark, sf), p)
    if upto == "event_priority":
        return df
    df = Z.neighbor_times(df, cm)
    if upto == "neighbor_times":
        return df.select("event_id", "customer", "batch_id", "egm_id", "tran_ts", "next_ts", "prev_ts")
    df = Z.time_deltas(df)
    if upto == "time_deltas":
        return df.select("event_id", "next_delta", "prev_delta")
    df = Z.threshold_flags(df, p)
    if upto == "threshold_flags":
        return df.select("event_id", "next_gap", "prev_gap")
    df = Z.session_state(Z.cash_flags(df, p))
    if upto == "session_state":
        return df.select("event_id", "session_state")
    df = Z.session_start(df, cm)
    if upto == "session_start":
        return df.select("event_id", "session_start")
    df = Z.session_number(df, cm)
    if upto == "session_number":
        return df.select("event_id", "session_number")
    df = Z.session_id(df, p)
    if upto == "session_id":
        return df.select("event_id", "unique_session_id")
    return Z.session_fill(df, cm).select("event_id", "session_id")


for _k in ("event_priority", "neighbor_times", "time_deltas", "threshold_flags", "session_state",
           "session_start", "session_number", "session_id", "session_fill"):
    QUERIES[_k] = (lambda k: lambda spark, sf: _z_chain(spark, sf, k))(_k)


@register("cash_flags")
def q_cash_flags(spark, sf):
    return Z.cash_flags(canon(spark, sf), DRIVER_SESSION).select("event_id", "is_cash_out", "is_cash_in")


# --- G1-G4 ------------------------------------------------------------------
@register("gap_status")
def q_gap_status(spark, sf):
    from meterline.operators.islands import islands
    return islands(canon(spark, sf), chunk_micros=chunk_width(spark, sf)).select(
        "event_id", "customer", "batch_id", "egm_id", "tran_ts", "next_ts", "time_gap", "credit_status")


@register("event_islands")
def q_event_islands(spark, sf):
    from meterline.operators.islands import islands
    return islands(canon(spark, sf), chunk_micros=chunk_width(spark, sf)).select(
        "event_id", "rectype", "egm_id", "tran_ts", "seq", "credit_meter", "tran_amt", "customer",
        "batch_id", "rectype_order", "calc_col", "grp", "final_num")


# --- Q1-Q16 -----------------------------------------------------------------
def _checked(spark, sf, cm="auto", fill_theme=True):
    from meterline.operators import quality as Q
    cm = chunk_width(spark, sf) if isinstance(cm, str) and cm == "auto" else cm
    return Q.checked_frame(sessionized(spark, sf, cm), chunk_micros=cm, fill_theme=fill_theme)


# outputs that carry the (filled) theme; every other rule skips the fill
THEMED = {"rectype_filter", "negative_amount_rows", "priority_sort"}


ORDERED_RULES = {"empty_bracket", "bracket_rule", "zero_intensity"}


def _rule(name):
    def run(spark, sf):
        from meterline.operators import quality as Q
        cm = chunk_width(spark, sf)
        fn = getattr(Q, name)
        checked = _checked(spark, sf, cm, fill_theme=name in THEMED)
        return fn(checked, chunk_micros=cm) if name in ORDERED_RULES else fn(checked)
    return run


@register("clamp_negative")
def q_clamp_negative(spark, sf):
    from meterline.functions.exprs import clamp_negative
    return sessionized(spark, sf).select("event_id", "session_id", F.col("payout").alias("payout_raw"),
                                         clamp_negative("payout").alias("payout"))


def sessionized_table(spark, sf, cm):
    """The sessionized log cut from its lineage (a reliable checkpoint in the
    shared checkpoint folder), as the pipeline hands it over as a table: the
    per-session scans read it twice (rows and chunk summaries)."""
    return sessionized(spark, sf, cm).checkpoint(eager=True)


@register("theme_backfill")
def q_theme_backfill(spark, sf):
    from meterline.operators import quality as Q
    cm = chunk_width(spark, sf)
    s = sessionized_table(spark, sf, cm).withColumn("theme_id_raw", F.col("theme_id"))
    return Q.theme_backfill(s, chunk_micros=cm).select("event_id", "session_id", "theme_id_raw", "theme_id")


QUERIES["rectype_filter"] = lambda spark, sf: _checked(spark, sf)
for _k in ("negative_amount_sessions", "negative_amount_rows", "priority_sort", "min_wager_sessions",
           "first_event_rule", "bracket_incomplete", "empty_bracket", "bracket_rule",
           "zero_intensity", "residual_credits", "multiple_cashouts", "final_balance"):
    QUERIES[_k] = _rule(_k)


def materialized_stages(spark, sf):
    """Sessionized and checked frames cut from their lineage (reliable
    checkpoints in the shared checkpoint folder): several rules and the
    curation each read them."""
    from meterline.operators import quality as Q
    cm = chunk_width(spark, sf)
    sess = sessionized(spark, sf, cm).checkpoint(eager=True)
    checked = Q.checked_frame(sess, chunk_micros=cm, fill_theme=False).checkpoint(eager=True)
    return sess, checked, cm


@register("violations")
def q_violations(spark, sf):
    from meterline.operators import quality as Q
    _, checked, cm = materialized_stages(spark, sf)
    return Q.violations(checked, chunk_micros=cm)


# --- C1-C7 ------------------------------------------------------------------
@register("valid_sessions")
def q_valid_sessions(spark, sf):
    from meterline.operators import curate as C
    from meterline.operators import quality as Q
    sess, checked, cm = materialized_stages(spark, sf)
    return C.valid_sessions(sess, Q.violations(checked, chunk_micros=cm))


@register("strict_prev_fill")
def q_strict_prev_fill(spark, sf):
    from meterline.operators import curate as C
    cm = chunk_width(spark, sf)
    return C.strict_prev_fill(sessionized_table(spark, sf, cm), chunk_micros=cm).select("event_id", "session_id", "theme_id", "theme_name")


@register("running_balance")
def q_running_balance(spark, sf):
    from meterline.operators import curate as C
    from meterline.operators import quality as Q
    cm = chunk_width(spark, sf)
    return C.running_balance(Q.clamp_payout(sessionized_table(spark, sf, cm)), chunk_micros=cm).select(
        "event_id", "session_id", "credit_meter")


@register("area_fill")
def q_area_fill(spark, sf):
    from meterline.operators import curate as C
    return C.area_fill(sessionized(spark, sf)).select("event_id", "location", "area_id")


@register("curated_sessions")
def q_curated_sessions(spark, sf):
    from meterline.operators import curate as C
    from meterline.operators import quality as Q
    sess, checked, cm = materialized_stages(spark, sf)
    return C.curated_sessions(sess, Q.violations(checked, chunk_micros=cm), chunk_micros=cm)


# --- N1-N11: landing tables -> canonical event log ---------------------------
def _landing(spark, sf):
    from meterline.plans.landing import landing_tables
    return landing_tables(spark, sf)


@register("tag_pad_union")
def q_tag_pad_union(spark, sf):
    from meterline.operators import events as N
    L = _landing(spark, sf)
    return N.tag_pad_union(L["primarygamestarted_raw"], L["gameended_raw"], "w", "o",
                           N.WAGER_START_COLS, N.WAGER_END_COLS)


@register("pair_payout")
def q_pair_payout(spark, sf):
    from meterline.operators import events as N
    return N.pair_payout(q_tag_pad_union(spark, sf)).select(
        "rectype", "egmid", "gameplaylogsequence", "deviceid", "eventdatetime", "customer", "batch_id",
        "g2s_playercashableamt", "sort_priority", "payout")


@register("wager_events")
def q_wager_events(spark, sf):
    from meterline.operators import events as N
    L = _landing(spark, sf)
    return N.wager_events(L["primarygamestarted_raw"], L["gameended_raw"])


@register("meter_delta_lag2")
def q_meter_delta_lag2(spark, sf):
    return q_wager_events(spark, sf).select("rectype", "egm_id", "tran_ts", "seq", "credit_meter",
                                            "tran_amt", "customer", "batch_id")


@register("meter_delta_starts")
def q_meter_delta_starts(spark, sf):
    """N4 without the alternation assumption: previous start row of the machine."""
    from meterline.functions.exprs import priority
    from meterline.operators import events as N
    from meterline.params import WAGER_PAIR_PRIORITY
    w = q_wager_events(spark, sf).withColumn("sort_priority", priority("rectype", WAGER_PAIR_PRIORITY, None))
    return N.meter_delta_prev_start(w.drop("tran_amt")).select(
        "rectype", "egm_id", "tran_ts", "seq", "credit_meter", "tran_amt", "customer", "batch_id")


@register("dedup_events")
def q_dedup_events(spark, sf):
    """Landing rows of which every fifth was loaded twice and every fifteenth three times."""
    from meterline.operators import events as N
    L = _landing(spark, sf)

    def again(df):
        copies = F.when(F.col("id") % 15 == 0, 3).when(F.col("id") % 5 == 0, 2).otherwise(1)
        return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")

    return N.secondary_tagged(again(L["secondarygamestarted_raw"]), again(L["secondarygameended_raw"]))


@register("secondary_deltas")
def q_secondary_deltas(spark, sf):
    from meterline.operators import events as N
    L = _landing(spark, sf)
    return N.secondary_deltas(L["secondarygamestarted_raw"], L["secondarygameended_raw"])


@register("canonical_projection")
def q_canonical_projection(spark, sf):
    """All eight single-source projections."""
    from functools import reduce
    from meterline.operators import events as N
    L = _landing(spark, sf)
    return reduce(DataFrame.unionByName, [N.canonical_projection(L, t) for t in N.PROJECTIONS])


@register("cash_events")
def q_cash_events(spark, sf):
    from meterline.operators import events as N
    return N.cash_events(_landing(spark, sf))


@register("start_end_unpivot")
def q_start_end_unpivot(spark, sf):
    from meterline.operators import events as N
    return N.start_end_unpivot(_landing(spark, sf)["stm_raw"])


@register("union_all_types")
def q_union_all_types(spark, sf):
    from meterline.operators import events as N
    return N.union_all_types(_landing(spark, sf))


@register("raw_event_log")
def q_raw_event_log(spark, sf):
    from meterline.operators import events as N
    return N.raw_event_log(_landing(spark, sf), batch_id="b0")


# --- I1-I11: ingestion ----------------------------------------------------------
# Driver mappings: documents = landing inventory, labels = load log
# (toxic -> Failed, else Completed), events = an append-only status log
# (signup/click -> Started, purchase/view -> Completed, error -> Failed).
LANDING_LOCATION = "mem://landing/"


def _doc_inventory(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(F.lit(LANDING_LOCATION).alias("location"),
                    F.concat(F.lit("documents/"), F.col("doc_id").cast("string"), F.lit(".parquet")).alias("file_name"),
                    F.col("n_chars").alias("size"))


def _label_log(spark, sf):
    lb = table(spark, sf, "labels")
    return lb.select(F.lit("FM").alias("source_name"),
                     F.concat(F.lit("documents/"), F.col("doc_id").cast("string"), F.lit(".parquet")).alias("file_name"),
                     F.when(F.col("toxic") == 1, "Failed").otherwise("Completed").alias("load_status"))


def _event_log(spark, sf):
    e = table(spark, sf, "events")
    st = (F.when(F.col("event_type").isin("signup", "click"), "Started")
          .when(F.col("event_type").isin("purchase", "view"), "Completed").otherwise("Failed"))
    return e.select(F.lit("FM").alias("source_name"),
                    F.concat(F.lit("events/u"), F.col("user_id").cast("string"), F.lit(".parquet")).alias("file_name"),
                    F.lit(LANDING_LOCATION).alias("location"), F.col("ts").alias("load_start"),
                    st.alias("load_status"), F.date_format("ts", "yyyyMMdd").alias("batch_id"),
                    F.col("event_id").alias("entry_id"))


@register("file_inventory")
def q_file_inventory(spark, sf):
    from meterline.sources.files import file_inventory
    return file_inventory(spark, sf, "*.parquet")


@register("pending_files")
def q_pending_files(spark, sf):
    from meterline.sources.loadlog import pending_files
    return pending_files(_doc_inventory(spark, sf), _label_log(spark, sf), "FM")


@register("load_log_open")
def q_load_log_open(spark, sf):
    from meterline.sources.loadlog import log_open
    return log_open(q_pending_files(spark, sf), "FM").drop("load_start")


@register("load_log_state")
def q_load_log_state(spark, sf):
    from meterline.sources.loadlog import log_state
    s = log_state(_event_log(spark, sf), at="load_start", tie="entry_id")
    return s.select("source_name", "file_name", "load_status", F.col("load_start").alias("status_at"),
                    "batch_id", F.col("n_entries").cast("long").alias("n_entries"))


@register("load_duration")
def q_load_duration(spark, sf):
    from meterline.sources.loadlog import minutes_between
    log = _event_log(spark, sf)
    per = log.groupBy("source_name", "file_name").agg(
        F.min(F.when(F.col("load_status") == "Started", F.col("load_start"))).alias("load_start"),
        F.max(F.when(F.col("load_status") == "Completed", F.col("load_start"))).alias("load_end"))
    return per.withColumn("duration_min", minutes_between(F.col("load_start"), F.col("load_end")).cast("long"))


def _typed(spark, sf):
    from meterline.sources.files import typed_load
    e = table(spark, sf, "events")
    raw = e.select("event_id", "user_id", F.date_format("ts", "yyyyMMdd").alias("batch_id"), "ts",
                   F.when(F.col("event_id") % 10 == 0, F.col("event_type"))
                    .otherwise(F.col("event_id").cast("string")).alias("id_text"),
                   F.when(F.col("event_id") % 7 == 0, F.lit("n/a"))
                    .otherwise(F.col("value").cast("decimal(18,2)").cast("string")).alias("amount_text"))
    return typed_load(raw, {"id_text": "bigint", "amount_text": "decimal(18,2)"},
                      keep=("event_id", "user_id", "batch_id", "ts"))


@register("typed_load_accepted")
def q_typed_load_accepted(spark, sf):
    return _typed(spark, sf)[0]


@register("typed_load_rejects")
def q_typed_load_rejects(spark, sf):
    return _typed(spark, sf)[1]


@register("batch_load_stats")
def q_batch_load_stats(spark, sf):
    from meterline.sources.files import batch_load_stats
    acc, rej = _typed(spark, sf)
    return batch_load_stats(acc, rej, ["batch_id"], "ts")


def _day_batches(spark, sf):
    return canon(spark, sf).withColumn("batch_id", F.date_format("tran_ts", "yyyyMMdd"))


@register("tenant_batch_scan")
def q_tenant_batch_scan(spark, sf):
    from meterline.session import scratch_path
    from meterline.sources.files import tenant_batch_scan, write_batch
    path = scratch_path(spark, "canonical")
    write_batch(_day_batches(spark, sf), path)
    return tenant_batch_scan(spark, path, "c1", "20240102")


@register("batch_overwrite")
def q_batch_overwrite(spark, sf):
    """The same batches written twice: the second write replaces, never duplicates."""
    from meterline.session import scratch_path
    from meterline.sources.files import write_batch
    path = scratch_path(spark, "overwrite")
    df = _day_batches(spark, sf)
    write_batch(df, path)
    write_batch(df, path)
    return spark.read.parquet(path)


@register("incremental_load")
def q_incremental_load(spark, sf):
    """events landed as files; the availableNow stream runs twice; the sink holds each row once."""
    from meterline.session import scratch_path
    from meterline.streaming.incremental import stream_available_now
    src, sink, ck = (scratch_path(spark, n) for n in ("landing", "sink", "stream-ckpt"))
    e = table(spark, sf, "events").withColumns({
        "customer": F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")),
        "batch_id": F.date_format("ts", "yyyyMMdd")})
    e.write.mode("overwrite").parquet(src)
    stream_available_now(spark, src, e.schema, sink, ck)
    stream_available_now(spark, src, e.schema, sink, ck)
    return spark.read.schema(e.schema).parquet(sink)


@register("logged_load")
def q_logged_load(spark, sf):
    """Note rows landed as two sets of files of one batch, loaded one after the other, then once more.

    The second set has its sequence as text, and every seventh of its rows
    holds one that doesn't cast: those rows go to the rejects.
    """
    from meterline.schemas import LANDING
    from meterline.session import scratch_path
    from meterline.streaming.incremental import load_pending_files, read_loaded, read_log
    landing, target = scratch_path(spark, "logged-landing"), scratch_path(spark, "logged-target")
    log_path = f"{target}/load_log"
    notes = _landing(spark, sf)["notestacked_raw"].drop("batch_id")
    seq = F.col("noteacceptorlogsequence")
    text = F.when(seq % 7 == 0, F.lit("n/a")).otherwise(seq.cast("string"))
    for part in (notes.where(seq % 2 == 0), notes.where(seq % 2 == 1).withColumn("noteacceptorlogsequence", text)):
        part.write.mode("append").parquet(f"{landing}/notestacked")
        load_pending_files(spark, landing, target, log_path, "b1")
    load_pending_files(spark, landing, target, log_path, "b1")  # nothing is pending any more
    schema = LANDING["notestacked_raw"]
    return read_loaded(spark, f"{target}/notestacked_raw", schema, read_log(spark, log_path)).select(
        *[f.name for f in schema.fields])


@register("logged_stream_load")
def q_logged_stream_load(spark, sf):
    """The note rows of ``logged_load`` as a stream of files run after each set and once more."""
    from meterline.schemas import LANDING
    from meterline.session import scratch_path
    from meterline.streaming import incremental as I
    landing, target, ck = (scratch_path(spark, n) for n in ("stream-landing", "stream-target", "stream-ckpt"))
    log_path = f"{target}/load_log"
    notes = _landing(spark, sf)["notestacked_raw"].drop("batch_id")
    seq = F.col("noteacceptorlogsequence")
    text = F.when(seq % 7 == 0, F.lit("n/a")).otherwise(seq.cast("string"))
    for part in (notes.where(seq % 2 == 0), notes.where(seq % 2 == 1).withColumn("noteacceptorlogsequence", text)):
        part.write.mode("append").parquet(f"{landing}/notestacked")
        I.stream_load(spark, landing, target, log_path, "b1", ck)
    I.stream_load(spark, landing, target, log_path, "b1", ck)  # nothing has come since
    schema = LANDING["notestacked_raw"]
    return I.read_loaded(spark, f"{target}/notestacked_raw", schema, I.read_log(spark, log_path)).select(
        *[f.name for f in schema.fields])


@register("replayed_rejects")
def q_replayed_rejects(spark, sf):
    """The note rows of ``logged_load`` and its rejects, replayed twice with the text ``n/a`` mended to no value."""
    from meterline.schemas import LANDING
    from meterline.session import scratch_path
    from meterline.streaming import incremental as I
    from meterline.streaming.upkeep import replay_rejects
    landing, target = scratch_path(spark, "replay-landing"), scratch_path(spark, "replay-target")
    log_path = f"{target}/load_log"
    notes = _landing(spark, sf)["notestacked_raw"].drop("batch_id")
    seq = F.col("noteacceptorlogsequence")
    text = F.when(seq % 7 == 0, F.lit("n/a")).otherwise(seq.cast("string"))
    notes.withColumn("noteacceptorlogsequence", text).write.parquet(f"{landing}/notestacked")
    I.load_pending_files(spark, landing, target, log_path, "b1")
    for _ in range(2):  # the second finds nothing left
        replay_rejects(spark, target, log_path, repairs={
            "notestacked_raw": {"noteacceptorlogsequence": lambda c: F.nullif(c, F.lit("n/a"))}})
    schema = LANDING["notestacked_raw"]
    return I.read_loaded(spark, f"{target}/notestacked_raw", schema, I.read_log(spark, log_path)).select(
        *[f.name for f in schema.fields])


@register("events_sent_again")
def q_events_sent_again(spark, sf):
    """Three batches by event id, each sending a part of the one before again: every event once, in its first batch."""
    from meterline.session import scratch_path
    from meterline.streaming.upkeep import first_sent
    digests = scratch_path(spark, "digests")
    events, out = table(spark, sf, "events"), None
    for k in range(3):
        sent = events.where((F.col("event_id") % 3 == k) | ((F.col("event_id") % 3 == k - 1) & (F.col("event_id") % 5 == 0)))
        got = first_sent(sent.withColumn("batch_id", F.lit(f"b{k}")), digests, f"b{k}")
        out = got if out is None else out.unionByName(got)
    return out


@register("zero_intensity_day")
def q_zero_intensity_day(spark, sf):
    """Q12 with pair times truncated to the day (wagers of a session never share a second here)."""
    from meterline.operators import quality as Q
    cm = chunk_width(spark, sf)
    return Q.zero_intensity(_checked(spark, sf, cm, fill_theme=False), chunk_micros=cm, grain="day")


# --- the chunked path on ordinary data: a small target cuts every machine ------------
def _small_ranges(spark, sf):
    from meterline.operators.ordered import plan_chunks
    from meterline.params import ENTITY
    return plan_chunks(canon(spark, sf), ENTITY, "tran_ts", target_rows=20)


@register("sessionized_ranges")
def q_sessionized_ranges(spark, sf):
    return sessionized(spark, sf, _small_ranges(spark, sf))


@register("running_balance_ranges")
def q_running_balance_ranges(spark, sf):
    from meterline.operators import curate as C
    from meterline.operators import quality as Q
    cm = _small_ranges(spark, sf)
    return C.running_balance(Q.clamp_payout(sessionized_table(spark, sf, cm)), chunk_micros=cm).select(
        "event_id", "session_id", "credit_meter")


@register("event_islands_ranges")
def q_event_islands_ranges(spark, sf):
    from meterline.operators.islands import islands
    return islands(canon(spark, sf), chunk_micros=_small_ranges(spark, sf)).select(
        "event_id", "rectype", "egm_id", "tran_ts", "seq", "credit_meter", "tran_amt", "customer",
        "batch_id", "rectype_order", "calc_col", "grp", "final_num")


# --- sessions and balances over batch borders ---------------------------------------
def _by_period(spark, sf):
    """The canonical log in batches of eight days."""
    day = F.floor(F.unix_seconds(F.col("tran_ts").cast("timestamp")) / 86400)
    return canon(spark, sf).withColumn("batch_id", F.format_string("p%05d", F.floor(day / 8)))


@register("sessions_over_batches")
def q_sessions_over_batches(spark, sf):
    """The log cut into batches, each continued from the carry of the ones before it, through the batch jobs."""
    from meterline.plans import pipeline as P
    from meterline.session import scratch_path
    wh = P.Warehouse(scratch_path(spark, "continued"))
    log = _by_period(spark, sf)
    wh.write(log, P.RAW, log)
    for b in wh.read(spark, P.RAW).select("batch_id").distinct().orderBy("batch_id").collect():
        P.continue_batch(spark, wh, b.batch_id, DRIVER_SESSION)
    return P.continued_log(spark, wh).select(
        "event_id", "customer", "egm_id", "session_id", "session_start", "session_number", "session_state", "next_delta",
        "prev_delta", "next_gap", "theme_id", "theme_name", "prev_theme_id", "balance")


# --- named, bucketed tables -----------------------------------------------------------
def _named(spark, df, name, **how):
    """``df`` as a fresh named table, bucketed by machine."""
    import uuid

    from meterline.session import scratch_path
    from meterline.sources import catalog
    name = f"{name}_{uuid.uuid4().hex[:12]}"
    catalog.declare(spark, name, df.schema, scratch_path(spark, name), buckets=16, **how)
    catalog.replace_partitions(df, name, buckets=16)
    return name


@register("curated_bucketed")
def q_curated_bucketed(spark, sf):
    """Rules and curation read the sessionized table by name; its buckets spare their machine windows an exchange."""
    from meterline.operators import curate as C
    from meterline.operators import quality as Q
    cm = chunk_width(spark, sf)
    sess = spark.table(_named(spark, sessionized(spark, sf, cm), "sessionized"))
    bad = Q.violations(Q.checked_frame(sess, chunk_micros=cm, fill_theme=False), chunk_micros=cm)
    return C.curated_sessions(sess, bad, chunk_micros=cm)


@register("event_islands_sql")
def q_event_islands_sql(spark, sf):
    from meterline.sources.catalog import islands_sql
    return islands_sql(spark, _named(spark, canon(spark, sf), "events")).drop("time_gap")
