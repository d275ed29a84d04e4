"""Session quality rules (Q1-Q16) and the violations table.

The checked frame is the sessionized log with payouts clamped (Q1), the
theme back-filled inside each session (Q2) and the types outside the
checked set dropped (Q3). Each rule maps it to violation rows
(customer, batch_id, egm_id, session_id, error_type); NULL sessions
(rows before a machine's first start) are never reported.

Rules are aggregates rather than joins, sorts or driver-side lists: map-side partial aggregation keeps a hot session from landing in
one task. Ordered rules (Q10, Q12) run on the chunked scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.exprs import clamp_negative, priority, seconds_between
from meterline.operators.ordered import FillForward, Lag, Lead, first_in_group, ordered_scan, sort_struct
from meterline.operators.sessions import ORDER
from meterline.params import (
    CASH_IN_FIRST_TYPES, CHECKED_TYPES, ENTITY, LABEL_BRACKET, LABEL_CASHIN_POSITION,
    LABEL_CREDITMETER, LABEL_INTENSITY, LABEL_MORE_CASHOUTS, LABEL_NEGATIVE_AMOUNT,
    LABEL_RESIDUAL, LABEL_SESSION_LENGTH, SEGREGATION_PRIORITY, SEGREGATION_PRIORITY_DEFAULT,
    SESSION_KEY,
)

VIOLATION_COLUMNS = [*SESSION_KEY, "error_type"]
# The columns of the quarantine table, in its order.
QUARANTINE_COLUMNS = [
    "rectype", "egm_id", "session_id", "theme_id", "theme_name", "device_id", "denom_id",
    "tran_ts", "seq", "credit_meter", "tran_amt", "payout", "player_id", "customer", "batch_id",
]
CHECKED_COLUMNS = QUARANTINE_COLUMNS + ["sort_priority", "event_id"]


def _has_session(df: DataFrame) -> DataFrame:
    return df.where(F.col("session_id").isNotNull())


def _label(df: DataFrame, label: str) -> DataFrame:
    return df.select(*SESSION_KEY).distinct().withColumn("error_type", F.lit(label))


# --- Q1 -----------------------------------------------------------------
def clamp_payout(df: DataFrame) -> DataFrame:
    return df.withColumn("payout", clamp_negative("payout"))


# --- Q2 -----------------------------------------------------------------
def theme_backfill(df: DataFrame, cols=("theme_id",), chunk_micros="auto") -> DataFrame:
    """A NULL theme takes the last earlier non-null value of its session."""
    return ordered_scan(df, SESSION_KEY, ORDER, "tran_ts",
                        [FillForward(c, c) for c in cols], chunk_micros=chunk_micros)


# --- Q3 -----------------------------------------------------------------
def rectype_filter(df: DataFrame, types=CHECKED_TYPES) -> DataFrame:
    return df.where(F.col("rectype").isin(*types))


def checked_frame(sessionized: DataFrame, chunk_micros="auto", fill_theme: bool = True) -> DataFrame:
    """Q1 -> Q2 -> Q3; theme name is blanked as in the checked view.

    No rule reads the theme, so rule inputs may skip the fill
    (``fill_theme=False``) and with it one shuffle; the quarantined rows
    and the checked table itself carry the filled theme.
    """
    df = clamp_payout(sessionized)
    if fill_theme:
        df = theme_backfill(df, chunk_micros=chunk_micros)
    df = df.withColumn("theme_name", F.lit(""))
    return rectype_filter(df).select(*CHECKED_COLUMNS)


# --- Q4, Q5 -------------------------------------------------------------
def negative_amount_sessions(checked: DataFrame) -> DataFrame:
    return _label(_has_session(checked).where(F.col("tran_amt") < 0), LABEL_NEGATIVE_AMOUNT)


def negative_amount_rows(checked: DataFrame) -> DataFrame:
    """The quarantined rows themselves (NULL sessions included)."""
    return checked.where(F.col("tran_amt") < 0).select(*QUARANTINE_COLUMNS, "event_id")


# --- Q6 -----------------------------------------------------------------
def priority_sort(checked: DataFrame) -> DataFrame:
    """Attach the rule-stage priority; each session comes out whole and ordered, without a global sort."""
    df = checked.withColumn("seg_priority",
                            priority("rectype", SEGREGATION_PRIORITY, SEGREGATION_PRIORITY_DEFAULT))
    return df.repartition(*SESSION_KEY).sortWithinPartitions(*SESSION_KEY, "seg_priority")


# --- Q7 -----------------------------------------------------------------
def min_wager_sessions(checked: DataFrame, min_wagers: int = 1) -> DataFrame:
    """Sessions with fewer than ``min_wagers`` wagers of amount >= 0."""
    good = ((F.col("rectype") == "w") & (F.col("tran_amt") >= 0)).cast("long")
    counts = _has_session(checked).groupBy(*SESSION_KEY).agg(
        F.coalesce(F.sum(good), F.lit(0)).alias("_n"))
    return _label(counts.where(F.col("_n") < min_wagers), LABEL_SESSION_LENGTH)


# --- Q8 -----------------------------------------------------------------
def first_event_rule(checked: DataFrame, allowed=CASH_IN_FIRST_TYPES) -> DataFrame:
    first = first_in_group(_has_session(checked), SESSION_KEY, ORDER, ["rectype"])
    return _label(first.where(~F.col("rectype").isin(*allowed)), LABEL_CASHIN_POSITION)


# --- Q9, Q10, Q11 ---------------------------------------------------------
def bracket_incomplete(checked: DataFrame) -> DataFrame:
    """Sessions lacking a player-session start or end (one aggregate, no joins)."""
    flags = _has_session(checked).groupBy(*SESSION_KEY).agg(
        F.max(F.coalesce(F.col("rectype") == "pss", F.lit(False))).alias("_pss"),
        F.max(F.coalesce(F.col("rectype") == "pse", F.lit(False))).alias("_pse"))
    return _label(flags.where(~(F.col("_pss") & F.col("_pse"))), LABEL_BRACKET)


def empty_bracket(checked: DataFrame, chunk_micros="auto") -> DataFrame:
    """Among w/x/pss/pse rows of a machine, a pss directly followed by a pse."""
    df = checked.where(F.col("rectype").isin("w", "x", "pse", "pss"))
    df = ordered_scan(df, ENTITY, ORDER, "tran_ts", [Lead("rectype", "_next_type")],
                      chunk_micros=chunk_micros)
    hit = (F.col("rectype") == "pss") & (F.col("_next_type") == "pse")
    return _label(_has_session(df.where(hit)), LABEL_BRACKET)


def bracket_rule(checked: DataFrame, chunk_micros="auto") -> DataFrame:
    return bracket_incomplete(checked).unionByName(empty_bracket(checked, chunk_micros)).distinct()


# --- Q12 ----------------------------------------------------------------
def zero_intensity(checked: DataFrame, chunk_micros="auto", grain: str | None = None) -> DataFrame:
    """Sessions whose consecutive positive wager pairs span 0 seconds in total.

    Sessions without any such pair are not flagged. ``grain`` (e.g. 'day')
    truncates the times before the pair seconds are counted.
    """
    w = checked.where(F.col("rectype") == "w")
    w = ordered_scan(w, SESSION_KEY, ORDER, "tran_ts",
                     [Lag("tran_amt", "_prev_amt"), Lag("tran_ts", "_prev_ts")],
                     chunk_micros=chunk_micros)
    pairs = w.where(F.col("_prev_ts").isNotNull() & (F.col("tran_amt") > 0) & (F.col("_prev_amt") > 0))
    t = (lambda c: F.col(c)) if grain is None else (lambda c: F.date_trunc(grain, F.col(c)))
    per = _has_session(pairs).groupBy(*SESSION_KEY).agg(
        (F.sum(seconds_between(t("_prev_ts"), t("tran_ts"))) > 0).alias("_ok"))
    return _label(per.where(~F.col("_ok")), LABEL_INTENSITY)


# --- Q14, Q15, Q16 (rules kept switched off in the default set) -----------
def residual_credits(checked: DataFrame) -> DataFrame:
    return _label(_has_session(checked).where((F.col("rectype") == "v") & (F.col("credit_meter") != 0)),
                  LABEL_RESIDUAL)


def multiple_cashouts(checked: DataFrame) -> DataFrame:
    n = (_has_session(checked).where(F.col("rectype") == "v")
         .groupBy(*SESSION_KEY).agg(F.count(F.lit(1)).alias("_n")))
    return _label(n.where(F.col("_n") > 1), LABEL_MORE_CASHOUTS)


def final_balance(checked: DataFrame) -> DataFrame:
    last = first_in_group(_has_session(checked), SESSION_KEY, ORDER, ["credit_meter"], last=True)
    return _label(last.where(F.col("credit_meter") != 0), LABEL_CREDITMETER)


# --- Q13 ----------------------------------------------------------------
DEFAULT_RULES = ("negative_amount", "min_wager", "first_event", "bracket", "intensity")
OPTIONAL_RULES = ("residual_credits", "multiple_cashouts", "final_balance")


def session_labels(checked: DataFrame, rules, min_wagers: int = 1, allowed=CASH_IN_FIRST_TYPES) -> DataFrame:
    """The rules that are aggregates per session, in one aggregate: a violation row per rule that fires."""
    kind, order = F.col("rectype"), sort_struct(ORDER)
    some = lambda c: F.max(F.coalesce(c, F.lit(False)))
    first = F.min(F.struct(order.alias("k"), kind.alias("v")))["v"]
    last = F.max(F.struct(order.alias("k"), F.col("credit_meter").alias("v")))["v"]
    wagers = F.coalesce(F.sum(((kind == "w") & (F.col("tran_amt") >= 0)).cast("long")), F.lit(0))
    fires = {
        "negative_amount": (LABEL_NEGATIVE_AMOUNT, some(F.col("tran_amt") < 0)),
        "min_wager": (LABEL_SESSION_LENGTH, wagers < min_wagers),
        "first_event": (LABEL_CASHIN_POSITION, ~first.isin(*allowed)),
        "bracket": (LABEL_BRACKET, ~(some(kind == "pss") & some(kind == "pse"))),
        "residual_credits": (LABEL_RESIDUAL, some((kind == "v") & (F.col("credit_meter") != 0))),
        "multiple_cashouts": (LABEL_MORE_CASHOUTS, F.count_if(kind == "v") > 1),
        "final_balance": (LABEL_CREDITMETER, last != 0),
    }
    labels = F.array_compact(F.array(*[F.when(fires[r][1], F.lit(fires[r][0])) for r in rules if r in fires]))
    per = _has_session(checked).groupBy(*SESSION_KEY).agg(labels.alias("_labels"))
    return per.select(*SESSION_KEY, F.explode("_labels").alias("error_type"))


def violations(checked: DataFrame, rules=DEFAULT_RULES, chunk_micros="auto") -> DataFrame:
    """One row per session and rule it breaks."""
    frames = [session_labels(checked, rules)]
    if "bracket" in rules:
        frames.append(empty_bracket(checked, chunk_micros))
    if "intensity" in rules:
        frames.append(zero_intensity(checked, chunk_micros))
    out = reduce(DataFrame.unionByName, [f.select(*VIOLATION_COLUMNS) for f in frames])
    return out.distinct() if "bracket" in rules else out  # both bracket rules may name a session
