"""Curation (C1-C7): valid sessions with filled attributes and a running balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.exprs import MONEY, clamp_negative, movement
from meterline.operators.ordered import FillForward, RunningSum, ordered_scan
from meterline.operators.sessions import ORDER, SESSIONIZED_COLUMNS
from meterline.params import MOVEMENT, SESSION_KEY


# --- C1 -----------------------------------------------------------------
def valid_sessions(sessionized: DataFrame, violations: DataFrame) -> DataFrame:
    """Rows whose session has no violation; NULL-session rows stay.

    Left anti join on the session key. AQE broadcasts the violation keys
    when their measured size allows and splits a hot session otherwise.
    """
    bad = violations.select(*SESSION_KEY).distinct()
    return sessionized.join(bad, list(SESSION_KEY), "left_anti")


# --- C3 -----------------------------------------------------------------
def strict_prev_fill(df: DataFrame, cols=("theme_id", "theme_name"), chunk_micros="auto") -> DataFrame:
    """Each value is replaced by the previous non-null one in the session (own value dropped)."""
    return ordered_scan(df, SESSION_KEY, ORDER, "tran_ts",
                        [FillForward(c, c, strict=True) for c in cols], chunk_micros=chunk_micros)


# --- C4, C5 ---------------------------------------------------------------
def running_balance(df: DataFrame, mapping=MOVEMENT, out: str = "credit_meter",
                    extra_ops=(), chunk_micros="auto", keys=SESSION_KEY) -> DataFrame:
    df = df.withColumn("_move", movement("rectype", "tran_amt", "payout", mapping))
    df = ordered_scan(df, keys, ORDER, "tran_ts",
                      [RunningSum("_move", "_bal"), *extra_ops], chunk_micros=chunk_micros)
    return df.withColumn(out, F.col("_bal").cast(MONEY)).drop("_move", "_bal")


# --- C6 -----------------------------------------------------------------
def area_fill(df: DataFrame, width: int = 4) -> DataFrame:
    return df.withColumn("area_id", F.coalesce(F.col("area_id"), F.substring("location", 1, width)))


# --- C7 -----------------------------------------------------------------
def curated_sessions(sessionized: DataFrame, violations: DataFrame, chunk_micros="auto") -> DataFrame:
    """C2 -> theme fill (coalescing) + running balance in one scan -> C1 -> C6.

    Invalid sessions are removed whole, and every window here is per
    session, so filtering after the scan gives the same rows as filtering
    before it. Done last, the anti join runs once; done first, both
    branches of the scan would repeat it.
    """
    df = sessionized.withColumn("payout", clamp_negative("payout"))
    df = running_balance(df, extra_ops=[FillForward("theme_id", "theme_id"),
                                        FillForward("theme_name", "theme_name")],
                         chunk_micros=chunk_micros)
    return area_fill(valid_sessions(df, violations)).select(*SESSIONIZED_COLUMNS)
