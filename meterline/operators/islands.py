"""Gaps and islands of a machine's events (G1-G4).

G1 next event time and gap status (> gap -> 'session_end', else
'continue'); G2 credit status (meter <= amount -> 'session_end', else
'countinue', spelled as the pipeline spells it); G3 type order; G4 islands:
``grp = row number in the machine - row number in the machine's cash-out
class``; a cash-out row gets its class row number, others ``grp + 1``.

The source query numbered rows over the whole table (one task); here the
row numbers run per machine through the chunked scan, and the class row
number is a running count, so one shuffle serves all three numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.exprs import priority, seconds_between
from meterline.operators.ordered import Lead, RowNumber, RunningSum, ordered_scan
from meterline.params import ENTITY, ISLAND_GAP_SECONDS, ISLAND_PRIORITY, ISLAND_PRIORITY_DEFAULT

ORDER = (("tran_ts", False), ("seq", True), ("rectype_order", False), ("event_id", False))
CASHOUT = "cashout"
OTHER = "other rectype"


def islands(df: DataFrame, gap_seconds: int = ISLAND_GAP_SECONDS, cash_out_type: str = "v",
            chunk_micros="auto") -> DataFrame:
    df = df.withColumns({
        "rectype_order": priority("rectype", ISLAND_PRIORITY, ISLAND_PRIORITY_DEFAULT),
        "calc_col": F.when(F.col("rectype") == cash_out_type, F.lit(CASHOUT)).otherwise(F.lit(OTHER)),
    })
    df = df.withColumns({
        "_is_out": (F.col("calc_col") == CASHOUT).cast("long"),
        "_not_out": (F.col("calc_col") != CASHOUT).cast("long"),
    })
    df = ordered_scan(df, ENTITY, ORDER, "tran_ts",
                      [Lead("tran_ts", "next_ts"), RowNumber("_rn_all"),
                       RunningSum("_is_out", "_rn_out"), RunningSum("_not_out", "_rn_other")],
                      chunk_micros=chunk_micros)
    rn_class = F.when(F.col("calc_col") == CASHOUT, F.col("_rn_out")).otherwise(F.col("_rn_other"))
    grp = (F.col("_rn_all") - rn_class).cast("long")
    return (df.withColumns({
        "time_gap": F.when(seconds_between("tran_ts", "next_ts") > gap_seconds, F.lit("session_end"))
                     .otherwise(F.lit("continue")),
        "credit_status": F.when(F.col("credit_meter") <= F.col("tran_amt"), F.lit("session_end"))
                          .otherwise(F.lit("countinue")),
        "grp": grp,
        "final_num": F.when(F.col("calc_col") == CASHOUT, rn_class).otherwise(grp + 1).cast("long"),
    }).drop("_is_out", "_not_out", "_rn_all", "_rn_out", "_rn_other"))
