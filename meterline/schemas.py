"""Schema registry: landing tables, canonical event log and pipeline tables.

The pipeline declares no DDL; these Spark types are our choice. Money and
meters are decimal(18,2) so results are exact. Landing column names are
the lower-cased file column names (Spark resolves names case-insensitively).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, B, I = T.StringType(), T.LongType(), T.BooleanType(), T.IntegerType()
TS = T.TimestampNTZType()
D = T.DecimalType(18, 2)


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TENANT = (("customer", S), ("batch_id", S))

# --- Landing tables (one folder of parquet files each) ---------------------
LANDING: dict[str, T.StructType] = {
    "primarygamestarted_raw": struct(
        ("egmid", S), ("deviceid", S), ("denomid", S), ("eventdatetime", TS),
        ("gameplaylogsequence", L), ("g2s_playercashableamt", D), ("g2s_wageredcashableamt", D), *TENANT),
    "gameended_raw": struct(
        ("egmid", S), ("deviceid", S), ("denomid", S), ("eventdatetime", TS),
        ("gameplaylogsequence", L), ("g2s_playercashableamt", D), *TENANT),
    "secondarygamestarted_raw": struct(
        ("id", L), ("egmid", S), ("eventdatetime", TS), ("deviceid", S), ("denomid", S),
        ("gameplaylogsequence", L), ("gcmdatetime", TS), ("commserverid", S), ("g2s_secwageredamt", D),
        *TENANT),
    "secondarygameended_raw": struct(
        ("id", L), ("egmid", S), ("eventdatetime", TS), ("deviceid", S), ("denomid", S),
        ("gameplaylogsequence", L), ("gcmdatetime", TS), ("commserverid", S), ("g2s_secwonamt", D),
        ("g2s_secwoncnt", L), ("g2s_seclostcnt", L), ("g2s_sectiedcnt", L), *TENANT),
    "bonusawardpaid_raw": struct(
        ("egmid", S), ("eventdatetime", TS), ("bonuslogsequence", L), ("g2s_cashableinamt", D),
        ("g2s_playercashableamt", D), *TENANT),
    "notestacked_raw": struct(
        ("egmid", S), ("eventdatetime", TS), ("noteacceptorlogsequence", L), ("g2s_currencyinamt", D),
        ("g2s_playercashableamt", D), *TENANT),
    "voucherissued_raw": struct(
        ("egmid", S), ("eventdatetime", TS), ("transactionid", L), ("transferamt", D), ("voucheramt", D),
        ("playerid", S), *TENANT),
    "voucherredeemed_raw": struct(
        ("egmid", S), ("eventdatetime", TS), ("transactionid", L), ("g2s_cashableinamt", D),
        ("g2s_playercashableamt", D), ("playerid", S), *TENANT),
    "gamecomboactivated_raw": struct(
        ("egmid", S), ("themeid", S), ("deviceid", S), ("denomid", S), ("eventdatetime", TS),
        ("maxwagercredits", D), ("paytableid", S), *TENANT),
    "stm_raw": struct(
        ("egmid", S), ("slotthemeid", S), ("slotthemename", S), ("sessionstartdate", TS),
        ("sessionenddate", TS), *TENANT),
    "gameplayprofilereceived_raw": struct(
        ("egmid", S), ("deviceid", S), ("eventdatetime", TS), ("maxwagercredits", D), *TENANT),
    "gameplaystatusreceived_raw": struct(
        ("egmid", S), ("themeid", S), ("deviceid", S), ("eventdatetime", TS), ("paytableid", S), *TENANT),
    "cabinetprofilereceived_raw": struct(
        ("egmid", S), ("eventdatetime", TS), ("areaid", S), ("location", S), ("currencyid", S), *TENANT),
    # loaded, but read by no later stage; nothing states their other columns
    "gameavailability_raw": struct(("egmid", S), ("eventdatetime", TS), *TENANT),
    "optionlistreceived_raw": struct(("egmid", S), ("eventdatetime", TS), *TENANT),
}

# --- Canonical event log ------------------------------------------------------
CANONICAL = struct(
    ("rectype", S), ("egm_id", S), ("theme_id", S), ("theme_name", S), ("device_id", S),
    ("denom_id", S), ("tran_ts", TS), ("seq", L), ("credit_meter", D), ("tran_amt", D),
    ("payout", D), ("player_id", S), ("customer", S), ("paytable", S), ("area_id", S),
    ("location", S), ("currency_id", S), ("batch_id", S),
)
CANONICAL_COLUMNS = [f.name for f in CANONICAL.fields]

# --- Pipeline tables ----------------------------------------------------------
VIOLATIONS = struct(("customer", S), ("batch_id", S), ("egm_id", S), ("session_id", S),
                    ("error_type", S), ("loaded_at", T.TimestampType()))

LOAD_LOG = struct(
    ("source_name", S), ("file_name", S), ("location", S), ("load_start", T.TimestampType()),
    ("load_status", S), ("load_end", T.TimestampType()), ("duration_min", L), ("error_cnt", L),
    ("batch_id", S), ("data_min", TS), ("data_max", TS),
)

# Log rows as stored: with the load (one run over a set of files) that wrote them, and what is wrong with the file.
STORED_LOG = T.StructType([*LOAD_LOG.fields, T.StructField("load_id", S, True), T.StructField("error", S, True)])
REJECTS = struct(("source_name", S), ("table_name", S), ("file_name", S), ("error_columns", S), ("raw_row", S),
                 ("batch_id", S), ("load_id", S))
