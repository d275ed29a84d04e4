"""Driver tables -> the 13 landing tables, in Spark and in DuckDB SQL.

Fixed mappings, each over a whole driver table (or a whole event-type
slice of ``events``):
  orders                 -> game started (w side)
  orders + lineitem sum  -> game ended (o side), at order date + (key % 5) days
  lineitem               -> secondary game started / ended
  events by type         -> bonus, notes, vouchers, game combo, player
                            sessions, profile, status, cabinet
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.plans.adapters import BATCH, table
from meterline.schemas import LANDING


def _conform(df: DataFrame, name: str) -> DataFrame:
    schema = LANDING[name]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _ev(events: DataFrame, event_type: str) -> DataFrame:
    return events.where(F.col("event_type") == event_type).withColumns({
        "egmid": F.col("user_id").cast("string"),
        "eventdatetime": F.col("ts"),
        "customer": F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")),
        "batch_id": F.lit(BATCH),
        "_amt": F.col("value").cast("decimal(18,2)"),
    })


def landing_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    orders, lineitem, events = (table(spark, sf, t) for t in ("orders", "lineitem", "events"))
    o = orders.withColumns({
        "egmid": F.col("o_custkey").cast("string"),
        "deviceid": F.col("o_orderpriority"), "denomid": F.col("o_orderstatus"),
        "gameplaylogsequence": F.col("o_orderkey"),
        "customer": F.concat(F.lit("c"), (F.col("o_custkey") % 3).cast("string")),
        "batch_id": F.lit(BATCH),
    })
    out = {}
    out["primarygamestarted_raw"] = _conform(o.withColumns({
        "eventdatetime": F.col("o_orderdate"),
        "g2s_playercashableamt": F.col("o_totalprice").cast("decimal(18,2)"),
        "g2s_wageredcashableamt": (F.col("o_orderkey") % 997).cast("decimal(18,2)"),
    }), "primarygamestarted_raw")
    ends = lineitem.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("g2s_playercashableamt"))
    out["gameended_raw"] = _conform(
        o.join(ends, o["o_orderkey"] == ends["l_orderkey"], "inner").withColumn(
            "eventdatetime", F.expr("timestampadd(DAY, CAST(o_orderkey % 5 AS INT), o_orderdate)")),
        "gameended_raw")
    li = lineitem.withColumns({
        "id": F.col("l_orderkey"), "egmid": F.col("l_suppkey").cast("string"),
        "eventdatetime": F.col("l_shipdate"), "deviceid": F.col("l_returnflag"),
        "denomid": F.col("l_linestatus"), "gameplaylogsequence": F.col("l_linenumber"),
        "gcmdatetime": F.col("l_shipdate"),
        "commserverid": F.concat(F.lit("cs"), (F.col("l_partkey") % 4).cast("string")),
        "customer": F.concat(F.lit("c"), (F.col("l_suppkey") % 3).cast("string")),
        "batch_id": F.lit(BATCH),
    })
    out["secondarygamestarted_raw"] = _conform(
        li.withColumn("g2s_secwageredamt", F.col("l_quantity").cast("decimal(18,2)")),
        "secondarygamestarted_raw")
    out["secondarygameended_raw"] = _conform(li.withColumns({
        "g2s_secwonamt": F.col("l_extendedprice").cast("decimal(18,2)"),
        "g2s_secwoncnt": F.col("l_partkey") % 3, "g2s_seclostcnt": F.col("l_suppkey") % 2,
        "g2s_sectiedcnt": F.col("l_linenumber") % 2,
    }), "secondarygameended_raw")
    eid = F.col("event_id")
    out["bonusawardpaid_raw"] = _conform(_ev(events, "purchase").withColumns({
        "bonuslogsequence": eid, "g2s_cashableinamt": F.col("_amt"),
        "g2s_playercashableamt": F.col("_amt") + 1}), "bonusawardpaid_raw")
    out["notestacked_raw"] = _conform(_ev(events, "signup").withColumns({
        "noteacceptorlogsequence": eid, "g2s_currencyinamt": F.col("_amt"),
        "g2s_playercashableamt": F.col("_amt")}), "notestacked_raw")
    player = F.concat(F.lit("p"), (F.col("user_id") % 50).cast("string"))
    out["voucherissued_raw"] = _conform(_ev(events, "error").withColumns({
        "transactionid": eid, "transferamt": F.col("_amt"), "voucheramt": F.col("_amt"),
        "playerid": player}), "voucherissued_raw")
    out["voucherredeemed_raw"] = _conform(_ev(events, "signup").withColumns({
        "transactionid": eid, "g2s_cashableinamt": F.col("_amt"), "g2s_playercashableamt": F.col("_amt"),
        "playerid": player}), "voucherredeemed_raw")
    theme = F.concat(F.lit("th"), (eid % 11).cast("string"))
    out["gamecomboactivated_raw"] = _conform(_ev(events, "click").withColumns({
        "themeid": theme, "deviceid": F.concat(F.lit("d"), (F.col("user_id") % 4).cast("string")),
        "denomid": F.concat(F.lit("m"), (eid % 3).cast("string")), "maxwagercredits": F.col("_amt"),
        "paytableid": F.concat(F.lit("pt"), (eid % 5).cast("string"))}), "gamecomboactivated_raw")
    out["stm_raw"] = _conform(_ev(events, "view").withColumns({
        "slotthemeid": theme, "slotthemename": F.concat(F.lit("theme "), (eid % 11).cast("string")),
        "sessionstartdate": F.col("ts"),
        "sessionenddate": F.expr("timestampadd(SECOND, CAST(event_id % 3600 AS INT), ts)")}), "stm_raw")
    out["gameplayprofilereceived_raw"] = _conform(_ev(events, "click").withColumns({
        "deviceid": F.concat(F.lit("d"), (F.col("user_id") % 4).cast("string")),
        "maxwagercredits": F.col("_amt")}), "gameplayprofilereceived_raw")
    out["gameplaystatusreceived_raw"] = _conform(_ev(events, "view").withColumns({
        "themeid": theme, "deviceid": F.concat(F.lit("d"), (F.col("user_id") % 4).cast("string")),
        "paytableid": F.concat(F.lit("pt"), (eid % 5).cast("string"))}), "gameplaystatusreceived_raw")
    out["cabinetprofilereceived_raw"] = _conform(_ev(events, "error").withColumns({
        "areaid": F.when(eid % 5 == 0, F.concat(F.lit("A"), (F.col("user_id") % 9).cast("string"))),
        "location": F.concat(F.lit("loc-"), F.col("user_id").cast("string")),
        "currencyid": F.lit("USD")}), "cabinetprofilereceived_raw")
    return out


_EV = """CAST(user_id AS VARCHAR) AS egmid, ts AS eventdatetime, 'c' || CAST(user_id % 3 AS VARCHAR) AS customer,
    'b0' AS batch_id"""
_AMT = "CAST(value AS DECIMAL(18,2))"
_O = """CAST(o_custkey AS VARCHAR) AS egmid, o_orderpriority AS deviceid, o_orderstatus AS denomid,
    o_orderkey AS gameplaylogsequence, 'c' || CAST(o_custkey % 3 AS VARCHAR) AS customer, 'b0' AS batch_id"""
_LI = """l_orderkey AS id, CAST(l_suppkey AS VARCHAR) AS egmid, l_shipdate AS eventdatetime,
    l_returnflag AS deviceid, l_linestatus AS denomid, CAST(l_linenumber AS BIGINT) AS gameplaylogsequence,
    l_shipdate AS gcmdatetime, 'cs' || CAST(l_partkey % 4 AS VARCHAR) AS commserverid,
    'c' || CAST(l_suppkey % 3 AS VARCHAR) AS customer, 'b0' AS batch_id"""

LANDING_SQL = {
    "primarygamestarted_raw": f"""SELECT {_O}, o_orderdate AS eventdatetime,
    CAST(o_totalprice AS DECIMAL(18,2)) AS g2s_playercashableamt,
    CAST(o_orderkey % 997 AS DECIMAL(18,2)) AS g2s_wageredcashableamt FROM orders""",
    "gameended_raw": f"""SELECT {_O}, o_orderdate + (o_orderkey % 5) * INTERVAL 1 DAY AS eventdatetime,
    e.cash AS g2s_playercashableamt FROM orders JOIN (
      SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS cash FROM lineitem GROUP BY l_orderkey) e
    ON o_orderkey = e.l_orderkey""",
    "secondarygamestarted_raw": f"""SELECT {_LI}, CAST(l_quantity AS DECIMAL(18,2)) AS g2s_secwageredamt
    FROM lineitem""",
    "secondarygameended_raw": f"""SELECT {_LI}, CAST(l_extendedprice AS DECIMAL(18,2)) AS g2s_secwonamt,
    l_partkey % 3 AS g2s_secwoncnt, l_suppkey % 2 AS g2s_seclostcnt,
    CAST(l_linenumber % 2 AS BIGINT) AS g2s_sectiedcnt FROM lineitem""",
    "bonusawardpaid_raw": f"""SELECT {_EV}, event_id AS bonuslogsequence, {_AMT} AS g2s_cashableinamt,
    CAST({_AMT} + 1 AS DECIMAL(18,2)) AS g2s_playercashableamt FROM events WHERE event_type = 'purchase'""",
    "notestacked_raw": f"""SELECT {_EV}, event_id AS noteacceptorlogsequence, {_AMT} AS g2s_currencyinamt,
    {_AMT} AS g2s_playercashableamt FROM events WHERE event_type = 'signup'""",
    "voucherissued_raw": f"""SELECT {_EV}, event_id AS transactionid, {_AMT} AS transferamt,
    {_AMT} AS voucheramt, 'p' || CAST(user_id % 50 AS VARCHAR) AS playerid FROM events WHERE event_type = 'error'""",
    "voucherredeemed_raw": f"""SELECT {_EV}, event_id AS transactionid, {_AMT} AS g2s_cashableinamt,
    {_AMT} AS g2s_playercashableamt, 'p' || CAST(user_id % 50 AS VARCHAR) AS playerid
    FROM events WHERE event_type = 'signup'""",
    "gamecomboactivated_raw": f"""SELECT {_EV}, 'th' || CAST(event_id % 11 AS VARCHAR) AS themeid,
    'd' || CAST(user_id % 4 AS VARCHAR) AS deviceid, 'm' || CAST(event_id % 3 AS VARCHAR) AS denomid,
    {_AMT} AS maxwagercredits, 'pt' || CAST(event_id % 5 AS VARCHAR) AS paytableid
    FROM events WHERE event_type = 'click'""",
    "stm_raw": f"""SELECT {_EV}, 'th' || CAST(event_id % 11 AS VARCHAR) AS slotthemeid,
    'theme ' || CAST(event_id % 11 AS VARCHAR) AS slotthemename, ts AS sessionstartdate,
    ts + (event_id % 3600) * INTERVAL 1 SECOND AS sessionenddate FROM events WHERE event_type = 'view'""",
    "gameplayprofilereceived_raw": f"""SELECT {_EV}, 'd' || CAST(user_id % 4 AS VARCHAR) AS deviceid,
    {_AMT} AS maxwagercredits FROM events WHERE event_type = 'click'""",
    "gameplaystatusreceived_raw": f"""SELECT {_EV}, 'th' || CAST(event_id % 11 AS VARCHAR) AS themeid,
    'd' || CAST(user_id % 4 AS VARCHAR) AS deviceid, 'pt' || CAST(event_id % 5 AS VARCHAR) AS paytableid
    FROM events WHERE event_type = 'view'""",
    "cabinetprofilereceived_raw": f"""SELECT {_EV},
    CASE WHEN event_id % 5 = 0 THEN 'A' || CAST(user_id % 9 AS VARCHAR) END AS areaid,
    'loc-' || CAST(user_id AS VARCHAR) AS location, 'USD' AS currencyid FROM events WHERE event_type = 'error'""",
}


def landing_ctes() -> str:
    return ",\n".join(f"{k} AS ({v})" for k, v in LANDING_SQL.items())
