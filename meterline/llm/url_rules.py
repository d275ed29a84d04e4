"""URL rules by a sort-merge range join.

A host is turned round into a canonical key, label by label and closed by a
dot: ``a.example.org`` becomes ``org.example.a.``. A rule for a host and all
its subdomains is then the interval of keys that begin with the rule's key,
and the intervals of any rule set are nested or apart. Rule starts and urls
are sorted together by key. The sweep keeps, at every url, the stack of the
rule that started last: that rule and all rules around it. Rules whose
interval has already closed are popped by testing the prefix; of those left,
the longest whose path also fits decides.

The sort is a range partitioning on (key, path, id), so one hot host spreads
over many chunks. The stack that is open at a chunk's beginning comes from
the last rule start of earlier chunks, found over one summary row per chunk.
Everything is DataFrame code.

Cases: a NULL url or one without ``://`` has an empty host and path and gets
the default verdict; repeated urls are judged row by row; of equally long
rules that fit, the one with the longer host wins, then ``block``; an empty
table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import partitions, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE_SCHEMA = "verdict string, rule string"


def host_of(url: Column) -> Column:
    """Host after the first ``://``, ASCII-lower-cased; empty for NULL or no ``://``."""
    found = F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def canonical(host: Column) -> Column:
    """Labels from the top down, each closed by a dot."""
    return F.concat(F.concat_ws(".", labels(host)), F.lit("."))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): for each host that has rules, its rules and those of the hosts above it."""
    r = rules.select("verdict", "rule", F.regexp_extract("rule", r"^[^/]*", 0).alias("host"),
                     F.regexp_extract("rule", r"^[^/]*([\s\S]*)$", 1).alias("path"))
    r = r.withColumn("key", canonical(F.col("host")))
    above = r.select("key", "host").distinct().withColumn("ls", labels(F.col("host"))).select(
        "key", F.explode(F.transform(F.sequence(F.lit(1), F.size("ls")), lambda i: F.concat(
            F.concat_ws(".", F.slice("ls", F.lit(1), i)), F.lit(".")))).alias("above"))
    parent = r.select(F.col("key").alias("above"), F.struct(
        F.length("rule").alias("len"), F.length("host").alias("host_len"), "verdict", "rule",
        F.col("key").alias("prefix"), "path").alias("entry"))
    return above.join(parent, "above").groupBy("key").agg(F.collect_list("entry").alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    spark = pages.sparkSession
    url = F.col(url_col).cast("string")
    stacks = rule_stacks(rules)
    urls = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    urls = urls.select(canonical(F.col("host")).alias("key"), F.lit(1).alias("kind"), "page_id", "host", "path",
                       F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"))
    id_type = urls.schema["page_id"].dataType
    starts = stacks.select("key", F.lit(0).alias("kind"), F.lit(None).cast(id_type).alias("page_id"),
                           F.lit("").alias("host"), F.lit("").alias("path"), "stack")
    swept = (starts.unionByName(urls)
             .repartitionByRange(partitions(spark), "key", "kind", "path", "page_id")
             .withColumn("chunk", F.spark_partition_id()))
    swept = table(swept, "url-sweep")  # a chunk's number must be the same for all readers

    ends = swept.groupBy("chunk").agg(F.max_by(F.when(F.col("kind") == 0, F.col("stack")),
                                               F.when(F.col("kind") == 0, F.col("key"))).alias("last"))
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # one row per chunk
    opened = ends.select("chunk", F.last("last", ignorenulls=True).over(before).alias("opened"))
    sweep = Window.partitionBy("chunk").orderBy("key", "kind", "path", "page_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    active = F.filter(F.coalesce("stack", "opened"), lambda r: F.col("key").startswith(r["prefix"])
                      & F.col("path").startswith(r["path"]))
    best = F.array_max(F.transform(active, lambda r: F.struct(r["len"], r["host_len"], r["verdict"], r["rule"])))
    return (swept.withColumn("stack", F.last("stack", ignorenulls=True).over(sweep))
            .filter(F.col("kind") == 1)
            .join(opened, "chunk", "left")
            .withColumn("best", best)
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
