"""Line dedup by a log-template tree.

Every line walks a tree of fixed depth: first by its number of tokens, then
by its first ``LEADING`` tokens (tokens with a digit count as the variable
mark). The lines of a leaf are generalised position by position: a token
that less than one in ``COMMON`` lines of the leaf (or fewer than
``MIN_DOCS``) have at its place is a variable field and becomes the mark. The
rule is a share, so a template is the same however often it occurs. Where it
leaves less than ``CONSTANT`` of a line constant, as in a leaf of many small
templates, only tokens of fewer than ``MIN_DOCS`` lines become the mark. What
remains is the line's template. A template recurs if at least ``CONSTANT`` of
its tokens are constant and ``MIN_DOCS`` different texts have it. Its lines are dropped from every text
but the first (the one with the smallest id), so nothing vanishes from the
corpus altogether. Exact copies of a text count as one text here.

Only DataFrame functions. Leaves with fewer than ``MIN_DOCS`` lines are cut
off on narrow hashes before any line's text is shuffled; equal lines are
summed before their tokens are exploded, so a line in a third of all
documents is one row there; drop lists are sets of line numbers of one text.

Cases: a NULL or empty text has no lines and stays as it is; blank lines are
never dropped; ties in "first" go to the smaller text key; rows with a NULL
id can be first only among themselves and are ordered before others; repeated
rows get the same result; an empty table gives no rows. The input's columns
are all returned, with the new text under the old name, plus counters whose
names are prefixed until none clashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import free_name, table

LEADING = 3
MIN_DOCS = 10
CONSTANT = 0.7
COMMON = 20  # a token of one in so many lines of its leaf is no field
MARK = "<*>"


def masked(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), MARK).otherwise(t))


def text_key(text: Column) -> Column:
    """96 bits that stand for a whole text."""
    return F.struct(F.xxhash64(text).alias("a"), F.hash(text).alias("b"))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def leaf_of(line: Column) -> Column:
    """Tree path of a trimmed line: its token count and its first masked tokens."""
    blanks = F.length(line) - F.length(F.translate(line, " ", ""))
    return F.xxhash64(blanks, masked(F.split(F.substring_index(line, " ", LEADING), " ", -1)))


def templates(lines: DataFrame, min_docs: int, constant: float, common: int = COMMON) -> DataFrame:
    """(line, template): each line's template, if enough of it is constant.

    ``lines``: (leaf, line, n) with distinct trimmed lines and how often they
    occur. A token's level is 2 if its share of the leaf is common, 1 if only
    ``min_docs`` lines have it, else 0; the template keeps level 2 where that is
    enough of the line, else levels 1 and 2. Lines that share the finer template
    share the coarser one, so a line never leaves its group as the table grows.
    """
    at = lines.select("line", "leaf", "n", F.posexplode(masked(F.split("line", " ", -1))).alias("p", "token"))
    totals = lines.groupBy("leaf").agg(F.sum("n").alias("total"))
    support = (at.groupBy("leaf", "p", "token").agg(F.sum("n").alias("support"))
               .filter((F.col("support") >= min_docs) & (F.col("token") != MARK)).join(totals, "leaf")
               .select("leaf", "p", "token", F.when(F.col("support") * common >= F.col("total"), 2).otherwise(1).alias("level")))
    kept = at.drop("n").join(support, ["leaf", "p", "token"], "left").withColumn("level", F.coalesce("level", F.lit(0)))
    need = F.lit(constant) * F.col("size")
    level = F.when(F.col("commons") >= need, 2).otherwise(1)
    return (kept.groupBy("line").agg(F.sort_array(F.collect_list(F.struct("p", "token", "level"))).alias("e"),
                                     F.count(F.lit(1)).alias("size"), F.count_if(F.col("level") >= 1).alias("constants"),
                                     F.count_if(F.col("level") >= 2).alias("commons"))
            .filter(F.col("constants") >= need)
            .select("line", F.array_join(F.transform("e", lambda x: F.when(x["level"] >= level, x["token"]).otherwise(MARK)),
                                         " ").alias("template")))


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                   constant: float = CONSTANT) -> DataFrame:
    """Every column of ``docs`` with recurring lines dropped from the text, plus lines and dropped."""
    text = F.col(f"`{text_col}`").cast("string")
    basis = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).filter(F.col("text").isNotNull())
    at = (basis.select("id", text_key(F.col("text")).alias("key"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
          .withColumn("line", F.trim("line")).filter(F.col("line") != ""))
    leaves = (at.select(leaf_of(F.col("line")).alias("leaf")).groupBy("leaf").count()
              .filter(F.col("count") >= min_docs).select("leaf"))
    leaves = table(leaves, "lines-leaves")  # its own exchange in the join, so a hot leaf can be split
    seen = table(at.withColumn("leaf", leaf_of(F.col("line"))).join(leaves, "leaf", "left_semi")
                 .groupBy("line", "key", "pos").agg(F.min("leaf").alias("leaf"), F.min("id").alias("id")), "lines-seen")
    lines = seen.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("n"))
    general = table(templates(lines, min_docs, constant), "lines-general")  # its own exchange, so a hot line can be split
    found = table(seen.join(general, "line")
                  .select(F.xxhash64("template", "leaf").alias("template"), "key", "pos", "id"), "lines-templates")
    recurring = (found.groupBy("template", "key").agg(F.min("id").alias("id"))
                 .groupBy("template").agg(F.count(F.lit(1)).alias("texts"), F.min(F.struct("id", "key")).alias("first"))
                 .filter(F.col("texts") >= min_docs).select("template", F.col("first.key").alias("first")))
    recurring = table(recurring, "lines-recurring")  # likewise for a hot template
    drops = (found.join(recurring, "template").filter(F.col("key") != F.col("first"))
             .groupBy("key").agg(F.collect_set("pos").alias("drops")))

    key, gone, rows = (free_name(docs.columns, c) for c in ("__key", "__drops", "__lines"))
    n_lines, n_dropped = free_name(docs.columns, "lines"), free_name(docs.columns, "dropped")
    out = (docs.withColumn(key, text_key(text))
           .join(drops.select(F.col("key").alias(f"{key}_r"), F.col("drops").alias(gone)),
                 F.col(key) == F.col(f"{key}_r"), "left").withColumn(rows, lines_of(text)))
    stay = F.array_except(F.sequence(F.lit(0), F.size(rows) - 1), F.col(gone))
    new = F.when(F.col(gone).isNull(), text).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col(rows), i)), "\n"))
    return out.select(
        *[(new.alias(c) if c == text_col else F.col(f"`{c}`")) for c in docs.columns],
        F.when(text.isNull(), 0).otherwise(F.size(rows)).alias(n_lines),
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).alias(n_dropped))
