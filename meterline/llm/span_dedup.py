"""Substring dedup by sliding sentence spans.

A text is cut into sentences (up to and with its closing marks or line end).
A sentence of ``LONG_WORDS`` or more words is cut again, after every word with
a rare letter, so text without marks has units too, and the cuts depend on
the words alone, wherever a passage stands. Every run of two or more
consecutive units with ``MIN_WORDS`` words in all, and every single unit of
``LONG_WORDS``, is a span. Spans are joined globally: of every span that occurs
more than once, the first occurrence (smallest id, then position) stays, and
all units covered by any other occurrence are removed.

Only the shortest span that begins at each unit and the shortest that ends at
each are hashed: every longer span is covered by such spans inside it, and
where it repeats they repeat with it, so the units removed are those of all
runs of every length (the tests compare with all runs). Every unit counts at least one
word, so no shortest span is longer than ``MIN_WORDS`` units. Where words
aren't set apart by blanks, ``WORD_CHARS`` characters count as a word.

Spans are counted by partial aggregation before the shuffle, so a passage in
a third of all documents is one row per task; only the spans' hashes (96
bits) travel, and the join back to the repeated ones is an equi-join that
Spark can split where a span is hot.

Cases: a NULL or empty text has no sentences and stays as it is; blank
sentences count as sentences of one word; rows with equal id and text are one
document and get the same result; a NULL id orders before others; an empty
table gives no rows; a text of any length has at most two spans a unit. The input's columns are all returned, with the new text
under the old name, plus counters whose names are prefixed until none
clashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import free_name, table

MIN_WORDS = 10
LONG_WORDS = 20
WORD_CHARS = 8
SENTENCE = r"[^.!?\n]*[.!?\n]+|[^.!?\n]+"
WIDE_MARKS = "。！？"
WIDE_SENTENCE = f"[^.!?{WIDE_MARKS}\\n]*[.!?{WIDE_MARKS}\\n]+|[^.!?{WIDE_MARKS}\\n]+"
PIECE = r"[^vkVK]*[vkVK][^ ]*[ ]*|[^vkVK]+"


def bare(unit: Column) -> Column:
    """A unit without the blanks around it; line ends and tabs are blanks."""
    for c in "\n\t\r":
        unit = F.replace(unit, F.lit(c), F.lit(" "))
    return F.trim(unit)


def weight(unit: Column) -> Column:
    """Words of a bare unit, one at least: the blanks in it and one."""
    blanks = F.length(unit) - F.length(F.replace(unit, F.lit(" "), F.lit("")))
    return F.greatest(blanks + 1, F.floor(F.length(unit) / WORD_CHARS).cast("int"))


def sentences(text: Column) -> Column:
    """The text's units; joined without a separator they are the text."""
    wide = F.contains(text, F.lit(WIDE_MARKS[0]))
    for c in WIDE_MARKS[1:]:
        wide = wide | F.contains(text, F.lit(c))
    cut = F.when(wide, F.regexp_extract_all(text, F.lit(WIDE_SENTENCE), F.lit(0))).otherwise(
        F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)))
    return F.flatten(F.transform(cut, lambda s: F.when(
        weight(bare(s)) >= LONG_WORDS, F.regexp_extract_all(s, F.lit(PIECE), F.lit(0))).otherwise(F.array(s))))


def spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, key, pos, run, a, b): the shortest spans that begin or end at each unit. ``docs``: (id, text)."""
    cut = (docs.select("id", F.xxhash64("text").alias("key"), F.transform(sentences(F.col("text")), bare).alias("s"))
           .select("id", "key", F.transform("s", lambda x: F.xxhash64(x)).alias("h"), F.transform("s", weight).alias("w")))
    w = F.col("w")

    def longer(i: Column, step: int) -> list[tuple[int, Column]]:
        """(run, words) of the runs of 2, 3, ... units from i, onwards or backwards; no words beyond the text."""
        out, words = [], F.get(w, i)
        for run in range(2, max(2, min_words) + 1):
            words = words + F.get(w, i + step * (run - 1))
            out.append((run, words))
        return out

    def begins(i: Column) -> Column:
        out = F.lit(None).cast("int")
        for run, words in reversed(longer(i, 1)):
            out = F.when(words >= min_words, run).otherwise(out)
        return F.struct(i.alias("at"), F.when(F.get(w, i) >= LONG_WORDS, 1).otherwise(out).alias("run"))

    def ends(j: Column) -> Column:
        """The shortest run that ends at j, as a negative number, unless it is the shortest that begins where it does."""
        out = F.lit(None).cast("int")
        for run, words in reversed(longer(j, -1)):
            first = F.get(w, j - (run - 1))
            other = first >= LONG_WORDS if run == 2 else (first >= LONG_WORDS) | (words - F.get(w, j) >= min_words)
            out = F.when(words >= min_words, F.when(other, -run)).otherwise(out)
        return F.struct(j.alias("at"), F.when(F.get(w, j) < LONG_WORDS, out).alias("run"))

    places = F.when(F.size("w") > 0, F.sequence(F.lit(0), F.size("w") - 1))
    both = F.concat(F.transform(places, begins), F.transform(places, ends))
    at = cut.select("id", "key", "h", F.inline(both)).filter(F.col("run").isNotNull()).select(
        "id", "key", "h", F.when(F.col("run") < 0, F.col("at") + F.col("run") + 1).otherwise(F.col("at")).alias("pos"),
        F.abs("run").alias("run"))
    span = F.slice("h", F.col("pos") + 1, F.col("run"))
    return at.select("id", "key", "pos", "run", F.xxhash64(span).alias("a"), F.hash(span).alias("b"))


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_words: int = MIN_WORDS) -> DataFrame:
    """Every column of ``docs`` with repeated spans removed from the text, plus sentences and removed."""
    text = F.col(f"`{text_col}`").cast("string")
    basis = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).filter(F.col("text").isNotNull())
    found = table(spans(basis, min_words), "spans")
    repeated = (found.groupBy("a", "b", "run")
                .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "key", "pos")).alias("first"))
                .filter(F.col("n") > 1).drop("n"))
    repeated = table(repeated, "spans-repeated")  # its own exchange in the join, so a hot span can be split
    place = F.struct("id", "key", "pos")
    drops = (found.join(repeated, ["a", "b", "run"]).filter(~place.eqNullSafe(F.col("first")))
             .groupBy("id", "key").agg(F.collect_set(F.struct("pos", "run")).alias("drops")))

    key, gone, rows = (free_name(docs.columns, c) for c in ("__key", "__drops", "__sentences"))
    n_all, n_removed = free_name(docs.columns, "sentences"), free_name(docs.columns, "removed")
    covered = F.array_distinct(F.flatten(F.transform(
        "drops", lambda d: F.sequence(d["pos"], d["pos"] + d["run"] - 1))))
    drops = drops.select(F.col("id").alias(f"{key}_id"), F.col("key").alias(f"{key}_r"), covered.alias(gone))
    out = (docs.withColumn(key, F.xxhash64(text))
           .join(drops, (F.col(key) == F.col(f"{key}_r")) & F.col(f"`{id_col}`").eqNullSafe(F.col(f"{key}_id")), "left")
           .withColumn(rows, sentences(text)))
    stay = F.array_except(F.sequence(F.lit(0), F.size(rows) - 1), F.col(gone))
    new = F.when(F.col(gone).isNull(), text).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col(rows), i)), ""))
    return out.select(
        *[(new.alias(c) if c == text_col else F.col(f"`{c}`")) for c in docs.columns],
        F.when(text.isNull(), 0).otherwise(F.size(rows)).alias(n_all),
        F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).alias(n_removed))
