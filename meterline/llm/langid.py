"""Language identification by Bayesian evidence fusion.

The log posterior of a language adds four pieces of evidence:

* text: mean log likelihood of the text's byte trigrams (hashed, letters
  only) under one table per language, counted over all documents that
  declare the language, times the number of trigrams, of which at most
  ``EVIDENCE`` count as independent. A class ``und`` with evenly spread
  trigrams competes, so text in none of the languages is recognised as such;
* declared markup language: how often texts of each language declare it;
* address suffix: how often texts of each language come from hosts under it;
* host prior: language shares of the host, smoothed towards its domain, that
  towards all documents (``KAPPA`` pseudo-documents at each level).

The last three come from grouped aggregation of the text-only decisions over
all documents, so every table grows with languages, declared codes, suffixes
or hosts, never with one host's documents; a hot host is summed by partial
aggregation before the shuffle. Trigram tables and the declared-code and
suffix tables have a fixed number of rows; hosts are joined, and Spark picks
the join by their measured size.

A document is accepted if its most probable class is a language with a
posterior of at least ``MIN_POSTERIOR``.

Cases: a NULL or empty text, or one without letters, has no text evidence and
is rejected as ``und``, whatever it declares; a NULL or unknown declared
code, host or suffix is neutral; ties go to the language named first;
repeated rows are each decided alike; with an empty table no row is returned.
``identify`` returns the columns of its input besides its own, whose names
are prefixed until none clashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.common import free_name, small_batches, table

LANGUAGES = ("de", "en", "es", "fr")
UNDETERMINED = "und"
TRIGRAMS = 8192
EVIDENCE = 100
SMOOTHING = 0.5
NOISE = 0.2  # share of a text's trigrams that may come from names, codes and addresses
KAPPA = 20.0
PRIOR_UNDETERMINED = 0.01
MIN_POSTERIOR = 0.5


def fold_bytes() -> np.ndarray:
    """Each byte as it is counted: ASCII letters in lower case, non-ASCII as is, the rest a blank."""
    fold = np.full(256, 32, np.uint32)
    fold[128:] = np.arange(128, 256)
    for low in range(ord("a"), ord("z") + 1):
        fold[low] = fold[low - 32] = low
    return fold


FOLD = fold_bytes()


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the whole text whose middle byte belongs to a letter."""
    b = FOLD[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    if len(b) < 3:
        b = np.concatenate(([32], b, [32])).astype(np.uint32) if len(b) else np.full(3, 32, np.uint32)
    code = ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(19)
    return code[b[1:-1] != 32]


def markup_language(html: Column) -> Column:
    """Two-letter code that a page's ``lang`` attribute declares; NULL if none."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([a-zA-Z]{2})", 1))
    return F.when(found != "", found)


def suffix_of(host: Column) -> Column:
    """Last label of a host name; NULL where there's no dot."""
    return F.when(F.instr(host, ".") > 0, F.lower(F.element_at(F.split(host, r"\."), -1)))


def domain_of(host: Column) -> Column:
    """Last two labels of a host name (the host itself if it has fewer)."""
    parts = F.split(host, r"\.")
    return F.when(F.size(parts) > 2, F.concat_ws(".", F.slice(parts, -2, 2))).otherwise(host)


def trigram_tables(texts: DataFrame, languages: tuple[str, ...]) -> np.ndarray:
    """Log probability of each trigram in each language, and evenly spread for ``und``.

    ``texts``: (text, declared). Counted over all documents that declare a language.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(languages), TRIGRAMS), np.int64)
        at = {code: k for k, code in enumerate(languages)}
        for batch in batches:
            for text, declared in zip(batch["text"], batch["declared"]):
                total[at[declared]] += np.bincount(trigrams(text), minlength=TRIGRAMS)
        language, trigram = np.nonzero(total)
        yield pd.DataFrame({"language": language, "trigram": trigram, "n": total[language, trigram]})

    rows = (texts.filter(F.col("declared").isin(*languages) & F.col("text").isNotNull())
            .mapInPandas(count, "language int, trigram int, n long")
            .groupBy("language", "trigram").agg(F.sum("n").alias("n")).collect())  # languages x TRIGRAMS rows
    counts = np.full((len(languages), TRIGRAMS), SMOOTHING)
    for r in rows:
        counts[r["language"], r["trigram"]] += r["n"]
    counts = np.vstack((counts, np.ones(TRIGRAMS)))
    p = (1 - NOISE) * counts / counts.sum(axis=1, keepdims=True) + NOISE / TRIGRAMS
    return np.log(p).astype(np.float32)


def text_evidence(df: DataFrame, text_col: str, languages: tuple[str, ...], log_p: np.ndarray, out: str) -> DataFrame:
    """``df`` with the tempered text log likelihoods as array ``out``; NULL without letters."""
    model = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(log_p.T))
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.value
        for batch in batches:
            found = []
            for text in batch.column(text_col).to_pylist():
                grams = trigrams(text) if text else np.empty(0, np.uint32)
                if not len(grams):
                    found.append(None)
                    continue
                counts = np.bincount(grams, minlength=TRIGRAMS).astype(np.float32)
                found.append((counts @ tables) * (min(len(grams), EVIDENCE) / len(grams)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.float32()))],
                                             names=[*batch.schema.names, out])

    return df.mapInArrow(weigh, schema)


def smoothed(n: Column, above: Column) -> Column:
    """Language shares of counts ``n``, smoothed towards the shares ``above``."""
    whole = F.aggregate(n, F.lit(0.0), lambda a, x: a + x) + KAPPA
    return F.transform(F.zip_with(n, above, lambda x, p: x + KAPPA * p), lambda x: x / whole)


def identify(docs: DataFrame, text_col: str = "text", declared_col: str | None = "lang", host_col: str | None = "source",
             languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """Every column of ``docs`` plus language, posterior, accepted and text_language."""
    spark = docs.sparkSession
    small_batches(spark)
    null = F.lit(None).cast("string")
    declared = F.lower(F.col(declared_col).cast("string")) if declared_col else null
    host = F.lower(F.col(host_col).cast("string")) if host_col else null
    basis = docs.select(F.col(text_col).cast("string").alias("text"), declared.alias("declared"), host.alias("host"))
    log_p = trigram_tables(basis.select("text", "declared"), languages)

    # Text-only decisions of all documents, and the evidence tables counted from them.
    k = len(languages)
    best = F.array_position("e", F.array_max("e")) - 1
    read = text_evidence(basis, "text", languages, log_p, "e").filter(F.col("e").isNotNull()).select(
        "declared", "host", best.cast("int").alias("best")).filter(F.col("best") < k)
    cells = read.groupBy("declared", "host", "best").agg(F.count(F.lit(1)).alias("docs"))
    cells = table(cells, "langid-cells")  # declared codes x hosts x languages
    weight = F.col("docs").cast("double")
    by = lambda key: (cells.filter(key.isNotNull()).groupBy(key.alias("key"))
                      .agg(F.array(*[F.sum(F.when(F.col("best") == i, weight).otherwise(0.0)) for i in range(k)]).alias("n")))
    found = {r["best"]: float(r["docs"]) for r in cells.groupBy("best").agg(F.sum("docs").alias("docs")).collect()}
    totals = np.array([found.get(i, 0.0) for i in range(k)])
    base = (totals + 1) / (totals.sum() + k)

    def log_given_language(counts: DataFrame, size: int) -> DataFrame:
        """(key, array): log P(key | language), one pseudo-document for each of ``size`` keys."""
        return counts.select("key", F.array(*[F.log((F.col("n")[i] + 1) / F.lit(float(totals[i] + size)))
                                              for i in range(k)]).alias("p"))

    codes = by(F.col("declared"))
    suffixes = by(suffix_of(F.col("host")))
    n_codes, n_suffixes = codes.count() + 1, suffixes.count() + 1
    codes, suffixes = log_given_language(codes, n_codes), log_given_language(suffixes, n_suffixes)
    flat = F.array(*[F.lit(float(x)) for x in base])
    domains = by(domain_of(F.col("host"))).select(F.col("key").alias("domain"), smoothed(F.col("n"), flat).alias("above"))
    hosts = (by(F.col("host")).withColumn("domain", domain_of(F.col("key"))).join(domains, "domain")
             .select("key", smoothed(F.col("n"), F.col("above")).alias("p")))

    name = lambda base_name: free_name(docs.columns, base_name)
    e, code, at, tail = name("__evidence"), name("__declared"), name("__host"), name("__suffix")
    p_code, p_suffix, p_host, post = name("__p_code"), name("__p_suffix"), name("__p_host"), name("__posterior")
    found = text_evidence(docs, text_col, languages, log_p, e)
    found = found.withColumns({code: declared, at: host}).withColumn(tail, suffix_of(F.col(at)))
    for key, part, col in ((code, codes, p_code), (tail, suffixes, p_suffix), (at, hosts, p_host)):
        found = found.join(part.select(F.col("key").alias(f"{col}_key"), F.col("p").alias(col)),
                           F.col(key) == F.col(f"{col}_key"), "left").drop(f"{col}_key")
    zero = F.array(*[F.lit(0.0)] * k)
    prior = F.transform(F.coalesce(p_host, flat), lambda p: F.log(p * (1 - PRIOR_UNDETERMINED)))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    known = add(add(add(F.slice(F.col(e), 1, k), prior), F.coalesce(p_code, zero)), F.coalesce(p_suffix, zero))
    # und declares and is hosted as the average document
    other = (F.col(e)[k] + float(np.log(PRIOR_UNDETERMINED))
             + F.coalesce(F.array_min(p_code), F.lit(0.0)) + F.coalesce(F.array_min(p_suffix), F.lit(0.0)))
    logs = F.concat(known, F.array(other))
    found = found.withColumn(post, F.transform(logs, lambda x: F.exp(x - F.array_max(logs))))
    whole = F.aggregate(F.col(post), F.lit(0.0), lambda a, x: a + x)
    names = F.array(*[F.lit(x) for x in (*languages, UNDETERMINED)])
    language = F.coalesce(F.get(names, (F.array_position(post, F.array_max(post)) - 1).cast("int")), F.lit(UNDETERMINED))
    posterior = F.coalesce(F.array_max(post) / whole, F.lit(0.0))
    text_language = F.get(names, (F.array_position(e, F.array_max(e)) - 1).cast("int"))
    return found.select(
        *[F.col(f"`{c}`") for c in docs.columns], language.alias(name("language")), posterior.alias(name("posterior")),
        ((language != UNDETERMINED) & (posterior >= MIN_POSTERIOR)).alias(name("accepted")),
        text_language.alias(name("text_language")))
