"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text becomes counts of terms: pairs of neighbouring character classes
(letters by case, digits, blanks, each punctuation mark), hashed words, words
that repeat the word before them, and length buckets. Document frequencies
of the terms are counted over *all* documents. The classifier is fitted on a
bounded sample of labelled rows (``MAX_LABELLED``, the documented bound): a
truncated SVD of their tf-idf rows gives the latent space, and their vectors
there are the voters. Voters and projection are a fixed-size broadcast
(MAX_LABELLED x RANK and TERMS x RANK floats).

Every document is then projected and compared with every voter in exact
blocked cosine products. Its score is the mean label of its ``NEIGHBOURS``
nearest voters, weighted by similarity.

Cases: a NULL or empty text has the term of the shortest length bucket and is
scored like any other; with no usable label every score is 0.5; several
labels of one document are one voter each; a document id that occurs more
than once lends the smallest of its texts to its labels; rows with a NULL
label or id aren't learned from; repeated rows are each scored; ties among
neighbours go to the voter that comes first by id; an empty table gives no
rows; other columns are neither read nor returned.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import small_batches, text_or_empty

MAX_LABELLED = 4096
RANK = 48
NEIGHBOURS = 15
CLASSES = 40
WORD_TERMS = 1024
WORD_WEIGHT = 0.3
LENGTH_TERMS = 24
REPEAT_TERM = CLASSES * CLASSES
FIRST_LENGTH = REPEAT_TERM + 8
FIRST_WORD = FIRST_LENGTH + LENGTH_TERMS
TERMS = FIRST_WORD + WORD_TERMS
DEFAULT_SCORE = 0.5
THRESHOLD = 0.7


def character_classes() -> np.ndarray:
    """Class of each byte: lower, upper, digit, blank, line end, non-ASCII, other, then each ASCII mark."""
    table = np.full(256, 6, np.int64)
    table[ord("a"):ord("z") + 1], table[ord("A"):ord("Z") + 1], table[ord("0"):ord("9") + 1] = 0, 1, 2
    table[[32, 9]], table[[10, 13]], table[128:] = 3, 4, 5
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    table[marks] = 7 + np.arange(len(marks))
    return table


CLASS_OF = character_classes()


def term_counts(text: str) -> np.ndarray:
    """Counts of all TERMS of one text, whole."""
    raw = text.encode("utf-8", "replace")
    classes = CLASS_OF[np.frombuffer(raw, np.uint8)]
    counts = np.zeros(TERMS, np.float32)
    counts[:REPEAT_TERM] = np.bincount(classes[:-1] * CLASSES + classes[1:], minlength=REPEAT_TERM)
    words = text.split()
    same = sum(map(str.__eq__, words, words[1:]))
    if words:
        counts[REPEAT_TERM + min(7, int(8 * same / len(words)))] = len(words)
        seen: dict[str, int] = {}
        for w in words:
            seen[w] = seen.get(w, 0) + 1
        slots = [zlib.crc32(w.encode("utf-8", "replace")) % WORD_TERMS for w in seen]
        np.add.at(counts, FIRST_WORD + np.array(slots), np.fromiter(seen.values(), np.float32, len(seen)))
    counts[FIRST_LENGTH + min(LENGTH_TERMS - 1, len(raw).bit_length())] = max(1, len(words))
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of log tf times idf; the surface terms and the words each to a fixed share of the norm."""
    x = np.log1p(counts) * idf
    for part, weight in ((slice(0, FIRST_WORD), 1.0), (slice(FIRST_WORD, TERMS), WORD_WEIGHT)):
        norm = np.linalg.norm(x[:, part], axis=1, keepdims=True)
        x[:, part] *= weight / np.where(norm > 0, norm, 1)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def latent_space(x: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors (TERMS x rank) by a seeded randomised range finder."""
    rank = min(rank, *x.shape)
    rng = np.random.default_rng(0)
    basis = np.linalg.qr(x @ rng.standard_normal((x.shape[1], min(rank + 16, x.shape[0]))))[0]
    for _ in range(3):
        basis = np.linalg.qr(x @ (x.T @ basis))[0]
    return np.linalg.svd(basis.T @ x, full_matrices=False)[2][:rank].T.astype(np.float32)


def vote(vectors: np.ndarray, voters: np.ndarray, labels: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted mean label of each row's nearest voters: one exact cosine block."""
    sims = vectors @ voters.T
    k = min(neighbours, len(labels))
    near = np.argsort(-sims, axis=1, kind="stable")[:, :k] if k == len(labels) else top_columns(sims, k)
    weight = np.maximum(np.take_along_axis(sims, near, axis=1), 0) ** 2 + 1e-9
    return (weight * labels[near]).sum(axis=1) / weight.sum(axis=1)


def top_columns(sims: np.ndarray, k: int) -> np.ndarray:
    """The k largest columns of each row; equal ones at the border by column number."""
    border = np.partition(sims, -k, axis=1)[:, -k][:, None]
    order = np.where(sims > border, 2.0, np.where(sims == border, 1.0, 0.0)) - np.arange(sims.shape[1]) * 1e-9
    return np.argpartition(-order, k - 1, axis=1)[:, :k]


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Documents, and documents with each term, over the whole table."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, df = 0, np.zeros(TERMS, np.int64)
        for batch in batches:
            for text in batch["text"]:
                df += term_counts(text) > 0
                n += 1
        if n:
            yield pd.DataFrame({"term": np.arange(-1, TERMS), "n": np.concatenate(([n], df))})

    total = texts.mapInPandas(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in total.collect()}  # TERMS + 1 rows
    return found.get(-1, 0), np.array([found.get(t, 0) for t in range(TERMS)])


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str, bound: int) -> pd.DataFrame:
    """At most ``bound`` labelled rows, chosen by the hash of their id, with their term counts."""
    rows = (labels.filter(learn & F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1))
            .select("doc_id", F.col(label_col).cast("int").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(bound))
    rows = docs.sparkSession.createDataFrame(rows.collect(), "doc_id long, label int")  # at most bound rows
    texts = (docs.join(F.broadcast(rows.select("doc_id").distinct()), "doc_id", "left_semi")
             .groupBy("doc_id").agg(F.min("text").alias("text")))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [term_counts(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "terms": [np.flatnonzero(r).astype(np.int32) for r in rows],
                                "counts": [r[r > 0] for r in rows]})

    got = texts.mapInPandas(counted, "doc_id long, terms array<int>, counts array<float>").join(
        F.broadcast(rows), "doc_id").orderBy("doc_id", "label")
    return pd.DataFrame(got.collect(), columns=["doc_id", "terms", "counts", "label"])


def score(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, score) of every document. ``learn``: which rows of ``labels`` may be learned from."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    sample = labelled_sample(texts, labels, learn, label_col, max_labelled)
    if sample.empty:
        return texts.select("doc_id", F.lit(DEFAULT_SCORE).alias("score"))
    n, df = document_frequencies(texts.select("text"))
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    counts = np.zeros((len(sample), TERMS), np.float32)
    for row, terms, values in zip(counts, sample["terms"], sample["counts"]):
        row[list(terms)] = values
    x = weighted(counts, idf)
    space = latent_space(x, RANK)
    model = spark.sparkContext.broadcast((idf, space, unit(x @ space).astype(np.float32),
                                          sample["label"].to_numpy(np.float64)))

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, space, voters, marks = model.value
        for batch in batches:
            if batch.num_rows:
                x = weighted(np.stack([term_counts(t) for t in batch.column("text").to_pylist()]), idf)
                found = np.clip(vote(unit(x @ space), voters, marks), 0, 1)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())],
                                                 names=["doc_id", "score"])

    return texts.mapInArrow(voted, "doc_id long, score double")


def judged(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """Scores learned outside the held-out fold: (doc_id, held_out, score, predicted)."""
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    got = score(docs, labels, fold != held_out)
    return got.select("doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
