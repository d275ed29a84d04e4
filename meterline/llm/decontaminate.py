"""Benchmark decontamination by spaced-seed hashing.

Words are lower-cased runs of letters and digits. A mask picks some positions
of a short window and ignores the others; a window's hash covers the picked
words only, so a substituted word at an ignored position doesn't change it.
Test windows are hashed under every mask, and every document position is
looked up in the test hashes. A hit lines up the document with the test item
on one diagonal. There the hit is verified word by word: a document is
contaminated if any stretch of at least ``min(MIN_OVERLAP, words of the
item)`` words has at least ``MIN_AGREEMENT`` of them equal; the longest such
stretch is the overlap. A match counts 1 and a mismatch ``-PENALTY``, so a
stretch qualifies if its sum isn't negative.

Every such stretch has a seed. In one of 13 or more words, f words differ and
at least 4 f, and never fewer than 11, are equal: four equal words stand
together, or else it is three runs of one differing word between four of three
equal words, which ``MASKS[1]`` hits. The items shorter than that are hashed
under ``SHORT_MASKS`` too: with ``MASKS[0]`` they hit any five words with at
most one differing, and every qualifying stretch of 5 to 12 words holds five
such.

The test set is read in slices of about ``SLICE_WORDS`` words' bytes, whose
hashes fit a broadcast; a larger test set takes more slices over the
documents, never a larger broadcast. Documents aren't shuffled: each is
judged where it is read, whole.

Cases: a NULL or empty text isn't contaminated; NULL, empty and one- to
three-word items give no seed and match nothing; very long texts, and one word
repeated in a text and an item, are judged whole in bounded memory; equal items are each
reported; an item without an id counts like any other and is reported as
NULL; repeated documents are each judged; empty tables on either side
give no hits; ``scan`` returns the columns of its input besides its own,
whose names are prefixed until none clashes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.common import free_name, small_batches

# The word offsets that each mask looks at.
MASKS = ((0, 1, 2, 3), (0, 1, 3, 5), (0, 2, 3, 6))
SHORT_MASKS = ((0, 1, 2, 4), (0, 1, 3, 4), (0, 2, 3, 4))  # for items of fewer than MIN_OVERLAP words
MIN_OVERLAP = 13
MIN_AGREEMENT = 0.8
PENALTY = 4.0  # MIN_AGREEMENT / (1 - MIN_AGREEMENT)
SLICE_WORDS = 500_000
WORD_BYTES = 8  # a slice is bounded by bytes; text without blanks counts by them too
LISTED = 10_000  # pairs of places of one seed in one document
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def mix(code: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    """Hash of the masked words at every start; 0 where a word is unknown (code 0)."""
    n = len(code) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, salt + 1, np.uint64)
    known = np.ones(n, bool)
    for o in mask:
        part = code[o:o + n]
        known &= part != 0
        h = (h ^ part) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return np.where(known, h, 0)


def _runs(places: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each run of neighbouring numbers in an ascending list."""
    cut = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[np.concatenate(([0], cut + 1))].tolist(), places[np.concatenate((cut, [len(places) - 1]))].tolist()))


def _by_first(rows: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """The second column's values for each value of the first; ``rows`` are sorted by the first."""
    keys, start = np.unique(rows[:, 0], return_index=True)
    return keys.tolist(), np.split(rows[:, 1], start[1:])


class TestSet:
    """Seed index of one slice of the test items."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids = [i for i, _ in items]
        words = [words_of(t) for _, t in items]
        self.code = {w: k + 1 for k, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.words = [np.array([self.code[w] for w in ws], np.uint64) for ws in words]
        short = [len(ws) < MIN_OVERLAP for ws in words]
        self.masks = (*MASKS, *SHORT_MASKS) if any(len(ws) > 4 and s for ws, s in zip(words, short)) else MASKS
        hashes, where = [], []
        for item, code in enumerate(self.words):
            for salt, mask in enumerate(self.masks if short[item] else MASKS):
                h = mix(code, mask, salt)
                hashes.append(h)
                where.append(np.stack((np.full(len(h), item), np.arange(len(h))), axis=1))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hashes, self.where = h[order], (np.concatenate(where) if where else np.zeros((0, 2), np.int64))[order]

    def diagonals(self, code: np.ndarray) -> dict[int, np.ndarray]:
        """Per item, the distinct places in the document where its start lies by some seed hit (document start - item start).

        A seed that stands at many places of both (one word repeated, say)
        isn't listed pair by pair: its places are runs of neighbours, and two
        runs give one range of places.
        """
        pairs, ranges = [], {}
        for salt, mask in enumerate(self.masks):
            h = mix(code, mask, salt)
            at = np.flatnonzero(h)
            lo, hi = np.searchsorted(self.hashes, h[at], "left"), np.searchsorted(self.hashes, h[at], "right")
            found = hi > lo
            at, lo, n = at[found], lo[found], (hi - lo)[found]
            if not len(at):
                continue
            seed, times = np.unique(lo, return_inverse=True, return_counts=True)[1:]
            many = n * times[seed] > LISTED
            for first in np.unique(lo[many]):
                here = lo == first
                self._ranges(at[here], self.where[first:first + n[here][0]], ranges)
            at, lo, n = at[~many], lo[~many], n[~many]
            row = np.repeat(lo - (n.cumsum() - n), n) + np.arange(n.sum())
            pairs.append(np.stack((self.where[row, 0], np.repeat(at, n) - self.where[row, 1]), axis=1))
        out: dict[int, np.ndarray] = {}
        if pairs:
            listed = np.unique(np.concatenate(pairs), axis=0)
            for item, starts in zip(*_by_first(listed)):
                out[item] = starts
        for item, some in ranges.items():
            low = min(a for a, _ in some)
            edge = np.zeros(max(b for _, b in some) - low + 2, np.int64)
            for a, b in some:
                edge[a - low] += 1
                edge[b + 1 - low] -= 1
            covered = np.flatnonzero(edge.cumsum()) + low
            out[item] = np.union1d(out[item], covered) if item in out else covered
        return out

    def _ranges(self, at: np.ndarray, where: np.ndarray, ranges: dict[int, list]) -> None:
        """Add the ranges of places that one seed gives: runs of the document's places less runs of an item's."""
        ours = _runs(np.sort(at))
        for item, starts in zip(*_by_first(where[np.lexsort((where[:, 1], where[:, 0]))])):
            ranges.setdefault(item, []).extend({(a - d, b - c) for c, d in _runs(starts) for a, b in ours})

    def overlap(self, code: np.ndarray, item: int, start: int) -> int:
        """Length of the verified overlap of an item laid on the document at ``start``; 0 if none."""
        test = self.words[item]
        lo, hi = max(0, -start), min(len(test), len(code) - start)
        need = min(MIN_OVERLAP, len(test))
        if hi - lo < need:
            return 0
        same = code[start + lo:start + hi] == test[lo:hi]
        if same.sum() < MIN_AGREEMENT * need:
            return 0
        total = np.concatenate(([0.0], np.where(same, 1.0, -PENALTY).cumsum()))
        later = np.maximum.accumulate(total[::-1])[::-1]  # the most that is reached from each place on
        ends = np.searchsorted(-later, -total, "right") - 1  # the last place that is no lower than each start
        n = int((ends - np.arange(len(total))).max())
        return n if n >= need else 0

    def leaks(self, text: str | None) -> list[tuple[int | None, int]]:
        """(item id, overlap) of every item that the document holds."""
        get = self.code.get
        words = words_of(text)
        code = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        out = []
        for item, starts in self.diagonals(code).items():
            size = len(self.words[item])
            shared = np.minimum(size, len(code) - starts) - np.maximum(0, -starts)  # no overlap is longer
            order, best = np.argsort(-shared, kind="stable"), 0
            for k in order:
                if shared[k] <= best:
                    break
                best = max(best, self.overlap(code, item, int(starts[k])))
            if best:
                out.append((self.ids[item], best))
        return out


def by_id(item_id: int | None) -> tuple[bool, int]:
    """Sort key of ids: NULL before others."""
    return item_id is not None, item_id or 0


def slices(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, str]]]:
    """The test items in lists of about SLICE_WORDS * WORD_BYTES bytes, fetched one list at a time."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter(
        F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / (SLICE_WORDS * WORD_BYTES)))
    for k in range(n):
        yield sorted(((r["id"], r["text"]) for r in
                      items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()),
                     key=lambda item: (by_id(item[0]), item[1]))


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text") -> DataFrame:
    """Every column of ``docs`` plus contaminated, items and longest_overlap."""
    spark = docs.sparkSession
    small_batches(spark)
    items, longest = free_name(docs.columns, "items"), free_name(docs.columns, "longest_overlap")
    flag = free_name(docs.columns, "contaminated")
    out = docs.withColumns({items: F.array().cast("array<bigint>"), longest: F.lit(0)})
    for part in slices(benchmark, item_col, item_text_col):
        tests = spark.sparkContext.broadcast(part)

        def judge(batches: Iterator[pa.RecordBatch], tests=tests) -> Iterator[pa.RecordBatch]:
            index = TestSet(tests.value)
            for batch in batches:
                found = [index.leaks(t) for t in batch.column(text_col).to_pylist()]
                had, most = batch.column(items).to_pylist(), batch.column(longest).to_pylist()
                new = {items: pa.array([sorted([*old, *(i for i, _ in f)], key=by_id) for old, f in zip(had, found)],
                                       pa.list_(pa.int64())),
                       longest: pa.array([max([old, *(n for _, n in f)]) for old, f in zip(most, found)], pa.int32())}
                yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in batch.schema.names],
                                                 names=batch.schema.names)

        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema.fields])
        out = out.mapInArrow(judge, schema)
    return out.withColumn(flag, F.size(items) > 0)
