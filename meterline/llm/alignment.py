"""Cross-tokenizer alignment by galloping intersection.

Two tokenizers cut the same bytes: A a byte-level BPE, B a piece model. A
token's end is a byte offset, so each tokenizer gives a sorted list of ends.
Their intersection is found by galloping: the shorter list drives, a stretch
of its ends at a time; from the last place reached, steps that double find a
range of the longer list that covers the stretch, and a binary search inside
that range finds each end. The common ends cut the tokens into groups, and the
differences of their ranks in either list are the ranges of tokens that lie in
a group. All pairs of an A and a B token of one group are linked.

Over the corpus every pair of ids counts the documents that hold it linked.
The pairs of a document are distinct, so counting is one partially aggregated
group-by. To bring the counts back to the documents, a pair that more than one
in ``HOT_PAIRS`` of all (document, pair) rows hold is joined from a broadcast
table, which has fewer than ``HOT_PAIRS`` rows whatever the input; no other
pair has more rows than that share, so the shuffled join has no hot key.

Cases: texts that are NULL or empty, or whose tokens don't give back the
bytes (a text that holds U+2581, say), have no tokens, groups or links; the
strings of special tokens are plain text; repeated rows and rows with equal
ids count as documents of their own; NULL ids are carried; texts are
tokenized whole, however long; an empty table gives no rows; other columns are
ignored whatever their names.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import free_name, small_batches, table, text_or_empty

STRETCH = 512
WIDE = 256
HOT_PAIRS = 50_000
B_BITS = 24  # a pair of ids in one long: A's id above B's
BATCH_TEXTS = 64
LONG_RUN = 10_000  # characters of a run of white space that the rank file's library isn't given
BLANK = "▁"
LONG_BLANK = re.compile(rf"\s{{{LONG_RUN}}}")
OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>")

_ALIGNERS: dict[tuple, Aligner] = {}


def byte_letters() -> dict[str, int]:
    """Byte of each letter that a byte-level vocabulary writes it with: printable Latin-1 as it is, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = {chr(b): b for b in plain}
    letters.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))})
    return letters


def galloping(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the common values of two ascending lists, in each. The shorter one drives."""
    in_short, in_long, at = [], [], 0
    for lo in range(0, len(short), STRETCH):
        part = short[lo:lo + STRETCH]
        step, to = STRETCH, at
        while to < len(long) and long[to] < part[-1]:  # ``to`` is the last place of the range
            to, step = to + step, step * 2
        to = min(to + 1, len(long))
        found = at + np.searchsorted(long[at:to], part)
        hit = found < len(long)
        hit[hit] = long[found[hit]] == part[hit]
        in_short.append(lo + np.flatnonzero(hit))
        in_long.append(found[hit])
        at = int(found[-1])
        if at >= len(long):
            break
    return np.concatenate(in_short), np.concatenate(in_long)


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks, in A and in B, of the ends that both have."""
    if len(ends_a) <= len(ends_b):
        return galloping(ends_a, ends_b)
    b, a = galloping(ends_b, ends_a)
    return a, b


def linked(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct pairs, occurrences of each) of all groups.

    In a group of more than ``WIDE`` links repeated ids are counted first, so
    only distinct ids are paired.
    """
    keys, times = [], []
    start_a, start_b = np.concatenate(([0], in_a[:-1] + 1)), np.concatenate(([0], in_b[:-1] + 1))
    n_a, n_b = in_a + 1 - start_a, in_b + 1 - start_b
    n = n_a * n_b
    usual = n <= WIDE
    s_a, s_b, w_b, n = start_a[usual], start_b[usual], n_b[usual], n[usual]
    within = np.arange(n.sum()) - np.repeat(n.cumsum() - n, n)
    w_b = np.repeat(w_b, n)
    keys.append((a[np.repeat(s_a, n) + within // w_b] << B_BITS) | b[np.repeat(s_b, n) + within % w_b])
    times.append(np.ones(len(keys[0]), np.int64))
    for g in np.flatnonzero(~usual):
        ids_a, many_a = np.unique(a[start_a[g]:in_a[g] + 1], return_counts=True)
        ids_b, many_b = np.unique(b[start_b[g]:in_b[g] + 1], return_counts=True)
        keys.append(((ids_a << B_BITS)[:, None] | ids_b[None, :]).ravel())
        times.append((many_a[:, None] * many_b[None, :]).ravel())
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, np.concatenate(times), len(key)).astype(np.int64)


class Aligner:
    """Both tokenizers with the bytes of their tokens.

    ``ranks``: the rank file and split pattern of A's vocabulary, if there are
    such; the ids are the same and take a sixth of the time. Texts with very
    long runs of white space, which that library can't take, go to A's own.
    """

    def __init__(self, byte_level: str, pieces: str, ranks: tuple[str, str] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.fast = None
        if ranks:
            import tiktoken
            with open(ranks[0], "rb") as f:
                known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=ranks[1], mergeable_ranks=known, special_tokens={})
        letters = byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, k in self.a.get_vocab().items():
            self.bytes_a[k] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.bytes_b = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace(BLANK, " ").encode())
        self.size_a, self.size_b = (np.array([len(t) for t in ts], np.int64) for ts in (self.bytes_a, self.bytes_b))
        # A token's digits with what may follow them: the next of its side, the other side, the next group, or nothing.
        self.written = [f"{k}{after}" for after in (",", "|", ";", "") for k in range(max(len(self.size_a), len(self.size_b)))]

    def ids_a(self, texts: list[str]) -> list[list[int]]:
        if self.fast and not any(len(t) > LONG_RUN and LONG_BLANK.search(t) for t in texts):
            return [self.fast.encode_ordinary(t) for t in texts]
        return [got.ids for got in self.a.encode_batch(texts, add_special_tokens=False)]

    def tokens(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        for lo in range(0, len(texts), BATCH_TEXTS):
            part = texts[lo:lo + BATCH_TEXTS]
            for text, a, b in zip(part, self.ids_a([" " + t for t in part]), self.b.encode(part, num_threads=1)):
                whole = (" " + text).encode("utf-8", "replace")
                same = (text and b"".join(map(self.bytes_a.__getitem__, a)) == whole
                        and b"".join(map(self.bytes_b.__getitem__, b)) == whole)
                yield (a, b) if same else ([], [])

    def groups(self, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group in order."""
        # Every token's place in the string: its own side's tokens before it and the other side's.
        group_a, group_b = np.searchsorted(in_a, np.arange(len(a))), np.searchsorted(in_b, np.arange(len(b)))
        after_a, after_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        after_a[in_a], after_b[in_b] = 1, 2
        after_b[-1] = 3
        width, line = len(self.written) // 4, np.empty(len(a) + len(b), np.int64)
        line[np.arange(len(a)) + np.concatenate(([0], in_b + 1))[group_a]] = after_a * width + a
        line[np.arange(len(b)) + (in_a + 1)[group_b]] = after_b * width + b
        return "".join(map(self.written.__getitem__, line.tolist()))

    def align(self, ids_a: list[int], ids_b: list[int]) -> tuple:
        """(n_a, n_b, n_groups, n_links, groups, pairs, times) of one text."""
        if not ids_a:
            return 0, 0, 0, 0, "", [], []
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        in_a, in_b = common_ends(self.size_a[a].cumsum(), self.size_b[b].cumsum())
        pairs, times = linked(a, b, in_a, in_b)
        return len(a), len(b), len(in_a), int(times.sum()), self.groups(a, b, in_a, in_b), pairs, times


def aligner(byte_level: str, pieces: str, ranks: tuple[str, str] | None = None) -> Aligner:
    """The aligner of two vocabulary files, one per worker process."""
    key = byte_level, pieces, ranks
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def align(docs: DataFrame, byte_level: str, pieces: str, ranks: tuple[str, str] | None = None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times) of every document.

    ``pairs``: the distinct id pairs linked, ``a << B_BITS | b`` each;
    ``times``: the links of each. ``ranks``: see ``Aligner``.
    """
    small_batches(docs.sparkSession)
    longs = pa.list_(pa.int64())
    types = (*[pa.int64()] * 4, pa.string(), longs, longs)
    names = ["n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_level, pieces, ranks)
        for batch in batches:
            rows = [both.align(a, b) for a, b in both.tokens(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([r[c] for r in rows], t) for c, t in enumerate(types))],
                names=["doc_id", *names])

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(f"`{text_col}`").alias("text"))
    return narrow.mapInArrow(run, OUT)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, docs, best): how many rows hold each pair linked, and whether its A id has no pair held by more."""
    counts = table(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs")),
                   "pair-counts")
    of_a = F.shiftright("pair", B_BITS).alias("a")
    most = counts.groupBy(of_a).agg(F.max("docs").alias("most"))
    return counts.withColumn("a", F.shiftright("pair", B_BITS)).join(most, "a").select(
        "pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def weighed(aligned: DataFrame) -> DataFrame:
    """The rows of ``align`` plus n_best and count_sum.

    They are written first; drop ``groups`` before, or keep a digest of it, if
    it isn't needed.
    """
    row = free_name(aligned.columns, "__row")
    rows = table(aligned.withColumn(row, F.monotonically_increasing_id()), "aligned")
    counts = table(pair_counts(rows), "pair-weights")
    total = counts.agg(F.sum("docs")).first()[0] or 0
    hot = counts.filter(F.col("docs") * HOT_PAIRS > total)  # fewer than HOT_PAIRS rows: their docs add up to total
    held = rows.select(row, F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        F.col(row).alias("row"), F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    marked = held.join(F.broadcast(hot), "pair", "left")
    sums = (F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    # Hot pairs are summed where they are; only the others travel.
    of_hot = marked.filter(F.col("docs").isNotNull()).groupBy("row").agg(*sums)
    rest = marked.filter(F.col("docs").isNull()).select("row", "pair", "times")
    of_rest = rest.join(counts.filter(F.col("docs") * HOT_PAIRS <= total).hint("merge"), "pair").groupBy("row").agg(*sums)
    both = of_hot.unionByName(of_rest).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return (rows.join(both.withColumnRenamed("row", row).hint("merge"), row, "left").drop(row)
            .withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")}))
