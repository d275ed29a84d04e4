"""Byte-level BPE by a monoid of token sequences.

Token sequences form a monoid: the product of the encodings of two strings is
the encoding of the joined string. A piece of text is halved until a half has
at most ``LEAF`` bytes, the leaves are encoded by plain merging, and neighbours
are multiplied up the tree. A product re-encodes a window of bytes around the
border, a token on each side at first, and twice as many on a side for as long
as the tokens next to the window on that side aren't settled. Matches of the
split pattern never merge with each other, so a product across a match border
needs no window. Decoding concatenates the tokens' bytes up a tree.

Why the rest is final. Call two adjacent tokens settled if their joined bytes
encode to just these two. A sequence of tokens, each of which encodes to
itself, is the encoding of its bytes if and only if all its neighbours are
settled: suppose that merging crosses a border, and take the first merge that
does. Until then merges inside the two tokens next to that border happen in the
order in which they happen when the two stand alone, so there the same merge
would cross it too. Inside both factors neighbours are settled because they are
encodings, inside the window because it is one, and the two at the window's
edges are tested. The vocabulary's tokens are tested to encode to themselves
(``check_vocabulary``).

Each text is encoded where it is read, whole, and nothing is shuffled. A worker
remembers a bounded number of words (``KEPT``) and products (an eighth of it,
``KEPT_BYTES`` bytes at most), so frequent words and long runs of one character
cost one tree each.

Cases: a NULL or empty text has no tokens and decodes to no bytes; the strings
of special tokens are plain text; repeated rows are encoded row by row; NULL
ids are carried; very long texts and very long matches (a million blanks, one
word of a million letters) take time in proportion to their length but for a
logarithm; an empty table gives no rows; other columns are ignored whatever
their names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import small_batches, text_or_empty

LEAF = 16  # bytes
NONE = 2**32  # above every rank
KEPT = 200_000
KEPT_BYTES = 4096
WORD_CHARS = 64
FAN = 256  # parts that one node of the decoding tree joins
ENCODED = "doc_id long, n_tokens long, ids binary"
DECODED = "doc_id long, n_tokens long, ids binary, decoded binary"

_CODERS: dict[str, Coder] = {}


class Coder:
    """Encoder and decoder of one vocabulary of ranks."""

    def __init__(self, vocabulary: str, pattern: str):
        with open(vocabulary, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.known: dict[bytes, list[int]] = {}
        self.words: dict[str, list[int]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def leaf(self, data: bytes) -> list[int]:
        """Plain merging: the adjacent pair of the lowest rank first, the leftmost of equals."""
        get = self.ranks.get
        parts = [data[k:k + 1] for k in range(len(data))]
        joined = [get(data[k:k + 2], NONE) for k in range(len(data) - 1)]  # rank of each part with the next
        while joined:
            best = min(joined)
            if best == NONE:
                break
            k = joined.index(best)
            parts[k] += parts.pop(k + 1)
            del joined[k]
            if k < len(joined):
                joined[k] = get(parts[k] + parts[k + 1], NONE)
            if k:
                joined[k - 1] = get(parts[k - 1] + parts[k], NONE)
        return [self.ranks[p] for p in parts]

    def settled(self, left: int, right: int) -> bool:
        """Do the joined bytes of two tokens encode to just these two?"""
        got = self.pairs.get((left, right))
        if got is None:
            if len(self.pairs) > KEPT:
                self.pairs.clear()
            # Plain merging, so the test doesn't rest on what it is used to prove.
            got = self.pairs[left, right] = self.leaf(self.tokens[left] + self.tokens[right]) == [left, right]
        return got

    def product(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the joined bytes of two encodings."""
        if not left or not right or self.settled(left[-1], right[0]):
            return left + right
        a, b = 1, 1  # tokens of the window on each side
        while True:
            lo, hi = max(0, len(left) - a), min(len(right), b)
            window = left[lo:] + right[:hi]
            data = b"".join([self.tokens[t] for t in window])
            whole = not lo and hi == len(right)
            middle = self.leaf(data) if whole or len(data) <= 2 * LEAF else self.encoded(data)
            before = lo == 0 or self.settled(left[lo - 1], middle[0])
            after = hi == len(right) or self.settled(middle[-1], right[hi])
            if before and after:
                return left[:lo] + middle + right[hi:]
            a, b = a if before else 2 * a, b if after else 2 * b

    def encoded(self, data: bytes) -> list[int]:
        """The encoding of one match of the pattern."""
        token = self.ranks.get(data)
        if token is not None:
            return [token]
        if len(data) <= LEAF:
            return self.leaf(data)
        got = self.known.get(data) if len(data) <= KEPT_BYTES else None
        if got is None:
            half = len(data) // 2
            got = self.product(self.encoded(data[:half]), self.encoded(data[half:]))
            if len(data) <= KEPT_BYTES:
                if len(self.known) > KEPT // 8:
                    self.known.clear()
                self.known[data] = got
        return got

    def encode(self, text: str) -> list[int]:
        """Ids of a text; matches are factors whose products need no window."""
        words, out = self.words, []
        for match in self.pattern.findall(text):
            ids = words.get(match)
            if ids is None:
                ids = self.encoded(match.encode("utf-8", "surrogatepass"))
                if len(match) <= WORD_CHARS:
                    if len(words) > KEPT:
                        words.clear()
                    words[match] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        """The ids' bytes, joined level by level."""
        parts = [self.tokens[t] for t in ids]
        while len(parts) > 1:
            parts = [b"".join(parts[k:k + FAN]) for k in range(0, len(parts), FAN)]
        return parts[0] if parts else b""

    def check_vocabulary(self) -> list[int]:
        """Tokens that don't encode to themselves; the products need that there are none."""
        return [rank for token, rank in self.ranks.items() if self.leaf(token) != [rank]]


def coder(vocabulary: str, pattern: str) -> Coder:
    """The coder of a rank file, one per worker process."""
    key = f"{vocabulary}\n{pattern}"
    if key not in _CODERS:
        _CODERS[key] = Coder(vocabulary, pattern)
    return _CODERS[key]


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) of every document; ids as little-endian unsigned 32-bit integers."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(vocabulary, pattern)
        for batch in batches:
            ids = [bpe.encode(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(i) for i in ids], pa.int64()),
                 pa.array([np.array(i, "<u4").tobytes() for i in ids], pa.binary())], names=["doc_id", "n_tokens", "ids"])

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(f"`{text_col}`").alias("text"))
    return narrow.mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """The rows of ``encode`` with the bytes that their ids stand for."""
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(vocabulary, pattern)
        for batch in batches:
            data = [bpe.decode(np.frombuffer(i, "<u4").tolist()) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_tokens", "ids")),
                                              pa.array(data, pa.binary())], names=["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, DECODED)
