"""Fill-in-the-middle by a learned rank index.

A text is a row of units (a run of ASCII letters, or one other character),
and a cut falls on a unit boundary, named by its rank. The index of a text
answers "at which character does boundary k lie?" without a list of all
boundaries: straight segments are fitted to all (rank, offset) points so that
none is further than ``ERROR`` characters off, and the signed distance of
every boundary from its segment is stored in one byte. A cut's offset is
predicted by its segment's line and then corrected exactly by the stored
residual.

A segment grows by a shrinking cone: as long as one slope through its first
point passes within the error of every point, the next point joins.

The places of the cuts and the form of a row come from the hash of its id
alone, so a rerun, a retry or another partitioning gives the same rows. Every
row is transformed where it is read; nothing is shuffled. A text without the
form's marks can be read back exactly (``restored``): the marks can't overlap
each other, so the first three marks found are those that were written.

Cases: a NULL text counts as empty; an empty text, and one that holds a mark
itself, stays plain; a NULL id is hashed as ``1:`` alone; rows with equal ids
get equal hashes; very long texts are indexed whole, with one byte a unit and
some numbers a segment; an empty table gives no rows; other columns are
ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import small_batches, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ERROR = 100  # characters; a residual fits one byte
SALT = "1:"
PLAIN_FROM = 90  # of 100
SPM_BELOW = 20  # of 100
FIRST_REACH = 256
OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, segments int, output string"


def boundaries(text: str) -> np.ndarray:
    """Character offsets of all unit boundaries: ``offsets[k]`` is where unit k begins, the last one is the end."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = ((code | 32) - np.uint32(97)) < 26
    inside = np.zeros(len(code) + 1, bool)
    inside[1:-1] = letter[1:] & letter[:-1]
    return np.flatnonzero(~inside)


class RankIndex(NamedTuple):
    """Offsets by rank: ``offset = base + floor(slope * (rank - start)) + residual``."""

    starts: np.ndarray  # first rank of each segment
    bases: np.ndarray
    slopes: np.ndarray
    residuals: np.ndarray  # one signed byte a boundary

    def offset(self, rank: int) -> int:
        s = int(np.searchsorted(self.starts, rank, "right")) - 1
        return int(self.predicted(s, rank)) + int(self.residuals[rank])

    def predicted(self, segment: int, rank):
        return self.bases[segment] + np.floor(self.slopes[segment] * (rank - self.starts[segment])).astype(np.int64)


def fitted(offsets: np.ndarray, start: int, error: int) -> tuple[int, float]:
    """(end, slope) of the longest segment from ``start``: a line through its first point, ``error`` off at most.

    The points are examined in stretches that double, so a segment costs in
    proportion to its length.
    """
    low, high, at, reach = -np.inf, np.inf, start + 1, FIRST_REACH
    while at < len(offsets):
        run = np.arange(at, min(len(offsets), at + reach))
        rise = offsets[run] - offsets[start]
        lows = np.maximum(np.maximum.accumulate((rise - error) / (run - start)), low)
        highs = np.minimum(np.minimum.accumulate((rise + error) / (run - start)), high)
        bad = np.flatnonzero(lows > highs)
        if len(bad):
            k = int(bad[0])
            if k:
                low, high = lows[k - 1], highs[k - 1]
            at += k
            break
        low, high = lows[-1], highs[-1]
        at, reach = at + len(run), reach * 2
    return at, (low + high) / 2 if np.isfinite(low + high) else 0.0


def learned(offsets: np.ndarray, error: int = ERROR) -> RankIndex:
    """The index of a text's boundaries. ``error`` is 126 at most, so that residuals fit a byte."""
    starts, bases, slopes, residuals, start = [], [], [], np.empty(len(offsets), np.int8), 0
    while start < len(offsets):
        end, slope = fitted(offsets, start, error)
        starts.append(start)
        bases.append(int(offsets[start]))
        slopes.append(slope)
        line = np.floor(slope * np.arange(end - start)).astype(np.int64) + offsets[start]
        residuals[start:end] = offsets[start:end] - line
        start = end
    return RankIndex(np.array(starts), np.array(bases), np.array(slopes), residuals)


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of an id."""
    digest = hashlib.sha256((SALT + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    return h1, h2, h3, h4


def transformed(doc_id: int | None, text: str) -> tuple:
    """(n, form, prefix_chars, middle_chars, segments, output) of one text."""
    offsets = boundaries(text)
    n, index = len(offsets) - 1, learned(offsets)
    h1, h2, h3, h4 = draws(doc_id)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= PLAIN_FROM:
        return n, "plain", None, None, len(index.starts), text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = index.offset(first), index.offset(last)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        return n, "spm", a, b - a, len(index.starts), f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, len(index.starts), f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, segments, output) of every document."""
    small_batches(docs.sparkSession)
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
    names = ["n", "form", "prefix_chars", "middle_chars", "segments", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [transformed(i, t) for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([r[c] for r in rows], t) for c, t in enumerate(types))],
                names=["doc_id", *names])

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_or_empty(f"`{text_col}`").alias("text"))
    return narrow.mapInArrow(run, OUT)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of the named form was made from."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", 4)
    first, second, middle = (F.get(parts, k) for k in (1, 2, 3))
    return (F.when(form == "psm", F.concat(first, middle, second))
            .when(form == "spm", F.concat(second, middle, first)).otherwise(output))
