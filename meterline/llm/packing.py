"""Best-fit packing by a grouping genetic algorithm.

Texts become token pieces of at most ``capacity`` tokens. Full pieces are
sequences by themselves. The rest are dealt into problems of about
``PROBLEM_ROWS`` pieces, and each problem is packed by a grouping genetic
algorithm: a solution is a set of whole bins. Crossover injects the
well-filled bins of one parent into the other, removes the bins that now hold
duplicates, and best-fits the displaced pieces, longest first. Mutation
empties some of the worst bins. Each problem runs on several islands, which
are Spark task groups of their own; after each epoch every island's best
solution migrates to its neighbour through a shuffle. The best island wins.

A group holds one problem, so its size doesn't grow with the input, whatever
the documents: pieces are dealt by row, not by content. Only lengths and row
numbers enter the algorithm; texts and token ids stay where they were read.

Cases: a NULL or empty text is the end token alone; very long texts and runs
of blanks are encoded whole, and their pieces are packed like any other; repeated rows are packed
row by row; ties are broken by row number, so a rerun over the same table
gives the same bins; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import math
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm import byte_bpe
from meterline.llm.common import partitions, small_batches, table, text_or_empty

CAPACITY = 1024
END_TOKEN = 2
PROBLEM_ROWS = 8192
ISLANDS = 3
POPULATION = 4
EPOCHS = 2
GENERATIONS = 4
WELL_FILLED = 0.99  # of the capacity
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
STATE = "problem long, island int, lengths array<int>, bins int, fill double, genome array<int>"

LONG_RUN = 10_000  # characters of white space

_ENCODERS: dict = {}
_LONG_BLANK = re.compile(rf"\s{{{LONG_RUN}}}")


def added_tokens(tokenizer: str) -> dict[str, int]:
    """The added tokens of a tokenizer's JSON file, which match in a text before it is split."""
    with open(tokenizer, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError("added tokens that depend on what stands around them aren't supported")
    return {t["content"]: t["id"] for t in added}


def encoder(vocabulary: str, pattern: str, added: dict[str, int]):
    """The byte-level BPE of a rank file and its added tokens, one per worker process."""
    key = (vocabulary, pattern, tuple(sorted(added.items())))
    if key not in _ENCODERS:
        import tiktoken
        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _ENCODERS[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
    return _ENCODERS[key]


def ids_of(text: str, vocabulary: str, pattern: str, added: dict[str, int]) -> list[int]:
    """A text's ids. The rank file's library can't split very long runs of white space: such texts go to ``byte_bpe``."""
    if len(text) <= LONG_RUN or not _LONG_BLANK.search(text):
        return encoder(vocabulary, pattern, added).encode(text, allowed_special="all")
    parts = re.split("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")", text) if added else [text]
    coder, out = byte_bpe.coder(vocabulary, pattern), []
    for part in parts:
        out += [added[part]] if part in added else coder.encode(part)
    return out


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; the first piece takes the remainder."""
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = CAPACITY, end_token: int = END_TOKEN,
           id_col: str = "doc_id", text_col: str = "text", added: dict[str, int] | None = None) -> DataFrame:
    """Token pieces of every text: (doc_id, piece, start, length, ids_crc32)."""
    small_batches(docs.sparkSession)
    added = added or {}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array(ids_of(text, vocabulary, pattern, added) + [end_token], dtype="<u4")
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    out.append((doc_id, k, start, length, zlib.crc32(ids[start:start + length].tobytes())))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(types)], names=names)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return narrow.mapInArrow(encode, PIECES)


def best_fit(items, lengths: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Add items, in the order given, each to the fullest bin that can hold it."""
    m = len(lengths) + 1
    room = [capacity - sum(lengths[i] for i in b) for b in bins]
    free = sorted(r * m + b for b, r in enumerate(room) if r)
    for i in items:
        n = lengths[i]
        at = bisect_left(free, n * m)
        if at < len(free):
            b = free.pop(at) % m
            bins[b].append(i)
            room[b] -= n
        else:
            b = len(bins)
            bins.append([i])
            room.append(capacity - n)
        if room[b]:
            insort(free, room[b] * m + b)
    return bins


def longest_first(items, lengths: list[int]) -> list[int]:
    return sorted(items, key=lambda i: (-lengths[i], i))


def crossover(giver: list[list[int]], taker: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Inject the giver's well-filled bins whole; best-fit what the taker's broken bins lose."""
    level = WELL_FILLED * capacity
    child = [list(b) for b in giver if sum(lengths[i] for i in b) >= level]
    held = {i for b in child for i in b}
    displaced = []
    for b in taker:
        if held.isdisjoint(b):
            child.append(list(b))
        else:
            displaced += [i for i in b if i not in held]
    return best_fit(longest_first(displaced, lengths), lengths, child, capacity)


def mutate(bins: list[list[int]], lengths: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Empty the worst bins and as many others at random; best-fit their pieces in a jittered order."""
    by_fill = sorted(range(len(bins)), key=lambda b: (sum(lengths[i] for i in bins[b]), b))
    worst = by_fill[:max(2, len(bins) // 20)]
    out = set(worst) | set(rng.choice(len(bins), size=min(len(bins), len(worst)), replace=False).tolist())
    moved = [i for b in sorted(out) for i in bins[b]]
    noise = rng.random(len(moved))
    order = [i for _, i in sorted((-lengths[i] * (0.9 + 0.1 * x), i) for i, x in zip(moved, noise))]
    return best_fit(order, lengths, [list(b) for k, b in enumerate(bins) if k not in out], capacity)


def rating(bins: list[list[int]], lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins are better; of equal counts, the more uneven fill (sum of squares)."""
    return len(bins), -sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in bins)


def to_bins(genome: np.ndarray) -> list[list[int]]:
    bins: list[list[int]] = [[] for _ in range(int(genome.max()) + 1)]
    for i, b in enumerate(genome):
        bins[b].append(i)
    return bins


def to_genome(bins: list[list[int]], n: int) -> np.ndarray:
    genome = np.empty(n, dtype=np.int32)
    for k, b in enumerate(bins):
        genome[b] = k
    return genome


def evolve(problem: int, island: int, epoch: int, lengths: list[int], people: list[list[list[int]]],
           capacity: int) -> list[list[list[int]]]:
    """One epoch of one island: its next population, best first."""
    rng = np.random.default_rng([problem & 0x7FFFFFFF, island, epoch])
    rate = lambda bins: rating(bins, lengths, capacity)
    while len(people) < POPULATION:
        start = best_fit(longest_first(range(len(lengths)), lengths), lengths, [], capacity)
        people.append(mutate(start, lengths, capacity, rng) if people else start)
    least = math.ceil(sum(lengths) / capacity)
    people.sort(key=rate)
    for _ in range(GENERATIONS):
        if len(people[0]) == least:
            break
        giver, taker = people[0], people[int(rng.integers(1, len(people)))]
        child = crossover(giver, taker, lengths, capacity)
        people += [child, mutate(child, lengths, capacity, rng)]
        people.sort(key=rate)
        people = people[:POPULATION]
    return people


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequence and offset of every piece. ``rows``: a written table of ``pieces``."""
    part = rows.filter(F.col("length") < capacity).withColumn("row", F.monotonically_increasing_id())
    n = part.count()
    problems = max(1, math.ceil(n / PROBLEM_ROWS))
    entry = F.struct("row", "length", "doc_id", "piece", "start", "ids_crc32")
    dealt = (part.withColumn("problem", F.pmod(F.xxhash64("row"), F.lit(problems)))
             .groupBy("problem").agg(F.sort_array(F.collect_list(entry)).alias("items")))  # PROBLEM_ROWS on average
    dealt = table(dealt, "pack-problems")
    state = dealt.select("problem", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
                         F.col("items.length").cast("array<int>").alias("lengths"),
                         F.lit(0).alias("bins"), F.lit(0.0).alias("fill"), F.array().cast("array<int>").alias("genome"))

    def epoch_of(epoch: int):
        def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            problem, island = int(key[0]), int(key[1])
            lengths = [int(x) for x in group["lengths"].iloc[0]]
            genomes = sorted(tuple(g) for g in group["genome"] if len(g))
            people = evolve(problem, island, epoch, lengths, [to_bins(np.array(g)) for g in genomes], capacity)
            out = []
            for k, bins in enumerate(people):
                count, fill = rating(bins, lengths, capacity)
                genome = to_genome(bins, len(lengths))
                out.append((problem, island, lengths, count, fill, genome))
                if not k:  # the elite also goes to the next island
                    out.append((problem, (island + 1) % ISLANDS, lengths, count, fill, genome))
            return pd.DataFrame(out, columns=["problem", "island", "lengths", "bins", "fill", "genome"])
        return run

    tasks = min(problems * ISLANDS, 4 * partitions(rows.sparkSession))  # little data, much work: never coalesced
    for epoch in range(EPOCHS):
        state = state.repartition(tasks, "problem", "island")
        state = state.groupBy("problem", "island").applyInPandas(epoch_of(epoch), STATE)
    best = state.groupBy("problem").agg(F.min_by("genome", F.struct("bins", "fill", "island", "genome")).alias("genome"))
    placed = (dealt.join(best, "problem")
              .select("problem", F.explode(F.arrays_zip("items", "genome")).alias("x"))
              .select("x.items.*", (F.col("problem") * (4 * PROBLEM_ROWS * 16) + F.col("x.genome")).alias("bin")))
    before = Window.partitionBy("bin").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    packed = placed.select("doc_id", "piece", "start", "length", "ids_crc32",
                           (F.col("bin") * 2).cast("long").alias("sequence_id"),
                           F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset"))
    full = (rows.filter(F.col("length") == capacity)
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    return packed.unionByName(full)


def pack_documents(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = CAPACITY,
                   end_token: int = END_TOKEN, id_col: str = "doc_id", text_col: str = "text",
                   added: dict[str, int] | None = None) -> DataFrame:
    """Pieces of all documents with their sequence and offset. ``added``: see ``added_tokens``."""
    cut = pieces(docs, vocabulary, pattern, capacity, end_token, id_col, text_col, added)
    return pack(table(cut, "pack-pieces"), capacity)
