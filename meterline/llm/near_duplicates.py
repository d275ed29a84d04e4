"""N-gram Jaccard join by chosen paths.

Texts are sets of hashed five-word shingles. Texts with equal sets are one
node. In each of several independent runs a node is split recursively: at a
path, it chooses each of its tokens with probability 1 / (threshold * size),
by a hash of the path and the token that all nodes share, and goes on to the
path extended by the token. Two sets at the threshold expect to share one
chosen token at every level, unrelated sets almost none, so buckets (nodes on
one path) shrink quickly. A bucket of at most ``SEARCHED`` nodes is
brute-forced; a larger one is split again, ``DEPTH`` times at most. The number
of runs follows from the target recall of a pair right at the threshold.

Brute force compares 8-bit minhash sketches at a loose level and keeps, per
bucket, a spanning forest of what it links, never the pairs. Buckets of up to
``SMALL`` nodes are compared many at a time; in a larger one, each node visited
is compared with the unvisited rest, so a group of near copies costs about one
comparison a node and is settled where it first fits a search.

Buckets that are still large after the last split are near copies, which no
token separates. Of each, a few nodes picked by hash are compared with all, and
the one with the most hits stands for its group: the group is one component, so
its members are compared with the bucket's other nodes only, each member in one
block per block of others. A group of any size thus costs rows in proportion.

The forests' components are the candidate classes. Inside each, all exact
similarities are computed in blocks of bounded size, as products of token
incidence matrices, and only counts and forests leave a block. So links that
the runs missed inside a class are found too, and no pair is listed.

Result: one row per document with its class (the smallest id among the
documents connected by links) and its number of links (other documents with
similarity at or above the threshold; copies count each).

Cases: NULL and empty texts have the empty set and are copies of each other;
texts of one to four words are one shingle; repeated rows count as copies;
NULL ids are carried, and a class that has no other id has a NULL class; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import free_name, small_batches, table, text_or_empty
from meterline.llm.components import components

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
DEPTH = 3
SMALL = 64
SEARCHED = 4096  # nodes of a bucket that one search takes
LEADERS = 8  # nodes of a bucket too large for that which are compared with all
SKETCH = 64
LOOSE = 0.6
BATCH_ROWS = 16384  # bucket rows of one task group
BLOCK_NODES = 2048
BLOCK_TOKENS = 1_000_000
SEARCH_NODES = 8192
COLUMNS = 8192  # token columns of one matrix product
WORDS_KEPT = 200_000
FILTER_BITS = 2**23  # 1 MB
GOLD = np.uint64(0x9E3779B97F4A7C15)

_WORDS: dict[str, int] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def runs_needed(recall: float = TARGET_RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``.

    Shared chosen tokens are about Poisson with mean 1 at each level, so the
    chance to meet d levels deep is p(d) = 1 - exp(-p(d - 1)), p(0) = 1.
    """
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def word_codes(words: list[str]) -> np.ndarray:
    """64-bit codes of words; a bounded memo keeps frequent ones."""
    if len(_WORDS) > WORDS_KEPT:
        _WORDS.clear()
    out = []
    for w in words:
        code = _WORDS.get(w)
        if code is None:
            code = _WORDS[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace"))
        out.append(code)
    return np.array(out, np.uint64)


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of the text's five-word shingles."""
    codes = word_codes(text.lower().split())
    if not len(codes):
        return codes
    width = min(SHINGLE_WORDS, len(codes))
    n = len(codes) - width + 1
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h = mix(h * GOLD + codes[k:k + n])
    return np.unique(h)


def chosen(tokens: np.ndarray, paths: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(index into paths, extended path) of every token chosen at every path.

    Tokens and paths are well-mixed hashes, so a product with the path made
    odd is hash enough to choose by.
    """
    limit = np.uint64(min(2**64 - 1, int(2**64 / (threshold * len(tokens)))))
    at, out = [], []
    for lo in range(0, len(tokens), COLUMNS):
        part = tokens[lo:lo + COLUMNS]
        h = part[None, :] * (paths | np.uint64(1))[:, None]
        i, j = np.nonzero(h < limit)
        at.append(i)
        out.append(mix(paths[i] * GOLD + part[j]))
    return np.concatenate(at), np.concatenate(out)


def sketch(tokens: np.ndarray) -> np.ndarray:
    """SKETCH minhashes, one byte each."""
    seeds = mix(np.arange(1, SKETCH + 1, dtype=np.uint64) * GOLD) | np.uint64(1)
    low = np.full(SKETCH, np.uint64(2**64 - 1))
    for lo in range(0, len(tokens), COLUMNS):
        low = np.minimum(low, (tokens[lo:lo + COLUMNS][None, :] * seeds[:, None]).min(axis=1))
    return (mix(low) & np.uint64(255)).astype(np.uint8)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def described(docs: DataFrame, runs: int, threshold: float) -> DataFrame:
    """(id, node, size, sketch, paths1, paths2, paths3) of every document; paths as [parent, path, ...]."""
    schema = ("id long, text_key long, node binary, size int, sketch binary, " +
              ", ".join(f"paths{d} array<long>" for d in range(1, DEPTH + 1)))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = mix(np.arange(1, runs + 1, dtype=np.uint64))
        longs = pa.list_(pa.int64())
        for batch in batches:
            nodes, sizes, marks, paths_of = [], [], [], [[] for _ in range(DEPTH)]
            for text in batch.column("text").to_pylist():
                tokens = shingles(text)
                paths = roots if len(tokens) else np.empty(0, np.uint64)
                for level in paths_of:
                    if len(paths):
                        at, longer = chosen(tokens, paths, threshold)
                        level.append(signed(np.stack((paths[at], longer), axis=1).ravel()))
                        paths = longer
                    else:
                        level.append(np.empty(0, np.int64))
                nodes.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                sizes.append(len(tokens))
                marks.append(sketch(tokens).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()),
                 pa.array(marks, pa.binary()), *(pa.array(level, longs) for level in paths_of)],
                names=["id", "text_key", "node", "size", "sketch", *(f"paths{d}" for d in range(1, DEPTH + 1))])

    return docs.select("id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(describe, schema)


def path_rows(nodes: DataFrame, level: int) -> DataFrame:
    """(parent, path, node) of one level."""
    p = F.col(f"paths{level}")
    pairs = F.transform(F.when(F.size(p) > 1, F.sequence(F.lit(0), F.size(p) - 2, F.lit(2))), lambda i: F.struct(
        F.get(p, i).alias("parent"), F.get(p, i + 1).alias("path")))
    return nodes.select("node", F.explode(pairs).alias("x")).select("x.parent", "x.path", "node")


def loose_forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest row connected to each of n rows by the links (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def brute_buckets(group: pd.DataFrame) -> pd.DataFrame:
    """Spanning links of many small buckets at once: rows d apart in a bucket, for d = 1, 2, ..."""
    group = group.sort_values(["path", "node"], kind="stable")
    path = group["path"].to_numpy()
    marks = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(-1, SKETCH)
    left, right, rows = [], [], np.arange(len(group))
    for d in range(1, len(group)):
        rows = rows[rows + d < len(path)]
        rows = rows[path[rows] == path[rows + d]]
        if not len(rows):
            break
        for lo in range(0, len(rows), COLUMNS):
            part = rows[lo:lo + COLUMNS]
            hit = part[(marks[part] == marks[part + d]).sum(axis=1) >= LOOSE * SKETCH]
            left.append(hit)
            right.append(hit + d)
    node = group["node"].to_numpy()
    if not left:
        return pd.DataFrame({"a": node[:0], "b": node[:0]})
    root = loose_forest(np.concatenate(left), np.concatenate(right), len(group))
    own = np.flatnonzero(root != np.arange(len(group)))
    return pd.DataFrame({"a": node[own], "b": node[root[own]]})


def alike(marks: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Which rows of ``marks`` agree with the sketch ``one`` at the loose level."""
    same = (marks == one).view(np.uint64)  # eight bytes of 0 or 1 in each word
    lanes = same[:, 0].copy()
    for k in range(1, same.shape[1]):
        lanes += same[:, k]
    return (lanes * np.uint64(0x0101010101010101)) >> np.uint64(56) >= np.uint64(math.ceil(LOOSE * SKETCH))


def search_block(group: pd.DataFrame) -> pd.DataFrame:
    """Spanning links of one block pair of a large bucket: each node visited is compared with the unvisited."""
    node = group["node"].to_numpy()
    marks = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(-1, SKETCH)
    rest, left, links = np.arange(len(group)), marks, []
    while len(rest):
        queue, rest, left = [int(rest[0])], rest[1:], left[1:]
        while queue and len(rest):
            at = queue.pop()
            near = alike(left, marks[at])
            if near.any():
                links += [(node[at], node[k]) for k in rest[near]]
                queue += rest[near].tolist()
                rest, left = rest[~near], left[~near]
    return pd.DataFrame(links, columns=["a", "b"])


def search_buckets(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Spanning links of one bucket (``key``: its path, batch) or of a batch of small ones (no path)."""
    return brute_buckets(group) if pd.isna(key[0]) else search_block(group)


def in_blocks(rows: DataFrame, key: str, blocks: str, spread: str) -> DataFrame:
    """Each row once per block pair (lo, hi) that its block of ``key`` takes part in."""
    own = F.pmod(F.xxhash64(spread, F.lit("block")), F.col(blocks)).cast("int")
    return (rows.withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int"))))
            .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("other"))


def growing(df: DataFrame) -> DataFrame:
    """A join side that grows with the documents: never broadcast, so the plan is the same at every size."""
    return df.hint("merge")


def likely(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id may be among ``ids``, by a bitmap of FILTER_BITS hashed ids.

    The bitmap has FILTER_BITS / 64 words whatever the input, so it may be
    broadcast. It only spares work: what it lets through is joined exactly.
    """
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), (c % 64).cast("int"))
    words = (ids.select(at(ids.columns[0]).alias("at")).groupBy(F.floor(F.col("at") / 64).alias("word"))
             .agg(F.bit_or(bit(F.col("at"))).alias("bits")))
    return (docs.withColumn("at", at("id")).withColumn("word", F.floor(F.col("at") / 64))
            .join(F.broadcast(words), "word").filter(F.col("bits").bitwiseAND(bit(F.col("at"))) != 0).drop("at", "word", "bits"))


def leading_groups(rest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of buckets too large for one search: the links of each one's leading group, and what is left to compare.

    ``rest``: (path, node, sketch). The second frame has the blocks (path,
    cross, lo, hi) with their nodes: all pairs of blocks of a bucket's other
    nodes, and each such block with each block of the leading group.
    """
    rest = table(rest, "bucket-rest")
    picks = table(rest.groupBy("path").agg(F.array(*(
        F.min(F.struct(F.xxhash64("node", F.lit(k)), "sketch", "node")) for k in range(LEADERS))).alias("pick"))
        .select("path", F.col("pick.sketch").alias("shown"), F.col("pick.node").alias("leader")), "bucket-leaders")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, 1, SKETCH)
            shown = np.frombuffer(b"".join(x for of in batch.column("shown").to_pylist() for x in of), np.uint8)
            hits = (marks == shown.reshape(-1, LEADERS, SKETCH)).sum(axis=2) >= LOOSE * SKETCH
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), batch.column("node"), batch.column("sketch"),
                 pa.array(hits.tolist(), pa.list_(pa.bool_()))], names=["path", "node", "sketch", "hits"])

    met = table(rest.join(growing(picks.select("path", "shown")), "path")
                .mapInArrow(compare, "path long, node binary, sketch binary, hits array<boolean>"), "bucket-hits")
    each = [F.sum(F.col("hits")[k].cast("long")).alias(f"n{k}") for k in range(LEADERS)]
    counts = F.array(*(F.col(f"n{k}") for k in range(LEADERS)))
    blocks = lambda n: F.ceil(n / SEARCH_NODES).cast("int")
    plans = table(met.groupBy("path").agg(F.count(F.lit(1)).alias("n"), *each)
                  .withColumn("most", F.array_max(counts)).withColumn("lead", F.array_position(counts, F.col("most")).cast("int"))
                  .join(picks.select("path", "leader"), "path")
                  .select("path", "lead", F.element_at("leader", F.col("lead")).alias("leader"),
                          blocks(F.col("most")).alias("groups"), blocks(F.col("n") - F.col("most")).alias("others")),
                  "bucket-plans")
    split = met.join(growing(plans), "path").withColumn("led", F.element_at("hits", F.col("lead")))
    links = split.filter("led").select(F.col("leader").alias("a"), F.col("node").alias("b"))

    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = F.pmod(F.xxhash64("node", F.lit("block")), F.when(F.col("led"), F.col("groups")).otherwise(F.col("others"))).cast("int")
    split = split.filter("others > 0").withColumn("own", own)
    place = lambda cross, lo, hi: F.struct(F.lit(cross).alias("cross"), lo.alias("lo"), hi.alias("hi"))
    mine = F.col("own")
    among = F.transform(upto("others"), lambda i: place(False, F.least(mine, i), F.greatest(mine, i)))
    facing = F.transform(upto("groups"), lambda i: place(True, mine, i))
    faced = F.transform(upto("others"), lambda i: place(True, i, mine))
    at = F.when(F.col("led"), faced).otherwise(F.concat(among, facing))
    return links, split.select("path", "node", "sketch", F.explode(at).alias("at")).select("path", "node", "sketch", "at.*")


def candidate_links(nodes: DataFrame) -> DataFrame:
    """(a, b) spanning links of all buckets of all runs."""
    marks = nodes.select("node", "sketch")
    found, large = [], None
    for level in range(1, DEPTH + 1):
        rows = path_rows(nodes, level)
        if large is not None:
            rows = rows.join(growing(large.select(F.col("path").alias("parent"))), "parent", "left_semi")
        rows = table(rows.select("path", "node"), f"paths-{level}") if level > 1 else rows.select("path", "node")
        sizes = table(rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1), f"buckets-{level}")
        fit = rows.join(growing(sizes.filter(F.col("n") <= SEARCHED)), "path").join(growing(marks), "node")
        small = F.col("n") <= SMALL
        n = sizes.filter(small).agg(F.sum("n")).first()[0] or 0
        groups = max(1, math.ceil(n / BATCH_ROWS))
        batch = F.when(small, F.pmod(F.xxhash64("path", F.lit("batch")), F.lit(groups))).alias("batch")
        found.append(fit.select("path", "node", "sketch", F.when(~small, F.col("path")).alias("alone"), batch)
                     .groupBy("alone", "batch").applyInPandas(search_buckets, "a binary, b binary"))
        large = sizes.filter(F.col("n") > SEARCHED)
    if not large.isEmpty():
        links, blocks = leading_groups(rows.join(growing(large.select("path")), "path").join(growing(marks), "node"))
        found += [links, blocks.groupBy("path", "cross", "lo", "hi").applyInPandas(search_block, "a binary, b binary")]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def exact_block(group: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links and spanning links of the candidate classes in one block pair.

    ``side`` is 1 for the rows of the second block of a cross pair, else 0.
    """
    out = []
    num = round(threshold * 1000)
    for _, rows in group.groupby("blob", sort=False):
        side, node = rows["side"].to_numpy(), rows["node"].to_numpy()
        cross = bool(side.any())
        sets = [np.asarray(s, np.int64) for s in rows["tokens"]]
        size = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        token, column, times = np.unique(flat, return_inverse=True, return_counts=True)
        column = np.where(times > 1, (times > 1).cumsum() - 1, -1)[column]
        row = np.repeat(np.arange(len(sets)), size)
        row, column = row[column >= 0], column[column >= 0]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            a, b = np.searchsorted(column, (lo, lo + COLUMNS))
            m = np.zeros((len(sets), int(column[b - 1]) - lo + 1 if b > a else 1), np.float32)
            m[row[a:b], column[a:b] - lo] = 1
            shared += m @ m.T
        shared = shared.astype(np.int64)
        near = shared * 1000 >= num * (size[:, None] + size[None, :] - shared)
        np.fill_diagonal(near, False)
        if cross:
            near &= side[:, None] != side[None, :]
        i, j = np.nonzero(near)
        root = loose_forest(i, j, len(sets))
        out.append(pd.DataFrame({"node": node, "links": near @ rows["copies"].to_numpy(np.int64), "root": node[root]}))
    return pd.concat(out) if out else pd.DataFrame({"node": [], "links": [], "root": []})


def exact_links(docs: DataFrame, nodes: DataFrame, blobs: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root): one row per node and block pair of the candidate classes."""
    who = table(nodes.select("node", F.col("least.id").alias("rep"), F.col("least.text_key").alias("rep_key"), "copies", "size")
                .join(blobs, "node"), "blob-nodes")
    per = who.groupBy("blob").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("tokens")).select(
        "blob", F.greatest(F.ceil(F.col("n") / BLOCK_NODES), F.ceil(F.col("tokens") / BLOCK_TOKENS), F.lit(1)).alias("blocks"))
    total = who.agg(F.sum("size")).first()[0] or 0
    groups = max(1, math.ceil(total / BLOCK_TOKENS))

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t) for t in batch["text"]]
            same = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == n for s, n in zip(sets, batch["node"])]
            yield pd.DataFrame({"node": batch["node"], "tokens": [signed(s) for s in sets]})[same]

    same_text = F.col("id").eqNullSafe(F.col("rep")) & (F.col("text_key") == F.col("rep_key"))
    texts = (likely(docs, who.select("rep")).withColumn("text_key", F.xxhash64("text"))
             .join(growing(who.select("rep", "rep_key", "node")), same_text).select("node", "text"))
    sets = texts.mapInPandas(tokenise, "node binary, tokens array<long>").dropDuplicates(["node"])
    rows = who.select("node", "copies", "blob").join(growing(per), "blob").join(growing(sets), "node")
    rows = in_blocks(rows, "blob", "blocks", "node")
    rows = rows.select("node", "copies", "blob", "tokens", "lo", "hi",
                       (F.col("own") != F.col("lo")).cast("int").alias("side"),
                       F.when(F.col("blocks") > 1, F.col("blob")).otherwise(F.lit(None)).alias("large"),
                       F.when(F.col("blocks") > 1, F.lit(0)).otherwise(
                           F.pmod(F.xxhash64("blob", F.lit("group")), F.lit(groups))).alias("batch"))

    def block(group: pd.DataFrame) -> pd.DataFrame:
        return exact_block(group, threshold)

    return rows.groupBy("large", "batch", "lo", "hi").applyInPandas(block, "node binary, links long, root binary")


def placed(docs: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(id, text_key, class_id, first, links) of every row of ``docs`` (id, text).

    ``first``: the row's (id, text_key) is the smallest of its class.
    """
    small_batches(docs.sparkSession)
    told = table(described(docs, runs_needed(recall), threshold), "described")
    same = [F.first(c).alias(c) for c in ("size", "sketch", *(f"paths{d}" for d in range(1, DEPTH + 1)))]
    nodes = table(told.groupBy("node").agg(F.min("id").alias("id"), F.min(F.struct("id", "text_key")).alias("least"),
                                           F.count(F.lit(1)).alias("copies"), *same), "nodes")
    blobs = components(candidate_links(nodes)).withColumnRenamed("label", "blob")
    exact = table(exact_links(docs, nodes, blobs, threshold), "exact-links")
    joined = components(exact.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("label", "root")
    links = exact.groupBy("node").agg(F.sum("links").alias("found"))
    known = nodes.select("node", "id", "least", "copies").join(joined, "node", "left").join(links, "node", "left").select(
        "node", "id", "least", F.coalesce("root", "node").alias("label"),
        (F.col("copies") - 1 + F.coalesce("found", F.lit(0))).alias("links"))
    named = known.groupBy("label").agg(F.min("id").alias("class_id"), F.min("least").alias("least_of_class"))
    known = known.drop("least", "id").join(named, "label").drop("label")
    return (told.select("id", "text_key", "node").join(known, "node")
            .select("id", "text_key", "class_id", F.struct("id", "text_key").eqNullSafe(F.col("least_of_class")).alias("first"),
                    "links"))


def basis(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_or_empty(f"`{text_col}`").alias("text"))


def classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, links) of every document."""
    return placed(basis(docs, id_col, text_col), threshold, recall).select(F.col("id").alias("doc_id"), "class_id", "links")


def first_of_class(docs: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their class: of each, the one with the smallest id (then text hash).

    Rows equal in id and text are one document: any one of them stays.
    """
    stay = table(placed(basis(docs, id_col, text_col), threshold, recall).filter("first")
                 .groupBy("id", "text_key").agg(F.count(F.lit(1)).alias("n")), "class-firsts")
    key, ident = free_name(docs.columns, "__key"), free_name(docs.columns, "__id")
    keys = stay.select(F.col("id").alias(f"{ident}_r"), F.col("text_key").alias(f"{key}_r"))
    out = docs.withColumns({key: F.xxhash64(text_or_empty(f"`{text_col}`")), ident: F.col(f"`{id_col}`").cast("long")})
    out = out.join(keys, (F.col(key) == F.col(f"{key}_r")) & F.col(ident).eqNullSafe(F.col(f"{ident}_r")), "left_semi")
    if not stay.filter("n > 1").isEmpty():
        out = out.dropDuplicates([key, ident])
    return out.select([F.col(f"`{c}`") for c in docs.columns])
