"""Exact top-k inner products by the threshold algorithm (Fagin).

Candidates are dealt into blocks of bounded size and queries into chunks.
Each (block, chunk) pair is one task group: it sorts the block once per
dimension and answers its queries by sorted access. A query walks each
dimension's list from its best end (the largest values for a positive
weight, the smallest for a negative one), scores every row met for the first
time, and stops when the bound (the sum of the weights times the values at
the current depth, which no unseen row can beat) is *below* the k-th score.
A bound equal to the k-th score does not stop it: an unseen row could tie
with a smaller id. The blocks' answers are merged per query, k rows each.

Cases: vectors that are NULL, empty, or hold a NULL or non-finite component
take no part; vectors of another length than the query's are not its
candidates; a row with the query's own id is not its candidate; ties go to
the smaller id; rows with a NULL id take no part; repeated rows are each a
candidate, and equal query rows are one query. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import table

BLOCK_ROWS = 2048
QUERY_ROWS = 512
FIRST_DEPTH = 4
SCALE = 1024
OUT = "query_id long, qkey long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v, dim): components floor(scale * x), x as double, of the vectors that take part."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
            .filter(~bad)
            .select("vec_id", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x)).alias("v"),
                    F.size("v").alias("dim")))


def threshold_search(lists: np.ndarray, values: np.ndarray, rows: np.ndarray, ids: np.ndarray, q: np.ndarray,
                     own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Top k of one block for one query.

    ``lists[:, d]``: row numbers by value of dimension d, ascending;
    ``values``: those values; ``rows``: the block; ``ids``: its ids.
    """
    n = len(rows)
    up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
    seen = ids == own
    best_s, best_i = np.empty(0, np.int64), np.empty(0, np.int64)
    depth, step = 0, FIRST_DEPTH
    while depth < n:
        to = min(n, depth + step)
        met = np.concatenate((lists[n - to:n - depth, up].ravel(), lists[depth:to, down].ravel()))
        if not len(met):  # a zero query: every row scores 0
            met, to = np.arange(n), n
        fresh = np.zeros(n, bool)
        fresh[met] = True
        fresh &= ~seen
        seen |= fresh
        met = np.flatnonzero(fresh)
        best_s, best_i = np.concatenate((best_s, rows[met] @ q)), np.concatenate((best_i, ids[met]))
        keep = np.lexsort((best_i, -best_s))[:k]
        best_s, best_i = best_s[keep], best_i[keep]
        bound = values[n - to, up] @ q[up] + values[to - 1, down] @ q[down]
        if len(best_s) == k and bound < best_s[-1]:
            break
        depth, step = to, step * 2
    return best_s, best_i


def top_k(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score) of every query; ``is_query`` maps the id column to a condition."""
    rows = table(quantised(vectors, id_col, vec_col, scale), "topk-vectors")
    queries = rows.filter(is_query(F.col("vec_id"))).distinct()
    n, nq = rows.count(), queries.count()
    blocks, chunks = max(1, math.ceil(n / BLOCK_ROWS)), max(1, math.ceil(nq / QUERY_ROWS))
    deal = F.xxhash64("vec_id", "v")
    left = rows.select("vec_id", "v", "dim", F.pmod(deal, F.lit(blocks)).alias("block"),
                       F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    right = queries.select("vec_id", "v", "dim", deal.alias("qkey"),
                           F.pmod(F.hash("vec_id", "v"), F.lit(chunks)).alias("chunk"),
                           F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")).alias("block"))

    def search(cands: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(cands) and len(asked):
            block, ids = np.stack(cands["v"].to_numpy()), cands["vec_id"].to_numpy()
            lists = np.argsort(block, axis=0, kind="stable")
            values = np.take_along_axis(block, lists, axis=0)
            for query_id, qkey, q in zip(asked["vec_id"], asked["qkey"], asked["v"]):
                scores, found = threshold_search(lists, values, block, ids, np.asarray(q), query_id, k)
                out.append(pd.DataFrame({"query_id": query_id, "qkey": qkey, "vec_id": found, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in
                                                       ("query_id", "qkey", "vec_id", "score")})

    keys = ("dim", "block", "chunk")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, OUT)
    best = Window.partitionBy("query_id", "qkey").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
