"""Approximate nearest neighbours by inner product with a forest of hash-prefix trees.

The rows are dealt into shards. In a shard every tree is a sorted array of long hash
strings: each letter is the axis, with its sign, that is nearest to the vector after a
random rotation. A query descends every tree to its longest matching prefix, which is a
range of the sorted array, and then all trees ascend together, one letter at a time,
until the ranges hold enough candidates. These are scored exactly, and the best of all
shards are merged. Different lengths of vectors add one coordinate, so that the largest
inner product is the smallest angle.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .ship import ship

TREES = 48
LETTERS = 4
#: Different candidates that end the ascent: this part of all rows, and at least so many.
CANDIDATE_PART = 0.1
MIN_CANDIDATES = 1000
#: Rows of a shard: a 32nd of the table, between these bounds.
SHARD_ROWS = (1 << 13, 1 << 18)
QUERY_BLOCK = 1 << 11


@lru_cache(maxsize=4)
def _rotations(dim: int, trees: int, letters: int, seed: int) -> np.ndarray:
    """(tree, letter, dim, dim) random rotations, the same in every task."""
    rng = np.random.default_rng(seed)
    return np.linalg.qr(rng.normal(size=(trees, letters, dim, dim)))[0].astype(np.float32)


def hash_strings(vectors: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """(tree, row): each row's string in each tree, as a number whose leading digits are the first letters."""
    trees, letters, dim, _ = rotations.shape
    out = np.zeros((trees, len(vectors)), np.uint64)
    rows, low = np.arange(len(vectors)), vectors.astype(np.float32)
    for t in range(trees):
        for k in range(letters):
            turned = low @ rotations[t, k]
            axis = np.abs(turned).argmax(axis=1)
            out[t] = out[t] * np.uint64(2 * dim) + (2 * axis + (turned[rows, axis] > 0)).astype(np.uint64)
    return out


def search_shard(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
                 k: int, longest: float, wanted: float, trees: int = TREES, letters: int = LETTERS,
                 seed: int = 42) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, row ids and scores of the best ``k`` candidates of each query in one shard."""
    dim = vectors.shape[1] + 1
    rotations = _rotations(dim, trees, letters, seed)
    rest = np.sqrt(np.maximum(longest ** 2 - (vectors ** 2).sum(1), 0))
    strings = hash_strings(np.column_stack([vectors, rest]), rotations)
    wanted_strings = hash_strings(np.column_stack([queries, np.zeros(len(queries))]), rotations)
    order = np.argsort(strings, axis=1, kind="stable")
    strings = np.take_along_axis(strings, order, axis=1)
    # Ranges of every prefix length in every tree: (letters + 1, tree, query).
    low, high = (np.zeros((letters + 1, trees, len(queries)), np.int64) for _ in range(2))
    for depth in range(letters + 1):
        unit = np.uint64((2 * dim) ** (letters - depth))
        for t in range(trees):
            prefix = wanted_strings[t] // unit * unit
            low[depth, t] = np.searchsorted(strings[t], prefix)
            high[depth, t] = np.searchsorted(strings[t], prefix + unit)
    # All trees ascend together. No more candidates than this are below a prefix length:
    most = (high - low).sum(axis=1)
    out_q, out_i = [], []
    for q in range(len(queries)):
        seen = np.zeros(len(ids), bool)
        for depth in range(letters, 0, -1):
            if most[depth, q] >= wanted:
                for t in range(trees):
                    seen[order[t, low[depth, t, q]:high[depth, t, q]]] = True
                if seen.sum() >= wanted:
                    break
        else:
            seen[:] = True
        at = np.flatnonzero(seen & (ids != query_ids[q]))
        scores = vectors[at] @ queries[q]
        if len(at) > k:
            least = np.partition(scores, len(at) - k)[len(at) - k]
            at = at[scores >= least - 1e-12 * dim * longest * np.linalg.norm(queries[q])]  # with all ties of the last
        out_q.append(np.full(len(at), q))
        out_i.append(at)
    q, i = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (out_q, out_i))
    # A matrix product rounds by place; added up one component after the other, equal vectors have equal scores.
    exact = np.zeros(len(q))
    for d in range(vectors.shape[1]):
        exact += vectors[i, d] * queries[q, d]
    order = np.lexsort((ids[i], -exact, q))
    q, i, exact = q[order], i[order], exact[order]
    first = np.searchsorted(q, q)
    best = np.arange(len(q)) - first < k
    return query_ids[q[best]], ids[i[best]], exact[best]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    array = column.combine_chunks()
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(array), -1)


def nearest(vectors: DataFrame, query_every: int = 20, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding", candidate_part: float = CANDIDATE_PART,
            min_candidates: int = MIN_CANDIDATES, trees: int = TREES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows with the largest inner product found.

    Queries are the rows whose id is divisible by ``query_every``; a row is no neighbour of
    its own id. Ties go to the smaller id. Null ids and vectors that are null, zero, empty or
    hold null or non-finite components take no part; vectors of different lengths are never
    compared. Every other row is in the index.
    """
    vector = F.col(vector_col).cast("array<double>")
    good = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & good).select(
        F.col(id_col).cast("bigint").alias("vec_id"), vector.alias("vector"), norm.alias("norm"),
        F.size(vector).alias("dim")).filter("norm > 0")
    query = F.col("vec_id") % query_every == 0
    n, asked, longest = rows.agg(F.count("*"), F.count(F.when(query, 1)), F.max("norm")).first()
    shards = max(1, -(-n // min(max(n // 32, SHARD_ROWS[0]), SHARD_ROWS[1])))
    blocks = max(1, -(-asked // QUERY_BLOCK))
    part = max(candidate_part, min(1.0, min_candidates / max(n, 1)))

    def search(own: pa.Table, asking: pa.Table) -> pa.Table:
        if not own.num_rows or not asking.num_rows:
            found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            found = search_shard(own["vec_id"].to_numpy(), _matrix(own["vector"]),
                                 asking["vec_id"].to_numpy(), _matrix(asking["vector"]), k,
                                 longest, part * own.num_rows, trees)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()),
                         "score": pa.array(found[2], pa.float64())})

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    index = rows.select("vec_id", "vector", "dim", dealt(shards, 1).alias("shard"), every(blocks).alias("block"))
    asking = rows.filter(query).select("vec_id", "vector", "dim", dealt(blocks, 2).alias("block"),
                                       every(shards).alias("shard"))
    keys = ["dim", "shard", "block"]
    found = ship(index).groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(
        search, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
