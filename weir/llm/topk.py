"""Exact top-k by inner product: tiled matrix products and tree merging.

Components become ``floor(64 * x)``. Candidates are dealt into shards and
queries into tiles, both of bounded size by a hash of their row. A task gets
one tile and a few shards, multiplies them, keeps the best ``k`` of each tile
(partial selection, then order) and merges them. What the tasks found per query
is merged in a tree, ``FAN`` lists at a time. No task sees more than a tile and
``RUN`` shards, no list is longer than ``FAN * k``.

Products run in double precision as long as every sum is an exact integer
there, else in Python's integers; scores beyond the range of a long stop at
its ends. Ties go to the smaller vec_id, then to the earlier row. NULL ids,
NULL vectors and vectors with NULL or non-finite components take no part. A
vector meets those of its own length only. Rows that repeat a vec_id are rows
of their own, as queries and as candidates; only the query's own row is left
out. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import written
from weir.llm.vectors import packs, slots, unpacked, valid_vectors

SCALE = 64
TILE = 4096
SHARD = 2048
RUN = 4  # shards that a task compares with a tile
FAN = 64
EXACT = 1 << 50  # sums below are exact as doubles, with room to break ties
HITS = "qrow long, query_id long, run int, score long, vec_id long, crow long"


def top_of_tile(queries: np.ndarray, vectors: np.ndarray, own: np.ndarray, k: int):
    """Per query the positions and scores of the ``k`` best vectors; earlier positions win ties.

    ``own`` marks the pairs to leave out; places that stay empty get position -1.
    """
    k = min(k, len(vectors))
    largest = max(np.abs(queries).max(initial=0), np.abs(vectors).max(initial=0))
    if largest * largest * max(queries.shape[1], 1) < EXACT / len(vectors):
        scores = (queries @ vectors.T).astype(np.int64)
        # one number that orders by score, then by position
        rank = scores * len(vectors) + np.arange(len(vectors) - 1, -1, -1)
        rank[own] = np.iinfo(np.int64).min
        best = np.argpartition(rank, len(vectors) - k, axis=1)[:, len(vectors) - k :]
        order = np.argsort(-np.take_along_axis(rank, best, 1), axis=1, kind="stable")
        best = np.take_along_axis(best, order, 1)
        top = np.take_along_axis(scores, best, 1)
        best[np.take_along_axis(own, best, 1)] = -1
        return best, top
    left = [[int(x) for x in q] for q in queries]
    right = [[int(x) for x in v] for v in vectors]
    most = np.iinfo(np.int64)
    best, top = np.full((len(left), k), -1), np.zeros((len(left), k), np.int64)
    for i, q in enumerate(left):
        sums = [min(max(sum(map(int.__mul__, q, v)), most.min), most.max) for v in right]
        order = sorted((j for j in range(len(right)) if not own[i, j]), key=lambda j: (-sums[j], j))[:k]
        best[i, : len(order)], top[i, : len(order)] = order, [sums[j] for j in order]
    return best, top


def merged(hits: pd.DataFrame, k: int) -> pd.DataFrame:
    hits = hits.sort_values(["qrow", "score", "vec_id", "crow"], ascending=[True, False, True, True])
    return hits[hits.groupby("qrow").cumcount() < k]


def _compare(k: int):
    def compare(tile: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        found = pd.DataFrame({name.split()[0]: pd.Series(dtype="int64") for name in HITS.split(", ")})
        for q in tile.itertuples():
            ids, rows, queries = unpacked(q)
            queries = np.floor(queries * SCALE)
            for shard in shards.itertuples():
                c_ids, c_rows, vectors = unpacked(shard)
                own = rows[:, None] == c_rows[None, :]
                best, top = top_of_tile(queries, np.floor(vectors * SCALE), own, k)
                at, slot = np.nonzero(best >= 0)
                pos = best[at, slot]
                new = pd.DataFrame({"qrow": rows[at], "query_id": ids[at], "run": q.run, "score": top[at, slot], "vec_id": c_ids[pos], "crow": c_rows[pos]})
                found = merged(pd.concat([found, new]), k)
        return found

    return compare


def top_k(embeddings: DataFrame, queries: str, k: int, tile: int = TILE, shard: int = SHARD) -> DataFrame:
    """The ``k`` highest products of every row for which ``queries`` holds: (query_id, rank, vec_id, score)."""
    vectors = valid_vectors(embeddings, "topk-vectors")
    asked = vectors.filter(queries)
    # one row per vector length
    sizes = {r.dim: r["count"] for r in vectors.groupBy("dim").count().collect()}
    asked_sizes = {r.dim: r["count"] for r in asked.groupBy("dim").count().collect()}
    if not asked_sizes:
        return vectors.limit(0).selectExpr("vec_id query_id", "1 rank", "vec_id", "vec_id score")
    shards = written(packs(vectors.withColumn("shard", slots(F.col("rid"), sizes, shard)), ["dim", "shard"]), "topk-shards")
    tiles = packs(asked.withColumn("tile", slots(F.col("rid"), asked_sizes, tile)), ["dim", "tile"])
    last = lambda counts, size: F.create_map(*[F.lit(x) for d, n in counts.items() for x in (d, -(-n // size) - 1)])[F.col("dim")]
    every_tile = F.explode(F.sequence(F.lit(0), last(asked_sizes, tile)))
    every_run = F.explode(F.sequence(F.lit(0), last(sizes, shard * RUN)))
    keys = ["dim", "tile", "run"]
    left = written(tiles, "topk-tiles").withColumn("run", every_run)
    right = shards.withColumn("run", F.expr(f"cast(shard % {'(' + _runs(sizes, shard) + ')'} as int)")).withColumn("tile", every_tile)
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_compare(k), HITS)
    runs = max(-(-n // (shard * RUN)) for n in sizes.values())
    order = [F.col("score").desc(), "vec_id", "crow"]
    while runs > FAN:
        hits = hits.withColumn("run", F.floor(F.col("run") / FAN))
        some = Window.partitionBy("qrow", "run").orderBy(*order)
        hits = hits.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
        runs = -(-runs // FAN)
    rank = F.row_number().over(Window.partitionBy("qrow").orderBy(*order))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _runs(sizes: dict[int, int], shard: int) -> str:
    cases = " ".join(f"when {d} then {-(-n // (shard * RUN))}" for d, n in sizes.items())
    return f"case dim {cases} end"
