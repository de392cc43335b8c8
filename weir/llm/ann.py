"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing.

Vectors are scaled to length 1, where the order by Euclidean distance is the
order by cosine. Each of ``TABLES`` tables hashes with k functions
``floor((a . v + b) / WIDTH)``, a Gaussian (2-stable): for a neighbour at distance
r the projections differ by N(0, r * r). So the chance that it lies in a given
bucket is a product of normal probabilities, and a query visits the buckets
around its own, in all tables together, in falling order of that chance, until
the estimated chance to have met the neighbour reaches ``success``. r is each
query's own distance to its k-th neighbour in a bounded sample, which errs to the
far side; so groups of near copies shorten the search of their own members only.
k grows with the logarithm of the table, without an end, so that buckets hold
about ``BUCKET`` rows at every size.

Tables hold row ids only. The ids that a query meets go to the blocks of rows
that hold their vectors, where those met in several tables become one; each
candidate is compared once, by its exact cosine on the given vectors in double
precision. Buckets, the queries at them and the blocks are cut by counts, so a
popular bucket is many bounded tasks. Of equal vectors only the ``k + 1`` with the
smallest ids can be an answer, so only these are indexed; equal queries are
searched once.

Queries that met fewer than ``k + 1`` rows, or that would visit more than
``MOST_PROBES`` buckets (neighbours hardly nearer than chance), are compared with
all rows, in blocks.

NULL ids and vectors, zero vectors, and vectors with NULL or non-finite
components take no part; a vector meets those of its own length only. Rows that
repeat a vec_id are rows of their own; only a query's own row is left out. Up to
``SMALL`` vectors of a length form one bucket, and the answer is exact.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import map_batches, written
from weir.llm.vectors import valid_vectors

TABLES = 16
WIDTH = 2.5
BUCKET = 12
SMALL = 1024
SUCCESS = 0.88
MOST_PROBES = 16384
SAMPLE = 4096
BLOCK = 4096  # rows of a block, whose vectors are in one task
LIST = 256  # ids of a list of a bucket
LISTS = 4096  # lists of a bucket that a query gathers in one task
ASKED = 1024  # queries at one list
TILE = 1 << 20  # candidates of a task
PROBED = 128  # queries whose buckets one task lists
MIX = 0x5851F42D4C957F2D  # an odd multiplier: cells to one number


class Hashing:
    """The functions for vectors of one length."""

    def __init__(self, dim: int, rows: int, sample: np.ndarray, near: int, success: float, tables: int = TABLES):
        self.k = round(math.log2(rows / BUCKET)) if rows > SMALL else 0
        rng = np.random.default_rng([7, dim])
        self.tables = tables if self.k else 1
        self.lines = rng.standard_normal((self.tables * self.k, dim))
        self.offsets = rng.uniform(0, WIDTH, (self.tables, self.k))
        self.sample, self.near, self.success = sample, near, success

    def radius(self, unit: np.ndarray) -> np.ndarray:
        """Each row's distance to its ``near``-th neighbour in the sample; the row itself may be the 0-th."""
        at = min(self.near, len(self.sample) - 1)
        near = np.partition(2 - 2 * unit @ self.sample.T, at, axis=1)[:, at]
        return np.sqrt(np.maximum(near, 1e-12))

    def places(self, unit: np.ndarray) -> np.ndarray:
        """Rows x tables x functions, in units of a cell."""
        return ((unit @ self.lines.T).reshape(len(unit), self.tables, self.k) + self.offsets) / WIDTH

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """Rows x tables: the bucket of each row."""
        cells = np.floor(self.places(unit)).astype(np.int64)
        code = np.zeros(cells.shape[:2], np.int64)
        for i in range(self.k):
            code = code * MIX + cells[..., i]
        return code

    def probes(self, unit: np.ndarray) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Per query the tables and buckets to visit, in falling order of success; None: too many."""
        out = []
        for at in range(0, len(unit), 8):
            out += self._visits(unit[at : at + 8])
        return out

    def _visits(self, unit: np.ndarray) -> list[tuple[np.ndarray, np.ndarray] | None]:
        places = self.places(unit)
        own = np.floor(places).astype(np.int64)
        # chance that the neighbour's cell is 1 below, the same, or 1 above, per function
        edges = own[..., None] + np.arange(-1, 3) - places[..., None]
        chance = np.diff(_normal(edges / (self.radius(unit) / WIDTH)[:, None, None, None]), axis=-1)
        chance = np.log(np.maximum(chance, 1e-300))
        best = chance.max(axis=-1)
        most = best.sum(axis=-1)
        out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(unit)
        # all buckets above a least chance, which falls until they suffice
        least = most.max(axis=1) - 4
        lowest = chance.min(axis=-1).sum(axis=-1).min(axis=1)
        waiting = np.arange(len(unit))
        while len(waiting):
            q, t = np.repeat(waiting, self.tables), np.tile(np.arange(self.tables), len(waiting))
            value, code = most[q, t], np.zeros(len(q), np.int64)
            for i in range(self.k):
                # the best that is still possible after this function's cell
                each = (value - best[q, t, i])[:, None] + chance[q, t, i]
                row, move = np.nonzero(each >= least[q][:, None])
                value, q, t = each[row, move], q[row], t[row]
                code = code[row] * MIX + own[q, t, i] + move - 1
            order = np.lexsort((code, t, -value, q))
            q, t, value, code = q[order], t[order], value[order], code[order]
            rest = []
            for n, first, last in zip(waiting, np.searchsorted(q, waiting), np.searchsorted(q, waiting, side="right")):
                enough = self._enough(t[first:last], np.exp(value[first:last]))
                if enough is None and least[n] > lowest[n]:
                    if last - first <= MOST_PROBES:
                        rest.append(n)
                elif enough is None or enough <= MOST_PROBES:
                    stop = last if enough is None else first + enough
                    out[n] = t[first:stop], code[first:stop]
            waiting = np.array(rest, np.int64)
            least[waiting] -= 0.7
        return out

    def _enough(self, table: np.ndarray, chance: np.ndarray) -> int | None:
        """How many visits of the given ones reach ``success``: that some table has met the neighbour."""
        reached = lambda n: 1 - np.prod(1 - np.bincount(table[:n], chance[:n], self.tables)) >= self.success
        if not reached(len(table)):
            return None
        low, high = 0, len(table)
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if reached(middle) else (middle + 1, high)
        return low


def _normal(x: np.ndarray) -> np.ndarray:
    erf = np.frompyfunc(math.erf, 1, 1)  # made here: it cannot be sent to tasks
    return 0.5 * (1 + erf(x / math.sqrt(2)).astype(float))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares must not overflow
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _by_length(batch: pa.RecordBatch):
    lengths = batch.column("dim").to_numpy()
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        vectors = batch.column("vec").take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), dim)
        yield int(dim), batch.column("rid").to_numpy()[rows], vectors


HASHED = "rid long, dim int, table int, bucket long"


def _hashed(found: list[tuple[np.ndarray, int, np.ndarray, np.ndarray]]) -> dict:
    join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    return {
        "rid": join([f[0] for f in found], np.int64),
        "dim": join([np.full(len(f[0]), f[1]) for f in found], np.int32),
        "table": join([f[2] for f in found], np.int32),
        "bucket": join([f[3] for f in found], np.int64),
    }


def _index(hashings: dict[int, Hashing], batch: pa.RecordBatch) -> dict:
    found = []
    for dim, rids, vectors in _by_length(batch):
        h = hashings[dim]
        found.append((np.repeat(rids, h.tables), dim, np.tile(np.arange(h.tables), len(rids)), h.codes(_unit(vectors)).ravel()))
    return _hashed(found)


def _probe(hashings: dict[int, Hashing], batch: pa.RecordBatch) -> dict:
    """The buckets that each query visits; one row with table -1 for a query that would visit too many."""
    found = []
    for dim, rids, vectors in _by_length(batch):
        for rid, probes in zip(rids, hashings[dim].probes(_unit(vectors))):
            table, bucket = probes if probes is not None else (np.array([-1]), np.array([0]))
            found.append((np.full(len(table), rid), dim, table, bucket))
    return _hashed(found)


def _mixed(rid, high):
    """A number that spreads rows evenly over blocks, from ids of which the high bits are a task's."""
    return rid + high * 7919


ROUTED = "dim int, block int, part int, asked array<long>, n array<int>, rids array<long>"


def _route(blocks: dict[int, int], parts: dict[int, int], batch: pa.RecordBatch) -> dict:
    """Met ids, each once a batch, by the block that holds their vectors."""
    lists = batch.column("rids")
    n = np.diff(lists.offsets.to_numpy())
    q, dim = (np.repeat(batch.column(c).to_numpy(), n) for c in ("q", "dim"))
    rid = lists.flatten().to_numpy()
    lengths, which = np.unique(dim, return_inverse=True)
    count = lambda of: np.array([of[int(d)] for d in lengths], np.int64)[which] if len(lengths) else np.zeros(0, np.int64)
    block, part = _mixed(rid, rid >> 33) % count(blocks), _mixed(q, q >> 33) % count(parts)
    order = np.lexsort((rid, q, part, block, dim))
    table = np.stack([x[order] for x in (dim, block, part, q, rid)])
    table = table[:, np.append(True, (table[:, 1:] != table[:, :-1]).any(axis=0))] if table.shape[1] else table
    new = lambda upto: np.flatnonzero(np.append(True, (table[:upto, 1:] != table[:upto, :-1]).any(axis=0))) if table.shape[1] else np.zeros(0, np.int64)
    tiles, runs = new(3), new(4)
    cut = lambda at, values, kind: pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))
    run_at = np.append(np.searchsorted(runs, tiles), len(runs))
    return {
        **{c: table[i, tiles].astype(np.int32) for i, c in enumerate(("dim", "block", "part"))},
        "asked": cut(run_at, table[3, runs], pa.int64()),
        "n": cut(run_at, np.diff(np.append(runs, table.shape[1])), pa.int32()),
        "rids": cut(np.append(tiles, table.shape[1]), table[4], pa.int64()),
    }


BEST = "q long, hits array<struct<less:double,vec_id:long,rid:long>>"


class _Rows:
    """The vectors of a block, by row id."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("rid")
        self.rid, self.vec_id = rows["rid"].to_numpy(), rows["vec_id"].to_numpy()
        self.vec = np.stack(rows["vec"].to_list())
        self.unit = _unit(self.vec)

    def best(self, k: int, vec: np.ndarray, at: np.ndarray | slice) -> list[dict]:
        """The k best of the rows ``at``, in order; ties to the smaller id."""
        at = np.arange(len(self.rid))[at]
        if len(at) > k:
            scores = self.unit[at] @ _unit(vec[None])[0]
            # products round differently in different blocks: leave room, rank exactly
            at = at[scores >= np.partition(scores, -k)[-k] - 1e-9]
        less = -cosine(np.broadcast_to(vec, (len(at), len(vec))), self.vec[at])
        order = np.lexsort((self.rid[at], self.vec_id[at], less))[:k]
        columns = zip(less[order].tolist(), self.vec_id[at[order]].tolist(), self.rid[at[order]].tolist())
        return [{"less": x, "vec_id": i, "rid": r} for x, i, r in columns]


def _compare(k: int, met: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
    """The k best of a block for each query that met some of its rows."""
    if not len(met):
        return pd.DataFrame({"q": pd.Series(dtype="int64"), "hits": pd.Series(dtype="object")})
    rows = _Rows(vectors[~vectors["query"]])
    asked = vectors[vectors["query"]]
    vec = dict(zip(asked["rid"].tolist(), asked["vec"]))
    q = np.repeat(np.concatenate(met["asked"].to_list()), np.concatenate(met["n"].to_list()))
    at = np.searchsorted(rows.rid, np.concatenate(met["rids"].to_list()))
    pairs = _distinct(q, at)
    starts = np.flatnonzero(np.append(True, pairs[0, 1:] != pairs[0, :-1]))
    ends = np.append(starts[1:], pairs.shape[1])
    hits = [rows.best(k, np.asarray(vec[int(pairs[0, s])]), pairs[1, s:e]) for s, e in zip(starts, ends)]
    return pd.DataFrame({"q": pairs[0, starts], "hits": hits})


def _distinct(q: np.ndarray, at: np.ndarray) -> np.ndarray:
    order = np.lexsort((at, q))
    q, at = q[order], at[order]
    return np.stack([q, at])[:, np.append(True, (q[1:] != q[:-1]) | (at[1:] != at[:-1]))]


def _scan(k: int, asked: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
    """The k best of a block for each query, of all its rows."""
    if not len(asked) or not len(near):
        return pd.DataFrame({"q": pd.Series(dtype="int64"), "hits": pd.Series(dtype="object")})
    rows = _Rows(near)
    return pd.DataFrame({"q": asked["q"].to_numpy(), "hits": [rows.best(k, np.asarray(v), slice(None)) for v in asked["vec"]]})


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed in one fixed order."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    dot, left, right = (np.add.reduce(x, axis=1) for x in (a * b, a * a, b * b))
    return dot / (np.sqrt(left) * np.sqrt(right))


def _samples(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length a bounded sample, scaled to length 1."""
    out = {}
    for dim in [r.dim for r in vectors.select("dim").distinct().collect()]:
        rows = vectors.filter(F.col("dim") == dim).select("rid", "vec").orderBy(F.xxhash64("rid")).limit(SAMPLE).collect()
        out[dim] = _unit(np.array([r.vec for r in rows]).reshape(len(rows), dim))
    return out


def _by_dim(counts: dict[int, int]):
    return F.create_map(*[F.lit(x) for item in counts.items() for x in item])[F.col("dim")]


def _block(counts: dict[int, int], rid: str = "rid"):
    return F.pmod(_mixed(F.col(rid), F.shiftright(F.col(rid), 33)), _by_dim(counts)).cast("int")


def _every(n):
    return F.explode(F.sequence(F.lit(0), n - 1))


def _spread(column: str, n: str):
    return F.pmod(F.xxhash64(column), F.col(n)).cast("int")


def _firsts(hits: DataFrame, k: int) -> DataFrame:
    """(q, rid, vec_id, less): the k best of the blocks' lists."""
    rows = hits.select("q", F.inline("hits"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy("less", "vec_id", "rid"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k).select("q", "rid", "vec_id", "less")


def candidates(index: DataFrame, probes: DataFrame, blocks: dict[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """The ids in the visited buckets, as rows of ``ROUTED``, and the number of parts of each block."""
    key = ["dim", "table", "bucket"]
    count = lambda df, name: df.groupBy(*key).agg(F.count("*").alias(name))
    cuts = count(index, "near").join(count(probes, "asked"), key)
    pieces = lambda name, size: F.ceil(F.col(name) / size).cast("int").alias(f"{name}_cuts")
    cuts = written(cuts.select(*key, "near", "asked", pieces("near", LIST), pieces("asked", ASKED)), "ann-cuts")
    total = cuts.groupBy("dim").agg(F.sum(F.col("near").cast("double") * F.col("asked")).alias("met"))
    parts = dict.fromkeys(blocks, 1) | {r.dim: math.ceil(r.met / blocks[r.dim] / TILE) for r in total.collect()}
    cuts = cuts.drop("near", "asked")
    lists = index.join(cuts, key).withColumn("near", _spread("rid", "near_cuts")).groupBy(*key, "near", "asked_cuts")
    lists = lists.agg(F.collect_list("rid").alias("rids")).select(*key, "near", _every(F.col("asked_cuts")).alias("asked"), "rids")
    visits = probes.join(cuts, key).select(*key, _spread("rid", "asked_cuts").alias("asked"), _every(F.col("near_cuts")).alias("near"), F.col("rid").alias("q"))
    met = visits.join(lists, [*key, "near", "asked"]).select("q", "dim", "rids", F.floor(F.col("near") / LISTS).alias("salt"))
    # a query's lists follow each other, so that most repeats meet in a batch
    met = met.repartition("q", "salt").sortWithinPartitions("q").drop("salt")
    return written(map_batches(met, partial(_route, blocks, parts), ROUTED), "ann-met"), parts


def nearest(embeddings: DataFrame, queries: str, k: int, success: float = SUCCESS, tables: int = TABLES) -> DataFrame:
    """The ``k`` nearest found for every row for which ``queries`` holds: (query_id, rank, vec_id, score)."""
    vectors = valid_vectors(embeddings, "ann-vectors").filter("dim > 0 and exists(vec, x -> x <> 0)")
    same = ["dim", "v1", "v2"]
    keyed = vectors.withColumn("v1", F.xxhash64("vec")).withColumn("v2", F.xxhash64(F.lit(1), "vec"))
    turn = F.row_number().over(Window.partitionBy(*same).orderBy("vec_id", "rid"))
    kept = written(keyed.withColumn("turn", turn).filter(F.col("turn") <= k + 1).drop("turn"), "ann-rows")
    sizes = {r.dim: r["count"] for r in kept.groupBy("dim").count().collect()}
    samples = _samples(kept) if sizes else {}
    hashings = {dim: Hashing(dim, n, samples[dim], k, success, tables) for dim, n in sizes.items()}
    blocks = {dim: -(-n // BLOCK) for dim, n in sizes.items()} or {0: 1}

    asked = keyed.filter(queries)
    # the first row of equal queries searches for all of them
    first = asked.groupBy(*same).agg(F.min("rid").alias("rid"))
    searched = written(asked.join(first.select("rid"), "rid").select("rid", "vec_id", "vec", "dim"), "ann-asked")
    rows = kept.select("rid", "vec_id", "vec", "dim")
    index = written(map_batches(rows.select("rid", "vec", "dim"), partial(_index, hashings), HASHED), "ann-index")
    dealt = searched.select("rid", "vec", "dim").repartition(1 + searched.count() // PROBED, "rid")
    probes = written(map_batches(dealt, partial(_probe, hashings), HASHED), "ann-probes")
    met, parts = candidates(index, probes.filter("table >= 0"), blocks)

    # to each block's vectors those of the queries that met some of them
    tile = ["dim", "block", "part"]
    near = rows.select(F.lit(False).alias("query"), "rid", "vec_id", "vec", "dim", _block(blocks).alias("block"), _every(_by_dim(parts)).alias("part"))
    needed = met.select(*tile, F.explode("asked").alias("rid")).distinct()
    near = near.unionByName(searched.drop("dim").join(needed, "rid").withColumn("query", F.lit(True)))
    compared = met.groupBy(*tile).cogroup(near.groupBy(*tile)).applyInPandas(partial(_compare, k + 1), BEST)
    found = written(_firsts(compared, k + 1), "ann-found")

    # queries that met too few rows, or that would visit too many buckets
    wanted = kept.groupBy("dim").agg(F.least(F.count("*"), F.lit(k + 1)).alias("wanted"))
    counts = found.groupBy(F.col("q").alias("rid")).agg(F.count("*").alias("met"))
    short = searched.join(wanted, "dim").join(counts, "rid", "left").filter("coalesce(met, 0) < wanted")
    short = written(short.select("rid", "vec", "dim"), "ann-short")
    n_short = short.count()
    if n_short:
        groups = -(-n_short // ASKED)
        part = F.pmod(F.xxhash64("rid"), F.lit(groups)).cast("int").alias("part")
        ask = short.select("dim", _every(_by_dim(blocks)).alias("block"), part, F.col("rid").alias("q"), "vec")
        near = rows.select("dim", _block(blocks).alias("block"), _every(F.lit(groups)).alias("part"), "rid", "vec_id", "vec")
        scanned = ask.groupBy(*tile).cogroup(near.groupBy(*tile)).applyInPandas(partial(_scan, k + 1), BEST)
        found = found.join(short.select(F.col("rid").alias("q")), "q", "left_anti").unionByName(_firsts(scanned, k + 1))

    top = found.select("q", "rid", "vec_id", (-F.col("less")).alias("score"))
    owners = asked.join(first.withColumnRenamed("rid", "q"), same).select("q", F.col("rid").alias("own"), F.col("vec_id").alias("query_id"))
    answers = owners.join(top, "q").filter("rid <> own")
    rank = F.row_number().over(Window.partitionBy("own").orderBy(F.col("score").desc(), "vec_id", "rid"))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
