"""Near copies of vectors by cosine: a subspace pigeonhole join.

For vectors of length 1 a cosine of ``c`` or more is a squared distance of ``2 - 2 c``
or less. A rotation (principal axes of a bounded sample, dealt out in turn) and a
cut into blocks of about ``BLOCK`` dimensions split that distance into parts. Each
block gets a share of the allowed sum in proportion to its variance; so a linked
pair is within its budget in one block at least. Candidates are the pairs within
the budget of some block; every one is decided by the cosine of the two original
vectors in double precision. No linked pair is missed.

1. Equal vectors form a class; one row stands for it.
2. Dense balls: where ``HOT`` vectors of the sample lie within ``BALL`` of a link's
   distance of one of them, all vectors that near to it form a ball. Balls whose centres and
   radii leave no doubt are linked as a whole, by counts and one edge a member:
   a group of near copies with a third of all rows costs one step a row.
3. Cells: a tree over the rotated sample (medians of the widest axis) deals out
   the other vectors. Cells whose boxes are farther apart than a link are not
   compared. The tree is bounded; large cells are cut into tiles by a hash.
4. Tiles: a task compares one tile with up to ``RUN`` others, a slice at a time and
   only within reach along the first axis: a product per block, the union of its
   candidates, the check. It returns a row per vector that has links there: how
   many, and the least member of those connected in the task. No row is made per
   pair, so copies need no room.
5. Those rows are the edges of the components.

How much is compared depends on the data: cells thin out what has structure. For
vectors in random directions in many dimensions no exact method of this kind can
leave much out, and the comparison of tiles is a blocked scan.

Vectors that are NULL, zero or hold NULL or non-finite components link with
nothing: 0 links, their own component. Vectors meet those of their own length.
Rows that repeat a vec_id, or have none, are rows of their own; a component takes
its smallest id that is not NULL. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import written
from weir.llm.near_dups import components

SAMPLE = 4096  # vectors of a length on the driver
BLOCK = 16
BALL = 0.45  # of the distance of a link, so that any two vectors of a ball are linked
HOT = 8
CELLS = 512
TILE = 8192
RUN = 4
SLICE = 512
CHECKED = 1 << 15  # pairs whose vectors are gathered at once
AXES = 32  # rotated axes that boxes are kept for
SLACK = 1e-5  # of products in float32
SURE = 1e-7


class Layout(NamedTuple):
    """How vectors of one length are placed and compared."""

    rotation: np.ndarray  # original to rotated axes
    blocks: list[np.ndarray]  # axes of each block
    budgets: list[float]  # squared distance for each block; they sum to the allowed one
    centres: np.ndarray  # rotated centres of the dense balls
    axis: np.ndarray  # tree: axis and place of each inner node, in heap order
    place: np.ndarray
    radius: float  # of the balls

    @property
    def balls(self) -> int:
        return len(self.centres)


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # squares must not overflow
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in double precision, summed in one fixed order; the same for (b, a)."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    dot, left, right = (np.add.reduce(x, axis=1) for x in (a * b, a * a, b * b))
    return dot / np.sqrt(left * right)


def layout(sample: np.ndarray, rows: int, allowed: float, tile: int) -> Layout:
    dim = sample.shape[1]
    u = unit(sample)
    centred = u - u.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(u))
    rotation = np.ascontiguousarray(axes[:, ::-1])
    variance = np.maximum(values[::-1], 0) + 1e-9
    count = max(1, dim // BLOCK)
    blocks = [np.arange(i, dim, count) for i in range(count)]
    budgets = [allowed * variance[b].sum() / variance.sum() for b in blocks]
    z = u @ rotation
    radius = BALL * math.sqrt(allowed)
    centres, rest = dense_balls(z, radius)
    cells = min(CELLS, max(1, -(-rows // tile)))
    axis, place = tree(z[rest], math.ceil(math.log2(cells)))
    return Layout(rotation, blocks, budgets, centres, axis, place, radius)


def dense_balls(z: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres of balls with ``HOT`` rows or more, the fullest first, and which rows are in none."""
    rest = np.ones(len(z), bool)
    near = np.concatenate([2 - 2 * z[i : i + SLICE] @ z.T <= radius * radius for i in range(0, len(z), SLICE)])
    centres = []
    while True:
        full = (near & rest).sum(axis=1) * rest
        best = int(full.argmax())
        if full[best] < HOT:
            return z[centres], rest
        centres.append(best)
        rest &= ~near[best]


def tree(z: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Splits at the median of the widest axis, in heap order."""
    axis, place = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
    inside = [z]
    for node in range(len(axis)):
        own = inside[node]
        if len(own) > 1:
            axis[node] = own.var(axis=0).argmax()
            place[node] = np.median(own[:, axis[node]])
        right = own[:, axis[node]] > place[node]
        inside += [own[~right], own[right]]
    return axis, place


def cells(how: Layout, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's cell, balls first, and its distance from the centre of its ball (0 without)."""
    node = np.zeros(len(z), np.int64)
    while len(z) and node[0] < len(how.axis):  # a complete tree: all arrive together
        node = 2 * node + 1 + (z[np.arange(len(z)), how.axis[node]] > how.place[node])
    cell, away = how.balls + node - len(how.axis), np.zeros(len(z))
    if how.balls:
        apart = np.sqrt(np.maximum((z * z).sum(1)[:, None] + (how.centres**2).sum(1) - 2 * z @ how.centres.T, 0))
        best = apart.argmin(axis=1)
        nearest = apart[np.arange(len(z)), best]
        member = nearest <= how.radius
        cell[member], away[member] = best[member], nearest[member]
    return cell, away


def _matrix(lists: pa.Array, rows: np.ndarray, dim: int) -> np.ndarray:
    return lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dim)


def _placed(layouts: dict[int, Layout], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = batch.column("dim").to_numpy()
        cell = np.zeros(len(lengths), np.int64)
        away = np.zeros(len(lengths))
        for dim in np.unique(lengths):
            rows = np.flatnonzero(lengths == dim)
            z = unit(_matrix(batch.column("vec"), rows, dim).astype(float)) @ layouts[dim].rotation
            cell[rows], away[rows] = cells(layouts[dim], z)
        columns = [batch.column(c) for c in ("cid", "dim", "copies", "vec")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(cell.astype(np.int32)), pa.array(away)], ["cid", "dim", "copies", "vec", "cell", "away"])


def _boxes(layouts: dict[int, Layout], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and cell the range along the first axes."""
    found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        lengths, cell = batch.column("dim").to_numpy(), batch.column("cell").to_numpy()
        for dim, own in set(zip(lengths.tolist(), cell.tolist())):
            rows = np.flatnonzero((lengths == dim) & (cell == own))
            z = (unit(_matrix(batch.column("vec"), rows, dim).astype(float)) @ layouts[dim].rotation)[:, :AXES]
            low, high = found.get((dim, own), (z[0], z[0]))
            found[dim, own] = np.minimum(low, z.min(axis=0)), np.maximum(high, z.max(axis=0))
    for (dim, own), (low, high) in found.items():
        k = len(low)
        names = ["dim", "cell", "i", "low", "high"]
        columns = [np.full(k, dim, np.int32), np.full(k, own, np.int32), np.arange(k, dtype=np.int32), low, high]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches)).combine_chunks()  # one tile
    lists = table.column("vec").chunk(0)
    kind = np.float32 if pa.types.is_float32(lists.type.value_type) else np.float64
    first = [table.column(c).slice(0, 1).combine_chunks() for c in ("dim", "cell", "part")]
    first = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in first]
    data = [table.column("cid").to_numpy(), table.column("copies").to_numpy(), lists.flatten().to_numpy(zero_copy_only=False).astype(kind)]
    wide = pa.array([kind is np.float64])
    yield pa.RecordBatch.from_arrays([*first, wide, *[pa.array([d.tobytes()], pa.binary()) for d in data]], ["dim", "cell", "part", "wide", "ids", "copies", "vectors"])


def _unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, copies = np.frombuffer(row.ids, np.int64), np.frombuffer(row.copies, np.int64)
    return ids, copies, np.frombuffer(row.vectors, np.float64 if row.wide else np.float32).reshape(len(ids), -1).astype(float)


class Forest:
    """Least connected member of each of n items."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up
            one, two = self.root[a], self.root[b]
            apart = one != two
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(one, two)[apart], np.minimum(one, two)[apart])


class Side(NamedTuple):
    """A tile ready for comparison, in order of its first rotated axis."""

    ids: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray
    first: np.ndarray
    left: list[np.ndarray]  # per block, so that left @ right.T is minus half the squared distance
    right: list[np.ndarray]


def side(how: Layout, row) -> Side:
    ids, copies, vectors = _unpacked(row)
    z = unit(vectors) @ how.rotation
    order = np.argsort(z[:, 0], kind="stable")
    ids, copies, vectors, z = ids[order], copies[order], vectors[order], z[order]
    left, right = [], []
    for block in how.blocks:
        own = z[:, block].astype(np.float32)
        half = (own * own).sum(axis=1, keepdims=True) / 2
        one = np.ones_like(half)
        left.append(np.hstack([own, -half, one]))
        right.append(np.hstack([own, one, -half]))
    return Side(ids, copies, vectors, z[:, 0], left, right)


def links(how: Layout, least: float, a: Side, b: Side, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of places, some at a time; of a tile with itself each pair once."""
    reach = math.sqrt(sum(how.budgets)) + SURE
    for at in range(0, len(a.ids), SLICE):
        end = min(at + SLICE, len(a.ids))
        low = np.searchsorted(b.first, a.first[at] - reach)
        high = np.searchsorted(b.first, a.first[end - 1] + reach, "right")
        if same:
            low = max(low, at)
        near = np.zeros((end - at, max(high - low, 0)), bool)
        if not near.size:
            continue
        for left, right, budget in zip(a.left, b.right, how.budgets):
            near |= left[at:end] @ right[low:high].T >= -(budget / 2 + SLACK)
        i, j = np.nonzero(near)
        i, j = i + at, j + low
        if same:
            i, j = i[i < j], j[i < j]
        for some in range(0, len(i), CHECKED):
            p, q = i[some : some + CHECKED], j[some : some + CHECKED]
            linked = cosine(a.vectors[p], b.vectors[q]) >= least
            yield p[linked], q[linked]


def _compare(layouts: dict[int, Layout], least: float, tiles: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
    """Per vector with links between a tile and others: cid, its number of links, the least connected cid."""
    out = []
    for row in tiles.itertuples():
        how = layouts[row.dim]
        a = side(how, row)
        for other in others.rename(columns=lambda c: c.removeprefix("b_")).sort_values("part").itertuples():
            same = (other.cell, other.part) == (row.cell, row.part)
            b = a if same else side(how, other)
            shift = 0 if same else len(a.ids)
            n = shift + len(b.ids)
            ids = a.ids if same else np.r_[a.ids, b.ids]
            order = np.argsort(ids, kind="stable")  # so that the least place is the least id
            place = np.empty(n, np.int64)
            place[order] = np.arange(n)
            met, forest = np.zeros(n, np.int64), Forest(n)
            for i, j in links(how, least, a, b, same):
                np.add.at(met, i, b.copies[j])
                np.add.at(met, shift + j, a.copies[i])
                forest.join(place[i], place[shift + j])
            has = np.flatnonzero(met)
            out.append(pd.DataFrame({"cid": ids[has], "links": met[has], "root": ids[order][forest.root[place[has]]]}))
    return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("cid", "links", "root")})


def box_gaps(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance between every two boxes."""
    gaps = np.zeros((len(low), len(low)))
    for k in range(low.shape[1]):
        apart = np.maximum(low[:, None, k] - high[None, :, k], 0)
        gaps += np.maximum(apart, apart.T) ** 2
    return gaps


class Cells(NamedTuple):
    """Bounded facts about the cells of one length."""

    numbers: np.ndarray  # of the cells that have rows
    parts: np.ndarray  # tiles of each
    met: np.ndarray  # cells to compare, as a matrix
    sure: np.ndarray  # balls that are linked as a whole


def _cell_facts(how: Layout, facts: pd.DataFrame, boxes: pd.DataFrame, allowed: float, tile: int) -> Cells:
    facts = facts.sort_values("cell")
    numbers = facts["cell"].to_numpy()
    boxes = boxes.sort_values(["cell", "i"])
    low, high = (boxes[c].to_numpy().reshape(len(numbers), -1) for c in ("low", "high"))
    met = box_gaps(low, high) <= allowed + SURE
    ball = numbers < how.balls
    sure = np.zeros_like(met)
    if ball.any():
        centres, radius = how.centres[numbers[ball]], facts["radius"].to_numpy()[ball]
        apart = np.sqrt(np.maximum((centres**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * centres @ centres.T, 0))
        np.fill_diagonal(apart, 0)
        sure[np.ix_(ball, ball)] = apart + radius[:, None] + radius <= math.sqrt(allowed) - SURE
    return Cells(numbers, -(-facts["n"].to_numpy() // tile), met & ~sure, sure)


def _neighbours(dims: dict[int, Cells]) -> list[tuple]:
    """(dim, cell, other, parts, other_parts) of cells to compare, cell <= other; at most the square of the bound on cells."""
    out = []
    for dim, c in dims.items():
        for i, j in zip(*np.nonzero(np.triu(c.met))):
            out.append((dim, int(c.numbers[i]), int(c.numbers[j]), int(c.parts[i]), int(c.parts[j])))
    return out


def usable(vec: Column) -> Column:
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _samples(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length a bounded sample of different vectors."""
    out = {}
    for dim in [r.dim for r in classes.select("dim").distinct().collect()]:
        some = classes.filter(F.col("dim") == dim).select("cid", "vec").orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).collect()
        out[dim] = np.array([r.vec for r in some], float)
    return out


def linked_vectors(embeddings: DataFrame, least: float = 0.9, tile: int = TILE) -> DataFrame:
    """Per row: vec_id, n_links (other rows with a cosine of ``least`` or more), component_id, kept.

    ``least`` is above 0. ``kept`` holds when the id is the component's.
    """
    spark = embeddings.sparkSession
    vec = F.col("embedding")
    if embeddings.schema["embedding"].dataType.elementType.typeName() not in ("float", "double"):
        vec = vec.cast("array<double>")
    rows = embeddings.select("vec_id", vec.alias("vec")).withColumn("ok", usable(F.col("vec")))
    rows = written(rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "ok", F.when(F.col("ok"), F.col("vec")).alias("vec")), "rows")
    key = ["dim", "v1", "v2"]
    keys = [F.size("vec").alias("dim"), F.xxhash64("vec").alias("v1"), F.xxhash64(F.lit(1), "vec").alias("v2")]
    usable_rows = rows.filter("ok").select("rid", "vec_id", "vec", *keys)
    classes = usable_rows.groupBy(*key).agg(
        F.min("rid").alias("cid"), F.count("*").alias("copies"), F.min("vec_id").alias("least_id"), F.min_by("vec", "rid").alias("vec")
    )
    classes = written(classes, "classes")
    # one row per vector length
    sizes = {r.dim: r["count"] for r in classes.groupBy("dim").count().collect()}
    allowed = 2 - 2 * least
    samples = _samples(classes)
    layouts = {dim: layout(samples[dim], n, allowed, tile) for dim, n in sizes.items()}
    kind = classes.schema["vec"].dataType.simpleString()
    placed = classes.select("cid", "dim", "copies", "vec").mapInArrow(partial(_placed, layouts), f"cid long, dim int, copies long, vec {kind}, cell int, away double")
    placed = written(placed, "placed")
    facts = placed.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.sum("copies").alias("weight"), F.max("away").alias("radius"), F.min("cid").alias("anchor"))
    facts = facts.toPandas()  # one row per cell
    boxes = placed.mapInArrow(partial(_boxes, layouts), "dim int, cell int, i int, low double, high double")
    boxes = boxes.groupBy("dim", "cell", "i").agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas()
    dims = {d: _cell_facts(layouts[d], facts[facts["dim"] == d], boxes[boxes["dim"] == d], allowed, tile) for d in sizes}

    hits = _tile_hits(placed, layouts, dims, least)
    sure, anchors = _sure_links(spark, facts, dims)
    members = placed.join(F.broadcast(sure), ["dim", "cell"])
    members = members.select("cid", (F.col("weight") - F.col("copies")).alias("links"), F.col("anchor").alias("root"))
    hits = written(hits.union(members), "hits")
    edges = hits.select(F.col("cid").alias("a"), F.col("root").alias("b")).union(anchors).filter("a <> b")
    roots = components(edges)

    counts = hits.groupBy("cid").agg(F.sum("links").alias("links"))
    found = classes.join(counts, "cid", "left").join(roots.select(F.col("node").alias("cid"), "root"), "cid", "left")
    found = found.select(*key, "least_id", F.expr("copies - 1 + coalesce(links, 0)").alias("n_links"), F.coalesce("root", "cid").alias("root"))
    found = written(found, "found")
    smallest = found.groupBy("root").agg(F.min("least_id").alias("component_id"))
    answers = found.join(smallest, "root").select(*key, "n_links", "component_id")
    out = usable_rows.select("vec_id", *key).join(answers, key).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _tile_hits(placed: DataFrame, layouts: dict[int, Layout], dims: dict[int, Cells], least: float) -> DataFrame:
    """Links found by comparing tiles: cid, links, root."""
    spark = placed.sparkSession
    parts = [(d, int(c), int(p)) for d, facts in dims.items() for c, p in zip(facts.numbers, facts.parts)]
    cut = F.broadcast(spark.createDataFrame(parts, "dim int, cell int, parts int"))
    dealt = placed.join(cut, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("cid"), "parts").cast("int"))
    rows = dealt.select("cid", "copies", "vec", "dim", "cell", "part").groupBy("dim", "cell", "part")
    packed = "dim int, cell int, part int, wide boolean, ids binary, copies binary, vectors binary"
    tiles = written(rows.applyInArrow(_pack_table, packed), "tiles")
    beside = _neighbours(dims)
    near = spark.createDataFrame(beside, "dim int, cell int, other int, parts int, other_parts int")
    runs = F.expr(f"explode(sequence(0, cast(ceil(other_parts / {RUN}) as int) - 1))")
    ask = tiles.join(F.broadcast(near.drop("parts")), ["dim", "cell"]).withColumn("run", runs).drop("other_parts")
    ask = ask.filter(f"cell <> other or part < {RUN} * (run + 1)")
    names = {c: f"b_{c}" for c in tiles.columns}
    their = near.select(F.col("dim").alias("b_dim"), F.col("other").alias("b_cell"), F.col("cell").alias("a_cell"), "parts")
    meet = tiles.withColumnsRenamed(names).join(F.broadcast(their), ["b_dim", "b_cell"])
    meet = meet.withColumn("a_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    meet = meet.filter("a_cell <> b_cell or a_part <= b_part").withColumn("b_run", F.expr(f"cast(floor(b_part / {RUN}) as int)"))
    groups = sum(-(-p // RUN) * q for _, _, _, q, p in beside)
    tasks = max(1, min(groups, 20_000))  # small but heavy groups: not merged by size
    own, met = ["dim", "cell", "part", "other", "run"], ["b_dim", "a_cell", "a_part", "b_cell", "b_run"]
    left, right = ask.repartition(tasks, *own).groupBy(*own), meet.repartition(tasks, *met).groupBy(*met)
    return left.cogroup(right).applyInPandas(partial(_compare, layouts, least), "cid long, links long, root long")


def _pack_table(table: pa.Table) -> pa.Table:
    return pa.Table.from_batches(list(_pack(iter(table.to_batches()))))


def _sure_links(spark, facts: pd.DataFrame, dims: dict[int, Cells]) -> tuple[DataFrame, DataFrame]:
    """What balls linked as a whole add: (dim, cell, weight, anchor) and the edges between anchors."""
    whole, edges = [], []
    for dim, c in dims.items():
        own = facts[facts["dim"] == dim].sort_values("cell")
        weight, anchor = own["weight"].to_numpy(), own["anchor"].to_numpy()
        for i in np.flatnonzero(c.sure.any(axis=1)):
            linked = np.flatnonzero(c.sure[i])
            whole.append((dim, int(c.numbers[i]), int(weight[linked].sum()), int(anchor[i])))
            edges += [(int(anchor[i]), int(anchor[j])) for j in linked if i < j]
    return spark.createDataFrame(whole, "dim int, cell int, weight long, anchor long"), spark.createDataFrame(edges, "a long, b long")
