import math

import numpy as np
import pytest
from conftest import SF_DIR

from weir.llm import vector_dups as V
from weir.llm.queries import REGISTRY
from weir.queries.tables import table


def brute(rows, least=0.9):
    """(vec_id, n_links, component_id, kept) by comparing all pairs."""
    ok = [v is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    linked = np.zeros((len(rows), len(rows)), bool)
    for dim in {len(v) for (_, v), good in zip(rows, ok) if good}:
        at = np.array([i for i, (_, v) in enumerate(rows) if ok[i] and len(v) == dim])
        u = np.array([rows[i][1] for i in at], float)
        u /= np.abs(u).max(axis=1, keepdims=True)
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        linked[np.ix_(at, at)] = u @ u.T >= least
    np.fill_diagonal(linked, False)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(*np.nonzero(linked)):
        root[find(i)] = find(j)
    smallest = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            smallest[find(i)] = min(k, smallest.get(find(i), k))
    out = [(k, int(linked[i].sum()), smallest.get(find(i))) for i, (k, _) in enumerate(rows)]
    return sorted([(*r, r[0] == r[2]) for r in out], key=repr)


def frame(spark, rows, kind="double"):
    data = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, dim int, cid int, root string")
    return data.repartition(4)


def answers(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_matches_its_sql(spark):
    from check_oracles import compare, connect

    assert compare(spark, connect(SF_DIR), SF_DIR, "op11_embedding_dups") == []


def planted(seed, n=900, dim=64):
    """Random directions, groups of near and equal copies from two to hundreds, chains, and pairs beside the threshold."""
    rng = np.random.default_rng(seed)
    v = list(rng.standard_normal((n, dim)))
    for size, noise in ((2, 0.1), (5, 0.3), (300, 0.02), (250, 0.25), (40, 0.33), (60, 0.0)):
        base = rng.standard_normal(dim)
        v += [rng.uniform(0.1, 9) * (base + noise * rng.standard_normal(dim)) if noise else base for _ in range(size)]
    for cos in (0.95, 0.9 + 1e-6, 0.9 - 1e-6, 0.9001, 0.8999, 0.85):
        a, b = np.linalg.qr(rng.standard_normal((dim, 2)))[0].T
        v += [a, cos * a + math.sqrt(1 - cos * cos) * b]
    step = np.linalg.qr(rng.standard_normal((dim, 2)))[0].T
    v += [math.cos(k * 0.4) * step[0] + math.sin(k * 0.4) * step[1] for k in range(12)]  # linked in a row
    order = rng.permutation(len(v))
    return [(int(k), v[i].tolist()) for k, i in enumerate(order)]


@pytest.mark.parametrize("tile", [V.TILE, 128])
def test_planted_copies(spark, tile):
    rows = planted(1)
    want = brute(rows)
    assert sum(r[1] > 0 for r in want) > 600
    assert answers(V.linked_vectors(frame(spark, rows), tile=tile)) == want


def test_tables_of_floats_and_other_thresholds(spark):
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in planted(2, n=300, dim=40)]
    for least in (0.9, 0.99, 0.6):
        assert answers(V.linked_vectors(frame(spark, rows, "float"), least, tile=200)) == brute(rows, least)


def test_odd_rows(spark):
    rows = [(i, [math.sin(i), math.cos(i * 7), 0.5]) for i in range(100)]
    rows += [(200, None), (201, [1.0, None, 2.0]), (202, [float("nan"), 0.0, 1.0]), (203, [float("inf"), 0.0, 1.0]), (204, [0.0, -0.0, 0.0]), (205, [])]
    rows += [(None, [1.0, 1.0, 1.0]), (None, [0.0, 0.0]), (7, [9.0, 9.0, 9.0]), (7, [9.0, 9.0, 9.0]), (300, [1.0, 2.0]), (301, [2.0, 4.0]), (302, [-1.0, -2.0])]
    rows += [(310, [1.0]), (311, [5.0]), (312, [-2.0]), (320, [1e300, -1e300, 1e299]), (321, [1e-300, -1e-300, 1e-301]), (322, [0.0, -0.0, 1.0]), (323, [-0.0, 0.0, 1.0])]
    rows += [(None, [0.0, 0.0, 0.0, 7.0]), (None, [0.0, 0.0, 0.0, 8.0])]
    for tile in (V.TILE, 16):
        assert answers(V.linked_vectors(frame(spark, rows), tile=tile)) == brute(rows)
    assert V.linked_vectors(frame(spark, rows).limit(0)).count() == 0
    assert answers(V.linked_vectors(frame(spark, rows[100:106]))) == brute(rows[100:106])


def test_hot_group_is_not_compared_pair_by_pair(spark, monkeypatch):
    """A third of the rows are near copies: their ball is linked as a whole."""
    rng = np.random.default_rng(3)
    v = rng.standard_normal((1500, 32))
    v[::3] = v[0] + 0.05 * rng.standard_normal((500, 32))
    rows = list(enumerate(v.tolist()))
    found = {}
    neighbours = V._neighbours

    def watched(dims):
        found.update(dims)
        return neighbours(dims)

    monkeypatch.setattr(V, "_neighbours", watched)
    assert answers(V.linked_vectors(frame(spark, rows))) == brute(rows)
    assert found[32].numbers[0] == 0 and found[32].sure[0, 0] and not found[32].met[0, 0]


def test_cells_leave_out_what_is_far(spark):
    """Vectors near a surface of few dimensions: the share of cells compared falls with their number."""
    rng = np.random.default_rng(4)
    v = rng.standard_normal((4000, 4)) @ rng.standard_normal((4, 64)) + 0.01 * rng.standard_normal((4000, 64))
    how = V.layout(v, 1 << 30, 0.2, 1 << 21)
    z = V.unit(v) @ how.rotation
    cell, _ = V.cells(how, z)
    tree = [z[cell == c][:, : V.AXES] for c in range(how.balls, how.balls + len(how.axis) + 1) if (cell == c).sum()]
    met = V.box_gaps(np.array([t.min(axis=0) for t in tree]), np.array([t.max(axis=0) for t in tree])) <= 0.2
    assert met.mean() < 0.2
