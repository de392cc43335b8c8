import math
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF_DIR

from weir.llm import whitening as W
from weir.llm.queries import REGISTRY
from weir.queries.tables import table


def usable(rows):
    return [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]


def check(got, rows, components=32, tolerance=1e-9):
    """All columns against a plain computation; signs are free but the same for all rows."""
    rows = usable(rows)
    x = np.array([[math.floor(64 * c) + 1000000 for c in v] for _, v in rows])
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, x.shape[1])
    table = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-10
        assert abs(r.explained * np.trace(v) / values[r.component - 1] - 1) < 1e-10
        table.setdefault(r.component, []).append((r.deviation, r.whitened))
    assert sorted(table) == list(range(1, k + 1))
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    for c, found in table.items():
        want = sorted(zip(deviation.tolist(), centred @ vectors[:, c - 1] / math.sqrt(values[c - 1])))
        assert sorted(d for d, _ in found) == sorted(deviation.tolist())
        one, two = (np.sort(np.array([w for _, w in part])) for part in (found, want))
        assert min(np.abs(one - two).max(), np.abs(one + two[::-1]).max()) < tolerance


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_DIR, "embeddings").collect()]
    got = REGISTRY["op12_whitening"][0](spark, SF_DIR)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.collect()
    assert len({(r.vec_id, r.component) for r in got}) == len(got) == 32 * len(usable(rows))
    check(got, rows)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, n int, component int")


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((90, 3)).tolist())]
    rows += [(5, [1.0, 2.0, 3.0])] * 7 + [(None, [3.0, 1.0, 2.0])]
    bad = [(200, None), (201, [1.0, None, 2.0]), (202, [float("nan"), 0.0, 1.0]), (203, [float("inf"), 0.0, 1.0]), (204, [])]
    got = W.whitened_components(frame(spark, rows + bad).repartition(5))
    check(got.collect(), rows)
    assert got.filter("vec_id is null").count() == 3
    vectors = {r.vec_id: r.whitened for r in W.whiten(frame(spark, rows + bad)).collect()}
    assert vectors[204] == [] and 200 not in vectors and len(vectors[0]) == 3
    assert W.whitened_components(frame(spark, rows).limit(0)).count() == 0
    assert W.whitened_components(frame(spark, bad)).count() == 0
    # lengths are fits of their own; equal rows and fewer rows than dimensions have components without variance
    mixed = W.whitened_components(frame(spark, rows + [(300 + i, [float(i % 2), 4.0]) for i in range(10)])).collect()
    check([r for r in mixed if r.vec_id is None or r.vec_id < 300], rows)
    flat = [r for r in mixed if r.vec_id is not None and r.vec_id >= 300]
    assert {(r.n, r.component, r.explained, round(abs(r.whitened), 9)) for r in flat} == {(10, 1, 1.0, 1.0), (10, 2, 0.0, 0.0)}
    assert all(r.whitened == r.explained == 0 and r.deviation == 0 for r in W.whitened_components(frame(spark, [(1, [1.0, 2.0])] * 3)).collect())


def test_large_values_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(a), float(b)]) for i, (a, b) in enumerate(rng.integers(-(10**9), 10**9, (40, 2)))]
    got = W.whitened_components(frame(spark, rows)).collect()
    x = [[math.floor(64 * c) + 1000000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {i: min(2**63 - 1, sum((40 * c - s) ** 2 for c, s in zip(v, sums))) for i, v in enumerate(x)}
    assert {r.vec_id: r.deviation for r in got} == want
    assert got[0].identity_error < 1e-10
    held = W.whitened_components(frame(spark, [(1, [1e300, -1e300]), (2, [0.0, 5.0]), (3, [1.0, 2.0])])).collect()
    assert len(held) == 6 and all(math.isfinite(r.whitened) for r in held)


def test_products_are_exact():
    rng = np.random.default_rng(3)
    for spread in (50, 2**19, 2**30, 2**50):
        y = rng.integers(-spread, spread, (9000, 3))
        want = y.astype(object).T @ y.astype(object)
        assert (W.products(y, spread).astype(object) == want).all()
    assert W.rounded(1, 3) * 3 == 1 and abs(Fraction(float(W.rounded(2, 7))) - Fraction(2, 7)) < Fraction(1, 10**16)


@pytest.mark.parametrize("gaps", ["spread", "clustered", "equal", "singular"])
def test_refinement_reaches_double_precision(gaps):
    rng = np.random.default_rng(4)
    n = 40
    q = np.linalg.qr(rng.standard_normal((n, n)))[0].astype(W.WIDE)
    for _ in range(3):  # orthogonal in extended precision
        q = q @ (3 * np.eye(n, dtype=W.WIDE) - q.T @ q) / 2
    values = np.linspace(100, 1, n).astype(W.WIDE)
    if gaps == "clustered":
        values[10:15] = 50 + np.arange(4, -1, -1) * W.WIDE(1e-7)
        values[20:22] = 30 + np.array([1e-6, 0], W.WIDE)
    if gaps == "equal":
        values[10:15] = 50
    if gaps == "singular":
        values[30:] = 0
    values = np.sort(values)[::-1]
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    found, x = W.refined(a)
    assert np.abs(found - values.astype(float)).max() < 1e-12
    assert np.abs(x.T @ x - np.eye(n)).max() < 1e-14
    assert np.abs(a.astype(float) @ x - x * found).max() < 1e-12
    if gaps in ("spread", "clustered"):  # float64 alone is off by about 1e-14 / 1e-7 in the clusters
        cosines = np.abs((q.T @ x.astype(W.WIDE)).diagonal()).astype(float)
        assert np.abs(cosines - 1).max() < 1e-14
        rest = q.T @ x.astype(W.WIDE)
        assert np.abs(rest - np.diag(rest.diagonal())).max() < 1e-8
