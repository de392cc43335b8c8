import math

import numpy as np
import pytest
from conftest import SF_DIR

from weir.llm import ann
from weir.llm.queries import REGISTRY
from weir.queries.tables import table


def brute(rows, step, k):
    ok = [(i, n, v) for n, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for i, n, q in ok:
        if i % step == 0:
            rest = [(j, np.array(v, float)) for j, m, v in ok if m != n and len(v) == len(q)]
            scores = [(float(np.round(-ann.cosine(np.array([q], float), v[None])[0], 12)), j) for j, v in rest]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def rounded(df):
    return sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 12) + 0.0) for r in df.collect())


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_DIR, "embeddings").collect()]
    assert rounded(REGISTRY["op9_ann"][0](spark, SF_DIR)) == brute(rows, 50, 5)


def test_odd_rows(spark):
    rows = [(i, [math.sin(i), math.cos(i * 7), 0.5]) for i in range(200)]
    rows += [(250 + i, [1.0, 2.0, 3.0]) for i in range(40)]  # a popular vector
    rows += [(400, None), (401, [1.0, None, 2.0]), (402, [float("nan"), 0.0, 1.0]), (450, [0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(50, [9.0, 1.0, 2.0]), (50, [9.0, 1.0, 2.0]), (500, [1.0, 2.0]), (501, [3.0, 2.0]), (550, [1.0]), (600, []), (650, [1e300, -1e300, 1e299])]
    data = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, table int")
    assert rounded(ann.nearest(data, "vec_id % 50 = 0", 5)) == brute(rows, 50, 5)
    assert ann.nearest(data.limit(0), "vec_id % 50 = 0", 5).count() == 0
    assert ann.nearest(data, "vec_id < -99", 5).count() == 0


@pytest.mark.parametrize("clusters", [0, 40])
def test_recall_of_many_buckets(spark, clusters):
    rng = np.random.default_rng(clusters)
    n = 6000
    data = rng.standard_normal((n, 24))
    if clusters:
        data = rng.standard_normal((clusters, 24))[rng.integers(0, clusters, n)] + 0.3 * data
    df = spark.createDataFrame(list(enumerate(data.tolist())), "vec_id long, embedding array<double>")
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    scores = unit[::50] @ unit.T
    scores[np.arange(len(scores)), np.arange(0, n, 50)] = -9
    want = np.argsort(-scores, axis=1)[:, :5]
    got = {}
    for r in ann.nearest(df, "vec_id % 50 = 0", 5).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = np.mean([len(got[50 * i] & set(map(int, w))) / 5 for i, w in enumerate(want)])
    assert recall >= 0.9


def found_and_wanted(spark, data, **options):
    df = spark.createDataFrame(list(enumerate(data.tolist())), "vec_id long, embedding array<double>")
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    got = {i: [] for i in range(0, len(data), 50)}
    for r in ann.nearest(df, "vec_id % 50 = 0", 5, **options).collect():
        got[r.query_id].append(r.vec_id)
    scores = unit[::50] @ unit.T
    scores[np.arange(len(scores)), list(got)] = -9
    return got, dict(zip(got, np.argsort(-scores, axis=1)[:, :5].tolist()))


def test_near_copies_do_not_shorten_the_search_of_others(spark):
    rng = np.random.default_rng(9)
    n = 6000
    data = rng.standard_normal((n, 24))
    copies = rng.random(n) < 0.55
    data[copies] = rng.standard_normal((3, 24))[rng.integers(0, 3, copies.sum())] + 0.002 * rng.standard_normal((copies.sum(), 24))
    got, want = found_and_wanted(spark, data)
    assert {len(ids) for ids in got.values()} == {5}
    for group in (False, True):
        asked = [i for i in got if copies[i] == group]
        assert np.mean([len(set(got[i]) & set(want[i])) / 5 for i in asked]) >= 0.9


def test_too_few_candidates_are_scanned_for(spark):
    rng = np.random.default_rng(3)
    data = 4 + rng.standard_normal((3000, 8))  # a cone
    data[::50] = rng.standard_normal((60, 8))  # queries apart from it
    got, _ = found_and_wanted(spark, data, success=0.0, tables=1)
    assert {len(ids) for ids in got.values()} == {5}


def share_met(n, queries=24, dim=32):
    rng = np.random.default_rng(n)
    unit = rng.standard_normal((n, dim))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    sample = unit[rng.choice(n, min(n, ann.SAMPLE), replace=False)]
    hashing = ann.Hashing(dim, n, sample, 5, ann.SUCCESS)
    codes = hashing.codes(unit)
    shares = []
    for table, bucket in hashing.probes(unit[:queries]):
        assert len(set(zip(table.tolist(), bucket.tolist()))) == len(table)  # no bucket twice
        met = np.zeros(n, bool)
        for t in range(hashing.tables):
            met |= np.isin(codes[:, t], bucket[table == t])
        shares.append(met.mean())
    return np.mean(shares)


def test_a_larger_table_meets_a_smaller_share():
    small, large = share_met(2000), share_met(64000)
    assert large < 0.8 * small


def test_visits_reach_the_chance_asked_for_and_not_more():
    rng = np.random.default_rng(1)
    unit = ann._unit(rng.standard_normal((5000, 16)))
    counts = []
    for success in (0.3, 0.6, 0.9):
        hashing = ann.Hashing(16, 5000, unit[:1000], 5, success)
        counts.append([len(t) for t, _ in hashing.probes(unit[:10])])
    assert all(a < b < c for a, b, c in zip(*counts))


def test_a_query_far_from_all_visits_no_buckets_but_all_rows(spark):
    rng = np.random.default_rng(4)
    data = 6 * np.eye(24)[0] + rng.standard_normal((200_000, 24))
    unit = ann._unit(data)
    hashing = ann.Hashing(24, len(data), unit[:4096], 5, 0.999)
    assert hashing.probes(-unit[:3]) == [None] * 3
    near = hashing.probes(unit[:3])
    assert all(p is None or len(p[0]) <= ann.MOST_PROBES for p in near)
    few = data[:3000].copy()
    few[::50] *= -1  # opposite to all but one another
    got, want = found_and_wanted(spark, few)
    assert np.mean([len(set(got[i]) & set(want[i])) / 5 for i in got]) >= 0.9


def test_met_ids_are_routed_once_by_block_and_query():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict(
        {
            "q": pa.array([1, 1, 2, 1], pa.int64()),
            "dim": pa.array([3, 3, 3, 4], pa.int32()),
            "rids": pa.array([[5, 6, 7], [6, 7], [7], []], pa.list_(pa.int64())),
        }
    )
    out = ann._route({3: 2, 4: 1}, {3: 1, 4: 1}, batch)
    rows = list(zip(*[c.to_pylist() if hasattr(c, "to_pylist") else c.tolist() for c in out.values()]))
    assert rows == [(3, 0, 0, [1], [1], [6]), (3, 1, 0, [1, 2], [2, 1], [5, 7, 7])]
    empty = ann._route({3: 2}, {3: 1}, batch.slice(0, 0))
    assert all(len(c) == 0 for c in empty.values())
