import math

from conftest import SF_DIR

from weir.llm import topk
from weir.llm.queries import REGISTRY
from weir.queries.tables import table


def brute(rows, step, k):
    ok = [(i, n, v) for n, (i, v) in enumerate(rows) if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, n, [math.floor(64 * x) for x in v]) for i, n, v in ok]
    out = []
    for i, n, q in whole:
        if i % step == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, m, v in whole if m != n and len(v) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_DIR, "embeddings").collect()]
    got = REGISTRY["op7_exact_topk"][0](spark, SF_DIR)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, 20)


def test_tiles_ties_and_odd_rows(spark):
    rows = [(i, [float(i % 3), -0.5, 0.01 * (i % 5)]) for i in range(300)]
    rows += [(400, None), (401, [1.0, None, 2.0]), (402, [float("nan"), 0.0, 1.0]), (403, [float("inf"), 0.0, 1.0])]
    rows += [(None, [1.0, 1.0, 1.0]), (20, [9.0, 9.0, 9.0]), (20, [9.0, 9.0, 9.0]), (420, [1.0, 2.0]), (440, [3.0, 2.0]), (460, []), (480, [])]
    rows += [(500, [1e12, -1e12, 3.0, 4.0]), (501, [1e12, 1e11, 1.0, 2.0]), (-20, [0.0, 0.0, 0.0])]
    data = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, rank int, rid int")
    want = brute(rows, 20, 7)
    for tile, shard in ((8192, 2048), (4, 3)):
        got = topk.top_k(data, "vec_id % 20 = 0", 7, tile, shard)
        assert sorted(map(tuple, got.collect())) == [(q, r, i, max(min(s, 2**63 - 1), -(2**63))) for q, r, i, s in want]
    assert topk.top_k(data.limit(0), "vec_id % 20 = 0", 7).count() == 0
    assert topk.top_k(data, "vec_id < -99", 7).count() == 0


def test_query_matches_its_sql(spark):
    from check_oracles import compare, connect

    assert compare(spark, connect(SF_DIR), SF_DIR, "op7_exact_topk") == []
