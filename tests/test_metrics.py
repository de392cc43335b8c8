import math
import random

import pytest
from conftest import plan, rows
from weir.functions import check_sql_text, nearest_rank
from weir.metrics import append_history, metrics_frame, observe, observed, read_history, throughput, timed


def test_observed_counts_cost_no_extra_job(spark, tmp_path):
    df, seen = observe(spark.range(100), "all")
    kept, left = observe(df.filter("id < 10"), "kept")
    kept.write.parquet(str(tmp_path / "t"))
    assert (seen.get["records"], left.get["records"]) == (100, 10)


def test_an_observation_behind_an_empty_shuffle(spark, tmp_path):
    df, seen = observe(spark.range(10).filter("id > 99"), "nothing")
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    assert observed(seen).get("records", 0) == 0
    df, seen = observe(spark.range(10), "some")
    df.repartition(3).write.parquet(str(tmp_path / "u"))
    assert observed(seen) == {"records": 10}


def test_history_and_throughput(spark, tmp_path):
    path = str(tmp_path / "history")
    line = {"pipeline": "p", "step": 0, "type": "load", "method": "toS3", "status": "SUCCESS"}
    append_history(metrics_frame(spark, [{**line, "duration_ms": 500, "records": 1000}]), path)
    append_history(
        metrics_frame(spark, [{**line, "duration_ms": 1500, "records": 3000}, {**line, "step": 1, "duration_ms": 0}]),
        path,
    )
    history = read_history(spark, path)
    assert history.count() == 3
    assert rows(throughput(history)) == [("p", 4000, 2000, 2000.0)]
    assert rows(throughput(history, ["pipeline", "step"])) == [("p", 0, 4000, 2000, 2000.0), ("p", 1, None, 0, None)]


def test_timed():
    status, millis, result = timed(lambda: 5)
    assert (status, result) == ("SUCCESS", 5) and millis >= 0
    status, _, error = timed(lambda: 1 / 0)
    assert status == "FAILED" and isinstance(error, ZeroDivisionError)


def by_rank(values, p):
    ordered = sorted(values)
    return ordered[max(math.ceil(p * len(ordered) / 100), 1) - 1]


@pytest.mark.parametrize("accuracy, leaf_rows", [(4, 10_000), (10_000, 10_000), (4, 300), (50, 300), (10_000, 300), (50, 40), (4, 2)])
def test_nearest_rank_matches_sorting(spark, accuracy, leaf_rows):
    random.seed(5)
    data = [("hot", float(random.choice([1, 1, 1, random.random() * 100]))) for _ in range(3000)]
    data += [("cold", random.gauss(0, 1)) for _ in range(200)]
    data += [(None, 4.0), (None, 2.0), ("single", 7.0), ("nulls", None)]
    df = spark.createDataFrame(data, "k string, v double")
    wished = [0, 1, 50, 95, 99, 100]
    got = {(r.k, r.percentile): (r.value, r.n) for r in nearest_rank(df, "v", wished, ["k"], accuracy, leaf_rows).collect()}
    want = {}
    for key in ("hot", "cold", None, "single"):
        values = [v for k, v in data if k == key]
        want.update({(key, p): (by_rank(values, p), len(values)) for p in wished})
    assert got == want


def test_nearest_rank_over_all_rows(spark):
    df = spark.range(1, 1001).selectExpr("id as v")
    assert rows(nearest_rank(df, "v", [50, 95, 99])) == [(50, 500, 1000), (95, 950, 1000), (99, 990, 1000)]
    assert rows(nearest_rank(df.filter("false"), "v", [50])) == []
    with pytest.raises(ValueError):
        nearest_rank(df, "v", [101])


def test_nearest_rank_orders_only_thin_slices(spark):
    df = spark.range(100_000).selectExpr("id as v")
    out = nearest_rank(df, "v", [50], leaf_rows=10_000)
    text = plan(out)
    assert "percentile_disc" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
    assert rows(out) == [(50, 49_999, 100_000)]


def test_guard():
    assert check_sql_text("a = 1") == "a = 1"
    for bad in ("a = 1 -- b", "a = 1; drop table t"):
        with pytest.raises(ValueError):
            check_sql_text(bad)
