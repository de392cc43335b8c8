"""Throughput, latency and growth against the published targets; all with wide margins."""

import math
import time

import pytest

from weir.metrics import observe
from weir.operators import aggregate, cache, enrich, filter_rows, join_using, uncache
from weir.scratch import scratch_path
from weir.sinks import write_files
from weir.sources import read_files, synthetic_rows


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def percentile(values, p):
    return sorted(values)[math.ceil(p / 100 * len(values)) - 1]


def run(df):
    df.write.format("noop").mode("overwrite").save()


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_path(spark, "perf")
    write_files(synthetic_rows(spark, 1_000_000, partitions=8), path)
    return read_files(spark, path)


def test_extract_filter_load(spark, stored):
    def load():
        write_files(filter_rows(stored, "id % 2 = 0"), scratch_path(spark, "perf-out"))

    load()
    assert 1_000_000 / seconds(load) >= 100_000


def test_join_and_aggregate(spark, stored):
    names = stored.select("category").distinct().withColumn("name", stored["category"].substr(1, 1))

    def job():
        kept = enrich(filter_rows(stored, "value1 > 100"), {"band": "floor(value2 / 10)"})
        joined = join_using([kept, names], "category")
        run(aggregate(joined, ["name", "band"], {"n": "count(*)", "top": "max(value1)"}))

    job()
    assert 1_000_000 / seconds(job) >= 10_000


def test_latency_and_its_spread(spark, stored):
    kept = filter_rows(stored.limit(50_000), "value1 > 500")
    grouped = aggregate(stored, ["category"], {"value1": "sum"})
    for df in (kept, grouped):
        run(df)
        took = [seconds(lambda df=df: run(df)) for _ in range(10)]
        assert percentile(took, 95) < 5
        assert max(took) < 3 * percentile(took, 50) + 0.5


def test_time_grows_no_faster_than_the_rows(spark):
    def job(rows):
        return lambda: run(filter_rows(synthetic_rows(spark, rows, partitions=4), "value1 > 500"))

    job(10_000)()
    small, large = seconds(job(10_000)), seconds(job(1_000_000))
    assert large < 1.2 * 100 * small


def test_caching_pays_or_costs_little(spark, stored):
    def three_filters(df):
        for bound in (100, 500, 900):
            run(filter_rows(df, f"value1 > {bound}"))

    plain = seconds(lambda: three_filters(stored))
    held = cache(stored)
    cached = seconds(lambda: three_filters(held))
    uncache(held)
    assert cached < 3 * plain + 1


def test_counting_costs_little(spark, stored):
    run(stored)
    plain = min(seconds(lambda: run(stored)) for _ in range(3))

    def counted():
        df, seen = observe(stored, f"perf-{time.perf_counter_ns()}")
        run(df)
        assert seen.get["records"] == 1_000_000

    assert min(seconds(counted) for _ in range(3)) < 1.2 * plain + 0.5
