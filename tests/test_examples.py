"""Small worked examples with known results, across several operators."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from weir.operators import (
    aggregate,
    enrich,
    filter_rows,
    join_frames,
    pivot,
    repartition,
    union_frames,
    validate_ranges,
    validate_rules,
)
from weir.plans import jobs, run_steps
from weir.scratch import scratch_path
from weir.sources import synthetic_rows


def test_wells_and_their_readings(spark, wells):
    taken = spark.sql("select pmod(id, 2) + 2 as id, cast(id as double) as litres from range(7)")
    joined = join_frames({"wells": wells, "taken": taken}, ["wells.id = taken.id"])
    assert joined.groupBy("label").count().orderBy("label").collect() == [("mill", 4), ("quarry", 3)]
    summary = jobs.join_summary(
        wells.selectExpr("id as c_custkey", "label as c_name"), taken.selectExpr("id as o_custkey", "litres as o_totalprice")
    )
    assert rows(summary) == [(2, "mill", 4, 12.0, 3.0), (3, "quarry", 3, 9.0, 3.0)]


def test_union_counts_the_primary_frame_once_more(spark):
    tides = {f"gauge{i}": spark.range(i, 3 * i).selectExpr("id", "id % 2 = 0 as high") for i in (1, 2, 4)}
    assert union_frames(list(tides.values())).count() == 14
    step = {"type": "transform", "method": "unionDataFrames", "config": {"inputDataFrames": list(tides), "distinct": True}}
    assert run_steps(spark, {"steps": [step]}, tides, primary=tides["gauge4"]).current().count() == 11


def test_pivot_of_days_without_a_list(spark):
    days = spark.range(28).selectExpr("id div 14 as fortnight", "concat('d', id % 7) as weekday", "id * id as rain")
    wide = pivot(days, ["fortnight"], "weekday", "rain", "max")
    assert wide.columns == ["fortnight", *[f"d{i}" for i in range(7)]]
    assert rows(wide)[1] == (1, *[(21 + i) ** 2 for i in range(7)])


def test_filter_then_enrich_then_check(catches):
    cod = enrich(filter_rows(catches, "species = 'cod'"), {"crates": "ceil(kilos / 5)"})
    assert rows(cod.select("kilos", "crates")) == [(12.5, 3), (3.0, 1)]
    report = validate_ranges(catches, {"kilos": {"min": 5, "max": 15}})
    assert [r.violations for r in report.collect()] == [1, 1]
    found = validate_rules(catches, ["length(species) = 4 or kilos < 15", "harbour <> species"]).collect()
    assert [r.violations for r in found] == [0, 0]


def test_generated_rows_spread_evenly(spark):
    df = synthetic_rows(spark, 4_096, categories=32)
    out = aggregate(df, ["category"], {"n": "count(*)"})
    assert out.count() == 32 and {r.n for r in out.collect()} == {128}
    assert repartition(df, 5).rdd.getNumPartitions() == 5


@pytest.mark.parametrize("cut", ["2024-01-02", "2024-01-09"])
def test_incremental_load_moves_the_checkpoint(spark, cut):
    source = spark.range(1, 6).selectExpr("id", "cast(date_add(date'2024-01-01', cast(id as int)) as timestamp_ntz) as at")
    checkpoint = spark.sql(f"select timestamp_ntz'{cut}' as last_processed")
    loaded, mark = jobs.incremental_load(source, checkpoint, "at", scratch_path(spark, "incremental-test"))
    fresh = 4 if cut == "2024-01-02" else 0
    assert loaded.count() == fresh
    assert str(mark.first().last_processed)[:10] == ("2024-01-06" if fresh else cut)
    assert {"year", "month", "day"} <= set(loaded.columns)


def test_repeated_incremental_loads(spark, tmp_path):
    path = str(tmp_path / "orders")
    day = "cast(date_add(date'2024-01-01', cast(id as int)) as timestamp_ntz) as at"
    nothing = spark.sql("select cast(null as timestamp_ntz) as last_processed").filter("false")
    loaded, _ = jobs.incremental_load(spark.range(0, 5).selectExpr("id", day), nothing, "at", path, "1970-01-01")
    assert loaded.count() == 5
    for upto, total in ((9, 9), (9, 9), (12, 12)):
        kept = spark.read.parquet(f"{path}/checkpoint")
        loaded, mark = jobs.incremental_load(spark.range(0, upto).selectExpr("id", day), kept, "at", path)
        assert rows(loaded.select("id")) == sorted(((i,) for i in range(total)), key=repr)
        assert mark.first().last_processed.day == total
    assert spark.read.parquet(f"{path}/checkpoint").count() == 3


def test_star_keeps_facts_without_dimensions(spark):
    lines = spark.createDataFrame([(1, 10, 5, 1.0), (2, 11, 6, 2.0)], "l_orderkey int, l_partkey int, l_suppkey int, q double")
    part = spark.createDataFrame([(10, "p")], "p_partkey int, p_name string")
    supplier = spark.createDataFrame([(6, "s")], "s_suppkey int, s_name string")
    orders = spark.createDataFrame([(1, "o")], "o_orderkey int, o_status string")
    out = jobs.star_denorm(lines, part, supplier, orders).select("l_orderkey", "p_name", "s_name", "o_status")
    assert rows(out) == [(1, "p", None, "o"), (2, None, "s", None)]


def test_compaction_leaves_one_small_file_per_value(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).withColumn("k", F.col("id") % 3)
    path = str(tmp_path / "t")
    out = jobs.compaction(df, "k", path)
    assert out.count() == 1000
    assert all(len(list((tmp_path / "t" / f"k={k}").glob("part-*"))) == 1 for k in range(3))
