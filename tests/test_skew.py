"""One key holds most rows: the plans must split it or collapse it."""

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from weir.operators import aggregate, join_frames, join_using, snapshot_as_of, validate_references

ROWS = 60_000


@pytest.fixture
def skewed(spark, tmp_path, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        spark__sql__shuffle__partitions=8,
    )
    path = str(tmp_path / "facts")
    facts = spark.range(0, ROWS, 1, 8).selectExpr("id as fact", "if(id % 3 < 2, 7, id % 500) as k")
    facts.write.parquet(path)
    dims = spark.range(0, 400).selectExpr("id as k", "concat('dim', id) as name")
    dims.write.parquet(path + "-dims")
    return spark.read.parquet(path), spark.read.parquet(path + "-dims")


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


@pytest.mark.parametrize("how, fact_first", [("inner", True), ("left", True), ("right", False)])
def test_joins_split_the_hot_key(skewed, how, fact_first):
    facts, dims = skewed
    frames = {"f": facts, "d": dims} if fact_first else {"d": dims, "f": facts}
    condition = "f.k = d.k" if fact_first else "d.k = f.k"
    out = join_frames(frames, [condition], how)
    assert "skew=true" in final_plan(out)
    assert out.count() == (ROWS if how != "inner" else facts.filter("k < 400").count())


@pytest.mark.parametrize("how", ["left", "full"])
def test_outer_joins_with_the_hot_side_optional(skewed, how):
    facts, dims = skewed
    out = join_using([dims, facts], "k", how, hot_keys=True)
    plain = join_using([dims, facts], "k", how)
    assert "skew=true" in final_plan(out)
    assert "skew=true" not in final_plan(plain)
    totals = [F.count("*"), F.sum("k"), F.count("name"), F.sum("fact")]
    assert rows(out.agg(*totals)) == rows(plain.agg(*totals))


def test_aggregates_and_references_shuffle_one_row_per_key_and_task(skewed):
    facts, dims = skewed
    out = aggregate(facts, ["k"], {"fact": "count"})
    assert "partial_count" in final_plan(out)
    assert out.agg(F.sum("fact_count")).first()[0] == ROWS
    report = validate_references(facts, "k", dims, "k")
    lost = facts.filter("k >= 400")
    assert rows(report.select("violations", "rows")) == [(lost.select("k").distinct().count(), lost.count())]


def test_snapshot_of_a_hot_key(skewed):
    facts, _ = skewed
    latest = snapshot_as_of(facts, "k", ["fact"])
    assert rows(latest) == rows(facts.groupBy("k").agg(F.max("fact").alias("fact")).select("fact", "k"))
