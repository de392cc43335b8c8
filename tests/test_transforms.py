from conftest import plan, rows
from weir.operators import aggregate, enrich, filter_rows

import pytest


def test_filter_keeps_only_true(wells):
    assert filter_rows(wells, "depth >= 40").count() == 2


def test_filter_drops_null_verdicts(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, v int")
    assert rows(filter_rows(df, "v > 1")) == [(2, 5)]
    assert rows(filter_rows(df, "not (v > 9)")) == [(2, 5)]


def test_enrich_adds_columns_in_order(spark):
    df = spark.createDataFrame([("A4", 210, 297), ("A5", 148, 210)], "paper string, wide int, high int")
    out = enrich(df, {"area": "wide * high", "tag": "concat(paper, '/', area)"})
    assert out.columns == ["paper", "wide", "high", "area", "tag"]
    assert [r.tag for r in out.orderBy("paper").collect()] == ["A4/62370", "A5/31080"]


def test_enrich_sees_earlier_columns_and_overwrites(wells):
    columns = {f"c{i}": f"c{i - 1} + 1" if i else "depth" for i in range(8)}
    out = enrich(wells, {**columns, "depth": "c7 * 2"})
    assert rows(out.select("id", "c7", "depth")) == [(1, 47, 94), (2, 19, 38), (3, 78, 156)]


def test_enrich_of_now_and_random(wells):
    out = enrich(wells, {"today": "current_date()", "at": "current_timestamp()", "r": "rand(7)"})
    first, second = out.collect(), out.collect()
    assert [r.r for r in first] == [r.r for r in second]
    assert all(0 <= r.r < 1 and r.today is not None and r.at is not None for r in first)


def test_chain_is_one_projection(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id * 2 as v", "id as unused").write.parquet(path)
    df = filter_rows(spark.read.parquet(path), "v > 10")
    df = enrich(df, {"w": "v + 1", "x": "w * 2"})
    df = filter_rows(df, "x > 50").select("id", "x")
    text = plan(df)
    assert text.count("Project") == 1 and text.count("Filter (") == 1
    assert "ReadSchema: struct<id:bigint,v:bigint>" in text
    assert "GreaterThan(v,10)" in text


def test_aggregate_by_function_name(catches):
    out = aggregate(catches, ["harbour"], {"kilos": "sum", "species": "count"})
    assert out.columns == ["harbour", "kilos_sum", "species_count"]
    assert rows(out) == [("Oban", 22.5, 3), ("Ullapool", 20.0, 1)]


@pytest.mark.parametrize(
    "name, column, value",
    [("avg", "kilos_avg", 7.5), ("MEAN", "kilos_avg", 7.5), ("min", "kilos_min", 3.0), ("max", "kilos_max", 12.5)],
)
def test_aggregate_functions(catches, name, column, value):
    out = aggregate(catches, ["harbour"], {"kilos": name}).filter("harbour = 'Oban'")
    assert rows(out.select(column)) == [(value,)]


def test_aggregate_by_expression(catches):
    measures = {"landings": "count(*)", "heaviest": "max_by(species, kilos)", "kinds": "count(distinct species)"}
    assert rows(aggregate(catches, ["harbour"], measures)) == [("Oban", 3, "cod", 2), ("Ullapool", 1, "hake", 1)]


def test_count_skips_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", 1)], "k string, v int")
    assert rows(aggregate(df, ["k"], {"v": "count"})) == [("a", 1)]


def test_sums_of_tenths_stay_exact(spark):
    tenths = enrich(spark.range(1, 31), {"pier": "id % 3", "tonnes": "cast(id as decimal(6,1)) / 10"})
    out = aggregate(enrich(tenths, {"tonnes": "cast(tonnes as decimal(6,1))"}), ["pier"], {"tonnes": "sum", "id": "count"})
    assert [(pier, str(total), n) for pier, total, n in rows(out)] == [(0, "16.5", 10), (1, "14.5", 10), (2, "15.5", 10)]


def test_global_aggregate_and_empty_input(catches):
    assert rows(aggregate(catches, [], {"kilos": "sum"})) == [(42.5,)]
    empty = catches.filter("false")
    assert rows(aggregate(empty, [], {"kilos": "sum"})) == [(None,)]
    assert rows(aggregate(empty, ["harbour"], {"kilos": "sum"})) == []


def test_aggregate_rejects_bad_input(catches):
    with pytest.raises(ValueError, match="at least one"):
        aggregate(catches, ["harbour"], {})
    with pytest.raises(ValueError, match="median"):
        aggregate(catches, ["harbour"], {"kilos": "median"})


def test_aggregation_combines_before_the_shuffle(catches):
    text = plan(aggregate(catches, ["harbour"], {"kilos": "sum"}))
    assert "partial_sum" in text
