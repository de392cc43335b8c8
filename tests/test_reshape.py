import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from weir.operators import pivot, union_frames, unpivot


@pytest.fixture
def quarters(spark):
    return spark.createDataFrame(
        [("P1", "Q1", 10.0), ("P1", "Q2", 20.0), ("P1", "Q2", 5.0), ("P2", "Q1", 30.0), ("P2", "Q3", 1.0)],
        "product string, quarter string, sales double",
    )


def test_pivot_sum_and_missing_cells(quarters):
    out = pivot(quarters, ["product"], "quarter", "sales")
    assert out.columns == ["product", "Q1", "Q2", "Q3"]
    assert rows(out) == [("P1", 10.0, 25.0, None), ("P2", 30.0, None, 1.0)]


def test_pivot_count_has_null_for_empty_cells(quarters):
    assert rows(pivot(quarters, ["product"], "quarter")) == [("P1", 1, 2, None), ("P2", 1, None, 1)]


@pytest.mark.parametrize("agg, cell", [("avg", 12.5), ("min", 5.0), ("max", 20.0), ("count", 2)])
def test_pivot_aggregates(quarters, agg, cell):
    out = pivot(quarters, ["product"], "quarter", "sales", agg, ["Q2"], rest="other")
    assert rows(out.filter("product = 'P1'").select("product", "Q2")) == [("P1", cell)]


def test_named_values_fix_the_columns(quarters):
    out = pivot(quarters, ["product"], "quarter", "sales", values=["Q3", "Q9"], rest="other")
    assert out.columns == ["product", "Q3", "Q9", "other"]
    assert rows(out) == [("P1", None, None, 35.0), ("P2", 1.0, None, 30.0)]
    with pytest.raises(Exception, match="not listed: Q1"):
        pivot(quarters.filter("quarter = 'Q1'"), ["product"], "quarter", "sales", values=["Q3"]).collect()
    with pytest.raises(ValueError):
        pivot(quarters, ["product"], "quarter", "sales", "median")


def test_unpivot_defaults_ids_and_keeps_nulls(spark):
    wide = spark.createDataFrame([("P1", "x", 10, None), ("P2", "y", 30, 40)], "p string, t string, Q1 int, Q2 int")
    out = unpivot(wide, ["Q1", "Q2"], "quarter", "sales")
    assert out.columns == ["p", "t", "quarter", "sales"]
    assert rows(out) == [
        ("P1", "x", "Q1", 10), ("P1", "x", "Q2", None), ("P2", "y", "Q1", 30), ("P2", "y", "Q2", 40),
    ]
    assert unpivot(wide, ["Q1"], "quarter", "sales", ["p"]).columns == ["p", "quarter", "sales"]
    assert "Exchange" not in plan(out)


def test_pivot_and_unpivot_are_inverse(quarters):
    totals = quarters.groupBy("product", "quarter").agg(F.sum("sales").alias("sales"))
    back = unpivot(pivot(quarters, ["product"], "quarter", "sales"), ["Q1", "Q2", "Q3"], "quarter", "sales")
    assert rows(back.dropna()) == rows(totals)


def test_union_keeps_duplicates_and_matches_by_position(spark):
    a = spark.createDataFrame([(1, "a")], "id int, name string")
    b = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    assert rows(union_frames([a, b])) == [(1, "a"), (1, "a"), (2, "b")]
    assert union_frames([a, b]).columns == ["id", "name"]
    assert rows(union_frames([a, b, a], distinct=True)) == [(1, "a"), (2, "b")]
    with pytest.raises(TypeError):
        union_frames([a, b], distinct="true")
    with pytest.raises(ValueError):
        union_frames([])


def test_union_counts_add_up(quarters, spark):
    assert union_frames([quarters] * 3).count() == 3 * quarters.count()
