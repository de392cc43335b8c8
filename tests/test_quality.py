from collections import Counter

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from weir.operators import (
    ValidationFailed,
    drop_invalid,
    null_checks,
    orphans,
    quarantine,
    range_checks,
    rule_checks,
    validate_nulls,
    validate_ranges,
    validate_references,
    validate_rules,
    violation_report,
    violation_samples,
    with_violations,
)


def counts(report):
    return {r.rule: r.violations for r in report.collect()}


def test_nulls(spark):
    df = spark.createDataFrame(
        [(1, "a", "x"), (2, "b", None), (3, "c", "z")], "id int, name string, required_field string"
    )
    report = validate_nulls(df, ["id", "required_field"])
    assert counts(report) == {"id is not null": 0, "required_field is not null": 1}
    assert report.columns == ["kind", "rule", "violations", "rows"]


def test_ranges_are_inclusive_and_pass_nulls(spark):
    df = spark.createDataFrame([(25, 0.0), (150, 100.0), (None, None)], "age int, score double")
    report = validate_ranges(df, {"age": {"min": 0, "max": 120}, "score": [0, 100]})
    assert counts(report) == {"age >= 0": 0, "age <= 120": 1, "score >= 0": 0, "score <= 100": 0}
    assert counts(validate_ranges(df, {"age": {"min": 26}})) == {"age >= 26": 1}


def test_rules_and_null_verdicts(spark):
    df = spark.createDataFrame(
        [(1, "gold", 100.0, 10.0), (2, "basic", 50.0, 50.0), (3, "basic", 20.0, None)],
        "order_id int, customer_type string, amount double, discount double",
    )
    report = validate_rules(df, ["discount <= 20", "amount >= 10", "amount > discount"])
    assert counts(report) == {"discount <= 20": 1, "amount >= 10": 0, "amount > discount": 1}


def test_report_is_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id % 7 as v").write.parquet(path)
    df = spark.read.parquet(path)
    report = violation_report(df, null_checks(["id", "v"]) + range_checks({"v": [1, 5]}) + rule_checks(["id <> v"]))
    assert plan(report).count("Scan") == 1
    assert counts(report)["v >= 1"] == 143


def test_fail_fast_carries_counts_and_samples(spark):
    df = spark.range(100).withColumnRenamed("id", "v")
    assert validate_ranges(df, {"v": [0, 99]}, fail_fast=True).count() == 2
    with pytest.raises(ValidationFailed, match="v <= 10: 89") as error:
        validate_ranges(df, {"v": [0, 10]}, fail_fast=True)
    assert len(error.value.samples) == 5 and all(s["v"] > 10 for s in error.value.samples)
    assert error.value.failures[0]["rows"] == 100


def test_empty_input_has_no_violations(spark):
    df = spark.createDataFrame([], "id int, value string")
    assert set(counts(validate_nulls(df, ["id", "value"])).values()) == {0}
    assert rows(validate_references(df, "id", df, "id").select("violations", "rows")) == [(0, 0)]
    clean, failed = quarantine(df, range_checks({"id": [1, 2]}))
    assert clean.count() == failed.count() == 0


def test_no_checks_is_an_error(wells):
    with pytest.raises(ValueError):
        violation_report(wells, [])
    with pytest.raises(ValueError):
        with_violations(wells, [])


def test_references(spark):
    fact = spark.createDataFrame([(1,), (1,), (9,), (9,), (8,), (None,)], "fk int")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "id int, n string")
    assert rows(orphans(fact, "fk", dim, "id")) == [(8, 1), (9, 2)]
    report = validate_references(fact, "fk", dim, "id")
    assert rows(report) == [("reference", "fk in id", 2, 3)]
    with pytest.raises(ValidationFailed) as error:
        validate_references(fact, "fk", dim, "id", fail_fast=True)
    assert error.value.samples == [{"fk": 8, "rows": 1}, {"fk": 9, "rows": 2}]
    assert validate_references(fact.filter("fk = 1"), "fk", dim, "id", fail_fast=True).count() == 1


def test_composite_references(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (1, None)], "x int, y string")
    dim = spark.createDataFrame([(1, "a")], "p int, q string")
    assert rows(orphans(fact, ["x", "y"], dim, ["p", "q"])) == [(1, "b", 1)]
    with pytest.raises(ValueError):
        orphans(fact, ["x", "y"], dim, ["p"])


def test_references_collapse_before_the_shuffle(spark):
    fact = spark.range(100).selectExpr("id % 3 as fk")
    text = plan(orphans(fact, "fk", spark.range(2), "id"))
    assert "partial_count" in text


def test_quarantine_splits_every_row_once(spark):
    df = spark.range(100).selectExpr("id", "if(id % 10 = 0, null, id) as v")
    checks = null_checks(["v"]) + range_checks({"v": [20, 90]}) + rule_checks(["id <> 55"])
    clean, failed = quarantine(df, checks)
    assert clean.columns == df.columns
    assert clean.count() + failed.count() == 100
    reasons = Counter(reason for r in failed.collect() for reason in r.violations)
    assert reasons == {"v is not null": 10, "v >= 20": 18, "v <= 90": 9, "id <> 55": 1}
    assert counts(violation_report(df, checks)) == reasons
    assert rows(drop_invalid(df, checks)) == rows(clean)


def test_quarantine_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id as v").write.parquet(path)
    _, failed = quarantine(spark.read.parquet(path), range_checks({"v": [10, 90]}))
    assert "Or(LessThan(v,10),GreaterThan(v,90))" in plan(failed)


def test_samples_are_the_first_by_key(spark):
    df = spark.range(1000).selectExpr("id", "id % 2 as odd")
    out = violation_samples(df, rule_checks(["odd = 0", "id < 990"]), ["id"], limit=3)
    assert rows(out.select("rule", "sample", "id")) == [
        ("id < 990", 1, 990), ("id < 990", 2, 991), ("id < 990", 3, 992),
        ("odd = 0", 1, 1), ("odd = 0", 2, 3), ("odd = 0", 3, 5),
    ]
    assert plan(out).count("WindowGroupLimit") == 2
    by_name = violation_samples(df, rule_checks(["id < 0"]), ["id"])
    assert by_name.agg(F.count("*")).first()[0] == 5
