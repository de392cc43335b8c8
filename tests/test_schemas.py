import json

import pytest
from conftest import plan, rows
from pyspark.sql import types as T

from weir.functions.avro import avro_of, spark_type_of
from weir.operators import (
    SchemaMismatch,
    avro_schema_json,
    compatible,
    evolve,
    schema_compat,
    schema_profile,
    to_avro_schema,
    validate_schema,
)

TARGET = {
    "type": "record",
    "name": "Reading",
    "fields": [
        {"name": "seq", "type": "long"},
        {"name": "kind", "type": "string"},
        {"name": "level", "type": "float"},
        {"name": "probe", "type": "long"},
        {"name": "remark", "type": ["null", "string"], "default": None},
        {"name": "edition", "type": "int", "default": 4},
        {"name": "marks", "type": {"type": "array", "items": "string"}, "default": ["k"]},
    ],
}


@pytest.fixture
def legacy(spark):
    return spark.createDataFrame(
        [("tilt", 1, "7", 2.5), ("heat", 2, "oops", None)], "kind string, seq int, probe string, spare double"
    )


def test_validate_schema_passes(spark):
    df = spark.createDataFrame([("p", 4, 0.5)], "port string, berth int, draught double")
    report = validate_schema(df, [{"name": "berth", "type": "integer"}, {"name": "port", "type": "STRING"}], fail_fast=True)
    assert {r.status for r in report.collect()} == {"ok"}


@pytest.mark.parametrize(
    "ddl, name",
    [
        ("bigint", "long"), ("bigint", "bigint"), ("int", "integer"), ("decimal(10,2)", "decimal(10,2)"),
        ("timestamp", "timestamp"), ("date", "date"), ("array<int>", "array<int>"), ("boolean", "Boolean"),
    ],
)
def test_type_spellings(spark, ddl, name):
    df = spark.createDataFrame([], f"c {ddl}")
    assert validate_schema(df, [{"name": "c", "type": name}]).first().status == "ok"


def test_validate_schema_reports(spark):
    df = spark.createDataFrame([("1", 1.0), ("x", 2.0), (None, 3.0), ("2.5", 4.0)], "a string, b double")
    report = validate_schema(
        df,
        [{"name": "a", "type": "int"}, {"name": "b", "type": "decimal(10,2)"}, {"name": "B", "type": "double"}],
    )
    assert rows(report) == [
        ("B", "double", None, "missing", 0),
        ("a", "int", "string", "type_differs", 2),
        ("b", "decimal(10,2)", "double", "type_differs", 0),
    ]
    with pytest.raises(SchemaMismatch, match="column B: missing"):
        validate_schema(df, [{"name": "B", "type": "double"}], fail_fast=True)


def test_evolve_keeps_order_and_types_by_default(legacy):
    out = evolve(legacy, json.dumps(TARGET))
    assert out.columns == ["kind", "seq", "probe", "level", "remark", "edition", "marks"]
    assert out.schema["seq"].dataType == T.IntegerType()
    assert out.schema["marks"].dataType == T.ArrayType(T.StringType(), False)
    assert out.filter("edition is null and marks is null").count() == 2
    assert "Exchange" not in plan(out)


def test_evolve_options(legacy):
    out = evolve(legacy, TARGET, cast=True, target_order=True, use_defaults=True)
    assert out.columns == [f["name"] for f in TARGET["fields"]]
    assert out.schema["seq"].dataType == T.LongType()
    assert [r.probe for r in out.orderBy("seq").collect()] == [7, None]
    assert {(r.edition, tuple(r.marks), r.remark) for r in out.collect()} == {(4, ("k",), None)}


def test_evolve_is_idempotent(legacy):
    once = evolve(legacy, TARGET)
    assert evolve(once, TARGET).schema == once.schema


def test_evolve_needs_a_record(legacy):
    with pytest.raises(ValueError, match="record"):
        evolve(legacy, {"type": "string"})
    with pytest.raises(ValueError, match="no fields"):
        evolve(legacy, {"type": "record", "name": "R", "fields": []})


def test_compatible():
    writer = {"type": "record", "name": "E", "fields": [{"name": "a", "type": "int"}]}
    fewer_or_defaulted = {
        "type": "record", "name": "E", "fields": [{"name": "b", "type": ["null", "int"], "default": None}],
    }
    needs_more = {"type": "record", "name": "E", "fields": [{"name": "b", "type": "int"}]}
    assert compatible(writer, writer) and compatible(writer, fewer_or_defaulted)
    assert not compatible(writer, needs_more)


def test_schema_compat_counts_failing_rows(legacy):
    report = {r.field: r for r in schema_compat(legacy, TARGET).collect()}
    assert report["kind"].verdict == "same"
    assert report["level"].verdict == "missing"
    assert report["remark"].verdict == "default"
    assert (report["probe"].verdict, report["probe"].failing_rows) == ("type_differs", 1)
    assert (report["seq"].verdict, report["seq"].failing_rows) == ("type_differs", 0)
    impossible = {"type": "record", "name": "E", "fields": [{"name": "seq", "type": {"type": "map", "values": "int"}}]}
    assert schema_compat(legacy, impossible).first().failing_rows == 2


def test_profile(legacy):
    by_name = {r.column: r for r in schema_profile(legacy).collect()}
    assert by_name["spare"].nulls == 1 and by_name["spare"].rows == 2
    assert by_name["kind"].approx_distinct == 2
    assert by_name["seq"].avro_type == '["int","null"]'
    assert "approx_distinct" not in schema_profile(legacy, approx_distinct=False).columns


def test_avro_schema_text(spark):
    df = spark.createDataFrame(
        [], "id long not null, name string, price decimal(10,2), day date, at timestamp, tags array<string>"
    )
    record = json.loads(avro_schema_json(df))
    assert (record["type"], record["name"], record["namespace"]) == ("record", "Record", "com.pipeline")
    types = {f["name"]: f["type"] for f in record["fields"]}
    assert types["id"] == "long" and types["name"] == ["string", "null"]
    assert types["price"][0] == {
        "type": "fixed", "name": "fixed", "namespace": "com.pipeline.Record.price", "size": 5,
        "logicalType": "decimal", "precision": 10, "scale": 2,
    }
    assert types["day"][0] == {"type": "int", "logicalType": "date"}
    assert types["tags"][0] == {"type": "array", "items": ["string", "null"]}
    out = to_avro_schema(df, "org.x", "Y")
    assert out.columns == ["avro_schema"] and out.count() == 1
    assert json.loads(out.first()[0])["namespace"] == "org.x"


@pytest.mark.parametrize(
    "avro, spark_type",
    [
        ("string", T.StringType()), ("int", T.IntegerType()), ("long", T.LongType()), ("float", T.FloatType()),
        ("double", T.DoubleType()), ("boolean", T.BooleanType()), ("bytes", T.BinaryType()), ("null", T.NullType()),
        (["null", "long"], T.LongType()), (["double", "null"], T.DoubleType()), (["null"], T.NullType()),
        ({"type": "string"}, T.StringType()),
        ({"type": "enum", "name": "E", "symbols": ["A"]}, T.StringType()),
        ({"type": "fixed", "name": "F", "size": 4}, T.BinaryType()),
        ({"type": "bytes", "logicalType": "decimal", "precision": 8, "scale": 3}, T.DecimalType(8, 3)),
        ({"type": "int", "logicalType": "date"}, T.DateType()),
        ({"type": "long", "logicalType": "timestamp-millis"}, T.TimestampType()),
        ({"type": "map", "values": ["null", "int"]}, T.MapType(T.StringType(), T.IntegerType(), True)),
        (
            {"type": "record", "name": "R", "fields": [{"name": "a", "type": ["null", "int"]}]},
            T.StructType([T.StructField("a", T.IntegerType(), True)]),
        ),
    ],
)
def test_avro_types(avro, spark_type):
    assert spark_type_of(avro) == spark_type


def test_avro_types_survive_both_ways():
    schema = T.StructType.fromDDL(
        "a int, b struct<c: array<double>, d: map<string, decimal(20,4)>>, e timestamp_ntz, f binary"
    )
    assert spark_type_of(avro_of(schema, "R", "n")) == schema


def test_unions_widen_or_fail_and_names_resolve(spark):
    assert spark_type_of(["null", "int", "long"]) == T.LongType()
    assert spark_type_of(["float", "double"]) == T.DoubleType()
    for union in (["null", "int", "string"], ["long", "double"], "Nowhere"):
        with pytest.raises(ValueError):
            spark_type_of(union)
    berth = {"type": "record", "name": "Berth", "namespace": "port", "fields": [{"name": "no", "type": "int"}]}
    ship = {"type": "record", "name": "Ship", "fields": [{"name": "at", "type": berth}, {"name": "next", "type": ["null", "port.Berth"]}]}
    out = evolve(spark.range(1).selectExpr("named_struct('no', 4) as at"), ship)
    assert out.schema["next"].dataType == out.schema["at"].dataType
    loop = {"type": "record", "name": "Node", "fields": [{"name": "child", "type": ["null", "Node"]}]}
    with pytest.raises(ValueError):
        spark_type_of(loop["fields"][0]["type"], {})


@pytest.mark.parametrize("value", ["array(1, 2)", "map('a', 1)", "named_struct('a', 1)", "array(named_struct('a', array(1)))"])
def test_nested_types_compare_without_nullability(spark, value):
    df = spark.sql(f"select {value} as c")
    kind = df.schema["c"].dataType.simpleString()
    assert validate_schema(df, [{"name": "c", "type": kind}], fail_fast=True).first().status == "ok"
