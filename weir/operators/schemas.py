"""Schema checks, profiles and evolution towards a target schema.

Targets are Avro record schemas, as JSON text or the parsed dict.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.functions.avro import avro_of, default_column, named_types, record_fields, same_type, spark_type_of

# Record name and namespace used when none is given.
DEFAULT_RECORD = "Record"
DEFAULT_NAMESPACE = "com.pipeline"


class SchemaMismatch(ValueError):
    """Raised by ``validate_schema(fail_fast=True)``."""


def spark_type(name: str) -> T.DataType:
    """Parse a type name: ``long`` or ``bigint``, ``decimal(10,2)``, ``array<int>``…"""
    return T.StructType.fromDDL(f"c {name}")["c"].dataType


def validate_schema(
    df: DataFrame, expected: Sequence[Mapping[str, str]], fail_fast: bool = False
) -> DataFrame:
    """One row per expected column: expected, actual, status, uncastable.

    Extra columns, order and nullability do not matter. ``status`` is ``ok``,
    ``missing`` or ``type_differs``; for a string column that should have
    another type, ``uncastable`` counts the values that would not convert.
    """
    if not expected:
        raise ValueError("give at least one expected column")
    actual = {f.name: f.dataType for f in df.schema.fields}
    lines, counts = [], []
    for i, want in enumerate(expected):
        name, target = want["name"], spark_type(want["type"])
        found = actual.get(name)
        status = "missing" if found is None else "ok" if same_type(found, target) else "type_differs"
        uncastable = F.lit(0).cast("bigint")
        if status == "type_differs" and isinstance(found, T.StringType):
            counts.append(F.count_if(_would_fail(df, name, target)).alias(f"_{i}"))
            uncastable = F.col(f"_{i}")
        lines.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(target.simpleString()).alias("expected"),
                F.lit(found.simpleString() if found else None).cast("string").alias("actual"),
                F.lit(status).alias("status"),
                uncastable.alias("uncastable"),
            )
        )
    report = _one_row(df, counts).select(F.inline(F.array(*lines)))
    if fail_fast:
        broken = report.filter("status <> 'ok'").collect()
        if broken:
            raise SchemaMismatch(
                "; ".join(
                    f"column {r['column']}: {r['status']}, expected {r['expected']}, got {r['actual']}"
                    for r in broken
                )
            )
    return report


def split_by_schema(df: DataFrame, expected: Sequence[Mapping[str, str]]) -> tuple[DataFrame, DataFrame]:
    """Rows whose values all convert to the expected types, and the others.

    Types are not changed. A missing column is an error, as no row can have it.
    """
    missing = [want["name"] for want in expected if want["name"] not in df.columns]
    if missing:
        raise SchemaMismatch("; ".join(f"column {name}: missing" for name in missing))
    fails = [
        _would_fail(df, want["name"], spark_type(want["type"]))
        for want in expected
        if not same_type(df.schema[want["name"]].dataType, spark_type(want["type"]))
    ]
    broken = reduce(lambda a, b: a | b, fails, F.lit(False))
    return df.filter(~broken), df.filter(broken)


def avro_schema_json(
    df: DataFrame, namespace: str = DEFAULT_NAMESPACE, name: str = DEFAULT_RECORD
) -> str:
    """The Avro record schema of a frame as JSON text."""
    return json.dumps(avro_of(df.schema, name, namespace), separators=(",", ":"))


def to_avro_schema(
    df: DataFrame, namespace: str = DEFAULT_NAMESPACE, name: str = DEFAULT_RECORD
) -> DataFrame:
    """One row, one column ``avro_schema``."""
    text = avro_schema_json(df, namespace, name)
    return df.sparkSession.range(1).select(F.lit(text).alias("avro_schema"))


def schema_profile(df: DataFrame, approx_distinct: bool = True) -> DataFrame:
    """Per column: Spark type, Avro type, nullable, rows, nulls, distinct values.

    One aggregate over the data; the distinct count is a sketch's estimate.
    """
    avro = {f["name"]: f["type"] for f in avro_of(df.schema, DEFAULT_RECORD, DEFAULT_NAMESPACE)["fields"]}
    counts: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    lines = []
    for i, field in enumerate(df.schema.fields):
        column = F.col(f"`{field.name}`")
        counts.append(F.count_if(column.isNull()).alias(f"_n{i}"))
        parts = [
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("spark_type"),
            F.lit(json.dumps(avro[field.name], separators=(",", ":"))).alias("avro_type"),
            F.lit(field.nullable).alias("nullable"),
            F.col("_rows").alias("rows"),
            F.col(f"_n{i}").alias("nulls"),
        ]
        if approx_distinct:
            countable = not isinstance(field.dataType, (T.MapType, T.NullType))
            estimate = F.approx_count_distinct(column) if countable else F.lit(None).cast("bigint")
            counts.append((estimate if countable else F.max(estimate)).alias(f"_d{i}"))
            parts.append(F.col(f"_d{i}").alias("approx_distinct"))
        lines.append(F.struct(*parts))
    return df.agg(*counts).select(F.inline(F.array(*lines)))


def evolve(
    df: DataFrame,
    target: str | Mapping[str, Any],
    *,
    cast: bool = False,
    target_order: bool = False,
    use_defaults: bool = False,
) -> DataFrame:
    """Add the target's missing fields and drop columns it does not name.

    By default kept columns stay in source order and type, and new ones follow
    as typed NULLs. ``cast`` converts kept columns (a value that does not
    convert becomes NULL), ``target_order`` follows the target and
    ``use_defaults`` fills new columns with the declared defaults.
    """
    fields = record_fields(target)
    types = named_types(json.loads(target) if isinstance(target, str) else target)
    wanted = {f["name"]: f for f in fields}
    kept = [c for c in df.columns if c in wanted]
    added = [f["name"] for f in fields if f["name"] not in df.columns]
    names = [f["name"] for f in fields] if target_order else kept + added

    def column(name: str) -> Column:
        kind = spark_type_of(wanted[name]["type"], types)
        if name in kept:
            value = F.col(f"`{name}`")
            return value.try_cast(kind).alias(name) if cast else value
        if use_defaults and wanted[name].get("default") is not None:
            return default_column(wanted[name]["default"], kind).alias(name)
        return F.lit(None).cast(kind).alias(name)

    return df.select(*[column(name) for name in names])


def compatible(writer: str | Mapping[str, Any], reader: str | Mapping[str, Any]) -> bool:
    """Can data written with ``writer`` be read as ``reader``, by field names?

    Every reader field must be written or have a default; types are compared
    by :func:`schema_compat`, against the data.
    """
    written = {f["name"] for f in record_fields(writer)}
    return all(f["name"] in written or "default" in f for f in record_fields(reader))


def schema_compat(df: DataFrame, target: str | Mapping[str, Any]) -> DataFrame:
    """Per target field: verdict, types, and rows whose value would not convert.

    Verdicts: ``same``, ``type_differs``, ``default`` (absent, has a default)
    and ``missing``. All counts come from one aggregate.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    lines, counts = [], []
    names = named_types(json.loads(target) if isinstance(target, str) else target)
    for i, field in enumerate(record_fields(target)):
        name, kind = field["name"], spark_type_of(field["type"], names)
        found = actual.get(name)
        failing = F.lit(0).cast("bigint")
        if found is None:
            verdict = "default" if "default" in field else "missing"
        elif same_type(found, kind):
            verdict = "same"
        else:
            verdict = "type_differs"
            counts.append(F.count_if(_would_fail(df, name, kind)).alias(f"_{i}"))
            failing = F.col(f"_{i}")
        lines.append(
            F.struct(
                F.lit(name).alias("field"),
                F.lit(verdict).alias("verdict"),
                F.lit(found.simpleString() if found else None).cast("string").alias("actual"),
                F.lit(kind.simpleString()).alias("target"),
                failing.alias("failing_rows"),
            )
        )
    return _one_row(df, counts).select(F.inline(F.array(*lines)))


def _would_fail(df: DataFrame, name: str, kind: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    try:
        df.select(value.try_cast(kind)).schema
    except AnalysisException:  # no conversion between the two types at all
        return value.isNotNull()
    fails = value.try_cast(kind).isNull()
    if isinstance(df.schema[name].dataType, T.StringType) and isinstance(kind, (T.IntegralType, T.DecimalType)):
        # Every failed conversion raises inside Spark; text without a digit need not try.
        fails = ~value.rlike("[0-9]") | fails
    return value.isNotNull() & fails


def _one_row(df: DataFrame, counts: list[Column]) -> DataFrame:
    return df.agg(*counts) if counts else df.sparkSession.range(1)
