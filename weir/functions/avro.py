"""Avro schema types and their Spark counterparts."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Avro primitive and logical types with their Spark types.
PRIMITIVES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
    "null": T.NullType(),
}
LOGICAL: dict[str, T.DataType] = {
    "date": T.DateType(),
    "timestamp-millis": T.TimestampType(),
    "timestamp-micros": T.TimestampType(),
    "local-timestamp-millis": T.TimestampNTZType(),
    "local-timestamp-micros": T.TimestampNTZType(),
    "uuid": T.StringType(),
}
# How Spark's types are written as Avro.
WRITTEN: dict[type, Any] = {
    T.StringType: "string",
    T.ByteType: "int",
    T.ShortType: "int",
    T.IntegerType: "int",
    T.LongType: "long",
    T.FloatType: "float",
    T.DoubleType: "double",
    T.BooleanType: "boolean",
    T.BinaryType: "bytes",
    T.NullType: "null",
    T.DateType: {"type": "int", "logicalType": "date"},
    T.TimestampType: {"type": "long", "logicalType": "timestamp-micros"},
    T.TimestampNTZType: {"type": "long", "logicalType": "local-timestamp-micros"},
}


def record_fields(schema: str | Mapping[str, Any]) -> list[dict[str, Any]]:
    parsed = json.loads(schema) if isinstance(schema, str) else schema
    if parsed.get("type") != "record":
        raise ValueError("the schema must be an Avro record")
    if not parsed["fields"]:
        raise ValueError("the record has no fields")
    return list(parsed["fields"])


def named_types(avro: Any, namespace: str = "") -> dict[str, Any]:
    """Records, enums and fixed types by name, with and without their namespace."""
    found: dict[str, Any] = {}
    if isinstance(avro, list):
        for member in avro:
            found |= named_types(member, namespace)
    elif isinstance(avro, Mapping):
        namespace = avro.get("namespace", namespace)
        if "name" in avro and avro.get("type") in ("record", "enum", "fixed"):
            found |= {name: avro for name in (avro["name"], f"{namespace}.{avro['name']}")}
        for inner in (avro.get("type"), avro.get("items"), avro.get("values"), *avro.get("fields", [])):
            if not isinstance(inner, str):
                found |= named_types(inner, namespace)
    return found


def widened(kinds: Sequence[T.DataType]) -> T.DataType:
    """The one type that holds every member of a union without loss."""
    if all(same_type(kind, kinds[0]) for kind in kinds):
        return kinds[0]
    if all(isinstance(kind, (T.IntegerType, T.LongType)) for kind in kinds):
        return T.LongType()
    if all(isinstance(kind, (T.FloatType, T.DoubleType)) for kind in kinds):
        return T.DoubleType()
    raise ValueError(f"no common type for the union of {', '.join(kind.simpleString() for kind in kinds)}")


def plain_type(kind: T.DataType) -> T.DataType:
    """The type with every nested value nullable."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(plain_type(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(plain_type(kind.keyType), plain_type(kind.valueType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, plain_type(f.dataType)) for f in kind.fields])
    return kind


def same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal but for nullability, at every depth."""
    return plain_type(a) == plain_type(b)


def spark_type_of(avro: Any, names: Mapping[str, Any] | None = None) -> T.DataType:
    """Spark type of an Avro type.

    A union of int and long, or float and double, takes the wider; one without
    a common type is an error. ``names`` resolves references to named types;
    see :func:`named_types`. Enums become strings.
    """
    names = named_types(avro) if names is None else names
    if isinstance(avro, list):
        members = [spark_type_of(member, names) for member in avro if member != "null"]
        return widened(members) if members else T.NullType()
    if isinstance(avro, str):
        if avro in PRIMITIVES:
            return PRIMITIVES[avro]
        if avro not in names:
            raise ValueError(f"unknown Avro type {avro!r}")
        others = {name: kind for name, kind in names.items() if kind is not names[avro]}  # no recursion
        return spark_type_of(names[avro], others)
    logical, kind = avro.get("logicalType"), avro["type"]
    if logical == "decimal":
        return T.DecimalType(avro["precision"], avro.get("scale", 0))
    if logical in LOGICAL:
        return LOGICAL[logical]
    if kind == "array":
        return T.ArrayType(spark_type_of(avro["items"], names), _nullable(avro["items"]))
    if kind == "map":
        return T.MapType(T.StringType(), spark_type_of(avro["values"], names), _nullable(avro["values"]))
    if kind == "record":
        return T.StructType(
            [T.StructField(f["name"], spark_type_of(f["type"], names), _nullable(f["type"])) for f in avro["fields"]]
        )
    if kind == "fixed":
        return T.BinaryType()
    if kind == "enum":
        return T.StringType()
    return spark_type_of(kind, names)


def _nullable(avro: Any) -> bool:
    return avro == "null" or (isinstance(avro, list) and "null" in avro)


def default_column(value: Any, kind: T.DataType) -> Column:
    """A declared default as a typed column; nested values go through JSON."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(F.lit(json.dumps(value)), kind)
    return F.lit(value).cast(kind)


def avro_of(kind: T.DataType, name: str, namespace: str, nullable: bool = False) -> Any:
    """Avro type of a Spark type; nullable values are a union with null."""
    if isinstance(kind, T.DecimalType):
        written: Any = {
            "type": "fixed",
            "name": "fixed",
            "namespace": f"{namespace}.{name}" if namespace else name,
            "size": _decimal_bytes(kind.precision),
            "logicalType": "decimal",
            "precision": kind.precision,
            "scale": kind.scale,
        }
    elif isinstance(kind, T.ArrayType):
        written = {"type": "array", "items": avro_of(kind.elementType, name, namespace, kind.containsNull)}
    elif isinstance(kind, T.MapType):
        written = {"type": "map", "values": avro_of(kind.valueType, name, namespace, kind.valueContainsNull)}
    elif isinstance(kind, T.StructType):
        inner = f"{namespace}.{name}" if namespace else name
        written = {
            "type": "record",
            "name": name,
            "namespace": namespace,
            "fields": [
                {"name": f.name, "type": avro_of(f.dataType, f.name, inner, f.nullable)} for f in kind.fields
            ],
        }
    else:
        written = WRITTEN.get(type(kind), "string")
    return [written, "null"] if nullable and written != "null" else written


def _decimal_bytes(precision: int) -> int:
    size = 1
    while 2 ** (8 * size - 1) - 1 < 10**precision - 1:
        size += 1
    return size
