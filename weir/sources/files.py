"""File and versioned-table sources."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FILE_FORMATS = ("parquet", "csv", "json", "orc", "avro")

# CSV options applied unless the caller gives others.
CSV_DEFAULTS = {"header": "true", "inferSchema": "true", "delimiter": ","}


def object_uri(bucket: str, path: str, scheme: str = "s3a") -> str:
    """``scheme://bucket/path`` whether or not the path starts with a slash."""
    return f"{scheme}://{bucket.strip('/')}/{path.lstrip('/')}"


def read_options(file_format: str, given: dict[str, Any], has_schema: bool = False) -> dict[str, str]:
    """Reader options of a format: its defaults overlaid with the given ones."""
    fmt = file_format.lower()
    if fmt not in FILE_FORMATS:
        raise ValueError(f"unknown file format {file_format!r}; use one of {FILE_FORMATS}")
    options = dict(CSV_DEFAULTS) if fmt == "csv" else {}
    options.update({key: _text(value) for key, value in given.items() if value is not None})
    if has_schema:
        options.pop("inferSchema", None)
    return options


def read_files(
    spark: SparkSession,
    path: str | list[str],
    file_format: str = "parquet",
    schema: str | T.StructType | None = None,
    **options: Any,
) -> DataFrame:
    """Read files of any URI. Give CSV and JSON a schema to save the inference scan."""
    reader = spark.read.format(file_format.lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**read_options(file_format, options, schema is not None)).load(path)


def avro_read_options(avro_schema: str | None = None, infer_schema: Any = None) -> dict[str, str]:
    options = {"avroSchema": avro_schema, "inferSchema": infer_schema}
    return {key: _text(value) for key, value in options.items() if value is not None}


def read_avro(
    spark: SparkSession, path: str, avro_schema: str | None = None, infer_schema: Any = None
) -> DataFrame:
    """Avro files, optionally with a reader schema. Needs the spark-avro module."""
    return spark.read.format("avro").options(**avro_read_options(avro_schema, infer_schema)).load(path)


def delta_read_options(version: int | str | None = None, timestamp: str | None = None) -> dict[str, str]:
    """Time travel options; a version wins over a timestamp."""
    if version is not None:
        return {"versionAsOf": str(version)}
    return {"timestampAsOf": str(timestamp)} if timestamp is not None else {}


def read_table(
    spark: SparkSession,
    path: str,
    version: int | str | None = None,
    timestamp: str | None = None,
    table_format: str = "delta",
    merge_schema: bool = False,
) -> DataFrame:
    """Table folder: Delta, latest or as of a version or timestamp, or Parquet.

    A Parquet folder has no versions; see ``snapshot_as_of`` for change logs.
    """
    travel = delta_read_options(version, timestamp)
    if table_format != "delta":
        if travel:
            raise ValueError(f"a {table_format} folder cannot be read as of a version or timestamp")
        return read_files(spark, path, table_format, mergeSchema=merge_schema)
    return spark.read.format("delta").options(**travel).load(path)


def _text(value: Any) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)
