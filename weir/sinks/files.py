"""File and versioned-table sinks."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.operators.layout import rebalance
from weir.operators.schemas import DEFAULT_NAMESPACE, DEFAULT_RECORD, avro_schema_json

# The save modes.
SAVE_MODES = ("append", "overwrite", "errorifexists", "ignore")


def save_mode(mode: str) -> str:
    spelled = mode.lower()
    if spelled not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}; use one of {', '.join(SAVE_MODES)}")
    return spelled


def column_list(columns: str | Sequence[str] | None) -> list[str]:
    if columns is None:
        return []
    return [columns] if isinstance(columns, str) else list(columns)


def write_files(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    mode: str = "append",
    partition_by: str | Sequence[str] | None = None,
    compression: str | None = None,
    balance: bool = False,
    **options: Any,
) -> None:
    """Write files. ``balance`` first shuffles rows into even, advisory-size
    partitions that keep a partition value together, so that a partitioned
    write leaves few files and no task holds a whole hot value.
    """
    columns = column_list(partition_by)
    given = {key: str(value) for key, value in options.items() if value is not None}
    if compression:
        given["compression"] = compression
    source = rebalance(df, columns) if balance else df
    writer = source.write.format(file_format.lower()).mode(save_mode(mode)).options(**given)
    if columns:
        writer = writer.partitionBy(*columns)
    writer.save(path)


def delta_write_options(merge_schema: Any = None, overwrite_schema: Any = None) -> dict[str, str]:
    options = {"mergeSchema": merge_schema, "overwriteSchema": overwrite_schema}
    return {key: str(value).lower() for key, value in options.items() if value is not None}


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: str | Sequence[str] | None = None,
    merge_schema: Any = None,
    overwrite_schema: Any = None,
    table_format: str = "delta",
    balance: bool = False,
) -> None:
    """Write a table folder: Delta (needs its module) or plain Parquet.

    A Parquet folder takes appended rows with new columns as they are; ask for
    the merged schema when reading it.
    """
    options = delta_write_options(merge_schema, overwrite_schema) if table_format == "delta" else {}
    write_files(df, path, table_format, mode, partition_by, balance=balance, **options)


def write_avro(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: str | Sequence[str] | None = None,
    compression: str | None = None,
    avro_schema: str | None = None,
) -> None:
    """Write Avro files. Needs the spark-avro module."""
    write_files(df, path, "avro", mode, partition_by, compression, avroSchema=avro_schema)


def write_parquet_with_avro_schema(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_by: str | Sequence[str] | None = None,
    compression: str = "snappy",
    namespace: str = DEFAULT_NAMESPACE,
    name: str = DEFAULT_RECORD,
) -> None:
    """Parquet whose files carry the frame's Avro schema.

    It travels as metadata of the first column that stays in the files, and a
    reader finds it in that field's ``metadata["avroSchema"]``.
    """
    folders = column_list(partition_by)
    carrier = next(c for c in df.columns if c not in folders)
    schema = avro_schema_json(df, namespace, name)
    marked = df.select(
        *[
            F.col(f"`{c}`").alias(c, metadata={"avroSchema": schema}) if c == carrier else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
    write_files(marked, path, "parquet", mode, partition_by, compression)
