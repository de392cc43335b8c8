"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.scratch import scratch_path

SCRATCH = "_scratch_path"
# An Arrow batch is held several times over by each task: outside the JVM's heap, and in Python as columns,
# strings and results. Spark's default lets it have 10,000 rows or 64 MB, whatever the texts' length.
BATCH_BYTES = "2m"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder; cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    table = spark.read.schema(df.schema).parquet(path)
    table.__dict__[SCRATCH] = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table that :func:`written` made and nothing reads any more, and let its shuffle files go.

    Shuffle files of finished steps stay until the driver's JVM collects the
    plans; they can be as large as the input, so it is asked to.
    """
    context = table.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(table.__dict__[SCRATCH])
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    context._jvm.System.gc()


def map_batches(df: DataFrame, rows: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Apply ``rows``, from one Arrow batch to columns by name, to every batch."""
    names = [field.split()[0] for field in _fields(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = rows(batch)
            yield pa.RecordBatch.from_arrays([_array(columns[name]) for name in names], names)

    return df.mapInArrow(run, schema)


def bound_batches(spark: SparkSession) -> None:
    """From now on batches for Python have ``BATCH_BYTES``, or one row if that is longer; a size the user set stays."""
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def map_texts(df: DataFrame, rows: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """:func:`map_batches` for rows that hold whole texts, in batches bounded by bytes."""
    bound_batches(df.sparkSession)
    return map_batches(df, rows, schema)


def _array(values) -> pa.Array:
    return values if isinstance(values, (pa.Array, pa.ChunkedArray)) else pa.array(values)


def _fields(schema: str) -> list[str]:
    """Top-level fields of a DDL schema."""
    fields, depth, start = [], 0, 0
    for i, char in enumerate(schema):
        depth += (char in "<(") - (char in ">)")
        if char == "," and not depth:
            fields.append(schema[start:i].strip())
            start = i + 1
    return [*fields, schema[start:].strip()]


def seeded(seed: int, *columns: Column) -> Column:
    """A number that looks random but depends on the seed and the columns only."""
    return F.xxhash64(F.lit(seed), *columns)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(value: Column) -> Column:
    """A string that is never NULL; NULL sorts after every value."""
    return F.when(value.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), value))


def repeat_rows(df: DataFrame, key: Column, times: DataFrame) -> DataFrame:
    """Each distinct row of ``df`` as often as ``times`` (key, times) says; rows without an entry go.

    ``key`` must tell different rows apart. Equal rows are combined in every task.
    """
    rows = df.select(key.alias("key"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    wanted = times.filter("times > 0").select("key", F.col("times").cast("int").alias("times"))
    found = rows.dropDuplicates(["key"]).join(wanted, "key")
    return found.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def row_key(df: DataFrame) -> Column:
    """A hash that tells rows apart, NULL columns from shifted ones included."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
