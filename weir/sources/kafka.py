"""Kafka source and decoding of its messages."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_SERVERS = "localhost:9092"

# Option defaults of the two read modes.
BATCH_DEFAULTS = {"startingOffsets": "earliest"}
STREAM_DEFAULTS = {"startingOffsets": "latest", "minPartitions": "1"}
# Only on request, as they skip lost offsets and bound a trigger.
LENIENT_STREAM_OPTIONS = {"failOnDataLoss": "false", "maxOffsetsPerTrigger": "1000000"}
STREAM_OPTIONS = (*STREAM_DEFAULTS, *LENIENT_STREAM_OPTIONS)


def kafka_options(servers: str | None = None, properties: Mapping[str, Any] | None = None) -> dict[str, str]:
    """Connection options; every further client property gets its ``kafka.`` prefix."""
    given = dict(properties or {})
    bootstrap = given.pop("bootstrap.servers", None)
    options = {"kafka.bootstrap.servers": servers or bootstrap or DEFAULT_SERVERS}
    options.update({f"kafka.{key}": value for key, value in given.items()})
    return {key: str(value) for key, value in options.items()}


def kafka_read_options(
    topic: str,
    streaming: bool = False,
    servers: str | None = None,
    properties: Mapping[str, Any] | None = None,
    **offsets: Any,
) -> dict[str, str]:
    """Options to read one topic; ``offsets`` override the defaults of the mode.

    ``endingOffsets`` belongs to batch reads and is left out of streams. Streams
    fail on lost offsets and read all there is per trigger, unless
    ``LENIENT_STREAM_OPTIONS``, or own values for them, are given.
    """
    options = dict(STREAM_DEFAULTS if streaming else BATCH_DEFAULTS)
    for key, value in offsets.items():
        batch_only = key == "endingOffsets"
        stream_only = key in STREAM_OPTIONS and key not in BATCH_DEFAULTS
        if value is None or (streaming and batch_only) or (not streaming and stream_only):
            continue
        options[key] = str(value).lower() if isinstance(value, bool) else str(value)
    return {"subscribe": topic, **options, **kafka_options(servers, properties)}


def read_kafka(spark: SparkSession, topic: str, streaming: bool = False, **options: Any) -> DataFrame:
    """One topic, in batch or as a stream. Needs the Kafka connector."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**kafka_read_options(topic, streaming, **options)).load()


def decode_json(
    df: DataFrame, schema: str | T.StructType, value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Parse the JSON message value into columns; malformed messages give NULLs.

    Use :func:`split_json` to keep malformed messages apart.
    """
    text: Column = F.col(value).cast("string")
    return df.select(*keep, F.from_json(text, schema).alias("_message")).select(*keep, "_message.*")


def split_json(
    df: DataFrame, schema: str | T.StructType, value: str = "value", keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """Decoded messages, and the others: those without a value or that do not parse.

    The second frame has the ``keep`` columns and the ``message`` as it came. A
    field that does not fit its type makes the whole message malformed.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    checked = T.StructType([*fields.fields, T.StructField("_malformed", T.StringType())])
    text: Column = F.col(value).cast("string")
    parsed = df.select(
        *keep, text.alias("_text"), F.from_json(text, checked, {"columnNameOfCorruptRecord": "_malformed"}).alias("_message")
    )
    good = F.col("_message").isNotNull() & F.col("_message._malformed").isNull()
    decoded = parsed.filter(good).select(*keep, *[F.col("_message")[f.name].alias(f.name) for f in fields])
    return decoded, parsed.filter(~good).select(*keep, F.col("_text").alias("message"))
