"""Kafka sink."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.sources.kafka import kafka_options


def kafka_frame(df: DataFrame) -> DataFrame:
    """``key`` and ``value`` for Kafka.

    A frame with both columns is sent as it is. Otherwise the whole row
    becomes the JSON value and the key is the frame's ``key`` column, or NULL.
    """
    if "key" in df.columns and "value" in df.columns:
        return df.select("key", "value")
    key = F.col("key").cast("string") if "key" in df.columns else F.lit(None).cast("string")
    return df.select(key.alias("key"), F.to_json(F.struct("*")).alias("value"))


def kafka_write_options(
    topic: str, servers: str | None = None, properties: Mapping[str, Any] | None = None
) -> dict[str, str]:
    return {"topic": topic, **kafka_options(servers, properties)}


def write_kafka(df: DataFrame, topic: str, **options: Any) -> None:
    """Send a batch to one topic. Needs the Kafka connector."""
    kafka_frame(df).write.format("kafka").options(**kafka_write_options(topic, **options)).save()
