"""Stream sources, sinks and query handling.

Filters, enrichment, decoding, quarantine and joins with static frames are the
batch operators; they run on a stream unchanged.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weir.scratch import scratch_path
from weir.sinks.files import column_list
from weir.sinks.kafka import kafka_frame, kafka_write_options
from weir.streaming.triggers import DEFAULT_TRIGGER, parse_trigger


def read_file_stream(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    file_format: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    **options: Any,
) -> DataFrame:
    """Files arriving in a folder, in bounded batches when a limit is given."""
    given = {"pathGlobFilter": glob, "maxFilesPerTrigger": max_files_per_trigger, **options}
    given = {key: str(value) for key, value in given.items() if value is not None}
    return spark.readStream.format(file_format).schema(schema).options(**given).load(folder)


def write_stream(
    df: DataFrame,
    path: str | None = None,
    file_format: str = "parquet",
    *,
    checkpoint: str | None = None,
    output_mode: str = "append",
    trigger: str = DEFAULT_TRIGGER,
    partition_by: str | Sequence[str] | None = None,
    query_name: str | None = None,
    **options: Any,
) -> StreamingQuery:
    """Start a stream into a file or table sink.

    Name a ``checkpoint`` to resume after a restart; without one the query
    starts in a fresh folder of the shared scratch space.
    """
    if not df.isStreaming:
        raise ValueError("this is a batch frame; use the batch sinks")
    folder = checkpoint or scratch_path(df.sparkSession, "stream-checkpoint")
    given = {key: str(value) for key, value in options.items() if value is not None}
    writer = (
        df.writeStream.format(file_format)
        .outputMode(output_mode)
        .option("checkpointLocation", folder)
        .options(**given)
        .trigger(**parse_trigger(trigger))
    )
    if column_list(partition_by):
        writer = writer.partitionBy(*column_list(partition_by))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start(path)


def write_kafka_stream(
    df: DataFrame,
    topic: str,
    servers: str | None = None,
    properties: dict[str, Any] | None = None,
    **stream: Any,
) -> StreamingQuery:
    """Start a stream into a Kafka topic. Needs the Kafka connector."""
    options = {**kafka_write_options(topic, servers, properties), **stream}
    return write_stream(kafka_frame(df), None, "kafka", **options)


def await_all(queries: Iterable[StreamingQuery], timeout: float | None = None) -> bool:
    """Wait for all queries, ``timeout`` seconds in total; True when all ended.

    A query that failed raises its error here.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    ended = True
    for query in queries:
        if deadline is None:
            query.awaitTermination()
        else:
            left = max(deadline - time.monotonic(), 0.001)
            ended = bool(query.awaitTermination(left)) and ended
    return ended


def any_active(queries: Iterable[StreamingQuery]) -> bool:
    return any(query.isActive for query in queries)


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()
