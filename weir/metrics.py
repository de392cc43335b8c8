"""Step metrics, their history and throughput summaries."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HISTORY_SCHEMA = (
    "pipeline string, step int, type string, method string, status string, "
    "duration_ms bigint, records bigint"
)


def observe(
    df: DataFrame, name: str, measures: Mapping[str, Column] | None = None
) -> tuple[DataFrame, Observation]:
    """Count rows, and any further aggregates, as the frame is computed.

    Costs no extra scan: read it with :func:`observed` after an action. Like the
    counters of the Spark UI, a count may include rows of a retried stage.
    """
    observation = Observation(name)
    extra = [column.alias(alias) for alias, column in (measures or {}).items()]
    return df.observe(observation, F.count(F.lit(1)).alias("records"), *extra), observation


def observed(observation: Observation) -> dict[str, Any]:
    """Values of an observation after its action.

    Empty when Spark left the observed part of the plan out, which it does
    behind a shuffle that moved no rows.
    """
    try:
        return dict(observation.get)
    except Py4JJavaError:
        return {}


def timed(action: Callable[[], Any]) -> tuple[str, int, Any]:
    """Run an action; return status, duration in ms and its result or error."""
    start = time.monotonic()
    try:
        result, status = action(), "SUCCESS"
    except Exception as error:  # recorded, and raised again by the caller
        result, status = error, "FAILED"
    return status, int((time.monotonic() - start) * 1000), result


def metrics_frame(spark: SparkSession, lines: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Recorded steps as a frame in the history schema: one short row per step."""
    fields = T.StructType.fromDDL(HISTORY_SCHEMA).fields
    steps = [
        F.struct(*[F.lit(line.get(f.name)).cast(f.dataType).alias(f.name) for f in fields])
        for line in lines
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*steps)))


def append_history(metrics: DataFrame, path: str) -> None:
    """Append to a history folder of JSON lines."""
    metrics.write.mode("append").json(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY_SCHEMA).json(path)


def throughput(history: DataFrame, by: Sequence[str] = ("pipeline",)) -> DataFrame:
    """Records, time and records per second, per pipeline or per step."""
    return history.groupBy(*by).agg(
        F.sum("records").alias("records"),
        F.sum("duration_ms").alias("duration_ms"),
        F.try_divide(F.sum("records") * 1000, F.sum("duration_ms")).alias("records_per_second"),
    )
