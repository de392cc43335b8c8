"""Generated rows for load tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def synthetic_rows(
    spark: SparkSession, rows: int, categories: int = 1000, seed: int = 42, partitions: int | None = None
) -> DataFrame:
    """``id, category, value1, value2, created_at``, generated inside the tasks."""
    return spark.range(0, rows, 1, partitions).selectExpr(
        "id",
        f"cast(id % {categories} as string) as category",
        f"rand({seed}) * 1000 as value1",
        f"rand({seed + 1}) * 100 as value2",
        "current_timestamp() as created_at",
    )
