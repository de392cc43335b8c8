"""Shared scratch space: written tables, stream checkpoints, cut lineage.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
local-mode session without that setting gets a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="weir-")


def scratch_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder that every executor can reach"
        )
    return _local_root()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder; never handed out twice."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and cut its lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return df.checkpoint()
