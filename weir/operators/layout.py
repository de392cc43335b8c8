"""Partitioning and caching chosen by the user."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame

log = logging.getLogger(__name__)

# The storage level names a step may give.
STORAGE_LEVELS = {
    "NONE": StorageLevel.NONE,
    "DISK_ONLY": StorageLevel.DISK_ONLY,
    "DISK_ONLY_2": StorageLevel.DISK_ONLY_2,
    "MEMORY_ONLY": StorageLevel.MEMORY_ONLY,
    "MEMORY_ONLY_2": StorageLevel.MEMORY_ONLY_2,
    "MEMORY_ONLY_SER": StorageLevel.MEMORY_ONLY,
    "MEMORY_ONLY_SER_2": StorageLevel.MEMORY_ONLY_2,
    "MEMORY_AND_DISK": StorageLevel.MEMORY_AND_DISK,
    "MEMORY_AND_DISK_2": StorageLevel.MEMORY_AND_DISK_2,
    "MEMORY_AND_DISK_SER": StorageLevel.MEMORY_AND_DISK,
    "MEMORY_AND_DISK_SER_2": StorageLevel.MEMORY_AND_DISK_2,
    "OFF_HEAP": StorageLevel.OFF_HEAP,
}


def repartition(df: DataFrame, partitions: int | str) -> DataFrame:
    """Deal the rows out evenly over ``partitions``."""
    return df.repartition(int(partitions))


def repartition_by(
    df: DataFrame, columns: str | Sequence[str], partitions: int | str | None = None
) -> DataFrame:
    """Hash the rows by ``columns``: equal keys share a partition, hot or not."""
    names = [columns] if isinstance(columns, str) else list(columns)
    if not names:
        raise ValueError("give at least one column")
    if partitions is None:
        return df.repartition(*names)
    return df.repartition(int(partitions), *names)


def coalesce(df: DataFrame, partitions: int | str) -> DataFrame:
    """Merge partitions down to at most ``partitions`` without a shuffle."""
    return df.coalesce(int(partitions))


def rebalance(df: DataFrame, columns: str | Sequence[str] = ()) -> DataFrame:
    """Shuffle into partitions of the advisory size, for writing files.

    Rows with equal ``columns`` meet where they fit; adaptive execution splits
    a key that is too big for one partition and merges the small ones.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    return df.hint("rebalance", *names)


def storage_level(name: str) -> StorageLevel:
    known = STORAGE_LEVELS.get(name.upper())
    if known is None:
        log.warning("unknown storage level %s, using MEMORY_AND_DISK", name)
        return StorageLevel.MEMORY_AND_DISK
    return known


def cache(df: DataFrame, level: str = "MEMORY_AND_DISK") -> DataFrame:
    """Persist lazily. A lost executor's blocks are recomputed from lineage."""
    return df.persist(storage_level(level))


def uncache(*frames: DataFrame, blocking: bool = False) -> None:
    for df in frames:
        df.unpersist(blocking)
