"""Session settings the library counts on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Skewed join and rebalance partitions are split at run time. The force flag
# lets Spark split a hot join key even when that costs one more exchange. The
# advisory size also sets how large the files of a balanced write become.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # sessions of a hot key are merged in every task before they meet
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# For streams that remember more than an executor's heap should hold: pass to
# build_session before the first start of a query.
LARGE_STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Input per shuffle partition to start from. Shuffled data is pruned and combined,
# so it is smaller.
PARTITION_BYTES = 256 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SIZED_BY_US = "weir.initialPartitionNum"


def build_session(
    app_name: str = "weir",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Session for scripts and tests; on a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return apply_runtime_settings(builder.getOrCreate())


def apply_runtime_settings(spark: SparkSession) -> SparkSession:
    """Set UTC and the adaptive switches, keeping what the user set already."""
    chosen = spark.conf.getAll
    for key, value in ADAPTIVE_SETTINGS.items():
        if key not in chosen:
            spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """Shuffles sized for an input while the block runs; the settings are as before afterwards."""
    before = {key: spark.conf.get(key, None) for key in (INITIAL_PARTITIONS, SIZED_BY_US)}
    try:
        yield size_shuffles(spark, input_bytes)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Start shuffles with enough partitions for the input; returns their number.

    Adaptive execution merges partitions that turn out small but adds none,
    except for skew, so the default of a small session would leave huge ones
    on a large input. A number the user chose stays.
    """
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chosen = spark.conf.get(INITIAL_PARTITIONS, None)
    if chosen is not None and chosen != spark.conf.get(SIZED_BY_US, None):
        return int(chosen)
    wanted = -(-input_bytes // PARTITION_BYTES)
    current = int(chosen or default)
    if wanted <= current:
        return current
    for key in (INITIAL_PARTITIONS, SIZED_BY_US):
        spark.conf.set(key, str(wanted))
    return wanted
