"""Valid vectors of a table, and bounded packs of them for matrix products."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import written

PACK = "ids binary, rows binary, vectors binary"


def valid_vectors(embeddings: DataFrame, label: str) -> DataFrame:
    """(rid, vec_id, vec, dim): one row per usable row; ``rid`` tells repeated rows apart.

    Left out: NULL ids and vectors, and vectors with a NULL or non-finite component.
    """
    vec = F.col("embedding").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).filter(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False))
    )
    return written(usable.select(F.monotonically_increasing_id().alias("rid"), "*", F.size("vec").alias("dim")), label)


def packs(vectors: DataFrame, keys: list[str]) -> DataFrame:
    """One row per value of ``keys``: its ids, row ids and vectors, in order of id.

    The caller's keys must bound a group.
    """

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["vec_id", "rid"])
        row = {k: [group[k].iloc[0]] for k in keys}
        row["ids"] = [group["vec_id"].to_numpy(np.int64).tobytes()]
        row["rows"] = [group["rid"].to_numpy(np.int64).tobytes()]
        row["vectors"] = [np.array(group["vec"].tolist(), np.float64).tobytes()]
        return pd.DataFrame(row)

    kinds = dict(vectors.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", " + PACK
    return vectors.select(*keys, "vec_id", "rid", "vec").groupBy(*keys).applyInPandas(pack, schema)


def unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, rows = np.frombuffer(row.ids, np.int64), np.frombuffer(row.rows, np.int64)
    vectors = np.frombuffer(row.vectors, np.float64)
    return ids, rows, vectors.reshape(len(ids), -1) if len(vectors) else np.zeros((len(ids), 0))


def slots(column: Column, counts: dict[int, int], size: int) -> Column:
    """A shard number per dimension so that shards hold about ``size`` rows."""
    shards = F.create_map(*[F.lit(x) for d, n in counts.items() for x in (d, -(-n // size))])
    return F.pmod(F.xxhash64(column), shards[F.col("dim")]).cast("int")
