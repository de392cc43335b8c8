"""JDBC sink."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame

from weir.sinks.files import save_mode

# Fixed value: rows per insert batch unless given.
BATCH_SIZE = 1000


def jdbc_write_options(
    url: str,
    table: str,
    *,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    batch_size: int | str = BATCH_SIZE,
    properties: Mapping[str, Any] | None = None,
) -> dict[str, str]:
    options: dict[str, Any] = {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "user": user,
        "password": password,
        "batchsize": int(batch_size),
        **(properties or {}),
    }
    return {key: str(value) for key, value in options.items() if value is not None}


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: Any) -> None:
    """One connection per partition: coalesce a wide frame first. Needs the driver jar."""
    writer = df.write.format("jdbc").options(**jdbc_write_options(url, table, **options))
    writer.mode(save_mode(mode)).save()
