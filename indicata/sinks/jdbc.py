"""JDBC table sink (K3)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, user: str | None = None,
               password: str | None = None, driver: str | None = None, mode: str = "overwrite",
               max_connections: int | None = None, batch_size: int = 10_000,
               truncate: bool = False) -> None:
    """Write a table over JDBC, replacing it by default (K3).

    Every task writes its own partition over its own connection;
    ``max_connections`` caps them (Spark coalesces to that many partitions)
    so a large job does not exhaust the database.  ``truncate`` keeps the
    table definition on overwrite instead of dropping it.
    """
    props = {"batchsize": str(batch_size)}
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    if driver is not None:
        props["driver"] = driver
    if max_connections is not None:
        props["numPartitions"] = str(max_connections)
    if truncate:
        props["truncate"] = "true"
    df.write.jdbc(url, table, mode=mode, properties=props)
