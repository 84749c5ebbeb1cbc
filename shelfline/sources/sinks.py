"""Sinks: folder export, JDBC. Stored tables are in ``snapshots``."""

from __future__ import annotations

from pyspark.sql import DataFrame


def overwrite_sink(df: DataFrame, path: str, partition_by=None, fmt: str = "parquet",
                   rebalance: bool = True) -> None:
    """Replace a whole parquet folder (static overwrite, whatever the
    session's partition overwrite mode). The folder is emptied first: for an
    export that nothing reads meanwhile. Stored tables are snapshots."""
    if partition_by:
        cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        df = rebalanced(df, cols) if rebalance else df
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt)
    if partition_by:
        w = w.partitionBy(*cols)
    w.save(path)


def rebalanced(df: DataFrame, cols) -> DataFrame:
    """Bring the rows of each partition value together before a partitioned
    write, so every value gets a few files of useful size instead of one
    small file per task and value. ``rebalance`` lets AQE split a skewed
    value over several tasks and coalesce small ones."""
    return df.hint("rebalance", *cols)


def jdbc_sink(df: DataFrame, url: str, table: str, mode: str = "append",
              properties: dict | None = None, batch_size: int = 10000,
              num_partitions: int | None = None) -> None:
    """Write a table over JDBC. Credentials and driver come from the caller
    (``properties``); nothing is hard-coded. ``num_partitions`` bounds the
    number of concurrent connections."""
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", batch_size).mode(mode))
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
