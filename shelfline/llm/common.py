"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# ASCII white space: space and the control characters tab .. carriage return.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The maximal runs of non-white-space characters (null text: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def hex_long(hex_text: Column, start: int, digits: int) -> Column:
    """``digits`` hexadecimal digits as a long; 16 digits wrap to negative."""
    base = -10 if digits > 15 else 10
    return F.conv(F.substring(hex_text, start, digits), 16, base).cast("long")


def with_small_side(side: DataFrame, rows: int, max_rows: int = 2_000_000) -> DataFrame:
    """Mark ``side`` for broadcast if its counted ``rows`` allow it.

    The caller knows the exact row count of this narrow side (a few long
    columns). Beyond ``max_rows`` the plain shuffle join stays, where AQE
    splits skewed partitions.
    """
    return F.broadcast(side) if rows <= max_rows else side


def stored(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, in folders ``by`` columns,
    and read it back.

    Cuts the lineage with files that survive lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def carried(df: DataFrame, added: list[str]) -> list[Column]:
    """The columns of ``df`` that an operator carries along: all but those
    whose names (in any case) it is about to add."""
    taken = {c.lower() for c in added}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]


class Memo(dict):
    """Computed values of recent string keys, in two bounded generations: a
    full one becomes the old one. Keys over 64 characters are not kept."""

    def __init__(self, compute: Callable[[str], object], limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key: str) -> object:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
