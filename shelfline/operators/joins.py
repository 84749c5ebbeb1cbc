"""Join helpers: plain dimension joins, literal partition filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Partition values that are filtered by literals. A run that touches more
# partitions than this reads most of the table anyway and joins instead.
MAX_PARTITION_VALUES = 10_000


def dim_join(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a fact table to a dimension.

    No hint and no probe: Spark broadcasts a dimension whose size in bytes
    it knows to be small, AQE does so when the run shows it, and otherwise
    the shuffle join stays, whose skewed partitions AQE splits.
    """
    return fact.join(dim, on=on, how=how)


def in_partitions(stored: DataFrame, rows: DataFrame, col: str) -> DataFrame:
    """The part of ``stored`` (partitioned by ``col``) whose partition value
    occurs in ``rows``.

    The distinct values are fetched first and become literals, so only the
    touched partitions are listed and read, whatever ``rows`` is made from.
    """
    values = [r[0] for r in rows.select(col).distinct().limit(MAX_PARTITION_VALUES + 1).collect()]
    if len(values) > MAX_PARTITION_VALUES:
        return stored.join(rows.select(col).distinct(), col, "left_semi")
    known = [v for v in values if v is not None]
    cond = F.col(col).isin(known) if known else F.lit(False)
    return stored.where(cond | F.col(col).isNull() if len(known) < len(values) else cond)
