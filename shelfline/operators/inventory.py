"""Inventory state derived from inventory events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R


def stock_status(df: DataFrame, stock_col: str = "current_stock",
                 reorder_col: str = "reorder_point") -> DataFrame:
    """Input plus ``stock_status``: OUT_OF_STOCK at or below 0, LOW_STOCK at
    or below the reorder point, NORMAL otherwise (also when the reorder
    point is NULL)."""
    return df.withColumn("stock_status", R.stock_status(F.col(stock_col), F.col(reorder_col)))


def inventory_status(inventory_events: DataFrame) -> DataFrame:
    """Current stock per (store, product): the newest event by
    (event_time, event_id) wins, plus its stock status.

    ``max_by`` is an aggregate with a partial (map-side) phase, so a product
    with a huge share of events never gathers in one task, and no window
    sort is needed.
    """
    latest = inventory_events.groupBy("store_id", "product_id").agg(
        F.max_by(F.struct("dept_id", "current_stock", "reorder_point", "event_time"),
                 F.struct("event_time", "event_id")).alias("s"))
    cur = latest.select(
        "store_id", F.col("s.dept_id").alias("dept_id"), "product_id",
        F.col("s.current_stock").alias("current_stock"),
        F.col("s.reorder_point").alias("reorder_point"),
        F.col("s.event_time").alias("last_updated"))
    return stock_status(cur).select("store_id", "dept_id", "product_id", "current_stock",
                                    "reorder_point", "stock_status", "last_updated")
