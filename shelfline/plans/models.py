"""Materialise the model graph: staging and intermediate models as views,
marts and real-time models as stored tables, the incremental summary as a
partition-merged table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..operators import batch, realtime, staging
from ..sources.snapshots import SnapshotTable
from .summary_log import SummaryLog


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """``view``: a lazy temp view; ``table``: the result written as a new
    snapshot of the stored table and read back, so later models start from
    stored data. A write that breaks off leaves the table as it was."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind == "table":
        if not path:
            raise ValueError("a table needs a path")
        table = SnapshotTable(df.sparkSession, path)
        table.overwrite(df)
        out = table.read()
        out.createOrReplaceTempView(name)
        return out
    raise ValueError(f"unknown materialization {kind!r}")


def build_batch_models(spark: SparkSession, sales: DataFrame, stores: DataFrame,
                       features: DataFrame, marts_root: str) -> dict:
    """staging (views) -> intermediate (views) -> marts (tables)."""
    out = {
        "stg_sales": materialize(staging.stg_sales(sales), "stg_sales"),
        "stg_stores": materialize(staging.stg_stores(stores), "stg_stores"),
        "stg_features": materialize(staging.stg_features(features), "stg_features"),
        "int_daily_sales": materialize(batch.daily_sales(sales), "int_daily_sales"),
        "int_store_performance": materialize(
            batch.store_performance(sales, stores, features), "int_store_performance"),
    }
    out["fct_sales_summary"] = materialize(
        batch.sales_summary(sales), "fct_sales_summary", "table",
        f"{marts_root.rstrip('/')}/fct_sales_summary")
    return out


def build_realtime_models(spark: SparkSession, events: DataFrame, as_of: dt.datetime,
                          root: str) -> dict:
    """The three trailing-window tables, stamped with ``as_of``."""
    r = root.rstrip("/")
    return {
        "rt_sales_summary": materialize(realtime.rt_sales_summary(events, as_of),
                                        "rt_sales_summary", "table", f"{r}/rt_sales_summary"),
        "rt_inventory_alerts": materialize(realtime.inventory_alerts(events, as_of),
                                           "rt_inventory_alerts", "table", f"{r}/rt_inventory_alerts"),
        "rt_customer_analytics": materialize(realtime.customer_analytics(events, as_of),
                                             "rt_customer_analytics", "table",
                                             f"{r}/rt_customer_analytics"),
    }


def materialize_incremental(spark: SparkSession, path: str, events: DataFrame,
                            as_of: dt.datetime, merge: str = "additive") -> None:
    """Run the incremental summary against the stored log of runs at
    ``path``; ``read_incremental`` resolves it."""
    SummaryLog(spark, path).run(events, as_of, merge)


def read_incremental(spark: SparkSession, path: str) -> DataFrame:
    """The stored incremental summary, one row per key."""
    return SummaryLog(spark, path).read()
