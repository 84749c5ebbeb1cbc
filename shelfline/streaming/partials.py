"""Models kept by a stream as mergeable partial rows.

Each model is a pair: partial rows of some events alone, and a merge of the
partial rows of any number of epochs into the model's rows. The stream
appends the partials of each micro-batch (``epochs``); late and out-of-order
events count like any other, and no state is held between triggers.

* ``alert_panes``: one row per 5-minute pane, store, department and product.
  A sliding window is the sum of the panes in it, so the stream keeps one row
  per pane where the window operator keeps one per overlapping window, and
  the overlap is expanded over panes, not over events.
* ``customer_partials``: one row per day, customer, store, department and
  product. Distinct departments and products are then exact whatever the
  order and the split of the events: the merge counts the rows' keys. (Bitmaps
  per customer and day would take 4 KB each for a handful of products.)
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import rules as R
from ..functions.time import to_timedelta, whole_minutes_between
from ..operators.batch import weighted_avg
from ..operators.realtime import SALE, customer_segments, with_alert_levels
from ..sources.snapshots import SnapshotTable
from .epochs import append_epoch, epoch_key, started

PANE_DATE = "pane_date"
PANE_KEYS = [PANE_DATE, "pane", "store_id", "dept_id", "product_id"]
_PANE_SUMS = ["n", "units", "revenue"]
CUSTOMER_KEYS = ["sale_date", "customer_id", "store_id", "dept_id", "product_id"]
_CUSTOMER_SUMS = ["n", "spent", "units", "promoted"]


def _merged(rows: DataFrame, keys, sums, lows=(), highs=()) -> DataFrame:
    """Partial rows of equal keys added up, with the columns they had."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    g = rows.groupBy(*keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in sums], *[F.min(c).alias(c) for c in lows],
                                *[F.max(c).alias(c) for c in highs])
    return g.select(*rows.columns)


def alert_panes(events: DataFrame, pane: str = "5 minutes") -> DataFrame:
    """SALE activity per pane, store, department and product."""
    sales = events.where(F.col("transaction_type") == SALE)
    rows = sales.groupBy(F.window("event_time", pane).start.alias("pane"), "store_id", "dept_id", "product_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("units"),
        F.sum("total_amount").cast("decimal(20,2)").alias("revenue"), F.max("event_time").alias("last"))
    return rows.withColumn(PANE_DATE, F.to_date("pane"))


def merge_panes(panes: DataFrame) -> DataFrame:
    return _merged(panes, PANE_KEYS, _PANE_SUMS, highs=["last"])


def alerts_from_panes(panes: DataFrame, size: str = "1 hour", slide: str = "5 minutes", velocity=R.VELOCITY_TIERS,
                      alert=R.ALERT_TIERS, keep=R.ALERT_KEEP) -> DataFrame:
    """Sliding-window restock alerts from merged or unmerged panes of width
    ``slide``: the rows of ``windows.stream_inventory_alerts``."""
    step, n = to_timedelta(slide), to_timedelta(size) // to_timedelta(slide)
    if n * step != to_timedelta(size):
        raise ValueError("the window must be a whole number of slides")
    starts = F.sequence(F.col("pane") - F.lit(step * (n - 1)), F.col("pane"), F.lit(step))
    g = (merge_panes(panes).withColumn("window_start", F.explode(starts))
         .groupBy("window_start", "store_id", "dept_id", "product_id")
         .agg(F.sum("n").alias("transactions_last_hour"), F.sum("units").alias("units_sold_last_hour"),
              F.sum("revenue").cast("decimal(20,2)").alias("revenue_last_hour"), F.max("last").alias("last_sale_time")))
    a = with_alert_levels(g, velocity=velocity, alert=alert).where(F.col("alert_level").isin(*keep))
    return a.select(
        "window_start", (F.col("window_start") + F.lit(to_timedelta(size))).alias("window_end"), "store_id", "dept_id",
        "product_id", "transactions_last_hour", "units_sold_last_hour", "revenue_last_hour",
        weighted_avg(F.col("revenue_last_hour"), F.col("transactions_last_hour"), S.MONEY).alias("avg_transaction_value"),
        "last_sale_time", "velocity_category", "alert_level")


def customer_partials(events: DataFrame) -> DataFrame:
    """SALE activity per day, customer, store, department and product."""
    sales = events.where(F.col("transaction_type") == SALE)
    return sales.groupBy(F.to_date("event_time").alias("sale_date"), "customer_id", "store_id", "dept_id", "product_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").cast("decimal(20,2)").alias("spent"),
        F.sum("quantity").alias("units"), R.count_where(F.col("promotion_applied")).alias("promoted"),
        F.min("event_time").alias("first"), F.max("event_time").alias("last"))


def merge_customers(partials: DataFrame) -> DataFrame:
    return _merged(partials, CUSTOMER_KEYS, _CUSTOMER_SUMS, lows=["first"], highs=["last"])


def customers_from_partials(partials: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The rows of ``realtime.customer_analytics`` for the day of ``as_of``."""
    today = merge_customers(partials.where(F.col("sale_date") == F.lit(as_of.date())))
    m = today.groupBy("customer_id", "store_id").agg(
        F.sum("n").alias("transactions_today"), F.sum("spent").cast("decimal(20,2)").alias("total_spent_today"),
        F.sum("units").alias("total_items_purchased"), F.count_distinct("dept_id").alias("departments_visited"),
        F.count_distinct("product_id").alias("unique_products_bought"), F.sum("promoted").alias("promotional_transactions"),
        F.min("first").alias("first_transaction_today"), F.max("last").alias("last_transaction_today"))
    m = m.withColumn("avg_transaction_value",
                     weighted_avg(F.col("total_spent_today"), F.col("transactions_today"), S.MONEY))
    m = m.withColumn("session_duration_minutes",
                     whole_minutes_between("first_transaction_today", "last_transaction_today"))
    return customer_segments(m, as_of)


def partials_hook(table_path: str, partials: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame],
                  partition_by: tuple = ()):
    """An ``after_write`` hook of the ingest that keeps a model's partials."""
    def hook(rows: DataFrame, batch_key) -> None:
        append_epoch(SnapshotTable(rows.sparkSession, table_path), partials(rows), f"{batch_key}", merge, partition_by)
    return hook


def pane_hook(table_path: str):
    return partials_hook(table_path, alert_panes, merge_panes, (PANE_DATE,))


def customer_hook(table_path: str):
    return partials_hook(table_path, customer_partials, merge_customers, ("sale_date",))


def start_partials_stream(events: DataFrame, checkpoint: str, table_path: str, partials, merge, partition_by: tuple = (),
                          processing_time: str | None = "10 seconds", available_now: bool = False):
    """Keep a model's partials from a stream of stored events."""
    hook = partials_hook(table_path, partials, merge, partition_by)

    def write(batch: DataFrame, epoch_id: int) -> None:
        hook(batch, epoch_key(batch.sparkSession, checkpoint, epoch_id))
    return started(events.writeStream.foreachBatch(write), checkpoint, processing_time, available_now)


def read_alerts(spark: SparkSession, table_path: str) -> DataFrame:
    return alerts_from_panes(SnapshotTable(spark, table_path).read())


def read_customers(spark: SparkSession, table_path: str, as_of: dt.datetime) -> DataFrame:
    """Only the day's partition is read."""
    day = f"sale_date={as_of.date().isoformat()}"
    return customers_from_partials(SnapshotTable(spark, table_path).read(lambda e: e["part"] == day), as_of)
