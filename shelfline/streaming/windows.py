"""Event-time window models. ``window()`` works on batch and streaming
DataFrames alike, so each function is both the stream and its batch check.
On a stream the watermark bounds the state; in append mode a window is
emitted once the watermark passes its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators.realtime import with_alert_levels
from ..sources.snapshots import SnapshotTable
from .epochs import append_epoch, epoch_key, started


def _window_cols():
    return [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]


def _watermarked(events: DataFrame, watermark: str | None) -> DataFrame:
    """On a stream a watermark must be chosen: events that arrive later than
    it are dropped from the windows (the monitor counts them). To count them
    all, use the batch form over the event table, or ``summary_hook``."""
    if not events.isStreaming:
        return events
    if not watermark:
        raise ValueError("a stream needs a watermark: later events are dropped")
    return events.withWatermark("event_time", watermark)


def stream_hourly_sales(events: DataFrame, watermark: str | None = None,
                        size: str = "1 hour") -> DataFrame:
    """Tumbling-window sales per store and department (same measures as the
    hourly summary)."""
    e = _watermarked(events, watermark)
    g = e.groupBy(F.window("event_time", size).alias("w"), "store_id", "dept_id").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("total_amount").alias("total_sales"),
        F.avg("total_amount").alias("avg_transaction_value"),
        R.count_where(F.col("transaction_type") == "SALE").alias("sale_count"),
        R.count_where(F.col("transaction_type") == "RETURN").alias("return_count"),
        R.count_where(F.col("transaction_type") == "EXCHANGE").alias("exchange_count"),
        R.count_where(F.col("promotion_applied")).alias("promotional_transactions"),
        F.max("event_time").alias("latest_transaction_time"))
    return g.select(*_window_cols(), *[c for c in g.columns if c != "w"])


def stream_inventory_alerts(events: DataFrame, watermark: str | None = None,
                            size: str = "1 hour", slide: str = "5 minutes",
                            velocity=R.VELOCITY_TIERS, alert=R.ALERT_TIERS,
                            keep=R.ALERT_KEEP) -> DataFrame:
    """Sliding-window product velocity with restock alerts: every
    ``slide``, the last ``size`` of SALE events per store, department and
    product; only alerting rows are kept."""
    e = _watermarked(events, watermark).where(F.col("transaction_type") == "SALE")
    g = e.groupBy(F.window("event_time", size, slide).alias("w"),
                  "store_id", "dept_id", "product_id").agg(
        F.count(F.lit(1)).alias("transactions_last_hour"),
        F.sum("quantity").alias("units_sold_last_hour"),
        F.sum("total_amount").alias("revenue_last_hour"),
        F.avg("total_amount").alias("avg_transaction_value"),
        F.max("event_time").alias("last_sale_time"))
    a = with_alert_levels(g, velocity=velocity, alert=alert).where(F.col("alert_level").isin(*keep))
    return a.select(*_window_cols(), *[c for c in a.columns if c != "w"])


SEQUENCE, WINDOW_DATE = "_sequence", "_window_date"


def _latest_windows(rows: DataFrame, keys) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    merged = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(SEQUENCE)).alias("r"))
    return merged.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


def _keyed_window_writer(checkpoint: str, table_path: str, keys):
    """``foreachBatch`` writer for update-mode window aggregates: each row
    carries the window's complete current figures, so the one written last
    counts. Epochs only append; ``read_windows`` resolves them."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        table = SnapshotTable(spark, table_path)
        rows = (batch.withColumn(SEQUENCE, F.lit(table.number() + 1).cast("long"))
                .withColumn(WINDOW_DATE, F.to_date("window_start")))
        append_epoch(table, rows, epoch_key(spark, checkpoint, epoch_id), lambda r: _latest_windows(r, keys), (WINDOW_DATE,))
    return write


def start_window_stream(windowed: DataFrame, keys, checkpoint: str, table_path: str,
                        processing_time: str | None = "10 seconds",
                        available_now: bool = False):
    """Run a window model (``stream_hourly_sales`` / ``stream_inventory_alerts``
    over a stream) in update mode into a keyed table, so windows still open
    are visible and refined as events arrive."""
    writer = _keyed_window_writer(checkpoint, table_path, list(keys))
    return started(windowed.writeStream.foreachBatch(writer), checkpoint, processing_time, available_now, mode="update")


def read_windows(spark: SparkSession, table_path: str, keys) -> DataFrame:
    """The current row of each window of ``start_window_stream``."""
    return _latest_windows(SnapshotTable(spark, table_path).read(), list(keys)).drop(SEQUENCE, WINDOW_DATE)


HOURLY_KEYS = ["window_start", "window_end", "store_id", "dept_id"]
ALERT_KEYS = ["window_start", "window_end", "store_id", "dept_id", "product_id"]
