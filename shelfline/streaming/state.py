"""Current-state tables kept by a stream (latest row per key).

Each micro-batch is reduced to its newest row per key (``max_by`` over the
event order, a partial aggregate) and appended as rows of its epoch; the
reader takes the newest row per key over all epochs (``epochs``). Because
event order decides, a replayed epoch or an out-of-order arrival gives the
same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.inventory import stock_status
from ..sources.snapshots import SnapshotTable
from .epochs import append_epoch, epoch_key, started

INVENTORY_KEYS = ["store_id", "product_id"]
INVENTORY_ORDER = ["event_time", "event_id"]
INVENTORY_STATE_COLS = ["dept_id", "current_stock", "reorder_point", "event_time", "event_id"]


def latest_by_key(df: DataFrame, keys, order_cols, value_cols) -> DataFrame:
    g = df.groupBy(*keys).agg(
        F.max_by(F.struct(*value_cols), F.struct(*order_cols)).alias("_s"))
    return g.select(*keys, *[F.col(f"_s.{c}").alias(c) for c in value_cols])


def keyed_state_writer(checkpoint: str, table_path: str, keys, order_cols, value_cols):
    def write(batch: DataFrame, epoch_id: int) -> None:
        def newest(rows):
            return latest_by_key(rows, keys, order_cols, value_cols)
        key = epoch_key(batch.sparkSession, checkpoint, epoch_id)
        append_epoch(SnapshotTable(batch.sparkSession, table_path), newest(batch), key, newest)
    return write


def start_inventory_status_stream(inventory_events: DataFrame, checkpoint: str, table_path: str,
                                  processing_time: str | None = "10 seconds",
                                  available_now: bool = False):
    """Keep the current stock per (store, product) from a stream of
    inventory events."""
    writer = keyed_state_writer(checkpoint, table_path, INVENTORY_KEYS, INVENTORY_ORDER, INVENTORY_STATE_COLS)
    return started(inventory_events.writeStream.foreachBatch(writer), checkpoint, processing_time, available_now)


def read_inventory_status(spark, table_path: str) -> DataFrame:
    """The stored state with its stock status (derived on read, as a
    generated column would be)."""
    rows = SnapshotTable(spark, table_path).read()
    cur = latest_by_key(rows, INVENTORY_KEYS, INVENTORY_ORDER, INVENTORY_STATE_COLS).select(
        "store_id", "dept_id", "product_id", "current_stock", "reorder_point",
        F.col("event_time").alias("last_updated"))
    return stock_status(cur).select("store_id", "dept_id", "product_id", "current_stock",
                                    "reorder_point", "stock_status", "last_updated")
