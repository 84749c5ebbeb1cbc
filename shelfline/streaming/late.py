"""Late events beside an hourly stream: kept, counted and folded in.

The stream runs with a watermark. Events of an hour that the watermark has
passed, which a window operator would drop, go to a side table with the batch
that brought them and the watermark they missed; the others are added to
partial sums per hour (``epochs``). The watermark is the query's own: Spark
writes it to the checkpoint's offset log before a batch runs, so a replayed
batch is split at the same time as before.

``fold_late`` later adds the hours of the side table's new batches to the
stored figures and marks them as folded, in one commit. On-time and folded
rows together equal the batch model over all events.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import rules as R
from ..operators.batch import weighted_avg
from ..sources.snapshots import SnapshotTable, held, hold
from .epochs import append_epoch, epoch_key, started

SALE_DATE = "sale_date"
KEYS = [SALE_DATE, "window_start", "store_id", "dept_id"]
SUMS = ["transaction_count", "total_sales", "sale_count", "return_count", "exchange_count", "promotional_transactions"]
MISSED = "missed_watermark"


def query_watermark(spark: SparkSession, checkpoint: str, epoch: int) -> dt.datetime | None:
    """The watermark (UTC) that batch ``epoch`` of a query runs with, None
    before the first one is known."""
    lines = [r[0] for r in spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{epoch}", wholetext=True).collect()]
    at = json.loads(lines[0].splitlines()[1])["batchWatermarkMs"]
    return dt.datetime.fromtimestamp(at / 1000, dt.timezone.utc).replace(tzinfo=None) if at else None


def hour_partials(events: DataFrame) -> DataFrame:
    """Sums per hour, store and department, mergeable with those of others."""
    return events.groupBy(F.to_date("event_time").alias(SALE_DATE), F.date_trunc("hour", "event_time").alias("window_start"),
                          "store_id", "dept_id").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("total_amount").cast("decimal(20,2)").alias("total_sales"),
        *[R.count_where(F.col("transaction_type") == t).alias(f"{t.lower()}_count") for t in S.TRANSACTION_TYPES],
        R.count_where(F.col("promotion_applied")).alias("promotional_transactions"),
        F.max("event_time").alias("latest_transaction_time"))


def merge_hours(partials: DataFrame) -> DataFrame:
    types = {f.name: f.dataType for f in partials.schema.fields}
    g = partials.groupBy(*KEYS).agg(*[F.sum(c).cast(types[c]).alias(c) for c in SUMS],
                                    F.max("latest_transaction_time").alias("latest_transaction_time"))
    return g.select(*partials.columns)


def start_hourly_stream(events: DataFrame, watermark: str, checkpoint: str, table_path: str, late_path: str,
                        processing_time: str | None = "10 seconds", available_now: bool = False):
    """Keep hourly sales from a stream of stored events; late ones go to
    ``late_path``."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        key, mark = epoch_key(spark, checkpoint, epoch_id), query_watermark(spark, checkpoint, epoch_id)
        mark_col = F.lit(mark).cast("timestamp")
        closes = F.date_trunc("hour", "event_time") + F.expr("INTERVAL 1 HOUR")
        late = F.coalesce(closes <= mark_col, F.lit(False))
        rows = batch.persist()
        try:
            SnapshotTable(spark, late_path).put(rows.where(late).withColumn(MISSED, mark_col), key)
            append_epoch(SnapshotTable(spark, table_path), hour_partials(rows.where(~late)), key, merge_hours, (SALE_DATE,))
        finally:
            rows.unpersist()
    stream = events.withWatermark("event_time", watermark)
    return started(stream.writeStream.foreachBatch(write), checkpoint, processing_time, available_now)


def read_late(spark: SparkSession, late_path: str) -> DataFrame:
    """Late events with the watermark they missed."""
    return SnapshotTable(spark, late_path).read()


def fold_late(spark: SparkSession, table_path: str, late_path: str) -> int:
    """Add the late batches that are not folded yet; how many there were.
    The rows and the note of what was folded are one commit: per query the
    last batch, as batches are stored in order."""
    table, late = SnapshotTable(spark, table_path), SnapshotTable(spark, late_path)
    notes = {k: n for k, n in table.meta().items() if "late" in n}
    folded: dict[str, int] = {}
    for n in notes.values():
        folded = hold(folded, (f"{q}-{e}" for q, e in n["late"].items()))
    new = sorted({e["key"] for e in late.entries() if not held(folded, e["key"])})
    if new:
        rows, done = late.read(lambda e: e["key"] in new), hold(folded, new)
        table.put(hour_partials(rows), f"late-{table.number():012d}", (SALE_DATE,), meta={"late": done}, forget=notes)
    return len(new)


def read_hourly(spark: SparkSession, table_path: str) -> DataFrame:
    """The rows of ``windows.stream_hourly_sales`` from the stored sums."""
    g = merge_hours(SnapshotTable(spark, table_path).read())
    return g.select(
        "window_start", (F.col("window_start") + F.expr("INTERVAL 1 HOUR")).alias("window_end"), "store_id", "dept_id",
        "transaction_count", "total_sales",
        weighted_avg(F.col("total_sales"), F.col("transaction_count"), S.MONEY).alias("avg_transaction_value"),
        "sale_count", "return_count", "exchange_count", "promotional_transactions", "latest_transaction_time")
