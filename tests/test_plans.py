"""Physical-plan properties that matter at scale."""

import contextlib
import datetime as dt
import io

from pyspark.sql import functions as F

from conftest import SF001, rows
from shelfline import schemas as S
from shelfline.operators import batch, inventory, realtime, upsert
from shelfline.session import scratch_path
from shelfline.sources import fixtures as fx
from shelfline.streaming import sources as sts
from shelfline.streaming import windows as stw


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_partition_filter_reaches_scan(spark):
    path = scratch_path(spark, "events_by_day")
    ev = fx.stream_sales_events(spark, SF001)
    ev.withColumn("event_date", F.to_date("event_time")).write.partitionBy("event_date").parquet(path)
    stored = spark.read.parquet(path)
    as_of = fx.as_of(stored)
    p = plan(realtime.rt_sales_summary(stored, as_of))
    assert "PartitionFilters: [isnotnull(event_date" in p and "event_date#" in p
    assert "PushedFilters: [IsNotNull(event_time), GreaterThanOrEqual(event_time" in p
    p = plan(realtime.customer_analytics(stored, as_of))
    assert "PartitionFilters: [isnotnull(event_date" in p


def test_store_performance_reduces_before_join(spark):
    p = plan(batch.store_performance(fx.raw_sales(spark, SF001), fx.raw_stores(spark, SF001),
                                     fx.raw_features(spark, SF001)))
    assert "partial_sum" in p and "partial_count" in p
    assert "BroadcastHashJoin" in p  # the store dimension, after its size check
    assert "Window" not in p


def test_upsert_and_latest_state_have_no_window_sort(spark):
    src = fx.raw_sales_file(spark, SF001, "second")
    p = plan(upsert.keyed_upsert(None, src, ["Store", "Dept", "Date"], ["Weekly_Sales", "IsHoliday"]))
    assert "Window" not in p and "partial_max_by" in p
    p = plan(inventory.inventory_status(fx.stream_inventory_events(spark, SF001)))
    assert "Window" not in p and "partial_max_by" in p


def test_only_needed_columns_are_read(spark):
    p = plan(batch.daily_sales(fx.raw_sales(spark, SF001)))
    assert "ReadSchema: struct<l_extendedprice:double,l_shipdate:timestamp_ntz>" in p


def test_window_stream_update_mode_keyed_sink(spark):
    root = scratch_path(spark, "win_sink")
    ev = fx.stream_sales_events(spark, SF001)
    as_of = fx.as_of(ev)
    cut = as_of - dt.timedelta(hours=10)
    ev.where(F.col("event_time") <= F.lit(cut)).write.parquet(f"{root}/in/a")
    src = sts.table_stream(spark, f"{root}/in/*", S.STREAM_SALES_EVENTS)
    kw = dict(keys=stw.HOURLY_KEYS, checkpoint=f"{root}/_ckpt", table_path=f"{root}/out",
              available_now=True)
    stw.start_window_stream(stw.stream_hourly_sales(src, watermark="3 hours"), **kw).awaitTermination()
    # The rest arrives later, including events of an hour already stored.
    ev.where(F.col("event_time") > F.lit(cut)).write.parquet(f"{root}/in/b")
    stw.start_window_stream(stw.stream_hourly_sales(src, watermark="3 hours"), **kw).awaitTermination()
    got = stw.read_windows(spark, f"{root}/out", stw.HOURLY_KEYS)
    want = stw.stream_hourly_sales(ev)
    assert rows(got, want.columns) == rows(want)
