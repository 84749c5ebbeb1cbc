"""Incremental law, stream = batch, replay with the same checkpoint."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from shelfline import schemas as S
from shelfline.operators import incremental as inc
from shelfline.operators import realtime as rt
from shelfline.plans.models import materialize_incremental, read_incremental
from shelfline.session import scratch_path
from shelfline.sources import fixtures as fx
from shelfline.streaming import ingest as sti
from shelfline.streaming import sources as sts
from shelfline.streaming import windows as stw

COLS = [c for c in inc.SUMMARY_COLUMNS if c != "last_updated"]


def test_additive_over_any_split_equals_one_run(spark):
    events = fx.stream_sales_events(spark, SF001).cache()
    as_of = fx.as_of(events)
    start = as_of - dt.timedelta(hours=24)
    full = rt.hourly_summary(events.where(F.col("event_time") >= F.lit(start)), as_of)
    for cut_h in (3, 7, 19):
        cut = as_of - dt.timedelta(hours=cut_h)
        lookback = cut - start
        run1 = inc.sales_summary_incremental(
            None, events.where(F.col("event_time") <= F.lit(cut)), cut, lookback=lookback).checkpoint()
        run2 = inc.sales_summary_incremental(run1, events, as_of, "additive")
        assert rows(run2, COLS) == rows(full, COLS)


def test_replace_keeps_only_second_part_of_split_hour(spark):
    t = dt.datetime(2024, 3, 4, 10, 0)
    schema = S.STREAM_SALES_EVENTS

    def e(i, minute, amount):
        ts = t + dt.timedelta(minutes=minute)
        return (str(i), ts, 1, 1, "p", "c", 1, Decimal(amount), Decimal(amount), "SALE", "CARD", False, ts)

    first = spark.createDataFrame([e(1, 10, "1.00")], schema)
    both = spark.createDataFrame([e(1, 10, "1.00"), e(2, 40, "2.00")], schema)
    run1 = inc.sales_summary_incremental(None, first, t + dt.timedelta(minutes=20))
    rep = inc.sales_summary_incremental(run1, both, t + dt.timedelta(minutes=50), "replace").first()
    add = inc.sales_summary_incremental(run1, both, t + dt.timedelta(minutes=50), "additive").first()
    assert (rep["transaction_count"], rep["total_sales"]) == (1, Decimal("2.00"))
    assert (add["transaction_count"], add["total_sales"], add["avg_transaction_value"]) == \
        (2, Decimal("3.00"), Decimal("1.500000"))
    # A late event (older than the high-water mark) is skipped by both modes
    # but counted by recompute (it arrived after the last run).
    late = (str(3), t + dt.timedelta(minutes=5), 1, 1, "p", "c", 1, Decimal("4.00"), Decimal("4.00"),
            "SALE", "CARD", False, t + dt.timedelta(minutes=55))
    with_late = both.union(spark.createDataFrame([late], schema))
    run2 = inc.sales_summary_incremental(run1, both, t + dt.timedelta(minutes=50), "additive").checkpoint()
    skip = inc.sales_summary_incremental(run2, with_late, t + dt.timedelta(minutes=60), "additive").first()
    assert skip["transaction_count"] == 2
    rec = inc.sales_summary_incremental(run2, with_late, t + dt.timedelta(minutes=60), "recompute").first()
    assert (rec["transaction_count"], rec["total_sales"]) == (3, Decimal("7.00"))


def test_materialize_incremental_partitions(spark):
    path = scratch_path(spark, "rt_inc")
    events = fx.stream_sales_events(spark, SF001)
    as_of = fx.as_of(events)
    cut = as_of - dt.timedelta(hours=6)
    materialize_incremental(spark, path, events.where(F.col("event_time") <= F.lit(cut)), cut)
    materialize_incremental(spark, path, events, as_of)
    stored = read_incremental(spark, path).select(*COLS)
    start = cut - dt.timedelta(hours=24)
    full = rt.hourly_summary(events.where(F.col("event_time") >= F.lit(start)), as_of)
    assert rows(stored, COLS) == rows(full.select(*COLS), COLS)


def test_stream_windows_equal_batch(spark):
    root = scratch_path(spark, "win")
    events = fx.stream_sales_events(spark, SF001)
    events.write.parquet(f"{root}/events")
    stream = sts.table_stream(spark, f"{root}/events", S.STREAM_SALES_EVENTS)
    q = (stw.stream_hourly_sales(stream, watermark="0 seconds").writeStream
         .outputMode("update").format("memory").queryName("hourly_win")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("hourly_win")
    want = stw.stream_hourly_sales(events)
    assert rows(got) == rows(want)
    q = (stw.stream_inventory_alerts(stream, watermark="0 seconds").writeStream
         .outputMode("update").format("memory").queryName("alerts_win")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows(spark.table("alerts_win")) == rows(stw.stream_inventory_alerts(events))


def test_ingest_replay_no_loss_no_duplicates(spark):
    root = scratch_path(spark, "ingest")
    wire = fx.wire_events_json(spark, SF001).select(F.col("value").cast("string").alias("value"))
    parts = wire.randomSplit([0.5, 0.5], seed=7)
    parts[0].write.text(f"{root}/inbox/a")
    src = sts.text_file_source(spark, f"{root}/inbox/*")
    kw = dict(checkpoint=f"{root}/_ckpt", table_path=f"{root}/events",
              quarantine_path=f"{root}/bad", available_now=True)
    sti.stream_ingest(src, **kw).awaitTermination()
    n1 = sti.read_event_table(spark, f"{root}/events").count()
    # Restart with the same checkpoint: nothing is read twice.
    sti.stream_ingest(src, **kw).awaitTermination()
    assert sti.read_event_table(spark, f"{root}/events").count() == n1
    # More files arrive, including replays of already stored events.
    parts[1].write.text(f"{root}/inbox/b")
    parts[0].limit(20).write.text(f"{root}/inbox/c")
    sti.stream_ingest(src, **kw).awaitTermination()
    stored = sti.read_event_table(spark, f"{root}/events")
    total = fx.stream_sales_events(spark, SF001).count()
    assert stored.count() == total
    assert stored.select("event_id").distinct().count() == total


def test_ingest_quarantines_bad_rows(spark):
    root = scratch_path(spark, "ingest_bad")
    good = ('{"event_id":"e1","event_time":"2024-01-01T10:00:00","store_id":1,"dept_id":2,'
            '"product_id":"p","customer_id":"c","quantity":2,"unit_price":1.5,"total_amount":3.0,'
            '"transaction_type":"SALE","payment_method":"CARD","promotion_applied":true}')
    bad_enum = good.replace('"e1"', '"e2"').replace('"SALE"', '"REFUND"')
    no_time = good.replace('"e1"', '"e3"').replace('"2024-01-01T10:00:00"', '"bad"')
    spark.createDataFrame([(good,), (bad_enum,), (no_time,), ("not json",)], "value string") \
        .write.text(f"{root}/inbox")
    sti.stream_ingest(sts.text_file_source(spark, f"{root}/inbox"), checkpoint=f"{root}/_ckpt",
                      table_path=f"{root}/events", quarantine_path=f"{root}/bad",
                      available_now=True, dedupe_delay=None).awaitTermination()
    assert [r["event_id"] for r in sti.read_event_table(spark, f"{root}/events").collect()] == ["e1"]
    bad = {r["event_id"]: r["failed_rules"] for r in spark.read.parquet(f"{root}/bad").collect()}
    assert bad.pop(None)[0] == "not_null:event_id"
    assert bad == {"e2": ["enum:transaction_type"], "e3": ["not_null:event_time"]}
    raw = {r["event_id"]: r["raw"] for r in spark.read.parquet(f"{root}/bad").collect()}
    assert raw == {"e2": bad_enum, "e3": no_time, None: "not json"}


def test_stream_metrics_and_late_rows(spark):
    from shelfline.streaming.monitor import stream_metrics
    root = scratch_path(spark, "mon")
    ev = fx.stream_sales_events(spark, SF001)
    ev.write.parquet(f"{root}/in/a")
    src = sts.table_stream(spark, f"{root}/in/*", S.STREAM_SALES_EVENTS)
    q = (stw.stream_hourly_sales(src, watermark="1 hour").writeStream.outputMode("append")
         .format("parquet").option("path", f"{root}/out").trigger(availableNow=True)
         .option("checkpointLocation", f"{root}/_ckpt").start())
    q.awaitTermination()
    # Old events arrive after the watermark moved on: they are dropped and
    # the drop is reported.
    ev.where(F.col("event_time") < F.lit(fx.as_of(ev) - dt.timedelta(hours=5))).limit(30) \
        .write.parquet(f"{root}/in/b")
    q = (stw.stream_hourly_sales(src, watermark="1 hour").writeStream.outputMode("append")
         .format("parquet").option("path", f"{root}/out").trigger(availableNow=True)
         .option("checkpointLocation", f"{root}/_ckpt").start())
    q.awaitTermination()
    m = {r["metric_name"]: r["metric_value"] for r in stream_metrics(spark, q).collect()}
    assert m["num_input_rows"] == 30
    # Counted where the state operator sees them: after the partial
    # aggregate, so late events of one window key count once.
    assert 0 < m["rows_dropped_by_watermark"] <= 30


def test_summary_hook_counts_every_event_once_including_late(spark):
    root = scratch_path(spark, "ingest_summary")
    wire = fx.wire_events_json(spark, SF001).select(F.col("value").cast("string").alias("value"))
    events = fx.stream_sales_events(spark, SF001)
    as_of = fx.as_of(events)
    cut = as_of - dt.timedelta(hours=30)
    # First the older half of the day, then the rest plus events that are
    # older than everything already stored (late arrivals).
    ids_early = events.where(F.col("event_time") <= F.lit(cut)).select("event_id")
    parsed = wire.withColumn("event_id", F.get_json_object("value", "$.event_id"))
    early = parsed.join(ids_early, "event_id", "left_semi").select("value")
    late = parsed.join(ids_early, "event_id", "left_anti").select("value")
    older = early.limit(25)
    early.exceptAll(older).write.text(f"{root}/inbox/a")
    kw = dict(checkpoint=f"{root}/_ckpt", table_path=f"{root}/events", available_now=True,
              after_write=sti.summary_hook(f"{root}/summary"))
    src = sts.text_file_source(spark, f"{root}/inbox/*")
    sti.stream_ingest(src, **kw).awaitTermination()
    late.write.text(f"{root}/inbox/b")
    older.write.text(f"{root}/inbox/c")
    sti.stream_ingest(src, **kw).awaitTermination()
    # A restart with nothing new must not count anything twice.
    sti.stream_ingest(src, **kw).awaitTermination()
    got = sti.read_summary(spark, f"{root}/summary").select(*COLS)
    want = rt.hourly_summary(events, as_of).select(*COLS)
    assert rows(got, COLS) == rows(want, COLS)


def test_summary_hook_replayed_epoch_is_skipped(spark):
    path = scratch_path(spark, "summary_replay")
    hook = sti.summary_hook(path)
    events = fx.stream_sales_events(spark, SF001)
    a = events.where(F.col("store_id") % 2 == 0)
    b = events.where(F.col("store_id") % 2 == 1)
    hook(a, 0)
    hook(b, 1)
    hook(b, 1)  # the same epoch again after a failure
    got = sti.read_summary(spark, path).select(*COLS)
    want = rt.hourly_summary(events, None).select(*COLS)
    assert rows(got, COLS) == rows(want, COLS)


def _ev(i, ts, amount="1.00", arrived=None):
    return (str(i), ts, 1, 1, "p", "c", 1, Decimal(amount), Decimal(amount), "SALE", "CARD",
            False, arrived or ts)


def test_tie_with_stored_max_and_empty_target(spark):
    schema = S.STREAM_SALES_EVENTS
    t = dt.datetime(2024, 3, 4, 10, 30)
    first = spark.createDataFrame([_ev(1, t)], schema)
    run1 = inc.sales_summary_incremental(None, first, t).checkpoint()
    # A second event with exactly the stored maximum time arrives later.
    both = spark.createDataFrame([_ev(1, t), _ev(2, t, "2.00", t + dt.timedelta(minutes=5))], schema)
    later = t + dt.timedelta(minutes=10)
    add = inc.sales_summary_incremental(run1, both, later, "additive").first()
    assert add["transaction_count"] == 1  # strict '>' skips the tie, as the source model does
    rec = inc.sales_summary_incremental(run1, both, later, "recompute").first()
    assert (rec["transaction_count"], rec["total_sales"]) == (2, Decimal("3.00"))
    # An empty stored table has no high-water mark: nothing is added...
    empty = run1.limit(0)
    assert inc.sales_summary_incremental(empty, both, later, "additive").count() == 0
    # ...while recompute rebuilds every key from the events.
    assert inc.sales_summary_incremental(empty, both, later, "recompute").first()["transaction_count"] == 2


def test_inventory_status_stream_equals_batch(spark):
    from shelfline.operators import inventory as inv
    from shelfline.streaming import state
    root = scratch_path(spark, "inv_state")
    inv_events = fx.stream_inventory_events(spark, SF001)
    as_of = fx.as_of(inv_events)
    cut = as_of - dt.timedelta(days=10)
    # Newer events first, older ones later: arrival order must not matter.
    inv_events.where(F.col("event_time") > F.lit(cut)).write.parquet(f"{root}/in/a")
    src = sts.table_stream(spark, f"{root}/in/*", S.STREAM_INVENTORY_EVENTS)
    kw = dict(checkpoint=f"{root}/_ckpt", table_path=f"{root}/state", available_now=True)
    state.start_inventory_status_stream(src, **kw).awaitTermination()
    inv_events.where(F.col("event_time") <= F.lit(cut)).write.parquet(f"{root}/in/b")
    state.start_inventory_status_stream(src, **kw).awaitTermination()
    got = state.read_inventory_status(spark, f"{root}/state")
    want = inv.inventory_status(inv_events)
    assert rows(got, want.columns) == rows(want)


GOOD = ('{"event_id":"%s","event_time":"%s","store_id":1,"dept_id":2,"product_id":"p","customer_id":"c",'
        '"quantity":2,"unit_price":1.5,"total_amount":%s,"transaction_type":"SALE",'
        '"payment_method":"CARD","promotion_applied":true}')


def _drop(spark, root, name, *messages):
    spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1).write.text(f"{root}/{name}")
    sti.stream_ingest(sts.text_file_source(spark, f"{root}/{name}"), checkpoint=f"{root}/_ckpt/{name}",
                      table_path=f"{root}/events", quarantine_path=f"{root}/bad",
                      available_now=True).awaitTermination()
    return {(r["event_id"], str(r["event_time"])) for r in sti.read_event_table(spark, f"{root}/events").collect()}


def test_new_checkpoint_keeps_stored_events_and_ids_are_unique(spark):
    root = scratch_path(spark, "ingest_new_ckpt")
    day1, day2 = "2024-01-01 10:00:00", "2024-01-02 10:00:00"
    assert _drop(spark, root, "a", GOOD % ("a1", day1, "3.0"), GOOD % ("a2", day1, "3.0")) == {("a1", day1), ("a2", day1)}
    # Another checkpoint starts at epoch 0 again; a2 comes back on another day.
    assert _drop(spark, root, "b", GOOD % ("b1", day1, "3.0"), GOOD % ("a2", day2, "3.0")) == {
        ("a1", day1), ("a2", day1), ("b1", day1)}


def test_first_arrival_wins_and_an_oversized_amount_is_quarantined(spark):
    root = scratch_path(spark, "ingest_first")
    got = _drop(spark, root, "a", GOOD % ("e1", "2024-01-01 12:00:00", "3.0"),
                GOOD % ("e1", "2024-01-01 10:00:00", "3.0"), GOOD % ("e2", "2024-01-01 10:00:00", "1e9"))
    assert got == {("e1", "2024-01-01 12:00:00")}
    bad = spark.read.parquet(f"{root}/bad").first()
    assert (bad["event_id"], bad["failed_rules"]) == ("e2", ["not_null:total_amount"])


def test_torn_summary_commit_is_repaired_by_the_replay(spark):
    path = scratch_path(spark, "summary_torn")
    hook = sti.summary_hook(path)
    events = fx.stream_sales_events(spark, SF001)
    a, b = (events.where(F.col("store_id") % 2 == i) for i in (0, 1))
    hook(a, 0)
    # Only some days of the second batch were committed before the crash.
    hook(b.where(F.dayofmonth("event_time") % 2 == 0), 1)
    hook(b, 1)
    got = sti.read_summary(spark, path).select(*COLS)
    assert rows(got, COLS) == rows(rt.hourly_summary(events, None).select(*COLS), COLS)


def test_recompute_counts_a_late_arrival_after_a_future_dated_event(spark):
    path = scratch_path(spark, "future")
    now, future = dt.datetime(2024, 3, 4, 10, 30), dt.datetime(2030, 1, 1)
    first = [_ev(1, now), _ev(2, future, arrived=now)]
    materialize_incremental(spark, path, spark.createDataFrame(first, S.STREAM_SALES_EVENTS), future, "recompute")
    # An event of the old hour arrives a minute later; the report time is
    # years ahead of it.
    late = [*first, _ev(3, now, "2.00", now + dt.timedelta(minutes=1))]
    for _ in range(2):  # the second run finds nothing new
        materialize_incremental(spark, path, spark.createDataFrame(late, S.STREAM_SALES_EVENTS), future, "recompute")
        got = {r["sale_date"].year: r["transaction_count"] for r in read_incremental(spark, path).collect()}
        assert got[2024] == 2


def test_progress_log_holds_every_report(spark):
    import time

    from shelfline.streaming.monitor import ProgressLog
    root = scratch_path(spark, "progress")
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        ev = fx.stream_sales_events(spark, SF001)
        n = ev.count()
        ev.write.parquet(f"{root}/in")
        src = sts.table_stream(spark, f"{root}/in", S.STREAM_SALES_EVENTS)
        (src.writeStream.format("noop").trigger(availableNow=True)
         .option("checkpointLocation", f"{root}/_ckpt").start().awaitTermination())
        seen = 0
        for _ in range(50):  # reports come through Spark's listener bus
            seen += sum(int(r["metric_value"]) for r in log.drain(spark).where("metric_name = 'num_input_rows'").collect())
            if seen >= n:
                break
            time.sleep(0.2)
        assert seen == n and log.drain(spark).count() == 0
    finally:
        spark.streams.removeListener(log)


def test_window_stream_needs_a_watermark(spark):
    src = spark.readStream.format("rate").load().withColumnRenamed("timestamp", "event_time")
    with pytest.raises(ValueError, match="watermark"):
        stw.stream_hourly_sales(src)


def test_micro_batches_on_a_trigger(spark):
    """Files that arrive while the query runs, in batches of a bounded size."""
    root = scratch_path(spark, "trigger")
    messages = [GOOD % (f"e{i}", "2024-01-01 10:00:00", "3.0") for i in range(6)]

    def land(*some):
        spark.createDataFrame([(m,) for m in some], "value string").repartition(len(some)).write.mode("append").text(f"{root}/in")
    land(*messages[:4])
    q = sti.stream_ingest(sts.text_file_source(spark, f"{root}/in", max_files_per_trigger=2), checkpoint=f"{root}/_ckpt",
                          table_path=f"{root}/events", processing_time="1 second")
    try:
        q.processAllAvailable()
        assert sti.read_event_table(spark, f"{root}/events").count() == 4
        land(*messages[3:])  # one of them again
        q.processAllAvailable()
        assert sti.read_event_table(spark, f"{root}/events").count() == 6
        sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
        assert len(sizes) >= 3
    finally:
        q.stop()


def test_nothing_stays_cached_after_a_stream(spark):
    from shelfline.streaming import state
    root = scratch_path(spark, "cached")
    before = spark._jsc.getPersistentRDDs().size()
    inv = fx.stream_inventory_events(spark, SF001)
    inv.write.parquet(f"{root}/in")
    src = sts.table_stream(spark, f"{root}/in", S.STREAM_INVENTORY_EVENTS)
    state.start_inventory_status_stream(src, f"{root}/_a", f"{root}/state", available_now=True).awaitTermination()
    wire = fx.wire_events_json(spark, SF001).select(F.col("value").cast("string").alias("value"))
    wire.limit(50).write.text(f"{root}/wire")
    sti.stream_ingest(sts.text_file_source(spark, f"{root}/wire"), f"{root}/_b", f"{root}/events",
                      available_now=True).awaitTermination()
    assert spark._jsc.getPersistentRDDs().size() <= before
