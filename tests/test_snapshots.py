"""Snapshot tables: torn writes, concurrent writers, compaction, bucketed
targets, the log of summary runs."""

import contextlib
import datetime as dt
import io
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from shelfline import schemas as S
from shelfline.operators import incremental as inc
from shelfline.operators import realtime as rt
from shelfline.operators import upsert as up
from shelfline.plans import models
from shelfline.plans.loader import load_dataset
from shelfline.plans.summary_log import SummaryLog, new_events
from shelfline.session import scratch_path
from shelfline.sources import fixtures as fx
from shelfline.sources import snapshots as sn
from shelfline.streaming import ingest as sti
from shelfline.streaming import sources as sts

COLS = [c for c in inc.SUMMARY_COLUMNS if c != "last_updated"]


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def frame(spark, *values):
    return spark.createDataFrame([(v, f"d{v % 2}") for v in values], "v int, d string")


def boom(df):
    """``df`` whose second half fails while it is written."""
    return df.withColumn("v", F.when(F.col("v") % 2 == 0, F.col("v")).otherwise(F.raise_error("lost").cast("int")))


# --- the manifest ----------------------------------------------------------------------
def test_a_write_that_breaks_off_leaves_the_old_version(spark):
    path = scratch_path(spark, "torn")
    models.materialize(frame(spark, 1, 2), "torn", "table", path)
    before = sn.read_table(spark, path)
    with pytest.raises(Exception, match="lost"):
        models.materialize(boom(frame(spark, 3, 4)), "torn", "table", path)
    assert rows(sn.read_table(spark, path)) == rows(frame(spark, 1, 2))
    # Written whole, but the writer dies before it publishes.
    table = sn.SnapshotTable(spark, path)
    table._stage(frame(spark, 9), "k", [], [], False)
    assert rows(sn.read_table(spark, path)) == rows(frame(spark, 1, 2)) == rows(before)
    models.materialize(frame(spark, 5), "torn", "table", path)
    assert [r.v for r in sn.read_table(spark, path).collect()] == [5]
    assert rows(before) == rows(frame(spark, 1, 2))  # a reader keeps its snapshot
    assert table.vacuum(keep=1) == 3 and [r.v for r in table.read().collect()] == [5]


def test_two_writers_cannot_publish_one_number(spark):
    path = scratch_path(spark, "race")
    a, b = sn.SnapshotTable(spark, path), sn.SnapshotTable(spark, path)
    a.put(frame(spark, 1), "a")
    assert not b._publish(1, {"entries": []})
    publish, calls = b._publish, []

    def late(number, manifest):  # another writer comes between read and rename
        if not calls:
            a.put(frame(spark, 2), "a2")
        calls.append(number)
        return publish(number, manifest)
    b._publish = late
    b.put(frame(spark, 3), "b")
    assert calls == [2, 3] and sorted(r.v for r in a.read().collect()) == [1, 2, 3]
    assert [x for x in a._fs().listStatus(a._at(f"{path}/_manifest")) if ".draft" in x.getPath().toString()] == []


def test_keys_are_replaced_and_other_schemas_refused(spark):
    table = sn.SnapshotTable(spark, scratch_path(spark, "keys"))
    table.put(frame(spark, 1, 2), "a", ["d"])
    table.put(frame(spark, 3), "b", ["d"])
    table.put(frame(spark, 4), "a", ["d"])
    table.put(frame(spark, 5).where("false"), "empty", ["d"])
    assert sorted(r.v for r in table.read().collect()) == [3, 4]
    assert [k in table.keys() for k in ("a", "b", "empty", "c")] == [True, True, True, False]
    n = table.number()
    with pytest.raises(up.SchemaChangeError):
        table.put(frame(spark, 1).withColumn("more", F.lit(1)), "c", ["d"])
    with pytest.raises(ValueError, match="partitioned"):
        table.put(frame(spark, 1), "c")
    assert table.number() == n
    table.replace_parts(frame(spark, 8), ["d"])  # only partition d0
    assert sorted(r.v for r in table.read().collect()) == [3, 8]


def test_compaction_under_a_reader(spark):
    table = sn.SnapshotTable(spark, scratch_path(spark, "small"))
    for i in range(6):
        table.put(frame(spark, i), f"k{i}", ["d"])
    reader, files = table.read(), len(table.entries())
    assert sn.compact(spark, table.path) == files
    assert sorted(r.v for r in reader.collect()) == sorted(r.v for r in table.read().collect()) == list(range(6))
    assert len(table.entries()) == 2 and sn.compact(spark, table.path) == 0
    table.put(frame(spark, 99), "k3", ["d"])  # a replay of what was folded
    assert sorted(r.v for r in table.read().collect()) == list(range(6))
    old = table.entries()
    table.put(frame(spark, 7), "k7", ["d"])
    table.replace_parts(frame(spark, 9), ["d"])  # takes away an entry of `old`
    with pytest.raises(sn.ConcurrentChange):
        table.replace(old, frame(spark, 0))


def test_held_keys_take_no_room(spark):
    holds = sn.hold({}, ["qa-0", "qa-2", "qb-7", "name", "compact-1f"])
    assert holds == {"qa": 2, "qb": 7, "name": -1}
    assert [sn.held(holds, k) for k in ("qa-1", "qa-2", "qa-3", "qb-0", "name", "qc-0", "other")] == [
        True, True, False, True, True, False, False]
    table = sn.SnapshotTable(spark, scratch_path(spark, "held"))
    for epoch in range(7):
        table.put(frame(spark, epoch), f"q1-{epoch}", ["d"])
        if epoch % 3 == 2:
            sn.compact(spark, table.path)
    m = table.manifest()
    assert m["holds"] == {"q1": 5} and m["meta"] == {} and len(m["entries"]) == 3
    assert "q1-4" in table.keys() and "q1-6" in table.keys() and "q1-7" not in table.keys()


def test_packing_by_size():
    def e(name, size, files=1):
        return {"key": name, "bytes": size, "files": files}
    got = sn.pack([e("a", 50), e("big", 100), e("b", 60), e("c", 40), e("d", 30), e("e", 1)], 100)
    assert sorted(sorted(x["key"] for x in b) for b in got) == [["a", "d", "e"], ["b", "c"]]
    assert sn.pack([e("a", 99)], 100) == [] and sn.pack([e("a", 99, 5)], 100) == [[e("a", 99, 5)]]


# --- upsert into a bucketed target --------------------------------------------------------
T1, T2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
KEYS, UPDATES = S.RAW_TABLES["raw_sales"]["keys"], S.RAW_TABLES["raw_sales"]["update_cols"]


def test_bucketed_target_is_neither_shuffled_nor_sorted(spark):
    first, second = (fx.raw_sales_file(spark, SF001, p) for p in ("first", "second"))
    table = sn.BucketedTable(spark, scratch_path(spark, "bucketed"))
    table.write(up.keyed_upsert(None, first, KEYS, UPDATES, ingestion_ts=T1).repartition(8, *KEYS), KEYS, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = up.merge_upsert(table.read(), second, KEYS, UPDATES, ingestion_ts=T2)
        tree = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = tree.index("SortMergeJoin")
    left = tree[join:tree.index("FileScan", join)]
    assert "Bucketed: true" in tree[join:tree.index("\n", tree.index("FileScan", join))]
    assert "Exchange" not in left and "Sort " not in left and "Exchange hashpartitioning" in tree
    want = up.keyed_upsert(table.read(), second, KEYS, UPDATES, ingestion_ts=T2)
    assert rows(got, want.columns) == rows(want)


def test_merge_upsert_equals_keyed_upsert(spark):
    schema = "Store int, Type string, Size int, Note string"
    target = up.keyed_upsert(None, spark.createDataFrame([(1, "A", 1, "x"), (2, "B", None, "y"), (3, None, 3, None)], schema),
                             ["Store"], ["Type", "Size"], ingestion_ts=T1)
    files = [spark.createDataFrame([(1, "A", 1, "z"), (2, "B", 5, "n"), (4, "C", 7, "first"), (4, "D", 8, "second")], schema),
             spark.createDataFrame([(1, "Q"), (9, None)], "Store int, Type string"), target.drop("ingestion_ts").limit(0)]
    for source in files:
        kw = dict(order_cols=["Type"], ingestion_ts=T2, with_flags=True)
        want = up.keyed_upsert(target, source, ["Store"], ["Type", "Size"], **kw)
        got = up.merge_upsert(target, source, ["Store"], ["Type", "Size"], **kw)
        assert rows(got, want.columns) == rows(want)


def test_load_layouts_give_one_table_and_one_report(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 8)
    schema = "Store int, Dept int, Date date, Weekly_Sales decimal(18,2), IsHoliday boolean"
    a = spark.createDataFrame([(1, 1, d1, Decimal("1.00"), False), (1, 1, d2, Decimal("2.00"), False)], schema)
    b = spark.createDataFrame([(1, 1, d2, Decimal("5.00"), True), (2, 1, d2, Decimal("3.00"), False),
                               (2, 1, d2, Decimal("4.00"), False)], schema)
    seen = []
    for layout in ({}, {"partition_by": "Date"}, {"buckets": 4}):
        path = scratch_path(spark, "layout")
        reports = [load_dataset(spark, f, path, "raw_sales", "upsert", t, file_name="f", **layout)
                   for f, t in ((a, T1), (b, T2), (b, T2))]
        table = sn.BucketedTable(spark, path) if "buckets" in layout else sn.SnapshotTable(spark, path)
        seen.append((reports, rows(sn.read_table(spark, path), sorted(table.read().columns)), rows(table.read()) != []))
    assert seen[0] == seen[1] == seen[2]
    assert [r["new_records"] for r in seen[0][0]] == [2, 1, 0] and seen[0][0][1]["updated_records"] == 1
    with pytest.raises(up.SchemaChangeError, match="Weekly_Sales"):
        load_dataset(spark, b.withColumn("Weekly_Sales", F.lit("much")), path, "raw_sales", buckets=4)


def test_a_bucketed_table_is_named_again_in_another_session(spark):
    table = sn.BucketedTable(spark, scratch_path(spark, "renamed"))
    table.write(frame(spark, 1, 2, 3), ["v"], 4)
    key = next(iter(table.meta()))
    spark.sql(f"DROP TABLE {table._name(key)}")
    again = sn.BucketedTable(spark, table.path).read()
    assert rows(again) == rows(frame(spark, 1, 2, 3)) and "Bucketed: true" in plan(again.groupBy("v").count())


# --- the log of summary runs ---------------------------------------------------------------
def _ev(i, ts, amount="1.00", arrived=None):
    return (str(i), ts, 1, 1, "p", "c", 1, Decimal(amount), Decimal(amount), "SALE", "CARD", False, arrived or ts)


def test_a_run_that_breaks_off_hides_no_events(spark, monkeypatch):
    events = fx.stream_sales_events(spark, SF001)
    as_of = fx.as_of(events)
    cut = as_of - dt.timedelta(hours=30)
    log = SummaryLog(spark, scratch_path(spark, "log"))
    log.run(events.where(F.col("event_time") <= F.lit(cut)), cut)
    stage = sn.SnapshotTable._stage

    def torn(self, df, *rest):
        stage(self, df.where(F.col("sale_date") == F.lit(as_of.date())), *rest)  # the newest date only
        raise RuntimeError("lost")
    monkeypatch.setattr(sn.SnapshotTable, "_stage", torn)
    with pytest.raises(RuntimeError):
        log.run(events, as_of)
    monkeypatch.undo()
    log.run(events, as_of)
    want = rt.hourly_summary(events.where(F.col("event_time") >= F.lit(cut - dt.timedelta(hours=24))), as_of)
    assert rows(log.read(), COLS) == rows(want, COLS)
    log.run(events, as_of)  # nothing new
    assert rows(log.read(), COLS) == rows(want, COLS)


def test_marks_are_kept_by_date(spark):
    day1, day2 = dt.datetime(2024, 3, 4, 10), dt.datetime(2024, 3, 5, 10)
    log = SummaryLog(spark, scratch_path(spark, "marks"))
    first = [_ev(1, day1), _ev(2, day2)]
    log.run(spark.createDataFrame(first, S.STREAM_SALES_EVENTS), day2 + dt.timedelta(hours=1), lookback="48 hours")
    # A later event of the older date is new though a newer date is known; one
    # at its mark is not.
    more = [*first, _ev(3, day1 + dt.timedelta(minutes=5), "2.00"), _ev(4, day1, "9.00")]
    log.run(spark.createDataFrame(more, S.STREAM_SALES_EVENTS), day2 + dt.timedelta(hours=2))
    assert {r.sale_date.day: (r.transaction_count, r.total_sales) for r in log.read().collect()} == {
        4: (2, Decimal("3.00")), 5: (1, Decimal("1.00"))}
    assert log.marks() == {day1.date(): day1 + dt.timedelta(minutes=5), day2.date(): day2}


def test_new_events_by_intervals_and_by_join(spark, monkeypatch):
    from shelfline.plans import summary_log
    events = fx.stream_sales_events(spark, SF001)
    as_of = fx.as_of(events)
    floor = as_of - dt.timedelta(days=9)
    days = [(floor + dt.timedelta(days=i)).date() for i in (0, 1, 4, 5, 8)]
    marks = {d: dt.datetime.combine(d, dt.time(13)) for d in days}
    want = sorted(r.event_id for r in events.collect() if (
        r.event_time > marks[r.event_time.date()] if r.event_time.date() in marks else r.event_time >= floor))
    got = new_events(events, marks, floor)
    assert sorted(r.event_id for r in got.collect()) == want
    monkeypatch.setattr(summary_log, "MAX_INTERVALS", 2)
    assert sorted(r.event_id for r in new_events(events, marks, floor).collect()) == want
    stored = scratch_path(spark, "stored")
    events.write.parquet(stored)
    assert "GreaterThan(event_time" in plan(got.sparkSession.read.parquet(stored).where(F.col("event_time") > F.lit(floor)))


@pytest.mark.parametrize("merge", ["additive", "replace", "recompute"])
def test_log_equals_the_merge_operator(spark, merge):
    events = fx.stream_sales_events(spark, SF001)
    as_of = fx.as_of(events)
    cuts = [as_of - dt.timedelta(hours=h) for h in (20, 9, 0)]
    log, target = SummaryLog(spark, scratch_path(spark, "modes")), None
    for last, cut in zip([None, *cuts], cuts):
        seen = events.where(F.col("event_time") <= F.lit(cut))
        log.run(seen, cut, merge)
        target = inc.sales_summary_incremental(target, seen, cut, merge, arrived_since=last).checkpoint()
    assert rows(log.read(), inc.SUMMARY_COLUMNS) == rows(target, inc.SUMMARY_COLUMNS)


def test_many_runs_are_folded(spark, monkeypatch):
    from shelfline.plans import summary_log
    monkeypatch.setattr(summary_log, "FOLD", 2)
    t = dt.datetime(2024, 3, 4, 10)
    log, events = SummaryLog(spark, scratch_path(spark, "fold")), []
    for i in range(5):
        events.append(_ev(i, t + dt.timedelta(minutes=i)))
        log.run(spark.createDataFrame(events, S.STREAM_SALES_EVENTS), t + dt.timedelta(minutes=i),
                "replace" if i == 3 else "additive")
    assert len({e["key"] for e in log.table.entries()}) <= 2
    assert log.read().first()["transaction_count"] == 2  # run 4 replaced, run 5 added


# --- the event table ----------------------------------------------------------------------
GOOD = ('{"event_id":"%s","event_time":"%s","store_id":1,"dept_id":2,"product_id":"p","customer_id":"c",'
        '"quantity":2,"unit_price":1.5,"total_amount":3.0,"transaction_type":"SALE",'
        '"payment_method":"CARD","promotion_applied":true}')


def _ingest(spark, root, name, *messages, **kw):
    spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1).write.text(f"{root}/{name}")
    sti.stream_ingest(sts.text_file_source(spark, f"{root}/{name}"), checkpoint=f"{root}/_ckpt/{name}",
                      table_path=f"{root}/events", available_now=True, **kw).awaitTermination()
    return sorted(r["event_id"] for r in sti.read_event_table(spark, f"{root}/events").collect())


def test_id_lookup_reads_the_buckets_of_the_batch_only(spark):
    root = scratch_path(spark, "index")
    _ingest(spark, root, "a", *[GOOD % (f"a{i}", "2024-01-01 10:00:00") for i in range(400)])
    index = sti.id_index(spark, f"{root}/events")
    assert len({e["part"] for e in index.table.entries()}) == index.buckets
    batch = spark.createDataFrame([("a7",), ("new",)], "event_id string")
    committed = sn.SnapshotTable(spark, f"{root}/events").keys()
    stored = index.stored(batch, committed)
    text = plan(stored)
    assert "PartitionFilters: [id_bucket" in text and "ReadSchema: struct<event_id:string>" in text
    assert len(stored.inputFiles()) <= 2
    assert [r.event_id for r in index.drop_stored(batch, committed).collect()] == ["new"]


def test_a_failed_hook_stores_nothing_and_the_replay_everything(spark):
    root, calls = scratch_path(spark, "hook"), []

    def hook(rows, key):
        calls.append(key)
        if len(calls) == 1:
            raise RuntimeError("lost")
    spark.createDataFrame([(GOOD % ("e1", "2024-01-01 10:00:00"),)], "value string").write.text(f"{root}/in")
    kw = dict(checkpoint=f"{root}/_ckpt", table_path=f"{root}/events", available_now=True, after_write=hook)
    with pytest.raises(Exception, match="lost"):
        sti.stream_ingest(sts.text_file_source(spark, f"{root}/in"), **kw).awaitTermination()
    assert not sn.SnapshotTable(spark, f"{root}/events").exists()
    sti.stream_ingest(sts.text_file_source(spark, f"{root}/in"), **kw).awaitTermination()
    assert [r.event_id for r in sti.read_event_table(spark, f"{root}/events").collect()] == ["e1"]
    assert len(set(calls)) == 1  # the same epoch again


def test_an_abandoned_batch_blocks_no_ids(spark):
    root = scratch_path(spark, "abandoned")
    one, two = (GOOD % (i, "2024-01-01 10:00:00") for i in ("e1", "e2"))
    assert _ingest(spark, root, "a", one) == ["e1"]
    # Indexed, but its checkpoint was given up before the commit.
    sti.id_index(spark, f"{root}/events").add(spark.createDataFrame([("e2",)], "event_id string"), "qdead-0")
    assert _ingest(spark, root, "b", one, two) == ["e1", "e2"]


def test_compacted_event_table_still_knows_its_ids(spark):
    root = scratch_path(spark, "compacted")
    for i, name in enumerate("abc"):
        _ingest(spark, root, name, GOOD % (f"e{i}", f"2024-01-0{i % 2 + 1} 10:00:00"), GOOD % (f"f{i}", "2024-01-01 11:00:00"))
    table = sn.SnapshotTable(spark, f"{root}/events")
    before, reader = len(table.entries()), table.read()
    assert sti.compact_events(spark, f"{root}/events") > 0 and len(table.entries()) < before
    assert rows(reader) == rows(table.read())
    assert _ingest(spark, root, "d", GOOD % ("e0", "2024-01-09 10:00:00"), GOOD % ("n", "2024-01-01 10:00:00")) == [
        "e0", "e1", "e2", "f0", "f1", "f2", "n"]
