"""Models kept by streams: late events, panes, customers, wire versions."""

import datetime as dt
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from shelfline import schemas as S
from shelfline.operators import events as ev
from shelfline.operators import realtime as rt
from shelfline.operators import wire
from shelfline.session import scratch_path
from shelfline.sources import files
from shelfline.sources import fixtures as fx
from shelfline.sources.snapshots import SnapshotTable, read_table
from shelfline.streaming import epochs, late, partials
from shelfline.streaming import ingest as sti
from shelfline.streaming import sources as sts
from shelfline.streaming import windows as stw


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


# --- late events --------------------------------------------------------------------------
def test_stream_and_late_side_table_equal_the_batch(spark):
    root, events = scratch_path(spark, "late"), fx.stream_sales_events(spark, SF001)
    as_of = fx.as_of(events)
    src = sts.table_stream(spark, f"{root}/in/*", S.STREAM_SALES_EVENTS)
    cut = as_of - dt.timedelta(days=3)
    parts = [events.where((F.col("event_time") > F.lit(cut)) & (F.col("store_id") % 2 == 0)),
             events.where((F.col("event_time") <= F.lit(cut))), events.where((F.col("event_time") > F.lit(cut)) & (F.col("store_id") % 2 == 1))]
    kw = dict(watermark="2 hours", checkpoint=f"{root}/_ckpt", table_path=f"{root}/hours", late_path=f"{root}/late",
              available_now=True)
    for i, part in enumerate(parts):
        part.write.parquet(f"{root}/in/{i}")
        late.start_hourly_stream(src, **kw).awaitTermination()
        if i == 1:
            assert late.fold_late(spark, f"{root}/hours", f"{root}/late") > 0
    missed = late.read_late(spark, f"{root}/late")
    n_late = missed.count()
    assert n_late > events.where(F.col("event_time") <= F.lit(cut)).count() * 0.9
    # What the watermark drops: hours that had ended by then, no others.
    closes = F.date_trunc("hour", "event_time") + F.expr("INTERVAL 1 HOUR")
    assert missed.where(closes > F.col(late.MISSED)).count() == 0
    on_time = late.read_hourly(spark, f"{root}/hours").agg(F.sum("transaction_count")).first()[0]
    assert on_time < events.count()
    assert late.fold_late(spark, f"{root}/hours", f"{root}/late") > 0
    assert late.fold_late(spark, f"{root}/hours", f"{root}/late") == 0
    want = stw.stream_hourly_sales(events)
    assert rows(late.read_hourly(spark, f"{root}/hours"), want.columns) == rows(want)


def test_the_side_table_holds_what_the_window_operator_drops(spark):
    root, events = scratch_path(spark, "drop"), fx.stream_sales_events(spark, SF001)
    cut = fx.as_of(events) - dt.timedelta(days=3)
    events.where(F.col("event_time") > F.lit(cut)).write.parquet(f"{root}/in/0")
    src = sts.table_stream(spark, f"{root}/in/*", S.STREAM_SALES_EVENTS)

    def both():
        late.start_hourly_stream(src, "2 hours", f"{root}/_a", f"{root}/hours", f"{root}/late",
                                 available_now=True).awaitTermination()
        stw.start_window_stream(stw.stream_hourly_sales(src, watermark="2 hours"), stw.HOURLY_KEYS, f"{root}/_b",
                                f"{root}/windows", available_now=True).awaitTermination()
    both()
    events.where(F.col("event_time") <= F.lit(cut)).write.parquet(f"{root}/in/1")
    both()
    got = late.read_hourly(spark, f"{root}/hours")
    want = stw.read_windows(spark, f"{root}/windows", stw.HOURLY_KEYS)
    assert rows(got, want.columns) == rows(want)


# --- partial rows ---------------------------------------------------------------------------
def _three_epochs(spark, events, hook):
    for i in (2, 0, 1, 1):  # out of order, the last one replayed
        hook(events.where(F.xxhash64("event_id") % 3 == i - 1), f"e{i}")


def test_panes_over_any_split_equal_the_sliding_windows(spark, monkeypatch):
    monkeypatch.setattr(epochs, "FOLD", 2)
    events, path = fx.stream_sales_events(spark, SF001), scratch_path(spark, "panes")
    events = events.withColumn("quantity", F.col("quantity") * 5)  # enough to alert
    _three_epochs(spark, events, partials.pane_hook(path))
    rest = events.where(~(F.xxhash64("event_id") % 3).isin(-1, 0, 1))
    partials.pane_hook(path)(rest, "e9")
    want = stw.stream_inventory_alerts(events)
    assert rows(partials.read_alerts(spark, path), want.columns) == rows(want) and want.count() > 100
    text = plan(partials.alert_panes(events))
    assert "Expand" not in text
    with pytest.raises(ValueError, match="whole number"):
        partials.alerts_from_panes(partials.alert_panes(events), size="7 minutes")


def test_customers_over_any_split_equal_the_batch(spark):
    events, path = fx.stream_sales_events(spark, SF001), scratch_path(spark, "customers")
    as_of = fx.as_of(events)
    day = events.withColumn("event_time", F.date_trunc("day", F.lit(as_of)) + (F.col("event_time") - F.date_trunc("day", "event_time")))
    _three_epochs(spark, day, partials.customer_hook(path))
    partials.customer_hook(path)(day.where(~(F.xxhash64("event_id") % 3).isin(-1, 0, 1)), "e9")
    want = rt.customer_analytics(day, as_of)
    assert rows(partials.read_customers(spark, path, as_of), want.columns) == rows(want)
    assert want.where("departments_visited > 1").count() > 0
    assert partials.read_customers(spark, path, as_of + dt.timedelta(days=400)).count() == 0


def test_state_epochs_are_folded(spark, monkeypatch):
    monkeypatch.setattr(epochs, "FOLD", 2)
    table = SnapshotTable(spark, scratch_path(spark, "fold"))
    for i in range(5):
        df = spark.createDataFrame([(1, i), (i + 2, 0)], "k int, n int")
        epochs.append_epoch(table, df, f"e{i}", lambda r: r.groupBy("k").agg(F.max("n").alias("n")))
    assert len({e["key"] for e in table.entries()}) <= 2
    assert rows(table.read().groupBy("k").agg(F.max("n"))) == [(1, 4), (2, 0), (3, 0), (4, 0), (5, 0), (6, 0)]


# --- parse once, wire versions -----------------------------------------------------------------
def test_a_message_is_parsed_once(spark):
    rows_ = ev.validate_event(ev.event_projection(ev.cast_event_time(ev.parse_event_json(
        fx.wire_events_json(spark, SF001), S.EVENT_V2_WIRE))))
    text = rows_._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json") == 1
    checked = ev.contract_check(sti.ingest_plan(fx.wire_events_json(spark, SF001)), S.SALES_EVENT_CONTRACT)
    text = checked.where(F.size("failed_rules") == 0)._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json") == 1
    mixed = wire.events_v1(wire.parse_wire(fx.wire_events_v1_json(spark, SF001)))
    assert mixed._jdf.queryExecution().executedPlan().toString().count("parseJson(") == 1


def test_wire_versions_are_told_apart(spark):
    values = ['{"event_id": 1, "event_time": "2024-01-01T10:00:00", "product_id": 3, "quantity": 2, "price": 1.5}',
              '{"event_id": "a", "store_id": 1, "price": 3}', "no json", None, "[1]", '{"event_id": 5, "price": "x", "quantity": "many"}', "{}"]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    parsed = wire.parse_wire(df, keep=("value",))
    assert {r.value: r.wire_version for r in parsed.collect()} == dict(zip(values, [1, 2, None, None, None, 1, None]))
    v1 = {r.event_id: (r.quantity, r.price) for r in wire.events_v1(parsed).collect()}
    assert v1[5] == (None, None) and str(v1[1][1]) == "1.50"


def test_variant_columns_equal_the_typed_parse(spark):
    messages = fx.dirty_wire_json(spark, SF001)
    want = ev.parse_event_json(messages, S.EVENT_V2_WIRE)
    got = wire.parse_wire(messages).select(*wire.wire_columns(S.EVENT_V2_WIRE))
    assert rows(got, want.columns) == rows(want)


def test_mixed_bus_keeps_every_message(spark):
    root = scratch_path(spark, "mixed")
    v1, v2 = (f(spark, SF001).select(F.col("value").cast("string").alias("value")) for f in (fx.wire_events_v1_json, fx.dirty_wire_json))
    v1.unionByName(v2).write.text(f"{root}/in")
    sti.stream_mixed_ingest(sts.text_file_source(spark, f"{root}/in"), f"{root}/_ckpt", f"{root}/events", f"{root}/v1",
                            quarantine_path=f"{root}/bad", available_now=True).awaitTermination()
    n_bad = spark.read.parquet(f"{root}/bad").count()
    assert n_bad > 0 and sti.read_event_table(spark, f"{root}/events").count() + n_bad == v2.count()
    want = fx.stream_events_v1(spark, SF001)
    assert rows(read_table(spark, f"{root}/v1").select(*want.columns)) == rows(want)


def test_mixed_batch_holds_typed_rows_only(spark):
    good = fx.wire_events_json(spark, SF001).limit(3)
    v1 = fx.wire_events_v1_json(spark, SF001).limit(2)
    odd = spark.createDataFrame([("no json",), (None,), ("{}",)], "value string")
    texts = [f.select(F.col("value").cast("string").alias("value")) for f in (good, v1, odd)]
    messages = texts[0].unionByName(texts[1]).unionByName(texts[2]).withColumn(sti.RAW_COL, F.col("value"))
    held = sti._mixed_rows(wire.parse_wire(messages, keep=(sti.RAW_COL,)), S.SALES_EVENT_CONTRACT)
    assert wire.MESSAGE not in held.columns
    seen = [(r.failed_rules and bool(r.failed_rules), r[sti.RAW_COL], r[sti.FIRST] is not None, r.event_id is not None) for r in held.collect()]
    assert sorted(seen, key=repr) == sorted([([], None, False, True)] * 3 + [(None, None, True, False)] * 2 + [
        (True, "no json", False, False), (True, None, False, False), (True, "{}", False, False)], key=repr)


def test_a_filter_on_mixed_messages_does_not_make_them_again(spark):
    from shelfline import catalog
    half = catalog._mixed_messages(spark, SF001).where(F.xxhash64("value") % 2 == 0)
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        text = half._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert text.count("StructsToJson") == 2


def test_defaults_fill_absent_columns_in_the_ingest(spark):
    from pyspark.sql.types import StructType
    schema = StructType([f for f in S.EVENT_V2_WIRE.fields if f.name not in ("payment_method", "promotion_applied")])
    out = sti.ingest_plan(fx.wire_events_json(spark, SF001), schema)
    assert out.select("payment_method", "promotion_applied").distinct().collect() == [("CARD", False)]
    # A field that one message lacks stays NULL and is rejected.
    one = spark.createDataFrame([('{"event_id":"e","event_time":"2024-01-01 10:00:00"}',)], "value string")
    assert sti.ingest_plan(one).first()["payment_method"] is None


# --- reading orders, drifting records ------------------------------------------------------------
def test_presentation_orders(spark):
    df = spark.createDataFrame([(i, i % 3, i % 5, f"2024-01-0{i % 2 + 1}", i % 4) for i in range(40)],
                               "id int, a int, b int, d string, h int")
    for model, cols in rt.PRESENTATION.items():
        names = [c for c, _ in cols]
        named = df.select("id", *[F.col(x).alias(c) for x, c in zip(("a", "b", "h"), names)])
        got = [tuple(r)[1:] for r in rt.presented(named, model).collect()]
        assert got == sorted(got, reverse=True) and len(got) == 40
        top = rt.presented(named, model, k=7)
        assert [tuple(r)[1:] for r in top.collect()] == got[:7] and "TakeOrderedAndProject" in plan(top)
    with pytest.raises(ValueError):
        rt.presented(df, "other")


def test_drifting_records(spark):
    path = scratch_path(spark, "drift")
    one = ['{"id": 1, "a": {"x": 1, "OBJECT": "k"}, "n": 1}', '{"id": 2, "n": 2.5, "void": null}', "not json"]
    two = ['{"id": 3, "a": {"y": {"VOID": true}}, "n": 3, "tags": ["t"]}', "{}", "7"]
    for name, lines in (("1", one), ("2", two)):
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{path}/{name}")
    flat = files.json_flatten(files.json_drifting(spark, f"{path}/*"))
    assert sorted(flat.columns) == ["a.OBJECT", "a.x", "a.y.VOID", "id", "n", "tags", "void"]
    got = {r["id"]: r for r in flat.collect()}
    assert flat.count() == 6 and got[1]["a.x"] == 1 and got[1]["a.OBJECT"] == "k" and got[1]["a.y.VOID"] is None
    assert got[2]["n"] == 2.5 and got[3]["n"] == 3.0 and got[3]["a.y.VOID"] is True and got[3]["tags"] == ["t"]
    empty = scratch_path(spark, "nodrift")
    spark.createDataFrame([("x",)], "value string").write.text(empty)
    assert files.json_drifting(spark, empty).columns == []


def test_an_ingest_job_keeps_its_models(spark):
    from shelfline.plans.cli import main
    root, events = scratch_path(spark, "job"), fx.stream_sales_events(spark, SF001)
    as_of = fx.as_of(events)
    fx.to_wire_json(events).select(F.col("value").cast("string").alias("value")).write.text(f"{root}/in")
    main(["ingest", "--inbox", f"{root}/in", "--table", f"{root}/events", "--checkpoint", f"{root}/_c", "--available-now",
          "--summary", f"{root}/summary", "--panes", f"{root}/panes", "--customers", f"{root}/customers",
          "--v1-table", f"{root}/v1"])
    main(["compact", "--table", f"{root}/events"])
    want = rt.customer_analytics(events, as_of)
    assert rows(partials.read_customers(spark, f"{root}/customers", as_of), want.columns) == rows(want)
    assert partials.read_alerts(spark, f"{root}/panes").count() == stw.stream_inventory_alerts(events).count()
    cols = [c for c in rt.hourly_summary(events, None).columns if c != "last_updated"]
    got = sti.read_summary(spark, f"{root}/summary", f"{root}/events")
    assert rows(got, cols) == rows(rt.hourly_summary(events, None), cols)
    assert read_table(spark, f"{root}/v1").count() == 0
