"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each callable reads the test tables through the fixture mappings and runs
one operator (or a short chain ending in it) over the whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import schemas as S
from .operators import batch, staging
from .operators import events as ev
from .operators import incremental as inc
from .operators import inventory as inv
from .operators import realtime as rt
from .operators import upsert as up
from .plans.loader import load_dataset
from .plans.models import materialize, materialize_incremental, read_incremental
from .session import checkpoint_root, scratch_path
from .sources import files
from .sources import fixtures as fx
from .sources.snapshots import read_table
from .streaming import ingest as sti
from .streaming import late as stl
from .streaming import partials as stp
from .streaming import sources as sts
from .streaming import state as stst
from .streaming import windows as stw

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def _sales(spark, d):
    return fx.raw_sales(spark, d)


def _stores(spark, d):
    return fx.raw_stores(spark, d)


def _features(spark, d):
    return fx.raw_features(spark, d)


# --- staging ---------------------------------------------------------------
@register("stg_sales")
def q_stg_sales(spark, d):
    return staging.stg_sales(_sales(spark, d))


@register("stg_stores")
def q_stg_stores(spark, d):
    return staging.stg_stores(_stores(spark, d))


@register("stg_features")
def q_stg_features(spark, d):
    return staging.stg_features(_features(spark, d))


# --- joins and marts ----------------------------------------------------------
@register("sales_stores_join")
def q_sales_stores_join(spark, d):
    return batch.sales_stores_join(_sales(spark, d), _stores(spark, d))


@register("sales_features_join")
def q_sales_features_join(spark, d):
    return batch.sales_features_join(_sales(spark, d), _features(spark, d))


@register("sales_enriched")
def q_sales_enriched(spark, d):
    return batch.sales_enriched(_sales(spark, d), _stores(spark, d), _features(spark, d))


@register("store_performance")
def q_store_performance(spark, d):
    return batch.store_performance(_sales(spark, d), _stores(spark, d), _features(spark, d))


@register("daily_sales")
def q_daily_sales(spark, d):
    return batch.daily_sales(_sales(spark, d))


@register("sales_summary")
def q_sales_summary(spark, d):
    """The mart as a stored table, built twice (the second snapshot replaces
    the first) and read back."""
    path = scratch_path(spark, "marts")
    materialize(batch.sales_summary(_sales(spark, d)).where("total_transactions > 1"), "fct_sales_summary", "table", path)
    return materialize(batch.sales_summary(_sales(spark, d)), "fct_sales_summary", "table", path)


@register("dedupe_rows")
def q_dedupe_rows(spark, d):
    both = fx.raw_sales_file(spark, d, "first").unionByName(fx.raw_sales_file(spark, d, "second"))
    return batch.dedupe_rows(both)


# --- events --------------------------------------------------------------------


def _events(spark, d):
    return fx.stream_sales_events(spark, d)


def _as_of(spark, d):
    return fx.as_of(_events(spark, d))


@register("parse_event_json")
def q_parse_event_json(spark, d):
    wire = fx.dirty_wire_json(spark, d)
    return ev.cast_event_time(ev.parse_event_json(wire, S.EVENT_V2_WIRE))


@register("parse_event_json_v1")
def q_parse_event_json_v1(spark, d):
    """The first-generation job: parse and type the time, no filters."""
    wire = fx.wire_events_v1_json(spark, d)
    return ev.cast_event_time(ev.parse_event_json(wire, S.EVENT_V1_WIRE))


@register("validate_event")
def q_validate_event(spark, d):
    return ev.validate_event(fx.dirty_sales_events(spark, d))


@register("contract_check")
def q_contract_check(spark, d):
    checked = ev.contract_check(fx.dirty_sales_events(spark, d), S.SALES_EVENT_CONTRACT)
    return checked.select(
        "event_id",
        F.array_join("failed_rules", ",").alias("failed_rules"),
        (F.size("failed_rules") == 0).alias("is_valid"))


@register("event_id_dedupe")
def q_event_id_dedupe(spark, d):
    events = _events(spark, d)
    as_of = fx.as_of(events)
    replayed = events.where(F.col("event_time") >= F.lit(as_of - dt.timedelta(days=1)))
    return ev.event_id_dedupe(events.unionByName(replayed))


@register("event_store_enrich")
def q_event_store_enrich(spark, d):
    return ev.event_store_enrich(_events(spark, d), _stores(spark, d))


@register("streaming_sales_hourly")
def q_streaming_sales_hourly(spark, d):
    return rt.streaming_sales_hourly(fx.stream_events_v1(spark, d))


@register("rt_sales_summary")
def q_rt_sales_summary(spark, d):
    return rt.rt_sales_summary(_events(spark, d), _as_of(spark, d))


@register("hourly_sales_rollup")
def q_hourly_sales_rollup(spark, d):
    return rt.hourly_sales_rollup(_events(spark, d))


@register("product_velocity")
def q_product_velocity(spark, d):
    return rt.product_velocity(_events(spark, d), _as_of(spark, d), "1 hour")


@register("inventory_alerts")
def q_inventory_alerts(spark, d):
    # The default one-hour look-back yields no alert on the test data; a
    # seven-day look-back exercises both alert levels.
    return rt.inventory_alerts(_events(spark, d), _as_of(spark, d), lookback="7 days")


@register("customer_metrics")
def q_customer_metrics(spark, d):
    return rt.customer_metrics(_events(spark, d), _as_of(spark, d))


@register("customer_analytics")
def q_customer_analytics(spark, d):
    return rt.customer_analytics(_events(spark, d), _as_of(spark, d))


@register("stream_health")
def q_stream_health(spark, d):
    return rt.stream_health(_events(spark, d), _as_of(spark, d))


@register("stream_health_stale")
def q_stream_health_stale(spark, d):
    """The report an hour after the newest event."""
    return rt.stream_health(_events(spark, d), _as_of(spark, d) + dt.timedelta(hours=1))


@register("hourly_performance")
def q_hourly_performance(spark, d):
    return rt.hourly_performance(_events(spark, d), _as_of(spark, d))


@register("top_stores")
def q_top_stores(spark, d):
    return rt.top_stores(_events(spark, d), _as_of(spark, d))


@register("streaming_metrics")
def q_streaming_metrics(spark, d):
    return rt.streaming_metrics(_events(spark, d))


@register("stock_status")
def q_stock_status(spark, d):
    return inv.stock_status(fx.stream_inventory_events(spark, d)).select(
        "event_id", "current_stock", "reorder_point", "stock_status")


@register("inventory_status")
def q_inventory_status(spark, d):
    return inv.inventory_status(fx.stream_inventory_events(spark, d))


@register("business_hours_flag")
def q_business_hours_flag(spark, d):
    return rt.business_hours_flag(_events(spark, d)).select(
        "event_id", "event_time", "is_business_hours")


@register("daypart")
def q_daypart(spark, d):
    enriched = ev.event_store_enrich(_events(spark, d), _stores(spark, d))
    return rt.daypart_sales(enriched)


# --- loading -------------------------------------------------------------------

# Fixed load times of the two sales extracts (deterministic ingestion_ts).
LOAD_1 = dt.datetime(2025, 1, 1)
LOAD_2 = dt.datetime(2025, 1, 8)
SALES_KEYS = S.RAW_TABLES["raw_sales"]["keys"]
SALES_UPDATES = S.RAW_TABLES["raw_sales"]["update_cols"]


def _first_load(spark, d):
    first = up.keyed_upsert(None, fx.raw_sales_file(spark, d, "first"), SALES_KEYS,
                            SALES_UPDATES, ingestion_ts=LOAD_1)
    # The stored table after the first load: materialised in the shared
    # checkpoint folder, which also cuts the lineage.
    checkpoint_root(spark)
    return first.checkpoint()


@register("key_unique_check")
def q_key_unique_check(spark, d):
    return up.key_unique_check(_sales(spark, d), SALES_KEYS)


@register("keyed_upsert")
def q_keyed_upsert(spark, d):
    return up.keyed_upsert(_first_load(spark, d), fx.raw_sales_file(spark, d, "second"),
                           SALES_KEYS, SALES_UPDATES, ingestion_ts=LOAD_2)


@register("load_report")
def q_load_report(spark, d):
    return up.load_report(_first_load(spark, d), fx.raw_sales_file(spark, d, "second"),
                          SALES_KEYS, SALES_UPDATES, file_name="sales.csv")


def _loaded_sales(spark, d, **layout):
    path = scratch_path(spark, "raw_sales")
    for part, mode, at in (("first", "create", LOAD_1), ("second", "upsert", LOAD_2)):
        load_dataset(spark, fx.raw_sales_file(spark, d, part), path, "raw_sales", mode, at,
                     file_name=f"sales_{part}.csv", **layout)
    return read_table(spark, path).select("Store", "Dept", "Date", "Weekly_Sales", "IsHoliday", S.INGESTION_TS)


@register("load_sales_table")
def q_load_sales_table(spark, d):
    """The stored-table path of the same two loads: create from the first
    extract, then upsert the second into the table, which lies in sorted
    buckets of its keys; the table is read back."""
    return _loaded_sales(spark, d, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))


@register("load_sales_by_week")
def q_load_sales_by_week(spark, d):
    """The same into a table partitioned by week: only the weeks that the
    second extract touches are read and rewritten."""
    return _loaded_sales(spark, d, partition_by="Date")


@register("csv_upsert_partial_columns")
def q_csv_upsert_partial_columns(spark, d):
    """Two store files: the second has its columns in another order, lacks
    one, and holds each key twice; its later row wins though it is smaller.
    The files are written in the order of a sequence number."""
    root = scratch_path(spark, "stores-csv")
    stores = _stores(spark, d).drop(S.INGESTION_TS)
    stores.write.option("header", True).csv(f"{root}/1")
    later = (stores.where(F.col("Store") % 2 == 0)
             .select("Store", "Size", F.explode(F.array(F.lit(2), F.lit(1))).alias("add"))
             .select((F.col("Size") + F.col("add")).alias("Size"), "Store",
                     (F.col("Store") * 2 - F.col("add")).alias("seq")))
    (later.repartitionByRange(4, "seq").sortWithinPartitions("seq").select("Size", "Store")
     .write.option("header", True).csv(f"{root}/2"))
    for part, mode, at in (("1", "create", LOAD_1), ("2", "upsert", LOAD_2)):
        src = files.csv_source(spark, f"{root}/{part}", S.RAW_STORES, load_order=True)
        load_dataset(spark, src, f"{root}/table", "raw_stores", mode, at, file_name="stores.csv")
    return read_table(spark, f"{root}/table").select("Store", "Type", "Size", S.INGESTION_TS)


@register("csv_source")
def q_csv_source(spark, d):
    path = scratch_path(spark, "features-csv")
    feats = fx.raw_features(spark, d, with_ts=False)
    feats.write.option("header", True).option("nullValue", "NA").csv(path)
    return files.csv_source(spark, path, S.RAW_FEATURES)


@register("csv_routing")
def q_csv_routing(spark, d):
    """A landing folder with files of two configured tables and one that is
    none: rows and distinct stores of each routed table."""
    root = scratch_path(spark, "landing")
    frames = {"stores": _stores(spark, d), "Features": _features(spark, d), "notes": _stores(spark, d)}
    for name, df in frames.items():
        files.land_csv(df.drop(S.INGESTION_TS), f"{root}/{name}.csv")
    routed = [df.groupBy(F.lit(table).alias("table_name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("Store").alias("n_stores"))
        for table, df in sorted(files.csv_routing(spark, root).items())]
    out = routed[0]
    for more in routed[1:]:
        out = out.unionByName(more)
    return out


@register("json_flatten")
def q_json_flatten(spark, d):
    path = scratch_path(spark, "products-json")
    part = fx.table(spark, d, "part")
    part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("price"),
        F.struct(F.col("p_brand").alias("brand"), F.col("p_type").alias("category"),
                 F.struct(F.col("p_size").alias("size")).alias("dimensions")).alias("details"),
    ).write.json(path)
    return files.json_flatten(files.json_records(spark, path))


@register("json_flatten_drift")
def q_json_flatten_drift(spark, d):
    """Product records of two API versions with other fields and nesting."""
    path, part = scratch_path(spark, "products-drift"), fx.table(spark, d, "part")
    key = F.col("p_partkey")
    old = F.struct(key.alias("id"), F.col("p_name").alias("title"), F.struct(
        F.col("p_brand").alias("brand"), F.struct(F.col("p_size").alias("size")).alias("dimensions")).alias("details"))
    new = F.struct(key.alias("id"), F.col("p_retailprice").alias("price"), F.struct(
        F.col("p_type").alias("category"), F.struct(F.lit("cm").alias("unit")).alias("dimensions")).alias("details"))
    part.where(key % 2 == 0).select(F.to_json(old).alias("value")).write.text(f"{path}/1")
    part.where(key % 2 == 1).select(F.to_json(new).alias("value")).write.text(f"{path}/2")
    return files.json_flatten(files.json_drifting(spark, f"{path}/*"))


def _incremental_runs(spark, d, merge):
    events = _events(spark, d)
    as_of = fx.as_of(events)
    split = as_of - dt.timedelta(hours=12)
    checkpoint_root(spark)
    run1 = inc.sales_summary_incremental(
        None, events.where(F.col("event_time") <= F.lit(split)), split).checkpoint()
    # Events arrive at their event time, so the first run's arrival mark is
    # the split (used by recompute only).
    return inc.sales_summary_incremental(run1, events, as_of, merge=merge, arrived_since=split)


@register("sales_summary_incremental")
def q_sales_summary_incremental(spark, d):
    return _incremental_runs(spark, d, "additive")


@register("sales_summary_incremental_replace")
def q_sales_summary_incremental_replace(spark, d):
    return _incremental_runs(spark, d, "replace")


@register("sales_summary_incremental_recompute")
def q_sales_summary_incremental_recompute(spark, d):
    return _incremental_runs(spark, d, "recompute")


@register("stored_sales_summary")
def q_stored_sales_summary(spark, d):
    """The stored form of the additive runs: a log of two runs, resolved on
    read."""
    events, path = _events(spark, d), scratch_path(spark, "summary-log")
    as_of = fx.as_of(events)
    split = as_of - dt.timedelta(hours=12)
    materialize_incremental(spark, path, events.where(F.col("event_time") <= F.lit(split)), split)
    materialize_incremental(spark, path, events, as_of)
    return read_incremental(spark, path)


@register("inventory_alerts_ordered")
def q_inventory_alerts_ordered(spark, d):
    """The ten alerts presented first."""
    return rt.presented(q_inventory_alerts(spark, d), "rt_inventory_alerts", k=10).select(
        "units_sold_last_hour", "revenue_last_hour")


@register("customer_analytics_ordered")
def q_customer_analytics_ordered(spark, d):
    """The ten customers presented first."""
    return rt.presented(q_customer_analytics(spark, d), "rt_customer_analytics", k=10).select(
        "total_spent_today", "transactions_today")


@register("contract_defaults")
def q_contract_defaults(spark, d):
    """The ingest chain over messages of a producer that sends no type,
    payment method or promotion flag: absent columns take their defaults."""
    absent = ("transaction_type", "payment_method", "promotion_applied")
    schema = StructType([f for f in S.EVENT_V2_WIRE.fields if f.name not in absent])
    rows = sti.ingest_plan(fx.dirty_wire_json(spark, d), schema)
    ok, _ = ev.split_by_contract(rows, S.SALES_EVENT_CONTRACT)
    return ok.select(*[c for c in S.SALES_EVENT_COLUMNS if c != "processed_at"])


# --- streaming -----------------------------------------------------------------


def _ingested(spark, d) -> str:
    """Wire messages, some of them spoiled, landed as text files in two
    drops. The second drop comes with a new checkpoint on the same table and
    replays stored ids with another time; none of it may change what the
    first one stored."""
    root = scratch_path(spark, "ingest")
    wire = fx.dirty_wire_json(spark, d)
    key = F.col("key").cast("bigint")
    later = fx.to_wire_json(_events(spark, d).withColumn(
        "event_time", F.col("event_time") + F.expr("INTERVAL 1 DAY")))
    clean = key % fx.BAD_EVERY > 5
    text = F.col("value").cast("string").alias("value")
    wire.where(key % 2 == 0).select(text).write.text(f"{root}/inbox/1")
    (wire.where(key % 2 == 1).unionByName(later.where((key % 10 == 4) & clean)).select(text)
     .write.text(f"{root}/inbox/2"))
    for drop in (1, 2):
        sti.stream_ingest(sts.text_file_source(spark, f"{root}/inbox/{drop}"),
                          checkpoint=f"{root}/_checkpoint/{drop}", table_path=f"{root}/events",
                          quarantine_path=f"{root}/quarantine", available_now=True).awaitTermination()
    return root


@register("stream_ingest")
def q_stream_ingest(spark, d):
    """The event table after both drops (without the arrival stamp, which is
    the wall-clock time)."""
    stored = sti.read_event_table(spark, f"{_ingested(spark, d)}/events")
    return stored.select(*[c for c in S.SALES_EVENT_COLUMNS if c != "processed_at"])


@register("stream_quarantine")
def q_stream_quarantine(spark, d):
    """The rejected messages of both drops."""
    bad = spark.read.parquet(f"{_ingested(spark, d)}/quarantine")
    return bad.select("event_id", F.array_join("failed_rules", ",").alias("failed_rules"),
                      (F.length("raw") > 0).alias("has_raw"))


@register("stream_hourly_sales")
def q_stream_hourly_sales(spark, d):
    return stw.stream_hourly_sales(_events(spark, d))


@register("stream_inventory_alerts")
def q_stream_inventory_alerts(spark, d):
    return stw.stream_inventory_alerts(_events(spark, d))


def _two_drops(spark, events, root: str, cut: dt.timedelta):
    """Stored events in two drops; the second one holds the older part."""
    split = fx.as_of(events) - cut
    newer = F.col("event_time") > F.lit(split)
    return [lambda: events.where(newer).write.parquet(f"{root}/inbox/1"),
            lambda: events.where(~newer).write.parquet(f"{root}/inbox/2")]


@register("stream_late_events")
def q_stream_late_events(spark, d):
    """Hourly sales of a stream with a watermark: the second drop is mostly
    late, goes to the side table and is folded in."""
    root, events = scratch_path(spark, "late"), _events(spark, d)
    src = sts.table_stream(spark, f"{root}/inbox/*", S.STREAM_SALES_EVENTS)
    for drop in _two_drops(spark, events, root, dt.timedelta(days=7)):
        drop()
        stl.start_hourly_stream(src, "2 hours", f"{root}/_checkpoint", f"{root}/hours", f"{root}/late",
                                available_now=True).awaitTermination()
    stl.fold_late(spark, f"{root}/hours", f"{root}/late")
    return stl.read_hourly(spark, f"{root}/hours")


def _kept_partials(spark, d, name: str, partials, merge, cut: dt.timedelta, partition_by=()) -> str:
    root, events = scratch_path(spark, name), _events(spark, d)
    src = sts.table_stream(spark, f"{root}/inbox/*", S.STREAM_SALES_EVENTS)
    for drop in _two_drops(spark, events, root, cut):
        drop()
        stp.start_partials_stream(src, f"{root}/_checkpoint", f"{root}/partials", partials, merge, partition_by,
                                  available_now=True).awaitTermination()
    return f"{root}/partials"


@register("stream_alert_panes")
def q_stream_alert_panes(spark, d):
    """Sliding-window alerts from the 5-minute panes that a stream keeps."""
    return stp.read_alerts(spark, _kept_partials(spark, d, "panes", stp.alert_panes, stp.merge_panes, dt.timedelta(days=7),
                                                 (stp.PANE_DATE,)))


@register("stream_customer_analytics")
def q_stream_customer_analytics(spark, d):
    """Customer analytics from the partial rows that a stream keeps; the
    day's events arrive in two out-of-order drops."""
    path = _kept_partials(spark, d, "customers", stp.customer_partials, stp.merge_customers, dt.timedelta(hours=6),
                          ("sale_date",))
    return stp.read_customers(spark, path, _as_of(spark, d))


def _mixed_messages(spark, d) -> DataFrame:
    """The messages of both wire versions. They are bound by a one-row
    generator: a filter then reads the text, where else the making of each
    message is copied into it."""
    v1 = fx.wire_events_v1_json(spark, d).select(F.col("value").cast("string").alias("value"))
    v2 = fx.dirty_wire_json(spark, d).select(F.col("value").cast("string").alias("value"))
    return v1.unionByName(v2).select(F.inline(F.array(F.struct("value"))))


def _mixed_bus(spark, d) -> str:
    """Both wire versions on one bus, in two drops."""
    root, both = scratch_path(spark, "mixed"), _mixed_messages(spark, d)
    half = F.xxhash64("value") % 2 == 0
    src = sts.text_file_source(spark, f"{root}/inbox/*")
    for i, part in enumerate((half, ~half)):
        both.where(part).write.text(f"{root}/inbox/{i}")
        sti.stream_mixed_ingest(src, f"{root}/_checkpoint", f"{root}/events", f"{root}/events_v1",
                                quarantine_path=f"{root}/quarantine", available_now=True).awaitTermination()
    return root


@register("stream_v1_hourly")
def q_stream_v1_hourly(spark, d):
    """The first-generation mart over its own stored stream table."""
    return rt.streaming_sales_hourly(read_table(spark, f"{_mixed_bus(spark, d)}/events_v1"))


@register("stream_mixed_events")
def q_stream_mixed_events(spark, d):
    """The second-generation events of the mixed bus."""
    stored = sti.read_event_table(spark, f"{_mixed_bus(spark, d)}/events")
    return stored.select(*[c for c in S.SALES_EVENT_COLUMNS if c != "processed_at"])


@register("stream_compacted")
def q_stream_compacted(spark, d):
    """The event table of both drops after its small files were merged."""
    path = f"{_ingested(spark, d)}/events"
    sti.compact_events(spark, path)
    return sti.read_event_table(spark, path).select(*[c for c in S.SALES_EVENT_COLUMNS if c != "processed_at"])


@register("stream_summary")
def q_stream_summary(spark, d):
    """The hourly summary kept by the ingest stream itself: the wire events
    arrive in two drops (the second holds the older half, i.e. late
    events), each micro-batch is merged into the summary exactly once."""
    root = scratch_path(spark, "ingest-summary")
    events = _events(spark, d)
    split = fx.as_of(events) - dt.timedelta(days=7)

    def wire(part):
        return fx.to_wire_json(part).select(F.col("value").cast("string").alias("value"))

    wire(events.where(F.col("event_time") > F.lit(split))).write.text(f"{root}/inbox/1")
    kw = dict(checkpoint=f"{root}/_checkpoint", table_path=f"{root}/events",
              available_now=True, after_write=sti.summary_hook(f"{root}/summary"))
    src = sts.text_file_source(spark, f"{root}/inbox/*")
    sti.stream_ingest(src, **kw).awaitTermination()
    wire(events.where(F.col("event_time") <= F.lit(split))).write.text(f"{root}/inbox/2")
    sti.stream_ingest(src, **kw).awaitTermination()
    return sti.read_summary(spark, f"{root}/summary").select(*inc.SUMMARY_COLUMNS)


@register("inventory_status_stream")
def q_inventory_status_stream(spark, d):
    """Current stock kept by a stream of inventory events; the events land
    in two drops, the older half last (out-of-order arrival)."""
    root = scratch_path(spark, "inventory-state")
    inv_events = fx.stream_inventory_events(spark, d)
    cut = fx.as_of(inv_events) - dt.timedelta(days=10)
    inv_events.where(F.col("event_time") > F.lit(cut)).write.parquet(f"{root}/inbox/1")
    src = sts.table_stream(spark, f"{root}/inbox/*", S.STREAM_INVENTORY_EVENTS)
    kw = dict(checkpoint=f"{root}/_checkpoint", table_path=f"{root}/state", available_now=True)
    stst.start_inventory_status_stream(src, **kw).awaitTermination()
    inv_events.where(F.col("event_time") <= F.lit(cut)).write.parquet(f"{root}/inbox/2")
    stst.start_inventory_status_stream(src, **kw).awaitTermination()
    return stst.read_inventory_status(spark, f"{root}/state")
