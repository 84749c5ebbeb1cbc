"""Near-real-time models over the stored sales event table.

All of them are filters plus one grouped aggregate; Catalyst plans a
partial (map-side) aggregate before the shuffle, so a store holding a third
of the events only sends one partial row per task and key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.time import hour_text, on_day, since, trailing, whole_minutes_between

SALE = "SALE"


def streaming_sales_hourly(events_v1: DataFrame) -> DataFrame:
    """First-generation events by hour text: sales (price x quantity) and
    units."""
    return events_v1.groupBy(hour_text("event_time").alias("hour_bucket")).agg(
        F.sum(F.col("price") * F.col("quantity")).alias("sales"),
        F.sum("quantity").alias("qty"))


def _hourly_measures():
    return [
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("total_amount").alias("total_sales"),
        F.avg("total_amount").alias("avg_transaction_value"),
        R.count_where(F.col("transaction_type") == "SALE").alias("sale_count"),
        R.count_where(F.col("transaction_type") == "RETURN").alias("return_count"),
        R.count_where(F.col("transaction_type") == "EXCHANGE").alias("exchange_count"),
        R.count_where(F.col("promotion_applied")).alias("promotional_transactions"),
        F.max("event_time").alias("latest_transaction_time"),
    ]


HOUR_KEYS = ["store_id", "dept_id", "sale_date", "sale_hour"]


def hourly_summary(events: DataFrame, as_of: dt.datetime | None, *more) -> DataFrame:
    """Group events by store, department, date and hour with the summary
    measures (RETURN amounts are added, as in the source model), and ``more``
    aggregates."""
    out = events.groupBy(
        "store_id", "dept_id",
        F.to_date("event_time").alias("sale_date"),
        F.hour("event_time").alias("sale_hour"),
    ).agg(*_hourly_measures(), *more)
    stamp = F.lit(as_of) if as_of is not None else F.current_timestamp()
    return out.withColumn("last_updated", stamp.cast("timestamp"))


def rt_sales_summary(events: DataFrame, as_of: dt.datetime,
                     lookback="24 hours") -> DataFrame:
    """Trailing-window hourly summary (the first hour is cut at
    ``as_of - lookback``)."""
    return hourly_summary(since(events, as_of, lookback), as_of)


# Orders in which the stored models are presented: (column, descending), by
# model. Stored tables carry no order; a read that wants one asks for it.
PRESENTATION = {
    "rt_sales_summary": [("sale_date", True), ("sale_hour", True), ("total_sales", True)],
    "rt_inventory_alerts": [("units_sold_last_hour", True), ("revenue_last_hour", True)],
    "rt_customer_analytics": [("total_spent_today", True), ("transactions_today", True)],
}


def presented(df: DataFrame, model: str, k: int | None = None) -> DataFrame:
    """``df`` in the presentation order of ``model``; its first ``k`` rows
    (a top-k, which sorts no more than ``k`` rows per task)."""
    if model not in PRESENTATION:
        raise ValueError(f"no presentation order for {model!r}")
    out = df.orderBy(*[F.desc(c) if down else F.asc(c) for c, down in PRESENTATION[model]])
    return out if k is None else out.limit(k)


def hourly_sales_rollup(events: DataFrame) -> DataFrame:
    """All-time hourly rollup in the shape of the hourly sales table:
    INT count, DECIMAL(12,2) total, DECIMAL(10,2) average, and the newest
    event time of the hour as ``last_updated``."""
    return events.groupBy(
        "store_id", "dept_id",
        F.to_date("event_time").alias("sale_date"),
        F.hour("event_time").alias("sale_hour"),
    ).agg(
        F.count(F.lit(1)).cast("int").alias("transaction_count"),
        F.sum("total_amount").cast("decimal(12,2)").alias("total_sales"),
        F.avg("total_amount").cast("decimal(10,2)").alias("avg_transaction_value"),
        F.max("event_time").alias("last_updated"))


def product_velocity(events: DataFrame, as_of: dt.datetime, lookback="1 hour") -> DataFrame:
    """Recent SALE activity per store, department and product."""
    recent = since(events, as_of, lookback).where(F.col("transaction_type") == SALE)
    return recent.groupBy("store_id", "dept_id", "product_id").agg(
        F.count(F.lit(1)).alias("transactions_last_hour"),
        F.sum("quantity").alias("units_sold_last_hour"),
        F.sum("total_amount").alias("revenue_last_hour"),
        F.avg("total_amount").alias("avg_transaction_value"),
        F.max("event_time").alias("last_sale_time"))


def with_alert_levels(df: DataFrame, units_col: str = "units_sold_last_hour",
                      velocity=R.VELOCITY_TIERS, alert=R.ALERT_TIERS) -> DataFrame:
    u = F.col(units_col)
    return (df.withColumn("velocity_category", R.tiered(u, velocity, R.VELOCITY_DEFAULT))
              .withColumn("alert_level", R.tiered(u, alert, R.ALERT_DEFAULT)))


def inventory_alerts(events: DataFrame, as_of: dt.datetime, lookback="1 hour",
                     velocity=R.VELOCITY_TIERS, alert=R.ALERT_TIERS,
                     keep=R.ALERT_KEEP) -> DataFrame:
    """Products selling fast enough to need restocking."""
    v = with_alert_levels(product_velocity(events, as_of, lookback),
                          velocity=velocity, alert=alert)
    return (v.where(F.col("alert_level").isin(*keep))
             .withColumn("alert_generated_at", F.lit(as_of).cast("timestamp"))
             .select("store_id", "dept_id", "product_id", "transactions_last_hour",
                     "units_sold_last_hour", "revenue_last_hour", "avg_transaction_value",
                     "velocity_category", "alert_level", "last_sale_time",
                     "alert_generated_at"))


def customer_metrics(events: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Today's SALE behaviour per customer and store."""
    today = on_day(events, as_of).where(F.col("transaction_type") == SALE)
    m = today.groupBy("customer_id", "store_id").agg(
        F.count(F.lit(1)).alias("transactions_today"),
        F.sum("total_amount").alias("total_spent_today"),
        F.avg("total_amount").alias("avg_transaction_value"),
        F.sum("quantity").alias("total_items_purchased"),
        F.count_distinct("dept_id").alias("departments_visited"),
        F.count_distinct("product_id").alias("unique_products_bought"),
        R.count_where(F.col("promotion_applied")).alias("promotional_transactions"),
        F.min("event_time").alias("first_transaction_today"),
        F.max("event_time").alias("last_transaction_today"))
    return m.withColumn("session_duration_minutes",
                        whole_minutes_between("first_transaction_today", "last_transaction_today"))


def customer_analytics(events: DataFrame, as_of: dt.datetime,
                       value=R.VALUE_SEGMENTS, frequency=R.FREQUENCY_SEGMENTS,
                       shopping=R.SHOPPING_SEGMENTS) -> DataFrame:
    """Customer metrics plus value, frequency and shopping segments."""
    return customer_segments(customer_metrics(events, as_of), as_of, value, frequency, shopping)


def customer_segments(m: DataFrame, as_of: dt.datetime, value=R.VALUE_SEGMENTS, frequency=R.FREQUENCY_SEGMENTS,
                      shopping=R.SHOPPING_SEGMENTS) -> DataFrame:
    """Segments from customer metrics."""
    return m.select(
        "customer_id", "store_id", "transactions_today", "total_spent_today",
        "avg_transaction_value", "total_items_purchased", "departments_visited",
        "unique_products_bought", "promotional_transactions",
        R.tiered(F.col("total_spent_today"), value, R.VALUE_DEFAULT).alias("value_segment"),
        R.tiered(F.col("transactions_today"), frequency, R.FREQUENCY_DEFAULT).alias("frequency_segment"),
        R.tiered(F.col("departments_visited"), shopping, R.SHOPPING_DEFAULT).alias("shopping_behavior"),
        "session_duration_minutes", "first_transaction_today", "last_transaction_today",
        F.lit(as_of).cast("timestamp").alias("analysis_timestamp"))


def stream_health(events: DataFrame, as_of: dt.datetime, recent="5 minutes") -> DataFrame:
    """One-row freshness report over the whole event table."""
    recent_cond = trailing("event_time", as_of, recent)
    # Reduced per store and department first: the distinct counts then expand
    # a small table, not the events.
    per = events.groupBy("store_id", "dept_id").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(recent_cond, F.lit(1))).alias("recent"),
        F.max("event_time").alias("hi"), F.min("event_time").alias("lo"))
    h = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("recent"), F.lit(0)).alias("recent_records"),
        F.max("hi").alias("latest_record"),
        F.min("lo").alias("earliest_record"),
        F.count_distinct("store_id").alias("unique_stores"),
        F.count_distinct("dept_id").alias("unique_departments"))
    fresh = F.col("recent_records") > 0
    return h.select(
        "*",
        F.when(fresh, "fresh").otherwise("stale").alias("data_freshness"),
        F.when(fresh, "healthy").otherwise("warning").alias("validation_status"))


def hourly_performance(events: DataFrame, as_of: dt.datetime, k: int = 5) -> DataFrame:
    """Today's figures per hour of day; the ``k`` latest hours (top-k)."""
    today = on_day(events, as_of)
    g = today.groupBy(F.hour("event_time").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_transaction_value"))
    return g.orderBy(F.desc("hour_of_day")).limit(k)


def top_stores(events: DataFrame, as_of: dt.datetime, k: int = 5, lookback="1 hour") -> DataFrame:
    """Best ``k`` stores by revenue over the last hour (store id breaks ties)."""
    recent = since(events, as_of, lookback)
    g = recent.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_transaction_value"))
    return g.orderBy(F.desc("total_revenue"), F.asc("store_id")).limit(k)


METRIC_TYPE = "decimal(15,4)"


def streaming_metrics(events: DataFrame) -> DataFrame:
    """Long-form metric rows (time, name, value, store, department): per
    hour, store and department the transaction count, revenue, average
    ticket and units, unpivoted."""
    g = events.groupBy(
        F.date_trunc("hour", "event_time").alias("metric_time"), "store_id", "dept_id",
    ).agg(
        F.count(F.lit(1)).cast(METRIC_TYPE).alias("transaction_count"),
        F.sum("total_amount").cast(METRIC_TYPE).alias("total_sales"),
        F.avg("total_amount").cast(METRIC_TYPE).alias("avg_transaction_value"),
        F.sum("quantity").cast(METRIC_TYPE).alias("units_sold"))
    long = g.unpivot(["metric_time", "store_id", "dept_id"],
                     ["transaction_count", "total_sales", "avg_transaction_value", "units_sold"],
                     "metric_name", "metric_value")
    return long.select("metric_time", "metric_name", "metric_value", "store_id", "dept_id")


def business_hours_flag(events: DataFrame, tz: str = "UTC") -> DataFrame:
    """Events plus ``is_business_hours`` in the stores' local time."""
    return events.withColumn("is_business_hours", R.business_hours("event_time", tz))


def daypart_sales(events: DataFrame, tz: str = "UTC") -> DataFrame:
    """Sales per daypart (RUSH / EVENING / NORMAL) and store type; expects
    ``store_type`` from ``event_store_enrich``."""
    d = events.withColumn("daypart", R.daypart("event_time", tz))
    return d.groupBy("store_type", "daypart").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("total_amount").alias("total_revenue"),
        F.sum("quantity").alias("units"))
