"""Incremental hourly sales summary.

First run: the trailing ``lookback`` window. Later runs read only events
newer than the stored high-water mark (``MAX(latest_transaction_time)``,
fetched first as one scalar so it becomes a literal that prunes the scan)
and merge them into the stored rows:

* ``additive`` (default): counts and sums are added, the average is
  recomputed from them, the newest time is the greater. Any split of the
  events without late rows gives the same table as one full run.
* ``replace``: a key seen again keeps only the newest run's figures (the
  behaviour of a plain unique-key merge; an hour split over two runs keeps
  only its second part).
* ``recompute``: keys touched by events that *arrived* (``processed_at``)
  after the last run are recomputed from all their events, so late events
  are counted too.

Merges are a union plus one grouped aggregate by key: no join, and hot keys
are reduced map-side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from .batch import weighted_avg
from .joins import dim_join
from .realtime import HOUR_KEYS, hourly_summary, rt_sales_summary
from .upsert import schema_change_fail

SUM_COLS = ["transaction_count", "total_sales", "sale_count", "return_count",
            "exchange_count", "promotional_transactions"]
SUMMARY_COLUMNS = HOUR_KEYS + ["transaction_count", "total_sales", "avg_transaction_value",
                               "sale_count", "return_count", "exchange_count",
                               "promotional_transactions", "latest_transaction_time",
                               "last_updated"]


def high_water_mark(target: DataFrame):
    return target.agg(F.max("latest_transaction_time").alias("m")).first()["m"]


def sales_summary_incremental(target: DataFrame | None, events: DataFrame,
                              as_of: dt.datetime, merge: str = "additive",
                              lookback="24 hours", high_water=None, arrived_since=None) -> DataFrame:
    """Merge the events newer than the stored high-water mark into
    ``target``. ``high_water`` may be given when ``target`` is only the
    part of the stored table the new events can touch.

    ``recompute`` rebuilds the keys of the events that arrived
    (``processed_at``) after ``arrived_since``, the arrival mark of the last
    run, which has nothing to do with event times. Without a mark the
    greatest ``last_updated`` stands in; that is right only if report times
    were clock times."""
    if target is None:
        return rt_sales_summary(events, as_of, lookback).select(*SUMMARY_COLUMNS)
    # Schemas are known without running anything.
    fresh = hourly_summary(events, as_of).select(*SUMMARY_COLUMNS)
    schema_change_fail(target.schema, fresh.schema)
    target = target.select(*SUMMARY_COLUMNS)

    if merge == "recompute":
        return _recompute(target, events, as_of, arrived_since)

    hw = high_water if high_water is not None else high_water_mark(target)
    if hw is None:
        # NULL high-water mark: no event compares greater, nothing is added.
        return target
    new = hourly_summary(events.where(F.col("event_time") > F.lit(hw)), as_of).select(*SUMMARY_COLUMNS)
    if merge == "replace":
        return _replace(target, new)
    if merge == "additive":
        return _additive(target, new)
    raise ValueError(f"unknown merge mode {merge!r}")


def _replace(target: DataFrame, new: DataFrame) -> DataFrame:
    u = target.withColumn("_run", F.lit(0)).unionByName(new.withColumn("_run", F.lit(1)))
    rest = [c for c in SUMMARY_COLUMNS if c not in HOUR_KEYS]
    g = u.groupBy(*HOUR_KEYS).agg(F.max_by(F.struct(*rest), F.col("_run")).alias("r"))
    return g.select(*HOUR_KEYS, *[F.col(f"r.{c}").alias(c) for c in rest])


def _additive(target: DataFrame, new: DataFrame) -> DataFrame:
    u = target.withColumn("_run", F.lit(0)).unionByName(new.withColumn("_run", F.lit(1)))
    g = u.groupBy(*HOUR_KEYS).agg(
        *[F.sum(c).alias(c) for c in SUM_COLS],
        F.max("latest_transaction_time").alias("latest_transaction_time"),
        F.max_by("last_updated", F.col("_run")).alias("last_updated"))
    return g.select(
        *HOUR_KEYS,
        F.col("transaction_count").cast("bigint").alias("transaction_count"),
        F.col("total_sales").cast("decimal(20,2)").alias("total_sales"),
        weighted_avg(F.col("total_sales"), F.col("transaction_count"), S.MONEY)
        .alias("avg_transaction_value"),
        *[F.col(c).cast("bigint").alias(c) for c in SUM_COLS[2:]],
        "latest_transaction_time", "last_updated")


def touched_events(events: DataFrame, arrived: DataFrame) -> DataFrame:
    """All events of the summary keys that the ``arrived`` ones belong to."""
    touched = arrived.select("store_id", "dept_id", F.to_date("event_time").alias("_d"),
                             F.hour("event_time").alias("_h")).distinct()
    keyed = events.select("*", F.to_date("event_time").alias("_d"), F.hour("event_time").alias("_h"))
    return dim_join(keyed, touched, on=["store_id", "dept_id", "_d", "_h"], how="left_semi").drop("_d", "_h")


def _recompute(target: DataFrame, events: DataFrame, as_of: dt.datetime, arrived_since=None) -> DataFrame:
    last_run = arrived_since or target.agg(F.max("last_updated").alias("m")).first()["m"]
    arrived = events if last_run is None else events.where(F.col("processed_at") > F.lit(last_run))
    new = hourly_summary(touched_events(events, arrived), as_of).select(*SUMMARY_COLUMNS)
    return _replace(target, new)


def summary_partials(events: DataFrame) -> DataFrame:
    """Summary rows of some events alone, mergeable with those of others."""
    return (hourly_summary(events, None).select(*SUMMARY_COLUMNS)
            .withColumn("last_updated", F.col("latest_transaction_time")))


def merged_summary(partials: DataFrame) -> DataFrame:
    """The summary of all events behind ``partials``: one row per key."""
    g = partials.groupBy(*HOUR_KEYS).agg(
        *[F.sum(c).alias(c) for c in SUM_COLS],
        F.max("latest_transaction_time").alias("latest_transaction_time"))
    return g.select(
        *HOUR_KEYS,
        F.col("transaction_count").cast("bigint").alias("transaction_count"),
        F.col("total_sales").cast("decimal(20,2)").alias("total_sales"),
        weighted_avg(F.col("total_sales"), F.col("transaction_count"), S.MONEY)
        .alias("avg_transaction_value"),
        *[F.col(c).cast("bigint").alias(c) for c in SUM_COLS[2:]],
        "latest_transaction_time",
        F.col("latest_transaction_time").alias("last_updated"))
