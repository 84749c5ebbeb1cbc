"""Retail fixture tables derived from the generic test tables.

The test data is a TPC-H-like star schema plus an ``events`` table. These
functions map it onto the retail tables the models expect (sales, stores,
features, sales/inventory events). Each mapping is a pure projection or
aggregation, so it scales with the input and Catalyst prunes unused columns
down to the parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S

# Fixed load time stamped on fixture rows (deterministic ingestion_ts).
FIXTURE_LOAD_TS = dt.datetime(2025, 1, 1, 0, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _week(col: str) -> Column:
    """Monday of the ISO week of a timestamp column, as DATE."""
    return F.trunc(F.to_date(F.col(col)), "week")


def raw_sales(spark: SparkSession, sf_dir: str, with_ts: bool = True) -> DataFrame:
    """Weekly sales rows, one per lineitem. Key (Store, Dept, Date) repeats."""
    li = table(spark, sf_dir, "lineitem")
    cols = [
        (F.col("l_suppkey") + 1).cast("int").alias("Store"),
        (F.col("l_partkey") % 20 + 1).cast("int").alias("Dept"),
        _week("l_shipdate").alias("Date"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("Weekly_Sales"),
        (F.col("l_returnflag") == "R").alias("IsHoliday"),
    ]
    if with_ts:
        cols.append(F.lit(FIXTURE_LOAD_TS).alias(S.INGESTION_TS))
    return li.select(*cols)


def raw_sales_file(spark: SparkSession, sf_dir: str, part: str) -> DataFrame:
    """Two overlapping sales extracts of the same history.

    ``"first"`` holds weeks shipped before 1999; ``"second"`` holds weeks
    from 1998 on, with re-priced amounts (extended price net of discount),
    so the overlap year is an update and later years are inserts.
    """
    li = table(spark, sf_dir, "lineitem")
    base = [
        (F.col("l_suppkey") + 1).cast("int").alias("Store"),
        (F.col("l_partkey") % 20 + 1).cast("int").alias("Dept"),
        _week("l_shipdate").alias("Date"),
    ]
    if part == "first":
        return li.where(F.col("l_shipdate") < F.lit(dt.datetime(1999, 1, 1))).select(
            *base,
            F.col("l_extendedprice").cast("decimal(18,2)").alias("Weekly_Sales"),
            (F.col("l_returnflag") == "R").alias("IsHoliday"),
        )
    if part == "second":
        return li.where(F.col("l_shipdate") >= F.lit(dt.datetime(1998, 1, 1))).select(
            *base,
            (F.col("l_extendedprice").cast("decimal(18,2)")
             * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))
            .cast("decimal(18,2)").alias("Weekly_Sales"),
            (F.col("l_returnflag") == "R").alias("IsHoliday"),
        )
    raise ValueError(f"unknown part {part!r}")


def raw_stores(spark: SparkSession, sf_dir: str, with_ts: bool = True) -> DataFrame:
    """Store dimension: one store per supplier. Its keys are shifted, so that
    the first five stores with sales have no row here."""
    su = table(spark, sf_dir, "supplier")
    cols = [
        (F.col("s_suppkey") + 6).cast("int").alias("Store"),
        F.when(F.col("s_nationkey") % 3 == 0, "A")
         .when(F.col("s_nationkey") % 3 == 1, "B")
         .otherwise("C").alias("Type"),
        (F.lit(30000) + (F.col("s_suppkey") * 7919) % 190000).cast("int").alias("Size"),
    ]
    if with_ts:
        cols.append(F.lit(FIXTURE_LOAD_TS).alias(S.INGESTION_TS))
    return su.select(*cols)


def raw_features(spark: SparkSession, sf_dir: str, with_ts: bool = True) -> DataFrame:
    """Weekly store features, one row per (Store, Date) seen in orders;
    fifteen customers make a store."""
    o = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    g = (o.select(
            (F.floor(F.col("o_custkey") / 15) + 1).cast("int").alias("Store"),
            _week("o_orderdate").alias("Date"),
            price.alias("p"),
            price.cast("decimal(18,2)").alias("p_dec"),
            F.col("o_orderkey"),
            F.col("o_orderstatus"),
            F.col("o_orderpriority"))
         .groupBy("Store", "Date")
         .agg(F.max("p_dec").alias("max_p"), F.min("p_dec").alias("min_p"),
              F.max("p").alias("max_pd"), F.min("p").alias("min_pd"),
              F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"),
              F.bool_or(F.col("o_orderstatus") == "F").alias("any_f"),
              F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent")))
    cols = [
        "Store", "Date",
        (F.col("max_p") * F.lit(0.0002).cast("decimal(5,4)")).cast("decimal(10,2)").alias("Temperature"),
        (F.col("min_p") * F.lit(0.00001).cast("decimal(6,5)")).cast("decimal(10,3)").alias("Fuel_Price"),
        F.when(F.col("n") > 1, F.col("max_pd") / 10).alias("MarkDown1"),
        F.when(F.col("first_key") % 3 == 0, F.col("min_pd")).alias("MarkDown2"),
        F.when(F.col("any_f"), F.col("max_pd") - F.col("min_pd")).alias("MarkDown3"),
        (F.col("n").cast("double") * 100.0).alias("MarkDown4"),
        F.when(F.col("n") >= 3, F.col("min_pd") / 4).alias("MarkDown5"),
        (F.lit(200.5) + (F.col("Store") % 20).cast("double")).alias("CPI"),
        F.when(F.col("Store") % 7 != 0, (F.col("Store") % 10).cast("double") + 0.25).alias("Unemployment"),
        F.col("urgent").alias("IsHoliday"),
    ]
    if with_ts:
        cols.append(F.lit(FIXTURE_LOAD_TS).alias(S.INGESTION_TS))
    return g.select(*cols)


def _event_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    # props is a one-key JSON object {"k": n}; a regex reads n in one pass
    # (cheaper than a JSON parser when the optimizer repeats the expression
    # in pushed-down filters).
    k = F.regexp_extract(F.col("props"), r'"k"\s*:\s*(-?[0-9]+)', 1).cast("int")
    store = (F.col("user_id") % 45 + 1).cast("int")
    return ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        store.alias("store_id"),
        (k % 10 + 1).alias("dept_id"),
        k.alias("k"),
        F.col("user_id"),
        F.col("event_type").alias("raw_type"),
        F.col("value"),
        F.col("event_id").alias("raw_event_id"),
    ).withColumn("product_id", F.concat_ws("_", F.col("store_id").cast("string"),
                                           F.col("dept_id").cast("string"),
                                           (F.col("k") % 3).cast("string")))


def stream_sales_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored sales event table (v2 schema plus processed_at)."""
    b = _event_base(spark, sf_dir)
    unit = F.col("value").cast(S.MONEY)
    qty = (F.col("k") % 5 + 1).cast("int")
    return b.select(
        "event_id", "event_time", "store_id", "dept_id", "product_id",
        F.col("user_id").cast("string").alias("customer_id"),
        qty.alias("quantity"),
        unit.alias("unit_price"),
        (unit * qty).cast(S.MONEY).alias("total_amount"),
        F.when(F.col("raw_type") == "signup", "RETURN")
         .when(F.col("raw_type") == "error", "EXCHANGE")
         .otherwise("SALE").alias("transaction_type"),
        F.when(F.col("k") % 3 == 0, "CARD")
         .when(F.col("k") % 3 == 1, "CASH")
         .otherwise("MOBILE").alias("payment_method"),
        (F.col("k") % 2 == 0).alias("promotion_applied"),
        F.col("event_time").alias("processed_at"),
    )


def stream_events_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-generation events: id, time, product, quantity, price."""
    b = _event_base(spark, sf_dir)
    return b.select(
        F.col("raw_event_id").cast("int").alias("event_id"),
        "event_time",
        F.col("k").alias("product_id"),
        (F.col("k") % 5 + 1).cast("int").alias("quantity"),
        F.col("value").cast(S.MONEY).alias("price"),
    )


def stream_inventory_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory movements derived from the same events."""
    b = _event_base(spark, sf_dir)
    et = (F.when(F.col("raw_type").isin("purchase", "click"), "SALE")
          .when(F.col("raw_type") == "view", "RESTOCK")
          .when(F.col("raw_type") == "signup", "WASTE")
          .otherwise("TRANSFER"))
    step = (F.col("k") % 5 + 1).cast("int")
    return b.select(
        "event_id", "event_time", "store_id", "dept_id", "product_id",
        et.alias("event_type"),
        F.when(F.col("raw_type") == "view", step).otherwise(-step).alias("quantity_change"),
        (F.col("k") % 40).cast("int").alias("current_stock"),
        F.lit(S.DEFAULT_REORDER_POINT).alias("reorder_point"),
        F.when(F.col("k") % 7 != 0, (F.col("k") % 7).cast("string")).alias("supplier_id"),
        F.col("event_time").alias("processed_at"),
    )


def wire_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales events as they arrive on the bus: one JSON text per row in
    ``value`` (binary, as a message payload), event_time as ISO text and
    money as JSON numbers."""
    return to_wire_json(stream_sales_events(spark, sf_dir))


def to_wire_json(ev: DataFrame) -> DataFrame:
    """Stored sales events -> bus messages (``key``, JSON ``value``)."""
    payload = F.struct(
        "event_id",
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"),
        "store_id", "dept_id", "product_id", "customer_id", "quantity",
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("total_amount").cast("double").alias("total_amount"),
        "transaction_type", "payment_method", "promotion_applied",
    )
    return ev.select(F.col("event_id").alias("key"),
                     F.to_json(payload).cast("binary").alias("value"))


# Of every 97 event ids, the messages of the first six are spoiled.
BAD_EVERY = 97


def dirty_wire_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bus messages with some spoiled by event id: broken JSON, a
    quantity that is no number, an unreadable time, a zero amount, an
    unknown transaction type, an amount that does not fit its column."""
    rule = F.col("key").cast("bigint") % BAD_EVERY
    text = F.col("value").cast("string")
    amount = r'"total_amount":[-0-9.E]+'
    spoiled = (F.when(rule == 0, F.substring(text, 1, 20))
               .when(rule == 1, F.regexp_replace(text, r'"quantity":-?[0-9]+', '"quantity":"many"'))
               .when(rule == 2, F.regexp_replace(text, r'"event_time":"[^"]*"', '"event_time":"yesterday"'))
               .when(rule == 3, F.regexp_replace(text, amount, '"total_amount":0.0'))
               .when(rule == 4, F.regexp_replace(text, r'"transaction_type":"[A-Z]+"', '"transaction_type":"GIFT"'))
               .when(rule == 5, F.regexp_replace(text, amount, '"total_amount":1.0E9'))
               .otherwise(text))
    return wire_events_json(spark, sf_dir).select("key", spoiled.cast("binary").alias("value"))


def dirty_sales_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spoiled messages as typed rows (``processed_at`` = event time)."""
    from ..operators import events as ev
    parsed = ev.cast_event_time(ev.parse_event_json(dirty_wire_json(spark, sf_dir), S.EVENT_V2_WIRE))
    return ev.event_projection(parsed.withColumn("processed_at", F.col("event_time")))


def as_of(events: DataFrame, col: str = "event_time"):
    """The report time of a run: the newest event time.

    One scalar is brought to the driver so it can be used as a literal,
    which lets the time filters reach the scan as pushed predicates.
    """
    from ..functions.time import latest_event_time
    return latest_event_time(events, col)


def wire_events_v1_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-generation wire form: integer ids, ISO text time, double price."""
    ev = stream_events_v1(spark, sf_dir)
    payload = F.struct(
        "event_id",
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"),
        "product_id", "quantity", F.col("price").cast("double").alias("price"))
    return ev.select(F.to_json(payload).cast("binary").alias("value"))
