"""Schemas, keys and contracts of the retail tables.

Fixed values: table names, key columns, update columns, enum members,
defaults and thresholds below must equal the source system's for the
results to agree. They are listed plainly and together.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType,
    StringType, StructField, StructType, TimestampType,
)

MONEY = DecimalType(10, 2)

# ---------------------------------------------------------------------------
# Raw tables loaded from CSV, their keys and update columns.
# ---------------------------------------------------------------------------
RAW_TABLES = {
    "raw_sales": {
        "keys": ["Store", "Dept", "Date"],
        "update_cols": ["Weekly_Sales", "IsHoliday"],
    },
    "raw_stores": {
        "keys": ["Store"],
        "update_cols": ["Type", "Size"],
    },
    "raw_features": {
        "keys": ["Store", "Date"],
        "update_cols": ["Temperature", "Fuel_Price", "MarkDown1", "MarkDown2",
                        "MarkDown3", "MarkDown4", "MarkDown5", "CPI",
                        "Unemployment", "IsHoliday"],
    },
}

INGESTION_TS = "ingestion_ts"

RAW_SALES = StructType([
    StructField("Store", IntegerType()),
    StructField("Dept", IntegerType()),
    StructField("Date", DateType()),
    StructField("Weekly_Sales", DecimalType(18, 2)),
    StructField("IsHoliday", BooleanType()),
])

RAW_STORES = StructType([
    StructField("Store", IntegerType()),
    StructField("Type", StringType()),
    StructField("Size", IntegerType()),
])

RAW_FEATURES = StructType([
    StructField("Store", IntegerType()),
    StructField("Date", DateType()),
    StructField("Temperature", DecimalType(10, 2)),
    StructField("Fuel_Price", DecimalType(10, 3)),
    StructField("MarkDown1", DoubleType()),
    StructField("MarkDown2", DoubleType()),
    StructField("MarkDown3", DoubleType()),
    StructField("MarkDown4", DoubleType()),
    StructField("MarkDown5", DoubleType()),
    StructField("CPI", DoubleType()),
    StructField("Unemployment", DoubleType()),
    StructField("IsHoliday", BooleanType()),
])

RAW_SCHEMAS = {"raw_sales": RAW_SALES, "raw_stores": RAW_STORES,
               "raw_features": RAW_FEATURES}

# ---------------------------------------------------------------------------
# Wire formats of sales events (JSON values on the event bus).
# ---------------------------------------------------------------------------
EVENT_V1_WIRE = StructType([
    StructField("event_id", IntegerType()),
    StructField("event_time", StringType()),
    StructField("product_id", IntegerType()),
    StructField("quantity", IntegerType()),
    StructField("price", DoubleType()),
])

EVENT_V2_WIRE = StructType([
    StructField("event_id", StringType(), False),
    StructField("event_time", StringType(), False),
    StructField("store_id", IntegerType(), False),
    StructField("dept_id", IntegerType(), False),
    StructField("product_id", StringType(), False),
    StructField("customer_id", StringType(), False),
    StructField("quantity", IntegerType(), False),
    StructField("unit_price", DoubleType(), False),
    StructField("total_amount", DoubleType(), False),
    StructField("transaction_type", StringType(), False),
    StructField("payment_method", StringType(), False),
    StructField("promotion_applied", BooleanType(), False),
])

# Column order of the stored sales event table.
SALES_EVENT_COLUMNS = [
    "event_id", "event_time", "store_id", "dept_id", "product_id",
    "customer_id", "quantity", "unit_price", "total_amount",
    "transaction_type", "payment_method", "promotion_applied", "processed_at",
]

STREAM_SALES_EVENTS = StructType([
    StructField("event_id", StringType()),
    StructField("event_time", TimestampType()),
    StructField("store_id", IntegerType()),
    StructField("dept_id", IntegerType()),
    StructField("product_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("quantity", IntegerType()),
    StructField("unit_price", MONEY),
    StructField("total_amount", MONEY),
    StructField("transaction_type", StringType()),
    StructField("payment_method", StringType()),
    StructField("promotion_applied", BooleanType()),
    StructField("processed_at", TimestampType()),
])

STREAM_INVENTORY_EVENTS = StructType([
    StructField("event_id", StringType()),
    StructField("event_time", TimestampType()),
    StructField("store_id", IntegerType()),
    StructField("dept_id", IntegerType()),
    StructField("product_id", StringType()),
    StructField("event_type", StringType()),
    StructField("quantity_change", IntegerType()),
    StructField("current_stock", IntegerType()),
    StructField("reorder_point", IntegerType()),
    StructField("supplier_id", StringType()),
    StructField("processed_at", TimestampType()),
])

STREAM_CUSTOMER_EVENTS = StructType([
    StructField("event_id", StringType()),
    StructField("event_time", TimestampType()),
    StructField("customer_id", StringType()),
    StructField("store_id", IntegerType()),
    StructField("dept_id", IntegerType()),
    StructField("event_type", StringType()),
    StructField("product_id", StringType()),
    StructField("session_id", StringType()),
    StructField("processed_at", TimestampType()),
])

RT_HOURLY_SALES = StructType([
    StructField("store_id", IntegerType()),
    StructField("dept_id", IntegerType()),
    StructField("sale_date", DateType()),
    StructField("sale_hour", IntegerType()),
    StructField("transaction_count", LongType()),
    StructField("total_sales", DecimalType(12, 2)),
    StructField("avg_transaction_value", DecimalType(10, 2)),
    StructField("last_updated", TimestampType()),
])


# ---------------------------------------------------------------------------
# Contracts: NOT NULL columns, CHECK rules, enums and defaults.
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Contract:
    name: str
    keys: tuple
    not_null: tuple
    # rule name -> SQL boolean expression that must hold (NULL counts as pass,
    # as a SQL CHECK does; NOT NULL is a separate rule).
    checks: dict = field(default_factory=dict)
    enums: dict = field(default_factory=dict)
    defaults: dict = field(default_factory=dict)


# Enum members and defaults of the event tables.
TRANSACTION_TYPES = ("SALE", "RETURN", "EXCHANGE")
PAYMENT_METHODS = ("CASH", "CARD", "MOBILE")
INVENTORY_EVENT_TYPES = ("SALE", "RESTOCK", "WASTE", "TRANSFER")
CUSTOMER_EVENT_TYPES = ("ENTRY", "DEPT_VISIT", "PRODUCT_VIEW", "CART_ADD",
                        "CART_REMOVE", "CHECKOUT", "EXIT")
DEFAULT_REORDER_POINT = 10

SALES_EVENT_CONTRACT = Contract(
    name="stream_sales_events",
    keys=("event_id",),
    not_null=("event_id", "event_time", "store_id", "dept_id", "product_id",
              "customer_id", "quantity", "unit_price", "total_amount",
              "transaction_type", "payment_method"),
    checks={"quantity_positive": "quantity > 0",
            "unit_price_positive": "unit_price > 0",
            "total_amount_positive": "total_amount > 0",
            "event_id_length": "length(event_id) <= 36",
            "product_id_length": "length(product_id) <= 50",
            "customer_id_length": "length(customer_id) <= 36"},
    enums={"transaction_type": TRANSACTION_TYPES,
           "payment_method": PAYMENT_METHODS},
    defaults={"transaction_type": "SALE", "payment_method": "CARD",
              "promotion_applied": False, "processed_at": "current_timestamp"},
)

INVENTORY_EVENT_CONTRACT = Contract(
    name="stream_inventory_events",
    keys=("event_id",),
    not_null=("event_id", "event_time", "store_id", "dept_id", "product_id",
              "event_type", "quantity_change", "current_stock"),
    checks={"current_stock_non_negative": "current_stock >= 0",
            "supplier_id_length": "length(supplier_id) <= 20"},
    enums={"event_type": INVENTORY_EVENT_TYPES},
    defaults={"reorder_point": DEFAULT_REORDER_POINT,
              "processed_at": "current_timestamp"},
)

CUSTOMER_EVENT_CONTRACT = Contract(
    name="stream_customer_events",
    keys=("event_id",),
    not_null=("event_id", "event_time", "customer_id", "store_id",
              "event_type", "session_id"),
    checks={},
    enums={"event_type": CUSTOMER_EVENT_TYPES},
    defaults={"processed_at": "current_timestamp"},
)

CONTRACTS = {c.name: c for c in (SALES_EVENT_CONTRACT,
                                 INVENTORY_EVENT_CONTRACT,
                                 CUSTOMER_EVENT_CONTRACT)}
