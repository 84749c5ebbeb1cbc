"""Staging views: fixed projections of the raw tables (drop load metadata)."""

from __future__ import annotations

from pyspark.sql import DataFrame

STG_SALES_COLUMNS = ["Store", "Dept", "Date", "Weekly_Sales", "IsHoliday"]
STG_STORES_COLUMNS = ["Store", "Type", "Size"]
STG_FEATURES_COLUMNS = ["Store", "Date", "Temperature", "Fuel_Price",
                        "MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4",
                        "MarkDown5", "CPI", "Unemployment", "IsHoliday"]


def stg_sales(raw: DataFrame) -> DataFrame:
    return raw.select(*STG_SALES_COLUMNS)


def stg_stores(raw: DataFrame) -> DataFrame:
    return raw.select(*STG_STORES_COLUMNS)


def stg_features(raw: DataFrame) -> DataFrame:
    return raw.select(*STG_FEATURES_COLUMNS)
