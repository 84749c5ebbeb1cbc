"""Batch marts over sales, stores and features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .joins import dim_join
from .staging import stg_features, stg_sales, stg_stores


def avg_type(dtype: DecimalType) -> DecimalType:
    """Result type of AVG over a DECIMAL(p, s): DECIMAL(p + 4, s + 4)."""
    return DecimalType(min(38, dtype.precision + 4), min(38, dtype.scale + 4))


def sum_type(dtype: DecimalType) -> DecimalType:
    """Result type of SUM over a DECIMAL(p, s): DECIMAL(p + 10, s)."""
    return DecimalType(min(38, dtype.precision + 10), dtype.scale)


def weighted_avg(total, count, dtype: DecimalType):
    """AVG rebuilt from a pre-aggregated sum and row count, typed and rounded
    (HALF_UP) exactly like AVG over the original rows.

    The sum is first brought to the type SUM gives over the original column,
    so the division keeps the same intermediate scale as AVG itself.
    """
    return (total.cast(sum_type(dtype)) / F.nullif(count, F.lit(0))).cast(avg_type(dtype))


def _stores_dim(stores: DataFrame) -> DataFrame:
    return stg_stores(stores).select(
        "Store", F.col("Type").alias("Store_Type"), F.col("Size").alias("Store_Size"))


def sales_stores_join(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales LEFT JOIN stores on Store; unknown stores keep NULL type/size,
    duplicated dimension rows fan out."""
    return dim_join(stg_sales(sales), _stores_dim(stores), on="Store", how="left")


def sales_features_join(sales: DataFrame, features: DataFrame) -> DataFrame:
    """Sales LEFT JOIN features on (Store, Date)."""
    f = stg_features(features).select(
        "Store", "Date", "Temperature", "Fuel_Price",
        F.col("IsHoliday").alias("Feature_IsHoliday"))
    return dim_join(stg_sales(sales), f, on=["Store", "Date"], how="left")


def sales_enriched(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """One row per sales row with store type/size and the week's features.

    ``IsHoliday`` is the *features* flag (the sales flag is dropped), as in
    the store-performance model.
    """
    s = stg_sales(sales).select("Store", "Date", "Weekly_Sales")
    f = stg_features(features).select("Store", "Date", "Temperature",
                                      "Fuel_Price", "IsHoliday")
    j = dim_join(s, _stores_dim(stores), on="Store", how="left")
    j = dim_join(j, f, on=["Store", "Date"], how="left")
    return j.select("Store", "Date", "Weekly_Sales", "Store_Type", "Store_Size",
                    "Temperature", "Fuel_Price", "IsHoliday")


def store_performance(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """Per store: rows, average and total weekly sales, average temperature
    and fuel price over the sales rows (so weighted by sales rows).

    Plan: the fact table is first reduced to one row per (Store, Date) with
    its row count and sales sum (a map-side partial aggregate, so a hot
    store never piles up in one task), and only that small table meets the
    features and stores. The averages are rebuilt from weighted sums, which
    gives the same values and types as AVG over the joined rows.
    """
    s = stg_sales(sales)
    ws_type = s.schema["Weekly_Sales"].dataType
    f = stg_features(features)
    t_type = f.schema["Temperature"].dataType
    fp_type = f.schema["Fuel_Price"].dataType

    per_week = s.groupBy("Store", "Date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Weekly_Sales").alias("ws"))
    # Both sides are now one row per store-week: a plain equi-join, planned
    # by AQE from their runtime sizes (no extra pass to size the features).
    j = per_week.join(f.select("Store", "Date", "Temperature", "Fuel_Price"),
                      on=["Store", "Date"], how="left")
    j = dim_join(j, _stores_dim(stores), on="Store", how="left")
    n_t = F.when(F.col("Temperature").isNotNull(), F.col("n"))
    n_f = F.when(F.col("Fuel_Price").isNotNull(), F.col("n"))
    agg = j.groupBy("Store", "Store_Type", "Store_Size").agg(
        F.sum("n").alias("total_weeks"),
        F.sum("ws").alias("total_sales"),
        F.sum(F.col("Temperature") * F.col("n")).alias("t_sum"),
        F.sum(n_t).alias("t_n"),
        F.sum(F.col("Fuel_Price") * F.col("n")).alias("f_sum"),
        F.sum(n_f).alias("f_n"),
    )
    return agg.select(
        "Store", "Store_Type", "Store_Size", "total_weeks",
        weighted_avg(F.col("total_sales"), F.col("total_weeks"), ws_type).alias("avg_weekly_sales"),
        F.col("total_sales").cast(sum_type(ws_type)).alias("total_sales"),
        weighted_avg(F.col("t_sum"), F.col("t_n"), t_type).alias("avg_temperature"),
        weighted_avg(F.col("f_sum"), F.col("f_n"), fp_type).alias("avg_fuel_price"),
    )


def daily_sales(sales: DataFrame) -> DataFrame:
    """Per week-date: total sales and number of store-dept rows."""
    return stg_sales(sales).groupBy(F.col("Date").alias("sale_date")).agg(
        F.sum("Weekly_Sales").alias("total_sales"),
        F.count(F.lit(1)).alias("total_transactions"))


def sales_summary(sales: DataFrame) -> DataFrame:
    """The daily-sales mart (stored as a table by ``plans.models``)."""
    return daily_sales(sales)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop fully identical rows (a distinct over all columns; partial
    aggregation removes copies before the shuffle)."""
    return df.dropDuplicates()
