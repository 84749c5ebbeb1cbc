"""Sales/inventory event operators: parse, type, validate, check, dedupe,
enrich. All of them work on batch and streaming DataFrames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas as S
from .joins import dim_join


def parse_event_json(df: DataFrame, schema: StructType = S.EVENT_V2_WIRE,
                     value_col: str = "value", keep: tuple = ()) -> DataFrame:
    """Message payload (bytes or text) -> typed columns of ``schema``.

    Malformed JSON gives an all-NULL row; a field of the wrong type is NULL
    on its own. ``keep`` passes message metadata (offsets, keys) through.
    The parsed record is bound by a one-row generator: a filter on its fields
    then reads them, where a plain projection is copied into the filter once
    per field and parses the message again each time.
    """
    data = F.from_json(F.col(value_col).cast("string"), schema)
    return df.select(*keep, F.inline_outer(F.array(data)))


def cast_event_time(df: DataFrame, col: str = "event_time") -> DataFrame:
    """ISO text -> TIMESTAMP; unreadable text becomes NULL instead of
    failing the job (``try_cast``)."""
    return df.withColumn(col, F.col(col).try_cast("timestamp"))


def valid_event(c=F.col) -> Column:
    return ((c("quantity") > 0) & (c("unit_price") > 0) & (c("total_amount") > 0)
            & c("store_id").isNotNull() & c("dept_id").isNotNull())


def validate_event(events: DataFrame) -> DataFrame:
    """Keep events with positive quantity, price and amount and a store and
    department (NULL comparisons drop malformed rows as well)."""
    return events.where(valid_event())


def event_projection(events: DataFrame, processed_at=None, keep: tuple = ()) -> DataFrame:
    """The stored event row: fixed 13-column order, money as DECIMAL(10,2),
    ``processed_at`` stamped (a given time or the current one). An amount
    that does not fit is NULL, so that the contract rejects the row instead
    of the job failing. ``keep`` passes more columns through."""
    stamp = F.lit(processed_at) if processed_at is not None else F.current_timestamp()
    out = events
    if "processed_at" not in events.columns:
        out = out.withColumn("processed_at", stamp.cast("timestamp"))
    return out.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_time").cast("timestamp").alias("event_time"),
        "store_id", "dept_id", "product_id", "customer_id", "quantity",
        F.col("unit_price").try_cast(S.MONEY).alias("unit_price"),
        F.col("total_amount").try_cast(S.MONEY).alias("total_amount"),
        "transaction_type", "payment_method", "promotion_applied", "processed_at", *keep)


def contract_defaults(df: DataFrame, contract: S.Contract, now=None) -> DataFrame:
    """Add defaulted columns that are *absent*; an explicit NULL stays NULL
    (as a column default only applies to omitted columns)."""
    out = df
    for col, value in contract.defaults.items():
        if col in df.columns:
            continue
        if value == "current_timestamp":
            expr = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
        else:
            expr = F.lit(value)
        out = out.withColumn(col, expr)
    return out


def contract_check(df: DataFrame, contract: S.Contract,
                   out_col: str = "failed_rules") -> DataFrame:
    """Input rows plus an array of the names of the rules each row breaks.

    Rules: ``not_null:<col>``, each CHECK by name (a NULL outcome passes,
    as in SQL), ``enum:<col>`` for values outside the allowed set.
    """
    present = set(df.columns)

    def col(name):
        return F.col(name) if name in present else F.lit(None)

    failures = []
    for name in contract.not_null:
        failures.append(F.when(col(name).isNull(), F.lit(f"not_null:{name}")))
    for name, cond in contract.checks.items():
        needed = [c for c in _idents(cond) if c not in present]
        if needed:
            continue
        failures.append(F.when(~F.expr(cond), F.lit(name)))
    for name, allowed in contract.enums.items():
        failures.append(F.when(~col(name).isin(*allowed), F.lit(f"enum:{name}")))
    # The names of the broken rules joined (concat_ws skips the NULLs of
    # rules that hold) and split back into an array: plain expressions that
    # stay in whole-stage codegen, unlike a lambda filter over an array.
    empty = F.array().cast("array<string>")
    if not failures:
        return df.withColumn(out_col, empty)
    joined = F.concat_ws(",", *failures)
    return df.withColumn(out_col, F.when(joined == "", empty).otherwise(F.split(joined, ",")))


def _idents(cond: str):
    import re
    return [w for w in re.findall(r"[A-Za-z_][A-Za-z_0-9]*", cond)
            if w.lower() not in {"and", "or", "not", "null", "is", "length", "in"}]


def split_by_contract(df: DataFrame, contract: S.Contract):
    """(valid rows, quarantined rows with their failed rules)."""
    checked = contract_check(df, contract)
    valid = checked.where(F.size("failed_rules") == 0).drop("failed_rules")
    bad = checked.where(F.size("failed_rules") > 0)
    return valid, bad


def event_id_dedupe(events: DataFrame, key: str = "event_id",
                    delay: str | None = None, time_col: str = "event_time") -> DataFrame:
    """One row per event id.

    Batch: the row that comes first by time and then by its other columns, so
    the survivor does not depend on the run (``min_by`` reduces replays of one
    id in each task before the shuffle). Stream: with ``delay`` the state is
    bounded by a watermark (``dropDuplicatesWithinWatermark``); without it
    the state keeps every id ever seen.
    """
    if not events.isStreaming:
        rest = [c for c in events.columns if c != key]
        order = [time_col, *[c for c in rest if c != time_col]]
        first = events.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
        return first.select(*[F.col(c) if c == key else F.col(f"_r.{c}").alias(c) for c in events.columns])
    if delay:
        return events.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])
    return events.dropDuplicates([key])


def event_store_enrich(events: DataFrame, stores: DataFrame,
                       default_type: str = "C") -> DataFrame:
    """Attach the store's type to each event; unknown stores get
    ``default_type``. The store table is a static dimension, so this is
    also a stream-static join. A store listed twice
    is looked up once (one type per store, the greatest), so events never
    fan out."""
    dim = (stores.groupBy(F.col("Store").alias("store_id"))
           .agg(F.max("Type").alias("_type")))
    j = dim_join(events, dim, on="store_id", how="left")
    return j.withColumn("store_type", F.coalesce(F.col("_type"), F.lit(default_type))).drop("_type")
