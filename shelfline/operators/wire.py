"""Messages of several wire versions on one bus.

A message is parsed once, into a VARIANT; its version follows from the
fields it has, and the columns of either version are read from that value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas as S

MESSAGE, VERSION = "message", "wire_version"


def parse_wire(df: DataFrame, value_col: str = "value", keep: tuple = ()) -> DataFrame:
    """``keep``, the message as a VARIANT (NULL if it is no JSON) and its
    wire version: 2 with a store, 1 with a price and no store, else NULL."""
    parsed = F.struct(F.try_parse_json(F.col(value_col).cast("string")).alias(MESSAGE))
    bound = df.select(*keep, F.inline_outer(F.array(parsed)))

    def has(name: str) -> Column:
        return F.try_variant_get(MESSAGE, f"$.{name}", "string").isNotNull()
    version = F.when(has("store_id"), 2).when(has("price"), 1)
    return bound.withColumn(VERSION, version)


def wire_columns(schema: StructType, where: Column | None = None) -> list[Column]:
    """The fields of ``schema`` from the VARIANT; one that is absent or of
    another type is NULL, and so are all of messages that are not ``where``."""
    found = [(f.name, F.try_variant_get(MESSAGE, f"$.{f.name}", f.dataType.simpleString())) for f in schema.fields]
    return [(c if where is None else F.when(where, c)).alias(name) for name, c in found]


def typed_v1(rows: DataFrame, keep: tuple = ()) -> DataFrame:
    """First-generation fields in their stored form (time and money typed)."""
    return rows.select(*keep, "event_id", F.col("event_time").try_cast("timestamp").alias("event_time"), "product_id",
                       "quantity", F.col("price").try_cast(S.MONEY).alias("price"))


def events_v1(messages: DataFrame, keep: tuple = ()) -> DataFrame:
    """First-generation events in their stored form."""
    return typed_v1(messages.where(F.col(VERSION) == 1).select(*keep, *wire_columns(S.EVENT_V1_WIRE)), keep)
