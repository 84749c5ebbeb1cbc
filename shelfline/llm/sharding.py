"""Sharding by jump consistent hashing.

The stable key of a row is the first 64 bits of the MD5 of its id as text,
so any engine can recompute it. Jump consistent hashing turns key and shard
count into a shard without a ring table; one more shard takes about
``1 / (n + 1)`` of the rows, all into itself.

Slots number the rows of a shard without gaps, in the order (bucket, id,
size, CRC). The bucket is taken from the MD5 of id, size and CRC. Slots come
from counts per (shard, bucket) and a running sum inside each of the 4096
buckets of a shard, so no task holds a shard; equal rows are numbered as one
counted row, and different texts of one id fall into different buckets, so no
task holds a hot id either.

Defined cases: a null id is the key of the empty string; a null text has
no bytes (size 1, CRC 0); equal rows get different slots; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hex_long

BUCKET_DIGITS = 3  # 4096 slot buckets in a shard
CHUNK_SLOTS = 65_536  # slots of one counted row that one row expands to


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """Jump consistent hash of 64-bit keys into ``0 .. n_shards - 1``."""
    k = keys.astype(np.uint64)
    shard = np.zeros(len(k), np.int64)
    jump = np.zeros(len(k), np.int64)
    todo = np.arange(len(k))
    while len(todo):
        shard[todo] = jump[todo]
        k[todo] = k[todo] * np.uint64(2862933555777941757) + np.uint64(1)
        step = 2.0**31 / ((k[todo] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        jump[todo] = ((shard[todo] + 1) * step).astype(np.int64)
        todo = todo[jump[todo] < n_shards]
    return shard


def shard_of(key: Column, n_shards: int) -> Column:
    """Shard (int) of a 64-bit key column."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")

    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64).view(np.uint64), n_shards).astype(np.int32))
    return jump(key)


def _digest(id_col: str) -> Column:
    return F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def shard_rows(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with a column ``shard``; every other column is kept."""
    return docs.withColumn("shard", shard_of(hex_long(_digest(id_col), 1, 16), n_shards))


def shard_manifest(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: its shard, its slot there and its shard after
    one more shard is appended."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    # Equal rows become one counted row before the shuffle.
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size", "text_crc32")
    rows = (rows.withColumn("key", hex_long(_digest("doc_id"), 1, 16))
            .withColumn("bucket", hex_long(F.md5(row.cast("binary")), 1, BUCKET_DIGITS).cast("int"))
            .withColumn("shard", shard_of(F.col("key"), n_shards)))
    # At most n_shards * 4096 rows, whatever the input: a bounded broadcast.
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("shard", "bucket").agg(F.sum("n").alias("n"))
               .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    inside = (Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    first = F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    # A count expands in two steps, chunks and their slots, so that the slots
    # of a hot row are made by many tasks.
    chunks = (rows.join(F.broadcast(offsets), ["shard", "bucket"])
              .withColumn("first", first).withColumn("end", F.col("first") + F.col("n"))
              .select("doc_id", "size", "text_crc32", "shard", "key", "end",
                      F.explode(F.sequence("first", F.col("end") - 1, F.lit(CHUNK_SLOTS).cast("long"))).alias("first"))
              .repartition("doc_id", "size", "text_crc32", "first"))
    last = F.least(F.col("first") + CHUNK_SLOTS, F.col("end")) - 1
    return (chunks
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    F.explode(F.sequence("first", last)).alias("slot"), "key")
            .withColumn("grown_shard", shard_of(F.col("key"), n_shards + 1))
            .drop("key"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 16, id_col: str = "doc_id",
                 files_per_shard: int = 16) -> None:
    """Write ``docs`` (all columns) to ``path/shard=<n>/``.

    A shard is dealt over ``files_per_shard`` tasks by the hash of its id.
    """
    part = F.pmod(F.xxhash64(id_col), F.lit(files_per_shard))
    (shard_rows(docs, n_shards, id_col)
     .repartition(n_shards * files_per_shard, F.col("shard"), part)
     .write.partitionBy("shard").parquet(path))


# The CRC table is built from its rule, then bytes are folded in order.
ORACLE_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n::BIGINT] || range(8),
      lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS n))),
base AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size,
    xor(list_reduce([4294967295::BIGINT] || list_transform(
          regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
          lambda h: ('0x' || h)::BIGINT),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
    md5(coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents, crc_table),
keyed AS (SELECT *, row_number() OVER () AS rid, ('0x' || substr(h, 1, 16))::UBIGINT AS k,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || size || ':' || text_crc32), 1, 3))::INT AS bucket FROM base),
jump AS (
  SELECT rid, n, k::HUGEINT AS k, 0::BIGINT AS b, 0::BIGINT AS j FROM keyed, (VALUES (16), (17)) v(n)
  UNION ALL
  SELECT rid, n, k2 AS k, j AS b,
    trunc((j + 1) * (2147483648::DOUBLE / ((k2 >> 33) + 1)::DOUBLE))::BIGINT AS j
  FROM (SELECT rid, n, j, (k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT AS k2
        FROM jump WHERE j < n)),
shards AS (
  SELECT rid, max(b) FILTER (n = 16)::INT AS shard, max(b) FILTER (n = 17)::INT AS grown_shard
  FROM jump GROUP BY rid)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, size, text_crc32) - 1 AS slot,
  grown_shard
FROM keyed JOIN shards USING (rid)
"""
