"""Keyed upsert, load report and key checks.

A keyed upsert is one grouped aggregate over ``target UNION ALL source``:
per key, ``max_by``/``min_by`` pick the winning row by (source rank, load
order). Both are partial-aggregate functions, so even a key that holds a
third of the input is reduced map-side before the shuffle, and no window
sort over a hot key is needed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from .. import schemas as S

LOAD_ORDER = "_load_order"  # as added by the CSV source
_RANK = "_src_rank"
_ORD = "_src_order"


class SchemaChangeError(ValueError):
    """Raised when a merge would change a stored table's columns."""


def schema_change_fail(target: StructType, incoming: StructType,
                       ignore: tuple = ()) -> None:
    """Refuse to merge when column names or types differ."""
    def cols(s):
        return {f.name: f.dataType.simpleString() for f in s.fields if f.name not in ignore}
    a, b = cols(target), cols(incoming)
    if a != b:
        missing = sorted(set(a) - set(b))
        added = sorted(set(b) - set(a))
        changed = sorted(k for k in set(a) & set(b) if a[k] != b[k])
        raise SchemaChangeError(
            f"schema change refused: missing={missing} added={added} changed={changed}")


def key_unique_check(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their row count (empty when the
    declared key holds)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
              .where(F.col("row_count") > 1))


def _aligned(df: DataFrame, columns, types) -> DataFrame:
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c)
                       for c in columns])


def _order_cols(source: DataFrame, keys, order_cols, ts_col: str) -> list:
    if order_cols:
        return list(order_cols)
    if LOAD_ORDER in source.columns:
        return [LOAD_ORDER]
    return [c for c in source.columns if c not in keys and c != ts_col]


FLAG_COLS = ("_had_target", "_touched", "_changed")


def keyed_upsert(target: DataFrame | None, source: DataFrame, keys, update_cols,
                 order_cols=None, ingestion_ts: dt.datetime | None = None,
                 ts_col: str = S.INGESTION_TS, with_flags: bool = False) -> DataFrame:
    """Insert-or-update ``source`` into ``target`` by ``keys``.

    Per key, as a row-by-row ``INSERT ... ON DUPLICATE KEY UPDATE`` would:
    a new key takes the first source row (in load order), then the last
    source row's update columns; an existing key keeps its other columns
    and takes the last source row's values of the update columns *present
    in the source*; ``ts_col`` is stamped with ``ingestion_ts`` on every
    key the source touches. Keys absent from the source are unchanged.

    Spark has no row order, so load order is the ascending order of
    ``order_cols``: by default the ``_load_order`` column of the CSV source
    (which is not stored), or else all non-key source columns.

    ``with_flags`` adds per-key booleans ``_had_target``, ``_touched`` and
    ``_changed`` (update columns differ from the stored ones), computed in
    the same aggregate, so a load can report what it did without a second
    pass (see ``plans.loader``).
    """
    stamp = F.lit(ingestion_ts).cast("timestamp") if ingestion_ts else F.current_timestamp()
    keys = list(keys)
    order_cols = _order_cols(source, keys, order_cols, ts_col)
    present_updates = [c for c in update_cols if c in source.columns]

    types = {f.name: f.dataType for f in source.schema.fields}
    if target is not None:
        types.update({f.name: f.dataType for f in target.schema.fields})
    types[ts_col] = TimestampType()
    columns = list(dict.fromkeys(
        (list(target.columns) if target is not None else [])
        + [c for c in source.columns if c != LOAD_ORDER]))
    if ts_col not in columns:
        columns.append(ts_col)
    others = [c for c in columns if c not in keys and c not in present_updates]

    src = _aligned(source.withColumn(ts_col, stamp).withColumn(_ORD, F.struct(*order_cols)),
                   [*columns, _ORD], types)
    src = src.withColumn(_RANK, F.lit(1))
    parts = [src]
    if target is not None:
        tgt = _aligned(target, columns, types).withColumn(_RANK, F.lit(0))
        tgt = tgt.withColumn(_ORD, F.lit(None).cast(src.schema[_ORD].dataType)).select(*src.columns)
        parts.insert(0, tgt)
    u = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    rank = F.struct(F.col(_RANK), F.col(_ORD))
    aggs = [F.max(_RANK).alias("_touched"), F.min(_RANK).alias("_min_rank")]
    if present_updates:
        aggs.append(F.max_by(F.struct(*present_updates), rank).alias("_upd"))
        if with_flags:
            aggs.append(F.min_by(F.struct(*present_updates), rank).alias("_old"))
    if others:
        aggs.append(F.min_by(F.struct(*others), rank).alias("_keep"))
    g = u.groupBy(*keys).agg(*aggs)

    out = []
    for c in columns:
        if c in keys:
            out.append(F.col(c))
        elif c == ts_col:
            out.append(F.when(F.col("_touched") == 1, stamp)
                        .otherwise(F.col(f"_keep.{c}")).alias(c))
        elif c in present_updates:
            out.append(F.col(f"_upd.{c}").alias(c))
        else:
            out.append(F.col(f"_keep.{c}").alias(c))
    if with_flags:
        had = F.col("_min_rank") == 0
        touched = F.col("_touched") == 1
        same = F.col("_upd").eqNullSafe(F.col("_old")) if present_updates else F.lit(True)
        out += [had.alias("_had_target"), touched.alias("_touched"),
                (had & touched & ~same).alias("_changed")]
    return g.select(*out)


def merge_upsert(target: DataFrame, source: DataFrame, keys, update_cols, order_cols=None,
                 ingestion_ts: dt.datetime | None = None, ts_col: str = S.INGESTION_TS,
                 with_flags: bool = False) -> DataFrame:
    """``keyed_upsert`` into a target that holds each key once, as a join:
    the source is reduced to one row per key and merged with the target by a
    full outer join. On a target bucketed and sorted by ``keys`` only the
    source is shuffled. A NULL in a key equals no stored key, as in a SQL
    unique key (``keyed_upsert`` groups NULLs together)."""
    stamp = F.lit(ingestion_ts).cast("timestamp") if ingestion_ts else F.current_timestamp()
    keys = list(keys)
    order = F.struct(*_order_cols(source, keys, order_cols, ts_col))
    updates = [c for c in update_cols if c in source.columns]
    others = [c for c in source.columns if c not in (*keys, *updates, LOAD_ORDER, ts_col)]
    last, first = F.struct(F.lit(1).alias("_"), *updates), F.struct(F.lit(1).alias("_"), *others)
    s = source.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.max_by(last, order).alias("_new"), F.min_by(first, order).alias("_first"))
    match = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    j = target.withColumn("_had", F.lit(True)).join(s, match, "full_outer")
    had, touched = F.coalesce("_had", F.lit(False)), F.col("_new").isNotNull()
    out = []
    for c in dict.fromkeys([*target.columns, *others, *updates, ts_col]):
        stored = F.col(c) if c in target.columns else F.lit(None).cast(source.schema[c].dataType) if c != ts_col else F.lit(None)
        if c in keys:
            out.append(F.when(had, stored).otherwise(F.col(f"_k_{c}")).alias(c))
        elif c == ts_col:
            out.append(F.when(touched, stamp).otherwise(stored).alias(c))
        elif c in updates:
            out.append(F.when(touched, F.col(f"_new.{c}")).otherwise(stored).alias(c))
        else:
            out.append((F.when(had, stored).otherwise(F.col(f"_first.{c}")) if c in others else stored).alias(c))
    if with_flags:
        same = F.lit(True)
        for c in updates:
            same = same & (F.col(c).eqNullSafe(F.col(f"_new.{c}")) if c in target.columns else F.col(f"_new.{c}").isNull())
        out += [had.alias("_had_target"), touched.alias("_touched"), (had & touched & ~same).alias("_changed")]
    return j.select(*out)


def report_metrics(flagged: DataFrame):
    """Aggregates over ``keyed_upsert(..., with_flags=True)`` that give the
    load report (for ``DataFrame.observe`` during the write)."""
    had, touched, changed = (F.col(c) for c in FLAG_COLS)
    return [
        F.count(F.when(had, 1)).alias("initial_keys"),
        F.count(F.lit(1)).alias("final_count"),
        F.count(F.when(~had & touched, 1)).alias("new_records"),
        F.count(F.when(changed, 1)).alias("updated_records"),
        F.count(F.when(had & touched & ~changed, 1)).alias("unchanged_records"),
    ]


def load_report(target: DataFrame | None, source: DataFrame, keys, update_cols,
                file_name: str, order_cols=None) -> DataFrame:
    """One row describing what an upsert of ``source`` does to ``target``:
    initial and final row counts, new (inserted) keys, keys whose update
    columns change, keys that stay identical, and the file name.

    Computed as one grouped pass by key plus a global sum, never by
    counting the table before and after.
    """
    keys = list(keys)
    present = [c for c in update_cols if c in source.columns]
    order_cols = _order_cols(source, keys, order_cols, S.INGESTION_TS)
    vals = F.struct(*present) if present else F.lit(None)
    s = source.select(*keys, vals.alias("_v"), F.struct(*order_cols).alias("_o"),
                      F.lit(1).alias("_s"), F.lit(0).alias("_t"))
    parts = s
    if target is not None:
        t = target.select(*keys, vals.alias("_v") if present else F.lit(None).alias("_v"),
                          F.lit(None).cast(s.schema["_o"].dataType).alias("_o"),
                          F.lit(0).alias("_s"), F.lit(1).alias("_t"))
        parts = t.unionByName(s)
    per_key = parts.groupBy(*keys).agg(
        F.sum("_t").alias("t_rows"), F.max("_s").alias("in_src"),
        F.max_by("_v", F.struct("_s", "_o")).alias("new_v"),
        F.min_by("_v", F.struct("_s", "_o")).alias("old_v"))
    has_t = F.col("t_rows") > 0
    touched = F.col("in_src") == 1
    changed = has_t & touched & ~F.col("new_v").eqNullSafe(F.col("old_v"))
    return per_key.agg(
        F.sum("t_rows").alias("initial_count"),
        F.count(F.lit(1)).alias("final_count"),
        F.count(F.when(~has_t & touched, 1)).alias("new_records"),
        F.count(F.when(changed, 1)).alias("updated_records"),
        F.count(F.when(has_t & touched & ~changed, 1)).alias("unchanged_records"),
    ).select(F.coalesce("initial_count", F.lit(0)).cast("bigint").alias("initial_count"),
             "final_count", "new_records", "updated_records", "unchanged_records",
             F.lit(file_name).alias("file_processed"))
