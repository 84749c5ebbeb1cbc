"""Load a dataset into a stored raw table with an explicit load mode.

Modes (chosen by the caller, never by a row-count threshold):

* ``create``: the table must not exist; the file becomes the table, with
  duplicate keys resolved (last row in load order wins).
* ``upsert``: keyed upsert into the existing table (created if missing).
* ``full``: drop and rebuild the table from the file.

Every load is one snapshot (``sources.snapshots``): a load that breaks off
leaves the table as it was. Two layouts keep an upsert cheap: with
``partition_by`` only the partitions the file touches are read and rewritten
(extracts of a few weeks); with ``buckets`` the table lies in sorted hash
buckets of its keys, and an upsert shuffles only the file (extracts that touch
all of it). Columns are matched by name: one that the file lacks keeps its
stored values, a new one is added (refused with ``partition_by``, as old
partitions would lack it), and a change of a column's type is refused.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession

from .. import schemas as S
from ..operators.joins import in_partitions
from ..operators.upsert import (FLAG_COLS, SchemaChangeError, key_unique_check, keyed_upsert, merge_upsert,
                                report_metrics)
from ..sources.sinks import rebalanced
from ..sources.snapshots import BucketedTable, SnapshotTable


def refuse_type_change(target: DataFrame, source: DataFrame) -> None:
    """A column that both have must have one type."""
    types = {f.name: f.dataType for f in target.schema.fields}
    changed = [f"{f.name}: {types[f.name].simpleString()} -> {f.dataType.simpleString()}" for f in source.schema.fields
               if f.name in types and types[f.name] != f.dataType]
    if changed:
        raise SchemaChangeError(f"schema change refused: {changed}")


def load_dataset(spark: SparkSession, source: DataFrame, table_path: str, dataset: str,
                 mode: str = "upsert", ingestion_ts: dt.datetime | None = None,
                 partition_by: str | None = None, file_name: str = "",
                 order_cols=None, buckets: int | None = None) -> dict:
    """Load ``source`` into the table at ``table_path``; returns the load
    report as a dict.

    The merge and its report come from one pass: the per-key flags of the
    upsert are totalled by an ``Observation`` while the result is written, so
    the target and the file are read once.
    """
    cfg = S.RAW_TABLES[dataset]
    keys, updates = cfg["keys"], cfg["update_cols"]
    if partition_by and partition_by not in keys:
        raise ValueError("the partition column must be part of the key")
    if partition_by and buckets:
        raise ValueError("a table is partitioned or bucketed, not both")
    if mode not in ("create", "upsert", "full"):
        raise ValueError(f"unknown load mode {mode!r}")
    ts = ingestion_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    table = BucketedTable(spark, table_path) if buckets else SnapshotTable(spark, table_path)
    exists = table.exists()
    if mode == "create" and exists:
        raise FileExistsError(f"{table_path} already exists")

    target = stored = table.read() if mode == "upsert" and exists else None
    if target is not None:
        refuse_type_change(target, source)
        if partition_by:
            target = in_partitions(target, source, partition_by)
    if target is not None and buckets:
        flagged = merge_upsert(target, source, keys, updates, order_cols, ts, with_flags=True)
    else:
        flagged = keyed_upsert(target, source, keys, updates, order_cols, ts, with_flags=True)
    if partition_by:
        flagged = rebalanced(flagged, [partition_by])
    elif buckets and target is None:
        flagged = flagged.repartition(buckets, *keys)
    # Observed directly under the write: a map task that runs again after a
    # lost executor is not counted twice.
    obs = Observation(f"load_{dataset}")
    merged = flagged.observe(obs, *report_metrics(flagged)).drop(*FLAG_COLS)
    if buckets:
        table.write(merged, keys, buckets)
    elif target is not None and partition_by:
        table.replace_parts(merged, [partition_by], rebalance=False)
    else:
        table.overwrite(merged, [partition_by] if partition_by else [], rebalance=False)
    m, untouched = obs.get, 0
    if target is not None and partition_by:
        # Rows of partitions the file does not touch stay as they are
        # (a count of the stored table, answered from file metadata).
        untouched = stored.count() - m["initial_keys"]
    return {"initial_count": m["initial_keys"] + untouched, "final_count": m["final_count"] + untouched,
            "new_records": m["new_records"], "updated_records": m["updated_records"],
            "unchanged_records": m["unchanged_records"], "file_processed": file_name}


def duplicate_keys(source: DataFrame, dataset: str) -> DataFrame:
    """Keys of ``source`` that the load collapses to one row."""
    return key_unique_check(source, S.RAW_TABLES[dataset]["keys"])


def load_folder(spark: SparkSession, folder: str, tables_root: str, mode: str = "upsert",
                ingestion_ts: dt.datetime | None = None, partitions: dict | None = None,
                buckets: int | None = None) -> list:
    """Route every configured CSV in ``folder`` to ``raw_<stem>`` and load it."""
    from ..sources.files import csv_source, list_files, route_csv
    reports = []
    for path in list_files(spark, folder, "*.csv"):
        table = route_csv(path)
        if table is None:
            continue
        src = csv_source(spark, path, S.RAW_SCHEMAS.get(table), load_order=True)
        rep = load_dataset(spark, src, f"{tables_root.rstrip('/')}/{table}", table, mode,
                           ingestion_ts, (partitions or {}).get(table),
                           file_name=path.rsplit("/", 1)[-1], buckets=buckets)
        rep["table"] = table
        reports.append(rep)
    return reports
