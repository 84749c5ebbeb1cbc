"""Tables kept by a stream as rows per epoch, resolved on read.

A micro-batch only appends its own rows (under its epoch's key, so a replay
replaces them) and reads nothing back; the reader merges the rows of all
epochs. When more than ``FOLD`` epochs have piled up in a partition, the writer
folds those of that partition into one, so a read stays cheap, each row is
rewritten rarely and days that no longer change are left alone. The merge must
give the same result on folded and unfolded rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.snapshots import SnapshotTable

FOLD = 32


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the checkpoint keeps for its query across restarts."""
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(line)["id"].replace("-", "")


def epoch_key(spark: SparkSession, checkpoint: str, epoch: int) -> str:
    return f"q{query_id(spark, checkpoint)}-{epoch}"


def fold_parts(table: SnapshotTable, fold: Callable[[DataFrame], DataFrame], most: int) -> None:
    """Merge the entries of each partition that has more than ``most``."""
    by_part: dict[str, list[dict]] = {}
    for e in table.entries():
        by_part.setdefault(e["part"], []).append(e)
    old = [e for own in by_part.values() if len(own) > most for e in own]
    if old:
        rows = table.read(entries=old)
        table.replace(old, fold(rows).select(*rows.columns))


def append_epoch(table: SnapshotTable, rows: DataFrame, key: str, fold: Callable[[DataFrame], DataFrame],
                 partition_by: tuple = ()) -> None:
    """Store the rows of an epoch; fold the epochs where they are many."""
    table.put(rows, key, partition_by)
    fold_parts(table, fold, FOLD)


def started(w, checkpoint: str, processing_time: str | None, available_now: bool, mode: str = "append",
            query_name: str | None = None) -> StreamingQuery:
    """Start a stream writer; the checkpoint is required."""
    if not checkpoint:
        raise ValueError("a checkpoint location is required")
    w = w.outputMode(mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
