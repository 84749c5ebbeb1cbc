"""Stream ingest: parse -> type -> contract -> dedupe -> store.

Nothing is dropped silently: every parsed row is checked against the
contract, and rows that fail it (malformed JSON included) go to the
quarantine with their raw text.

An event id is stored once, whatever its time: of the copies in one batch
the first to arrive is kept, and ids already stored are left out by the
id index (``id_index``), of which a batch reads its own buckets only. The
optional ``dedupe_delay`` adds Spark's watermark dedupe, which keeps state
bounded but *drops* events arriving later than the delay; use it only where
that loss is acceptable.

The event table is a snapshot table (``sources.snapshots``) partitioned by
``event_date``. A micro-batch is stored under the key ``<query>-<epoch>``; the
query part is the streaming query's id, which its checkpoint keeps. Quarantine,
hooks and index are written first, each replacing what the same key held
before; publishing the events is the commit. A replayed epoch that was
committed is skipped, one that was not is written again, and a run with
another checkpoint never touches what an earlier one stored. Write errors are
not swallowed; the query stops and the checkpoint does not advance past a
batch that was not stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import schemas as S
from ..operators import events as ev
from ..operators import wire
from ..operators.incremental import merged_summary, summary_partials
from ..sources.snapshots import SnapshotTable, compact
from .epochs import epoch_key, started
from .id_index import IdIndex

BATCH_COL = "batch_id"
DATE_COL = "event_date"
RAW_COL = "raw"


def ingest_plan(messages: DataFrame, schema: StructType = S.EVENT_V2_WIRE,
                value_col: str = "value", dedupe_delay: str | None = None,
                contract: S.Contract = S.SALES_EVENT_CONTRACT) -> DataFrame:
    """The per-row part of the ingest, for batch or stream input: the stored
    columns and the raw text of every message. Columns that ``schema`` lacks
    take the contract's defaults (a field missing in a message stays NULL)."""
    texts = messages.withColumn(RAW_COL, F.col(value_col).cast("string"))
    parsed = ev.cast_event_time(ev.parse_event_json(texts, schema, value_col, keep=(RAW_COL,)))
    rows = ev.event_projection(ev.contract_defaults(parsed, contract), keep=(RAW_COL,))
    if dedupe_delay and rows.isStreaming:
        rows = ev.event_id_dedupe(rows, delay=dedupe_delay)
    return rows


def read_event_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored events, with their partition column ``event_date``."""
    return SnapshotTable(spark, path).read()


def summary_hook(summary_path: str):
    """An ``after_write`` hook that adds the hourly summary of each
    micro-batch to a table of partial summaries, partitioned by ``sale_date``.
    A replayed batch replaces its own partials and nothing is read back; late
    events count. ``read_summary`` adds the partials up."""
    def hook(rows: DataFrame, batch_key) -> None:
        SnapshotTable(rows.sparkSession, summary_path).put(summary_partials(rows), f"{batch_key}", ["sale_date"])
    return hook


def all_hooks(*hooks):
    """One ``after_write`` hook that calls several; the rows are kept for them."""
    def hook(rows: DataFrame, batch_key) -> None:
        kept = rows.persist()
        try:
            for each in hooks:
                each(kept, batch_key)
        finally:
            kept.unpersist()
    return hook


def read_summary(spark: SparkSession, summary_path: str, table_path: str | None = None) -> DataFrame:
    """The summary kept by ``summary_hook``; with ``table_path`` only of the
    batches that the event table holds (an abandoned checkpoint may have left
    partials of a batch it never committed)."""
    committed = SnapshotTable(spark, table_path).keys() if table_path else None
    partials = SnapshotTable(spark, summary_path).read(lambda e: committed is None or e["key"] in committed)
    return merged_summary(partials)


def _first_arrivals(good: DataFrame) -> DataFrame:
    """One row per event id: the first in the order the source gave them."""
    cols = good.columns
    placed = good.withColumn("_arrival", F.monotonically_increasing_id())
    return (placed.groupBy("event_id").agg(F.min_by(F.struct(*cols), "_arrival").alias("r"))
            .select("r.*"))


def id_index(spark: SparkSession, table_path: str) -> IdIndex:
    """The index of the ids stored in an event table."""
    return IdIndex(spark, f"{table_path.rstrip('/')}/_ids")


def _checked(rows: DataFrame, contract: S.Contract, where: Column | None = None) -> DataFrame:
    """Typed rows with the rules they break (NULL for rows not ``where``);
    only rejected rows keep their raw text, so what a batch holds in memory
    is its typed columns."""
    checked = ev.contract_check(rows, contract)
    if where is not None:
        checked = checked.withColumn("failed_rules", F.when(where, F.col("failed_rules")))
    return checked.withColumn(RAW_COL, F.when(F.size("failed_rules") > 0, F.col(RAW_COL)))


def _store_batch(rows: DataFrame, key: str, table_path: str, quarantine_path: str | None, contract: S.Contract,
                 dedupe_against_table: bool, after_write=None) -> None:
    """Check, dedupe and store one micro-batch of typed rows under ``key``."""
    if key in SnapshotTable(rows.sparkSession, table_path).keys():
        return
    checked = _checked(rows, contract).persist()
    try:
        _store_checked(checked, key, table_path, quarantine_path, dedupe_against_table, after_write)
    finally:
        checked.unpersist()


def _store_checked(checked: DataFrame, key: str, table_path: str, quarantine_path: str | None,
                   dedupe_against_table: bool, after_write=None) -> None:
    """Dedupe and store the checked rows of a micro-batch under ``key``."""
    spark = checked.sparkSession
    table, index = SnapshotTable(spark, table_path), id_index(spark, table_path)
    committed = table.keys()
    if key in committed:
        return
    ok = F.size("failed_rules") == 0
    if quarantine_path:
        checked.where(~ok).write.mode("overwrite").parquet(f"{quarantine_path}/{BATCH_COL}={key}")
    new = _first_arrivals(checked.where(ok).drop("failed_rules", RAW_COL)).withColumn(DATE_COL, F.to_date("event_time"))
    kept = []
    try:
        if dedupe_against_table:
            # Kept for the lookup of stored ids and the writes (a micro-batch
            # is bounded by the trigger, e.g. maxOffsetsPerTrigger).
            kept.append(new.persist())
            new = index.drop_stored(new, committed)
            if new is not kept[0]:
                kept.append(new.persist())  # looked up once, for all writes
            index.add(new, key)
        if after_write is not None:
            after_write(new, key)
        table.put(new, key, [DATE_COL], sort_within=["store_id", "event_time"])
    finally:
        for rows in reversed(kept):
            rows.unpersist()


def _batch_writer(checkpoint: str, table_path: str, quarantine_path: str | None, contract: S.Contract,
                  dedupe_against_table: bool, after_write=None):
    def write(batch: DataFrame, epoch_id: int) -> None:
        key = epoch_key(batch.sparkSession, checkpoint, epoch_id)
        _store_batch(batch, key, table_path, quarantine_path, contract, dedupe_against_table, after_write)
    return write


FIRST = "first_generation"  # the typed event of a first-generation message


def _mixed_rows(messages: DataFrame, contract: S.Contract) -> DataFrame:
    """Parsed messages of both versions as typed rows: a first-generation
    event is in ``FIRST``, all others are checked. The VARIANT is let go."""
    first = F.coalesce(F.col(wire.VERSION) == 1, F.lit(False))
    typed = messages.select(RAW_COL, F.when(first, F.struct(*wire.wire_columns(S.EVENT_V1_WIRE))).alias(FIRST),
                            *wire.wire_columns(S.EVENT_V2_WIRE, ~first))
    rows = ev.event_projection(ev.cast_event_time(typed), keep=(RAW_COL, FIRST))
    return _checked(rows, contract, F.col(FIRST).isNull())


def _mixed_writer(checkpoint: str, table_path: str, v1_path: str, quarantine_path: str | None, contract: S.Contract,
                  after_write=None):
    def write(batch: DataFrame, epoch_id: int) -> None:
        key = epoch_key(batch.sparkSession, checkpoint, epoch_id)
        rows = _mixed_rows(batch, contract).persist()
        try:
            first = wire.typed_v1(rows.where(F.col(FIRST).isNotNull()).select(f"{FIRST}.*"))
            SnapshotTable(batch.sparkSession, v1_path).put(first.withColumn(DATE_COL, F.to_date("event_time")), key, [DATE_COL])
            _store_checked(rows.where(F.col(FIRST).isNull()).drop(FIRST), key, table_path, quarantine_path, True, after_write)
        finally:
            rows.unpersist()
    return write


def stream_mixed_ingest(messages: DataFrame, checkpoint: str, table_path: str, v1_path: str, value_col: str = "value",
                        quarantine_path: str | None = None, processing_time: str | None = "10 seconds",
                        available_now: bool = False, contract: S.Contract = S.SALES_EVENT_CONTRACT,
                        query_name: str | None = None, after_write=None) -> StreamingQuery:
    """Ingest a bus that carries both wire versions. Each message is parsed
    once; first-generation events go to their own table as they are (that
    job had no checks), all others take the way of ``stream_ingest``."""
    texts = messages.withColumn(RAW_COL, F.col(value_col).cast("string"))
    rows = wire.parse_wire(texts, value_col, keep=(RAW_COL,))
    writer = _mixed_writer(checkpoint, table_path, v1_path, quarantine_path, contract, after_write)
    return started(rows.writeStream.foreachBatch(writer), checkpoint, processing_time, available_now, query_name=query_name)


def compact_events(spark: SparkSession, table_path: str, target_bytes: int = 256 << 20) -> int:
    """Merge the small files of each day and of each bucket of the id index;
    the number of file groups that went."""
    n = compact(spark, table_path, target_bytes, ["store_id", "event_time"])
    return n + id_index(spark, table_path).compact(SnapshotTable(spark, table_path).keys())


def stream_ingest(messages: DataFrame, checkpoint: str, table_path: str,
                  schema: StructType = S.EVENT_V2_WIRE, value_col: str = "value",
                  quarantine_path: str | None = None, dedupe_delay: str | None = None,
                  dedupe_against_table: bool = True,
                  processing_time: str | None = "10 seconds",
                  available_now: bool = False,
                  contract: S.Contract = S.SALES_EVENT_CONTRACT,
                  query_name: str | None = None, after_write=None) -> StreamingQuery:
    """Start the ingest query. ``checkpoint`` is required and must be on
    shared storage. ``available_now`` drains what is there and stops
    (backfill, tests); otherwise a micro-batch runs every
    ``processing_time``. ``after_write(rows, batch key)`` gets the rows of
    each batch that are about to be stored (e.g. ``summary_hook``)."""
    rows = ingest_plan(messages, schema, value_col, dedupe_delay, contract)
    writer = _batch_writer(checkpoint, table_path, quarantine_path, contract, dedupe_against_table, after_write)
    return started(rows.writeStream.foreachBatch(writer), checkpoint, processing_time, available_now, query_name=query_name)
