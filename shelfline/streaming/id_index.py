"""Ids already stored, as a hash-bucketed table beside the event table.

Each epoch appends its ids to ``buckets`` partition folders by the hash of
the id, sorted by id. A lookup fetches which buckets a batch touches (at most
``buckets`` small integers), which become literals: other buckets are
neither listed nor read, and inside one only the id column. ``buckets`` trades
the files of an epoch against the share that a small batch reads: take more
where triggers are short, and ``compact`` merges them. Epochs that were
indexed but never committed to the event table (an abandoned checkpoint) are
not looked at, so their ids may come again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.snapshots import COMPACTED, Keys, SnapshotTable, compact

BUCKET = "id_bucket"


class IdIndex:
    def __init__(self, spark: SparkSession, path: str, key: str = "event_id", buckets: int = 16):
        self.table, self.key, self.buckets = SnapshotTable(spark, path), key, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def add(self, rows: DataFrame, epoch: str) -> None:
        """Note the ids of an epoch (again: in place of its earlier ones)."""
        self.table.put(rows.select(self.key, self._bucket()), epoch, [BUCKET], sort_within=[self.key])

    def stored(self, rows: DataFrame, committed: Keys) -> DataFrame | None:
        """The index restricted to the buckets of ``rows`` and to epochs in
        ``committed``; None if it holds nothing there."""
        wanted = sorted(r[0] for r in rows.select(self._bucket()).distinct().collect())
        parts = {f"{BUCKET}={b}" for b in wanted}
        found = [e for e in self.table.entries()
                 if e["part"] in parts and (e["key"] in committed or e["key"].startswith(COMPACTED))]
        if not found:
            return None
        return self.table.read(entries=found).where(F.col(BUCKET).isin(wanted))

    def drop_stored(self, rows: DataFrame, committed: Keys) -> DataFrame:
        """``rows`` whose id no committed epoch holds. The stored ids that
        the batch has too are few: they are found first, then left out."""
        stored = self.stored(rows, committed)
        if stored is None:
            return rows
        seen = stored.select(self.key).join(rows.select(self.key), self.key, "left_semi")
        return rows.join(seen, self.key, "left_anti")

    def compact(self, committed: Keys, target_bytes: int = 64 << 20) -> int:
        """Merge the small files of each bucket (committed epochs only)."""
        return compact(self.table.spark, self.table.path, target_bytes, [self.key],
                       lambda e: e["key"] in committed or e["key"].startswith(COMPACTED))
