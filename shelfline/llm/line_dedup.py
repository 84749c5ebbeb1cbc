"""Line deduplication over levelled sorted runs, in DataFrame functions only.

A line's key is the line without outer ASCII white space, A-Z lower-cased; it
is known by two XXH64 values of different seeds (128 bits). ``LineRuns`` keeps
the known keys as sorted runs: bucketed tables in the shared folder, sorted
by hash inside a bucket, so runs and batches of one bucket merge without a
shuffle. For each batch of documents

1. its keys are reduced to (hash, documents, largest id),
2. merge-anti-joined with every run: keys in no run are the batch's own run,
   so the runs stay disjoint and each key is stored once,
3. keys that a run holds already go, with their counts, to the log of repeats.

Every ``fan_in`` runs of a level are compacted to one of the next, so a key is
rewritten a logarithmic number of times. A key's documents are those of its
run plus its repeats; the log is added up by key, so a line that a third of
the rows hold is one counted row per batch. More batches can be added at any
time; ``frequent`` reads what is there.

``deduplicate`` deals the documents over batches by the hash of their id,
adds them all, and drops the lines of frequent keys outside their largest id.
Decisions go back to the documents as line numbers per (id, hash of the
text), so texts are shuffled once at most and no list holds a key's documents.

Defined cases: a null or empty text is one empty line; ``\\n`` alone splits, so
``\\r`` is white space; rows that share an id are one document (counted once,
and the holder's rows all keep the line); a null id is one document, smaller
than every other; a line twice in the holder stays twice; if all lines go, the
text is empty; very long texts are split whole; columns named like the added
ones are replaced, others are carried along; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import carried, stored

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["k1", "k2"]
_DOC = ["id_", "t1_", "t2_"]
ADDED = ["n_lines", "n_dropped", "kept"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def _hashes(text: Column, names: list[str]) -> list[Column]:
    """128 bits of ``text``: XXH64 with the usual seed and with another."""
    return [F.xxhash64(text).alias(names[0]), F.xxhash64(F.lit(1), text).alias(names[1])]


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


class LineRuns:
    """The known line keys of a growing set of documents, as sorted runs."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fan_in: int = 2):
        if fan_in < 2:
            raise ValueError("fan_in must be at least 2")
        self.spark, self.fan_in = spark, fan_in
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.repeats: list[DataFrame] = []

    def _write_run(self, keys: DataFrame) -> str:
        """``keys`` as a table of sorted buckets; its name."""
        name = f"line_run_{uuid.uuid4().hex}"
        (keys.write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", scratch_path(self.spark, "line-run")).saveAsTable(name))
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, lines: DataFrame) -> None:
        """Add a batch: rows (k1, k2, id_), repeats allowed. A document id
        belongs to one batch."""
        per_doc = lines.select(*KEY, "id_").distinct()
        keys = per_doc.groupBy(*KEY).agg(F.count("*").alias("docs"), F.max("id_").alias("holder"))
        if self.buckets != int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            keys = keys.repartition(self.buckets, *KEY)  # else grouped by bucket already
        known = self.runs()
        batch = self._write_run(keys)
        if not known:
            self._push(0, batch)
            return
        fresh = self.spark.table(batch)
        for run in known:
            fresh = fresh.join(run.select(*KEY), KEY, "left_anti")
        own = self._write_run(fresh)
        again = self.spark.table(batch).join(self.spark.table(own).select(*KEY), KEY, "left_anti")
        self.repeats.append(stored(again, "line-repeats"))
        self._push(0, own)

    def _push(self, level: int, run: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan_in:
            full, self.levels[level] = self.levels[level], []
            merged = self.spark.table(full[0])
            for name in full[1:]:
                merged = merged.unionByName(self.spark.table(name))
            self._push(level + 1, self._write_run(merged.repartition(self.buckets, *KEY)))

    def frequent(self, min_docs: int) -> DataFrame:
        """Keys (k1, k2) in ``min_docs`` documents or more, with the largest
        id (``holder``)."""
        totals = None
        if self.repeats:
            log = self.repeats[0]
            for more in self.repeats[1:]:
                log = log.unionByName(more)
            totals = log.groupBy(*KEY).agg(F.sum("docs").alias("more"), F.max("holder").alias("later"))
            totals = stored(totals, "line-totals")
        found = []
        for run in self.runs():
            if totals is not None:
                run = run.join(totals, KEY, "left").select(
                    *KEY, (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"),
                    F.greatest("holder", "later").alias("holder"))
            found.append(run.where(F.col("docs") >= min_docs).select(*KEY, "holder"))
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out


def key_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
              batches: int = 4) -> DataFrame:
    """One row per line whose key has ``min_chars`` code points or more:
    batch, the document (id and hash of the text), line number, hash."""
    text = _text(text_col)
    rows = docs.select(F.pmod(F.xxhash64(id_col), F.lit(batches)).cast("int").alias("batch"), F.col(id_col).alias("id_"),
                       *_hashes(text, _DOC[1:]), text.alias("x_"))
    lines = rows.select("batch", *_DOC, F.posexplode(F.split("x_", "\n")).alias("pos", "line"))
    keyed = lines.select("batch", *_DOC, "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select("batch", *_DOC, "pos", *_hashes(F.col("key"), KEY))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 5, min_chars: int = 40,
                batches: int = 4, fan_in: int = 2) -> DataFrame:
    """``docs`` with n_lines (before), n_dropped and kept (the text without
    the dropped lines)."""
    spark = docs.sparkSession
    lines = stored(key_lines(docs, id_col, text_col, min_chars, batches), "line-keys", by=("batch",))
    index = LineRuns(spark, fan_in=fan_in)
    for batch in range(batches):
        index.add(lines.where(F.col("batch") == batch))
    frequent = stored(index.frequent(min_docs), "line-frequent")
    elsewhere = ~F.col("holder").eqNullSafe(F.col("id_"))
    drops = (lines.join(frequent, KEY).where(elsewhere)
             .groupBy(*_DOC).agg(F.collect_set("pos").alias("drop_")))
    # Stored first: the join below then has a plain exchange on both sides,
    # which AQE may split where rows repeat.
    drops = stored(drops, "line-drops").withColumnsRenamed({c: f"d{c}" for c in _DOC})
    text = _text(text_col)
    rows = docs.select(F.struct(*carried(docs, ADDED)).alias("doc_"), F.col(id_col).alias("id_"), text.alias("x_"),
                       *_hashes(text, _DOC[1:]))
    same = F.col("id_").eqNullSafe(F.col("did_")) & (F.col("t1_") == F.col("dt1_")) & (F.col("t2_") == F.col("dt2_"))
    joined = rows.join(drops, same, "left").select("doc_", "x_", "drop_", F.split("x_", "\n").alias("lines_"))
    n = F.size("lines_")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), "drop_")
    kept = F.array_join(F.transform(stay, lambda i: F.get("lines_", i)), "\n")
    return joined.select("doc_.*", n.cast("long").alias("n_lines"),
                         F.when(F.col("drop_").isNull(), 0).otherwise(F.size("drop_")).cast("long").alias("n_dropped"),
                         F.when(F.col("drop_").isNull(), F.col("x_")).otherwise(kept).alias("kept"))


ORACLE_SQL = r"""
WITH l AS (
  SELECT d.rid, d.doc_id, u.pos, u.line,
    translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents) d,
    LATERAL (SELECT unnest(d.s) AS line, generate_subscripts(d.s, 1) AS pos) u),
f AS (
  SELECT key, max(doc_id) AS holder FROM (SELECT DISTINCT key, doc_id FROM l WHERE length(key) >= 40)
  GROUP BY key HAVING count(*) >= 5),
m AS (SELECT l.*, f.key IS NOT NULL AND f.holder IS DISTINCT FROM l.doc_id AS gone FROM l LEFT JOIN f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""
