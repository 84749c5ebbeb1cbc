"""The incremental hourly summary as a log of runs.

Each run commits, in one manifest, its rows (partitioned by ``sale_date``)
and a note of what the log has seen: the newest event time of every date, the
newest arrival and the lower bound of the first run. Nothing is merged on write; the
reader adds runs up, starting for each key at the last run that replaces it.
A run that breaks off leaves no note and no rows, so the next one finds the
same new events.

New events are those past the mark of *their* date: a run that stopped after
the newest date cannot hide older ones. The marks become literal intervals of
the event time, so row groups that hold nothing new are skipped by their
statistics; nothing is scanned to find the marks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.time import PARTITION_DATE, since, to_timedelta
from ..operators.batch import weighted_avg
from ..operators.incremental import SUM_COLS, SUMMARY_COLUMNS, touched_events
from ..operators.realtime import HOUR_KEYS, hourly_summary
from ..sources.snapshots import SnapshotTable
from ..streaming.epochs import fold_parts

FOLD = 32  # runs of a date that are read as they are; beyond, they are folded into one
MAX_INTERVALS = 1000
DAY = dt.timedelta(days=1)
RUN, REPLACES, ARRIVED = "_run", "_replaces", "_arrived"
REST = [c for c in SUMMARY_COLUMNS if c not in HOUR_KEYS]


def new_events(events: DataFrame, marks: dict[dt.date, dt.datetime], floor: dt.datetime) -> DataFrame:
    """Events after the mark of their date; on dates without one, events at
    or after ``floor``."""
    def past(lo: Column, strict: bool, hi: dt.datetime | None) -> Column:
        t = F.col("event_time")
        c = t > lo if strict else t >= lo
        return c if hi is None else c & (t < F.lit(hi))
    if not marks:
        return events.where(past(F.lit(floor), False, None))
    if len(marks) > MAX_INTERVALS:
        known = events.sparkSession.createDataFrame(sorted(marks.items()), "_date date, _mark timestamp")
        j = events.join(F.broadcast(known), F.to_date("event_time") == F.col("_date"), "left")
        later = F.col("event_time") > F.col("_mark")
        return j.where(F.coalesce(later, F.col("event_time") >= F.lit(floor))).drop("_date", "_mark")
    midnight = {d: dt.datetime.combine(d, dt.time()) for d in marks}
    days = sorted(marks)
    cond = past(F.lit(floor), False, midnight[days[0]])
    for d, after in zip(days, [*days[1:], None], strict=True):
        # From the mark to the next date that has one.
        cond = cond | past(F.lit(marks[d]), True, midnight[after] if after else None)
    out = events.where(cond)
    if PARTITION_DATE in events.columns:
        out = out.where(F.col(PARTITION_DATE) >= F.lit(min(floor.date(), days[0])))
    return out


class SummaryLog:
    def __init__(self, spark: SparkSession, path: str):
        self.table = SnapshotTable(spark, path)

    def _note(self) -> dict | None:
        """What the runs have noted; the last one carries the others'."""
        return max((n for n in self.table.meta().values() if "run" in n), key=lambda n: n["run"], default=None)

    def marks(self) -> dict[dt.date, dt.datetime]:
        """Newest event time of each date over all runs."""
        marks = (self._note() or {"marks": {}})["marks"]
        return {dt.date.fromisoformat(d): dt.datetime.fromisoformat(t) for d, t in marks.items()}

    def run(self, events: DataFrame, as_of: dt.datetime, merge: str = "additive", lookback="24 hours") -> None:
        """Add the events that are new since the last run.

        ``additive`` adds their figures, ``replace`` lets them stand for the
        keys they touch, ``recompute`` rebuilds the keys of events that
        *arrived* (``processed_at``) after the last run from all events."""
        if merge not in ("additive", "replace", "recompute"):
            raise ValueError(f"unknown merge mode {merge!r}")
        last, arrival = self._note(), F.max("processed_at").alias(ARRIVED)
        before = self.marks()
        if not last:
            floor = as_of - to_timedelta(lookback)
            rows = hourly_summary(since(events, as_of, lookback), as_of, arrival)
        elif merge == "recompute":
            floor, fresh = dt.datetime.fromisoformat(last["floor"]), events
            if last["arrived"]:
                fresh = events.where(F.col("processed_at") > F.lit(dt.datetime.fromisoformat(last["arrived"])))
            rows = hourly_summary(touched_events(events, fresh), as_of, arrival)
        else:
            floor = dt.datetime.fromisoformat(last["floor"])
            rows = hourly_summary(new_events(events, before, floor), as_of, arrival)
        n = last["run"] + 1 if last else 1

        def note(written: DataFrame) -> dict:
            dates = written.groupBy("sale_date").agg(F.max("latest_transaction_time").alias("m"), F.max(ARRIVED).alias("a")).collect()
            arrived = [r["a"].isoformat() for r in dates if r["a"]]
            if last and last["arrived"]:
                arrived.append(last["arrived"])
            marks = {**before, **{r["sale_date"]: max(r["m"], before.get(r["sale_date"], r["m"])) for r in dates if r["sale_date"]}}
            return {"run": n, "merge": merge, "as_of": as_of.isoformat(), "floor": floor.isoformat(),
                    "arrived": max(arrived, default=None), "marks": {d.isoformat(): t.isoformat() for d, t in sorted(marks.items())}}
        rows = rows.select(*SUMMARY_COLUMNS, ARRIVED).withColumn(RUN, F.lit(n))
        self.table.put(rows.withColumn(REPLACES, F.lit(bool(last) and merge != "additive")), f"run-{n:08d}",
                       ["sale_date"], meta=note, forget=[f"run-{n - 1:08d}"])
        fold_parts(self.table, lambda r: (
            _resolve(r).withColumn(ARRIVED, F.lit(None).cast("timestamp")).withColumn(RUN, F.lit(n))
            .withColumn(REPLACES, F.lit(False))), FOLD)

    def read(self) -> DataFrame:
        """One row per key."""
        return _resolve(self.table.read())


def _resolve(rows: DataFrame) -> DataFrame:
    base = rows.where(REPLACES).groupBy(*HOUR_KEYS).agg(F.max(RUN).alias("_base"))
    base = base.select("_base", *[F.col(k).alias(f"_b_{k}") for k in HOUR_KEYS])
    same = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in HOUR_KEYS]
    live = rows.join(base, same, "left").where(F.col("_base").isNull() | (F.col(RUN) >= F.col("_base")))
    g = live.groupBy(*HOUR_KEYS).agg(
        *[F.sum(c).alias(c) for c in SUM_COLS], F.max("latest_transaction_time").alias("latest_transaction_time"),
        F.max_by("last_updated", RUN).alias("last_updated"))
    out = {c: F.col(c).cast("bigint").alias(c) for c in SUM_COLS}
    out["total_sales"] = F.col("total_sales").cast("decimal(20,2)").alias("total_sales")
    out["avg_transaction_value"] = weighted_avg(F.col("total_sales"), F.col("transaction_count"),
                                                S.MONEY).alias("avg_transaction_value")
    return g.select(*HOUR_KEYS, *[out.get(c, F.col(c)) for c in REST])
