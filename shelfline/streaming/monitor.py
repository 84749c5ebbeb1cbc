"""Streaming performance metrics in the long form of the metrics table
(metric_time, metric_name, metric_value, store_id, dept_id).

The figures come from the query's progress reports (a handful of numbers
per micro-batch, kept by Spark on the driver), not from the data.
"""

from __future__ import annotations

import datetime as dt
import json
from collections import deque
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import (DecimalType, IntegerType, StringType, StructField,
                               StructType, TimestampType)

METRICS_SCHEMA = StructType([
    StructField("metric_time", TimestampType()),
    StructField("metric_name", StringType()),
    StructField("metric_value", DecimalType(15, 4)),
    StructField("store_id", IntegerType()),
    StructField("dept_id", IntegerType()),
])


def _num(x):
    return None if x is None else Decimal(str(round(float(x), 4)))


def progress_rows(progress: dict) -> list:
    """Metric rows of one progress report."""
    t = dt.datetime.strptime(progress["timestamp"][:19], "%Y-%m-%dT%H:%M:%S")
    out = [
        (t, "num_input_rows", _num(progress.get("numInputRows")), None, None),
        (t, "input_rows_per_second", _num(progress.get("inputRowsPerSecond")), None, None),
        (t, "processed_rows_per_second", _num(progress.get("processedRowsPerSecond")), None, None),
        (t, "trigger_execution_ms", _num((progress.get("durationMs") or {}).get("triggerExecution")),
         None, None),
    ]
    # Late rows as the state operators count them (after partial
    # aggregation, so per group rather than per event).
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for op in progress.get("stateOperators", []))
    out.append((t, "rows_dropped_by_watermark", _num(dropped), None, None))
    state = sum(op.get("numRowsTotal", 0) for op in progress.get("stateOperators", []))
    out.append((t, "state_rows", _num(state), None, None))
    return out


class ProgressLog(StreamingQueryListener):
    """Every progress report of the session's queries as metric rows.

    Register it with ``spark.streams.addListener`` before the queries start.
    ``drain`` hands over the rows since the last call, for a job to append to
    the metrics table; what is held is bounded by the time between calls
    (``recentProgress`` keeps only the last hundred reports).
    """

    def __init__(self):
        self._rows: deque = deque()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self._rows.extend(progress_rows(json.loads(event.progress.json)))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def drain(self, spark: SparkSession) -> DataFrame:
        rows = [self._rows.popleft() for _ in range(len(self._rows))]
        return spark.createDataFrame(rows, METRICS_SCHEMA)


def stream_metrics(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The progress reports that ``query`` still holds as metric rows (the
    last hundred; see ``ProgressLog`` for all)."""
    rows = [r for p in query.recentProgress for r in progress_rows(p)]
    return spark.createDataFrame(rows, METRICS_SCHEMA)
