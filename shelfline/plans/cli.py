"""Command-line jobs: ``python -m shelfline.plans.cli <job> ...``.

* ``load``     every configured CSV of a folder -> raw tables (explicit mode)
* ``clean``    one CSV -> exact duplicates dropped -> parquet and/or JDBC
* ``models``   raw tables -> staging/intermediate views and the marts
* ``realtime`` event table -> trailing-window tables and the incremental summary
* ``monitor``  event table -> freshness and top-k reports
* ``ingest``   event bus (Kafka or a folder of JSON lines) -> event table
* ``compact``  merge the small files of the event table and its id index
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from ..session import CORE_CONF, sizing_conf


def _session(input_bytes: int | None = None) -> SparkSession:
    spark = SparkSession.builder.appName("shelfline").getOrCreate()
    conf = dict(CORE_CONF)
    if input_bytes:
        cores = spark.sparkContext.defaultParallelism
        conf.update(sizing_conf(input_bytes, cores))
    for k, v in conf.items():
        spark.conf.set(k, v)
    return spark


def _time(text: str) -> dt.datetime:
    t = dt.datetime.fromisoformat(text)
    return t.astimezone(dt.timezone.utc).replace(tzinfo=None) if t.tzinfo else t


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="shelfline")
    ap.add_argument("--input-gb", type=float,
                    help="expected input size, to size shuffles and scan splits")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("load")
    p.add_argument("--raw-dir", required=True)
    p.add_argument("--tables", required=True)
    p.add_argument("--mode", default="upsert", choices=["create", "upsert", "full"])
    p.add_argument("--buckets", type=int, help="hash buckets of the tables' keys, in place of partitions by week")
    p = sub.add_parser("clean")
    p.add_argument("--csv", required=True)
    p.add_argument("--out", help="parquet folder")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-table")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password-env", help="name of the variable holding the password")
    p = sub.add_parser("models")
    p.add_argument("--tables", required=True)
    p.add_argument("--marts", required=True)
    p = sub.add_parser("realtime")
    p.add_argument("--events", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--merge", default="additive", choices=["additive", "replace", "recompute"])
    p.add_argument("--as-of", type=_time, help="report time, ISO (default: the clock, UTC)")
    p = sub.add_parser("monitor")
    p.add_argument("--events", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--as-of", type=_time, help="report time, ISO (default: the clock, UTC)")
    p = sub.add_parser("ingest")
    p.add_argument("--table", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--quarantine")
    p.add_argument("--kafka-servers")
    p.add_argument("--topic", default="sales_events")
    p.add_argument("--inbox", help="folder of JSON-lines files instead of Kafka")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--max-offsets-per-trigger", type=int, default=1_000_000, help="messages of a micro-batch (Kafka)")
    p.add_argument("--max-files-per-trigger", type=int, default=1000, help="files of a micro-batch (inbox)")
    p.add_argument("--v1-table", help="the bus carries both wire versions; table of the first one")
    p.add_argument("--summary", help="table of the hourly summary kept by the stream")
    p.add_argument("--panes", help="table of the alert panes kept by the stream")
    p.add_argument("--customers", help="table of the customer partials kept by the stream")
    p = sub.add_parser("compact")
    p.add_argument("--table", required=True)
    p.add_argument("--target-mb", type=int, default=256)
    a = ap.parse_args(argv)
    spark = _session(int(a.input_gb * (1 << 30)) if a.input_gb else None)

    if a.job == "load":
        from .loader import load_folder
        # Sales and features are partitioned by their week so that a new
        # file rewrites only the weeks it contains.
        parts = {} if a.buckets else {"raw_sales": "Date", "raw_features": "Date"}
        for rep in load_folder(spark, a.raw_dir, a.tables, a.mode, partitions=parts, buckets=a.buckets):
            print(json.dumps(rep, default=str))
    elif a.job == "clean":
        import os
        from ..operators.batch import dedupe_rows
        from ..sources.files import csv_source
        from ..sources.sinks import jdbc_sink, overwrite_sink
        df = dedupe_rows(csv_source(spark, a.csv))
        if a.out:
            overwrite_sink(df, a.out)
        if a.jdbc_url:
            props = {"user": a.jdbc_user} if a.jdbc_user else {}
            if a.jdbc_password_env:
                props["password"] = os.environ[a.jdbc_password_env]
            jdbc_sink(df, a.jdbc_url, a.jdbc_table, mode="overwrite", properties=props)
    elif a.job == "models":
        from ..sources.snapshots import read_table
        from .models import build_batch_models
        raw = [read_table(spark, f"{a.tables.rstrip('/')}/raw_{t}") for t in ("sales", "stores", "features")]
        build_batch_models(spark, *raw, a.marts)
    elif a.job == "realtime":
        from ..streaming.ingest import read_event_table
        from .models import build_realtime_models, materialize_incremental
        events, as_of = read_event_table(spark, a.events), a.as_of or _now()
        build_realtime_models(spark, events, as_of, a.out)
        materialize_incremental(spark, f"{a.out.rstrip('/')}/rt_sales_summary_incremental",
                                events, as_of, a.merge)
    elif a.job == "monitor":
        from ..operators import realtime
        from ..sources.snapshots import SnapshotTable
        from ..streaming.ingest import read_event_table
        events, as_of = read_event_table(spark, a.events), a.as_of or _now()
        for name in ("stream_health", "hourly_performance", "top_stores"):
            SnapshotTable(spark, f"{a.out.rstrip('/')}/{name}").overwrite(getattr(realtime, name)(events, as_of))
    elif a.job == "ingest":
        from ..streaming import ingest, partials, sources
        if a.inbox:
            src = sources.text_file_source(spark, a.inbox, a.max_files_per_trigger)
        else:
            src = sources.kafka_source(spark, a.kafka_servers, a.topic,
                                       max_offsets_per_trigger=a.max_offsets_per_trigger)
        kept = ((a.summary, ingest.summary_hook), (a.panes, partials.pane_hook), (a.customers, partials.customer_hook))
        hooks = [make(path) for path, make in kept if path]
        hook = ingest.all_hooks(*hooks) if hooks else None
        if a.v1_table:
            q = ingest.stream_mixed_ingest(src, a.checkpoint, a.table, a.v1_table, quarantine_path=a.quarantine,
                                           available_now=a.available_now, after_write=hook)
        else:
            q = ingest.stream_ingest(src, a.checkpoint, a.table, quarantine_path=a.quarantine,
                                     available_now=a.available_now, after_write=hook)
        q.awaitTermination()
    elif a.job == "compact":
        from ..streaming.ingest import compact_events
        print(json.dumps({"merged": compact_events(spark, a.table, a.target_mb << 20)}))


if __name__ == "__main__":
    main()
