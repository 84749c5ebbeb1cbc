"""End-to-end jobs: CSV folder -> raw tables -> marts; events -> rt tables."""

import datetime as dt

from conftest import SF001, rows
from shelfline.operators import batch
from shelfline.plans.loader import load_folder
from shelfline.plans.models import build_batch_models, build_realtime_models
from shelfline.session import scratch_path
from shelfline.sources import fixtures as fx
from shelfline.sources.snapshots import read_table


def test_csv_folder_to_marts(spark):
    root = scratch_path(spark, "jobs")
    # Land the fixtures as CSV files named like the source system's.
    for name, df in (("sales", fx.raw_sales(spark, SF001, with_ts=False)),
                     ("stores", fx.raw_stores(spark, SF001, with_ts=False)),
                     ("features", fx.raw_features(spark, SF001, with_ts=False))):
        df.coalesce(1).write.option("header", True).option("nullValue", "NA").csv(f"{root}/csv/{name}")
    # One folder of *.csv files, as the loader expects.
    import glob
    import os
    import shutil
    os.makedirs(f"{root}/raw", exist_ok=True)
    for name in ("sales", "stores", "features"):
        part = glob.glob(f"{root}/csv/{name}/part-*.csv")[0]
        shutil.copy(part, f"{root}/raw/{name}.csv")
    with open(f"{root}/raw/notes.csv", "w") as f:
        f.write("x\n1\n")
    reps = load_folder(spark, f"{root}/raw", f"{root}/tables", "upsert",
                       ingestion_ts=dt.datetime(2025, 1, 1),
                       partitions={"raw_sales": "Date", "raw_features": "Date"})
    assert sorted(r["table"] for r in reps) == ["raw_features", "raw_sales", "raw_stores"]
    t = f"{root}/tables"
    sales = read_table(spark, f"{t}/raw_sales")
    stores = read_table(spark, f"{t}/raw_stores")
    feats = read_table(spark, f"{t}/raw_features")
    out = build_batch_models(spark, sales, stores, feats, f"{root}/marts")
    # The loaded sales are deduplicated by key, so compare with the models
    # computed on the same loaded tables.
    want = batch.daily_sales(sales)
    assert rows(out["fct_sales_summary"]) == rows(want)
    assert spark.table("int_store_performance").count() == sales.select("Store").distinct().count()
    n_sales = sales.count()
    # Loading the same folder again changes nothing but the load time.
    reps = load_folder(spark, f"{root}/raw", f"{root}/tables", "upsert",
                       ingestion_ts=dt.datetime(2025, 1, 2),
                       partitions={"raw_sales": "Date", "raw_features": "Date"})
    assert all(r["new_records"] == 0 and r["updated_records"] == 0 for r in reps)
    # (re-read: the reload replaced the files the earlier DataFrame listed)
    assert read_table(spark, f"{t}/raw_sales").count() == n_sales


def test_realtime_tables(spark):
    root = scratch_path(spark, "rt")
    ev = fx.stream_sales_events(spark, SF001)
    as_of = fx.as_of(ev)
    out = build_realtime_models(spark, ev, as_of, root)
    assert set(out) == {"rt_sales_summary", "rt_inventory_alerts", "rt_customer_analytics"}
    assert out["rt_sales_summary"].count() > 0


def test_workers_import_the_package_from_any_folder(tmp_path):
    import os
    import subprocess
    import sys
    import textwrap

    from conftest import ROOT
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        import __spark_entry__ as E
        from shelfline.session import build_session
        spark = build_session("local[2]", extra={{"spark.ui.enabled": "false"}})
        E._prepare(spark)

        def columns(batches):
            from shelfline import schemas
            for b in batches:
                yield b.assign(n=len(schemas.SALES_EVENT_COLUMNS))[["n"]]
        print("found", spark.range(1).mapInPandas(columns, "n long").first()[0])
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "found 13" in out.stdout, out.stderr[-2000:]
