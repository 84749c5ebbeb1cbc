"""CSV columns are bound by name, the later row of a file wins, and tables
are looked up in the file system Spark uses."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline.sources.snapshots import SnapshotTable, read_table
from shelfline import schemas as S
from shelfline.operators.joins import in_partitions
from shelfline.plans.loader import load_dataset, load_folder
from shelfline.session import scratch_path
from shelfline.sources import files


def _file(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def _stores(spark, root):
    return sorted(tuple(r) for r in read_table(spark, f"{root}/raw_stores").select("Store", "Type", "Size").collect())


def test_missing_and_reordered_columns(spark, tmp_path):
    a = tmp_path / "a"
    b = tmp_path / "b"
    a.mkdir()
    b.mkdir()
    root = scratch_path(spark, "by-name")
    _file(a, "stores.csv", "Store,Type,Size\n1,A,100\n2,B,200\n")
    load_folder(spark, str(a), root)
    _file(b, "stores.csv", "Size,Store\n500,1\n")
    load_folder(spark, str(b), root)
    assert _stores(spark, root) == [(1, "A", 500), (2, "B", 200)]
    with pytest.raises(ValueError, match="not in the schema"):
        files.csv_source(spark, _file(tmp_path, "stores.csv", "Store,Colour\n1,red\n"), S.RAW_STORES)
    empty = files.csv_source(spark, _file(tmp_path, "none.csv", ""), S.RAW_STORES)
    assert empty.count() == 0 and empty.columns == ["Store", "Type", "Size"]


def test_files_with_other_headers_under_one_path_are_refused(spark, tmp_path):
    d = tmp_path / "mixed"
    d.mkdir()
    _file(d, "1.csv", "Store,Type,Size\n1,A,100\n")
    _file(d, "2.csv", "Size,Store,Type\n100,2,B\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        files.csv_source(spark, str(d), S.RAW_STORES).collect()


def test_later_row_of_the_file_wins(spark, tmp_path):
    root = scratch_path(spark, "file-order")
    _file(tmp_path, "stores.csv", "Store,Type,Size\n47,Z,900\n48,A,1\n47,A,100\n")
    load_folder(spark, str(tmp_path), root)
    assert _stores(spark, root) == [(47, "A", 100), (48, "A", 1)]
    _file(tmp_path, "stores.csv", "Store,Type,Size\n48,C,9\n48,B,3\n")
    report = load_folder(spark, str(tmp_path), root)[0]
    assert _stores(spark, root) == [(47, "A", 100), (48, "B", 3)]
    assert (report["new_records"], report["updated_records"], report["unchanged_records"]) == (0, 1, 0)


def test_table_lookup_uses_the_default_file_system(spark, tmp_path):
    conf = spark._jsc.hadoopConfiguration()
    old = conf.get("fs.defaultFS")
    root = scratch_path(spark, "default-fs")
    SnapshotTable(spark, f"{root}/t").overwrite(spark.range(3))
    bare = root.removeprefix("file://").removeprefix("file:")

    def exists(path):
        return SnapshotTable(spark, path).exists()
    assert exists(f"{bare}/t") and not exists(f"{bare}/none")
    try:
        conf.set("fs.defaultFS", "viewfs://shop/")
        conf.set("fs.viewfs.mounttable.shop.link./tables", f"file://{bare}")
        assert exists("/tables/t")
        assert not exists(f"{bare}/t")  # on the local disk only
        SnapshotTable(spark, "/tables/u").put(spark.range(2).withColumn("d", F.col("id") % 2), "k", ["d"])
        assert SnapshotTable(spark, "/tables/u").read().count() == 2
    finally:
        conf.set("fs.defaultFS", old)


def test_touched_partitions_become_literal_filters(spark, tmp_path):
    path = scratch_path(spark, "weeks")
    spark.range(40).select((F.col("id") % 4).alias("k"), "id").write.partitionBy("k").parquet(path)
    stored = spark.read.parquet(path)
    csv = _file(tmp_path, "k.csv", "k\n1\n3\n")
    for rows in (spark.read.option("header", True).csv(csv), spark.createDataFrame([(1,), (3,)], "k int").cache()):
        part = in_partitions(stored, rows, "k")
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [k" in plan and "Join" not in plan
        assert {r.k for r in part.collect()} == {1, 3}


def test_report_counts_the_written_rows(spark):
    path = scratch_path(spark, "report")
    day = dt.date(2024, 1, 1)
    rows = spark.createDataFrame([(1, 1, day, "1.00", False), (2, 1, day, "2.00", False)],
                                 "Store int, Dept int, Date date, Weekly_Sales string, IsHoliday boolean")
    rows = rows.withColumn("Weekly_Sales", F.col("Weekly_Sales").cast("decimal(18,2)"))
    rep = load_dataset(spark, rows, path, "raw_sales", "create", dt.datetime(2024, 1, 2), partition_by="Date")
    assert (rep["final_count"], rep["new_records"]) == (2, 2)
