"""Upsert laws, load report, CSV/JSON sources, load modes."""

import datetime as dt
import os
from decimal import Decimal

import pytest

from conftest import rows
from shelfline import schemas as S
from shelfline.operators import upsert as up
from shelfline.plans.loader import load_dataset, load_folder
from shelfline.session import scratch_path
from shelfline.sources import files
from shelfline.sources.snapshots import read_table

T1 = dt.datetime(2025, 1, 1)
T2 = dt.datetime(2025, 1, 2)
KEYS = ["Store"]
UPD = ["Type", "Size"]


def stores(spark, data):
    return spark.createDataFrame(data, "Store int, Type string, Size int")


def test_first_load_dedupes_last_wins(spark):
    # Store 47 twice, as in the shipped stores file.
    src = stores(spark, [(46, "A", 100), (47, "B", 200), (47, "C", 300)])
    out = up.keyed_upsert(None, src, KEYS, UPD, order_cols=["Size"], ingestion_ts=T1)
    assert rows(out, ["Store", "Type", "Size"]) == [(46, "A", 100), (47, "C", 300)]
    dup = up.key_unique_check(src, KEYS).collect()
    assert [(r["Store"], r["row_count"]) for r in dup] == [(47, 2)]


def test_same_file_twice_changes_only_timestamp(spark):
    src = stores(spark, [(1, "A", 100), (2, "B", 200)])
    first = up.keyed_upsert(None, src, KEYS, UPD, ingestion_ts=T1)
    second = up.keyed_upsert(first, src, KEYS, UPD, ingestion_ts=T2)
    assert rows(second, ["Store", "Type", "Size"]) == rows(first, ["Store", "Type", "Size"])
    assert {r["ingestion_ts"] for r in second.collect()} == {T2}
    rep = up.load_report(first, src, KEYS, UPD, "stores.csv").first()
    assert (rep["initial_count"], rep["final_count"], rep["new_records"],
            rep["updated_records"], rep["unchanged_records"]) == (2, 2, 0, 0, 2)


def test_split_file_equals_one_load(spark):
    data = [(i, "ABC"[i % 3], 1000 + i) for i in range(1, 21)]
    whole = up.keyed_upsert(None, stores(spark, data), KEYS, UPD, ingestion_ts=T1)
    part = up.keyed_upsert(None, stores(spark, data[:12]), KEYS, UPD, ingestion_ts=T1)
    part = up.keyed_upsert(part, stores(spark, data[12:]), KEYS, UPD, ingestion_ts=T1)
    assert rows(whole) == rows(part)


def test_update_new_key_and_missing_update_column(spark):
    target = up.keyed_upsert(None, stores(spark, [(1, "A", 100), (2, "B", 200)]), KEYS, UPD,
                             ingestion_ts=T1)
    # The new file has no Size column: Size keeps the stored value.
    src = spark.createDataFrame([(1, "C"), (3, "A")], "Store int, Type string")
    out = {r["Store"]: (r["Type"], r["Size"], r["ingestion_ts"]) for r in
           up.keyed_upsert(target, src, KEYS, UPD, ingestion_ts=T2).collect()}
    assert out == {1: ("C", 100, T2), 2: ("B", 200, T1), 3: ("A", None, T2)}
    rep = up.load_report(target, src, KEYS, UPD, "stores.csv").first()
    assert (rep["new_records"], rep["updated_records"], rep["unchanged_records"],
            rep["final_count"]) == (1, 1, 0, 3)


def test_non_update_column_keeps_first_row(spark):
    # 'Note' is not an update column: a new key keeps its first row's Note,
    # an existing key keeps the stored one.
    src = spark.createDataFrame([(5, "A", 1, "first"), (5, "B", 2, "second")],
                                "Store int, Type string, Size int, Note string")
    out = up.keyed_upsert(None, src, KEYS, UPD, order_cols=["Size"], ingestion_ts=T1).first()
    assert (out["Type"], out["Size"], out["Note"]) == ("B", 2, "first")


def test_schema_change_fail():
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    a = StructType([StructField("x", IntegerType()), StructField("y", StringType())])
    b = StructType([StructField("x", IntegerType())])
    up.schema_change_fail(a, a)
    with pytest.raises(up.SchemaChangeError):
        up.schema_change_fail(a, b)


def test_csv_source_na_bool_date(spark, tmp_path):
    p = tmp_path / "features.csv"
    p.write_text("Store,Date,Temperature,Fuel_Price,MarkDown1,MarkDown2,MarkDown3,MarkDown4,"
                 "MarkDown5,CPI,Unemployment,IsHoliday\n"
                 "1,2010-02-05,42.31,2.572,NA,NA,NA,NA,NA,211.0963582,8.106,FALSE\n"
                 "1,2010-02-12,38.51,2.548,10.5,NA,NA,NA,NA,211.2421698,8.106,TRUE\n")
    df = files.csv_source(spark, str(p), S.RAW_FEATURES)
    r = df.orderBy("Date").collect()
    assert r[0]["Date"] == dt.date(2010, 2, 5) and r[0]["MarkDown1"] is None
    assert r[0]["IsHoliday"] is False and r[1]["IsHoliday"] is True
    assert r[1]["MarkDown1"] == 10.5 and r[0]["Temperature"] == Decimal("42.31")


def test_csv_routing_skips_unknown(spark, tmp_path):
    (tmp_path / "stores.csv").write_text("Store,Type,Size\n1,A,151315\n")
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    routed = files.csv_routing(spark, str(tmp_path))
    assert list(routed) == ["raw_stores"]
    assert routed["raw_stores"].first()["Size"] == 151315


def test_csv_extract_is_landed_by_all_its_tasks(spark, tmp_path):
    folder = str(tmp_path)
    landed = spark.createDataFrame([(i, "A" if i % 2 else None, i * 10) for i in range(40)],
                                   "Store int, Type string, Size int").repartition(4)
    files.land_csv(landed, f"{folder}/Stores.csv")
    (tmp_path / "notes.csv").write_text("a\n1\n")
    assert len(list((tmp_path / "Stores.csv").glob("part-*.csv"))) == 4
    assert [p.rsplit("/", 1)[-1] for p in files.list_files(spark, folder)] == ["Stores.csv", "notes.csv"]
    routed = files.csv_routing(spark, folder)
    assert list(routed) == ["raw_stores"] and rows(routed["raw_stores"]) == rows(landed)
    report = load_folder(spark, folder, scratch_path(spark, "landed"))[0]
    assert (report["file_processed"], report["final_count"]) == ("Stores.csv", 40)
    with pytest.raises(OSError):
        files.land_csv(landed, f"{folder}/Stores.csv")


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        files.csv_dataset(spark, str(tmp_path / "sales.csv"), "raw_sales").collect()


def test_json_flatten_nested(spark, tmp_path):
    p = tmp_path / "products.json"
    p.write_text('{"id": 1, "meta": {"brand": "x", "dims": {"w": 2}}, "tags": ["a", "b"]}\n'
                 '{"id": 2, "meta": {"brand": "y"}}\n')
    flat = files.json_flatten(files.json_records(spark, str(p)))
    assert sorted(flat.columns) == ["id", "meta.brand", "meta.dims.w", "tags"]
    r = {x["id"]: x for x in flat.collect()}
    assert r[1]["meta.dims.w"] == 2 and r[1]["tags"] == ["a", "b"] and r[2]["meta.dims.w"] is None


def test_load_modes_and_partition_overwrite(spark):
    path = scratch_path(spark, "raw_sales_table")
    sales = "Store int, Dept int, Date date, Weekly_Sales decimal(18,2), IsHoliday boolean"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 8)
    a = spark.createDataFrame([(1, 1, d1, Decimal("1.00"), False), (1, 1, d2, Decimal("2.00"), False)], sales)
    rep = load_dataset(spark, a, path, "raw_sales", "create", T1, partition_by="Date", file_name="a.csv")
    assert rep["new_records"] == 2
    with pytest.raises(FileExistsError):
        load_dataset(spark, a, path, "raw_sales", "create", T1)
    b = spark.createDataFrame([(1, 1, d2, Decimal("5.00"), True), (2, 1, d2, Decimal("3.00"), False)], sales)
    rep = load_dataset(spark, b, path, "raw_sales", "upsert", T2, partition_by="Date", file_name="b.csv")
    assert (rep["initial_count"], rep["final_count"], rep["new_records"],
            rep["updated_records"], rep["unchanged_records"]) == (2, 3, 1, 1, 0)
    got = {(r["Store"], r["Date"]): (r["Weekly_Sales"], r["ingestion_ts"])
           for r in read_table(spark, path).collect()}
    assert got == {(1, d1): (Decimal("1.00"), T1), (1, d2): (Decimal("5.00"), T2),
                   (2, d2): (Decimal("3.00"), T2)}
    load_dataset(spark, b, path, "raw_sales", "full", T2, partition_by="Date")
    assert read_table(spark, path).count() == 2
    assert os.path.isdir(path)


def test_observed_report_equals_report_operator(spark):
    path = scratch_path(spark, "raw_stores_table")
    first = stores(spark, [(1, "A", 100), (2, "B", 200), (3, "C", 300)])
    load_dataset(spark, first, path, "raw_stores", "create", T1, file_name="stores.csv")
    second = stores(spark, [(1, "A", 100), (2, "C", 200), (4, "A", 50), (4, "B", 60)])
    stored = read_table(spark, path).checkpoint()
    want = up.load_report(stored, second, KEYS, UPD, "stores.csv").first().asDict()
    got = load_dataset(spark, second, path, "raw_stores", "upsert", T2, file_name="stores.csv")
    assert got == want
    assert (got["new_records"], got["updated_records"], got["unchanged_records"]) == (1, 1, 1)
    final = {r["Store"]: (r["Type"], r["Size"]) for r in read_table(spark, path).collect()}
    assert final == {1: ("A", 100), 2: ("C", 200), 3: ("C", 300), 4: ("B", 60)}


def test_csv_corrupt_rows_kept_aside(spark, tmp_path):
    p = tmp_path / "stores.csv"
    p.write_text("Store,Type,Size\n1,A,151315\ntwo,B,200\n3,C,NA\n")
    df = files.csv_source(spark, str(p), S.RAW_STORES, corrupt_col="_bad")
    r = {x["Type"]: x for x in df.collect()}
    assert r["A"]["_bad"] is None and r["C"]["Size"] is None and r["C"]["_bad"] is None
    assert r["B"]["_bad"] == "two,B,200" and r["B"]["Store"] is None


def test_clean_job(spark, tmp_path):
    from shelfline.plans.cli import main
    p = tmp_path / "sales.csv"
    p.write_text("Store,Dept,Date,Weekly_Sales,IsHoliday\n1,1,2010-02-05,24924.5,FALSE\n"
                 "1,1,2010-02-05,24924.5,FALSE\n1,2,2010-02-05,50605.27,FALSE\n")
    out = str(tmp_path / "clean")
    main(["clean", "--csv", str(p), "--out", out])
    assert spark.read.parquet(out).count() == 2
