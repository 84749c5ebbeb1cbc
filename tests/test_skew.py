"""A key holding a third of all rows: results equal a brute-force
computation in plain Python on the small fixture."""

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from conftest import SF001
from shelfline.operators import batch, upsert
from shelfline.sources import fixtures as fx

HOT = 7


def hot_sales(spark):
    s = fx.raw_sales(spark, SF001)
    # Every row of a Dept divisible by 3 (about a third) moves to one store.
    return s.withColumn("Store", F.when(F.col("Dept") % 3 == 0, F.lit(HOT)).otherwise(F.col("Store")))


def q(x, places):
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def test_store_performance_with_hot_store(spark):
    sales = hot_sales(spark)
    stores = fx.raw_stores(spark, SF001)
    feats = fx.raw_features(spark, SF001)
    got = {r["Store"]: r for r in batch.store_performance(sales, stores, feats).collect()}

    st = {}
    for r in stores.collect():
        st.setdefault(r["Store"], []).append(r)
    ft = {}
    for r in feats.collect():
        ft.setdefault((r["Store"], r["Date"]), []).append(r)
    acc = defaultdict(lambda: [0, Decimal(0), Decimal(0), 0, Decimal(0), 0])
    n_hot = 0
    for r in sales.collect():
        n_hot += r["Store"] == HOT
        for s in st.get(r["Store"], [None]):
            for f in ft.get((r["Store"], r["Date"]), [None]):
                a = acc[(r["Store"], s and s["Type"], s and s["Size"])]
                a[0] += 1
                a[1] += r["Weekly_Sales"]
                if f is not None and f["Temperature"] is not None:
                    a[2] += f["Temperature"]
                    a[3] += 1
                if f is not None and f["Fuel_Price"] is not None:
                    a[4] += f["Fuel_Price"]
                    a[5] += 1
    assert n_hot * 4 >= sales.count()  # the hot store really holds about a third
    assert len(got) == len(acc)
    for (store, typ, size), (n, ws, t, tn, fp, fn) in acc.items():
        r = got[store]
        assert (r["Store_Type"], r["Store_Size"], r["total_weeks"], r["total_sales"]) == (typ, size, n, ws)
        assert r["avg_weekly_sales"] == q(ws / n, 6)
        assert r["avg_temperature"] == (q(t / tn, 6) if tn else None)
        assert r["avg_fuel_price"] == (q(fp / fn, 7) if fn else None)


def test_upsert_with_hot_key(spark):
    src = fx.raw_sales_file(spark, SF001, "second")
    hot_date = dt.date(1999, 1, 4)
    src = src.withColumn("hot", F.col("Dept") % 3 == 0)
    src = (src.withColumn("Store", F.when(F.col("hot"), F.lit(HOT)).otherwise(F.col("Store")))
              .withColumn("Dept", F.when(F.col("hot"), F.lit(1)).otherwise(F.col("Dept")))
              .withColumn("Date", F.when(F.col("hot"), F.lit(hot_date)).otherwise(F.col("Date")))
              .drop("hot"))
    keys = ["Store", "Dept", "Date"]
    out = upsert.keyed_upsert(None, src, keys, ["Weekly_Sales", "IsHoliday"],
                              ingestion_ts=dt.datetime(2025, 1, 1))
    want = {}
    for r in src.collect():
        k = (r["Store"], r["Dept"], r["Date"])
        v = (r["Weekly_Sales"], r["IsHoliday"])
        if k not in want or v > want[k]:
            want[k] = v
    got = {(r["Store"], r["Dept"], r["Date"]): (r["Weekly_Sales"], r["IsHoliday"]) for r in out.collect()}
    assert got == want
    assert src.where((F.col("Store") == HOT) & (F.col("Dept") == 1)).count() * 4 >= src.count()
