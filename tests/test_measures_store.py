"""Measures under slicers, previous-month semantics with gaps, and the materialised store."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.plans import measures as M
from ledgerlens.plans import store


def _fact(spark):
    rows = []
    # months 2024-01, 2024-02, (gap in 2024-03), 2024-04
    for m, n in ((1, 3), (2, 2), (4, 4)):
        for i in range(n):
            rows.append((dt.date(2024, m, 1 + i), "SUCCESS" if i % 2 == 0 else "FAILED", 1000 + i, 100 * (m + i),
                         "CAT" + str(i % 2), 2024))
    return spark.createDataFrame(rows, "txn_date date, status string, amount_cents long, revenue_cents long, "
                                       "merchant_category string, txn_year int") \
        .withColumn("is_success", F.when(F.col("status") == "SUCCESS", 1).otherwise(0))


def test_previous_month_leaves_gap_blank(spark):
    out = {r.year_month: r for r in M.previous_month(_fact(spark), "transactions").collect()}
    assert out["2024-02"].transactions_pm == 3.0
    assert out["2024-04"].transactions_pm is None          # March has no rows: DATEADD gives blank
    assert out["2024-02"].transactions_mom_pct == round(100 * (2 - 3) / 3, 4)


def test_measure_query_with_slicers(spark):
    f = _fact(spark)
    got = {r.merchant_category: r.total_transactions for r in
           M.measure_query(f, ["total_transactions"], by=["merchant_category"],
                           slicers={"txn_year": [2024], "status": "SUCCESS"}).collect()}
    assert got == {"CAT0": 5}
    one = M.measure_query(f, ["total_transactions", "total_revenue"]).collect()[0]
    assert one.total_transactions == 9
    assert one.total_revenue == sum(r.revenue_cents for r in f.collect()) / 100


def test_store_writes_once_and_reads_back(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(10).withColumn("k", (F.col("id") % 3).cast("string"))
    a = store.materialized(spark, "unit_test_table", [f"{SF_SMALL}/region.parquet"], build, partition_by="k")
    b = store.materialized(spark, "unit_test_table", [f"{SF_SMALL}/region.parquet"], build, partition_by="k")
    assert len(calls) == 1
    assert a.columns == ["id", "k"] and sorted(r.id for r in b.collect()) == list(range(10))


def test_store_sees_files_added_in_folders(spark, tmp_path):
    src = f"{tmp_path}/t.parquet"
    spark.range(5).write.parquet(f"{src}/part=1")

    def read():
        return store.materialized(spark, "unit_test_nested", [src], lambda: spark.read.parquet(src).select("id"))
    assert read().count() == 5
    spark.range(7).write.parquet(f"{src}/part=2")
    assert read().count() == 12


def test_slicers_take_nothing_as_all_and_null_as_a_value(spark):
    f = spark.createDataFrame([(1, "a", 2024), (2, None, 2024), (3, "b", 2023)], "id int, c string, txn_year int")
    ids = lambda s: sorted(r.id for r in M.apply_slicers(f, s).collect())
    assert ids({"c": []}) == [1, 2, 3] and ids({"c": ["a", None]}) == [1, 2] and ids({"c": None}) == [2]
    assert ids({"c": ["b"], "txn_year": [2024]}) == [] and ids({"txn_year": 2024}) == [1, 2]


def test_matrices_keep_what_is_not_listed(spark):
    from ledgerlens.plans import visuals as P
    e = spark.createDataFrame([("P", "x", "FAILED", "S", "C1", 100), ("P", "y", "FAILED", "S", "C2", 100), ("P", None, "FAILED", "S", "C2", 5),
                               ("P", None, "SUCCESS", "S", "C1", 300), ("P", None, "SUCCESS", "S", None, 50)],
                              "bank_type string, failure_reason string, status string, customer_state string, merchant_category string, amount_cents long")
    assert P.bank_type_reason_matrix(e, ["x"]).first().asDict() == {"bank_type": "P", "x": 1, "other": 2}
    assert P.state_category_matrix(e, ["C1"]).first().asDict() == {"customer_state": "S", "C1": 3.0, "other": 0.5}


def test_year_slicer_prunes_month_folders(spark, tmp_path):
    rows = [(f"{y}-{m:02d}", y, i) for i, (y, m) in enumerate((y, m) for y in (2022, 2023) for m in range(1, 13))]
    spark.createDataFrame(rows, "txn_year_month string, txn_year int, id int").write.partitionBy("txn_year_month").parquet(f"{tmp_path}/f")
    kept = M.apply_slicers(spark.read.parquet(f"{tmp_path}/f"), {"txn_year": [2023]})
    assert kept.count() == 12 and "PartitionFilters: [isnotnull(txn_year_month" in kept._jdf.queryExecution().toString()
