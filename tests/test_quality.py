"""Audit and cleaning on the injected-defect fixture (FIXTURES part 3, 'messy')."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.plans import quality as C
from ledgerlens.sources import schemas as S


def _messy(spark):
    base = []
    for i in range(1000):
        status = ("SUCCESS", "FAILED", "PENDING")[i % 3]
        base.append([f"T{i:05d}", i % 50, i % 20, i % 5, f"D{i % 4}", f"{100 + i}.50", status,
                     "BANK_DOWN" if status == "FAILED" else None, "UPI",
                     (dt.datetime(2024, 1, 1) + dt.timedelta(minutes=17 * i)).strftime("%Y-%m-%d %H:%M:%S")])
    for i in range(5):
        base[i][5] = "-1"
    for i in range(5, 8):
        base[i][9] = "not-a-date"
    for i in range(8, 10):
        base[i][6] = "succes"
    for i in range(10, 15):
        base[i][5] = None
    rows = base + [list(r) for r in base[:7]]
    return spark.createDataFrame([tuple(r) for r in rows], S.RAW_TRANSACTIONS)


def test_audit_counts_injected_defects(spark):
    rep = {r.check: r.value for r in C.data_quality_report(_messy(spark)).collect()}
    assert rep["rows"] == 1007
    assert rep["duplicate_txn_ids"] == 7
    assert rep["full_duplicate_rows"] == 7
    assert rep["missing_amount"] == 5
    assert rep["non_positive_amount"] == 5 + 5       # 5 originals + their 5 appended copies
    assert rep["invalid_timestamps"] == 3 + 2        # rows 5..7 and the copies of 5, 6
    assert rep["invalid_status"] == 2
    assert list(rep) == list(C.AUDIT_CHECKS)


def test_cleaning_log_and_no_remaining_issues(spark):
    messy = _messy(spark)
    log = {r.action: r.rows_dropped for r in C.cleaning_actions(messy, order=("transaction_id",)).collect()}
    assert log == {"dropped_duplicate_ids": 7, "dropped_bad_timestamps": 3, "dropped_bad_amounts": 10,
                   "dropped_bad_status": 2}
    clean = C.clean_transactions(messy, order=("transaction_id",))
    assert clean.count() == 1000 - 3 - 10 - 2
    rep = {r.check: r.value for r in C.data_quality_report(clean.drop("txn_dt")).collect()}
    assert sum(v for k, v in rep.items() if k != "rows") == 0
    # 'succes' survives upper/trim as an unknown status, so rows 8 and 9 go by the status rule.
    statuses = {r.status for r in clean.select("status").distinct().collect()}
    assert statuses <= {"SUCCESS", "FAILED", "PENDING"}


def test_dedupe_keeps_first_in_order(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "transaction_id string, o int, v string")
    got = {r.transaction_id: r.v for r in C.dedupe_first(df, order=("o",)).collect()}
    assert got == {"a": "y", "b": "z"}


def test_orphans(spark):
    parent = spark.createDataFrame([(1,), (2,)], "bank_id long")
    child = spark.createDataFrame([(1,), (3,), (None,)], "primary_bank_id long")
    out = C.orphan_counts({"banks": parent, "customers": child.withColumn("device_id", F.lit(None).cast("string"))})
    got = {(r.child_column): r.orphans for r in out.collect()}
    assert got["primary_bank_id"] == 1
