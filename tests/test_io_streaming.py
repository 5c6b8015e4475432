"""Sources, sinks and the incremental (streaming) load."""

import csv
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.sources import io as IO
from ledgerlens.sources import schemas as S
from ledgerlens.sources.adapter import tables
from ledgerlens.streaming.incremental import load_incrementally

HEADER = [f.name for f in S.RAW_TRANSACTIONS.fields]


def _write_csv(path, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(HEADER)
        w.writerows(rows)


def _row(i, amount="10.00", ts="2024-01-05 10:00:00", status="SUCCESS"):
    return [f"T{i}", i % 7, i % 5, i % 3, "F-1", amount, status, "", "UPI", ts]


def test_load_tables_requires_every_file():
    d = tempfile.mkdtemp(prefix="ll-io-")
    _write_csv(os.path.join(d, "transactions.csv"), [_row(1)])
    from ledgerlens.session import get_session
    with pytest.raises(FileNotFoundError):
        IO.load_tables(get_session(), d)


def test_verify_schema_and_row_counts(spark):
    t = tables(spark, SF_SMALL)
    texts = [F.col(f.name).cast(f.dataType).alias(f.name) for f in S.TRANSACTIONS.fields]
    out = {r.column: r.ok for r in IO.verify_schema(t.transactions_a.select(*texts), S.TRANSACTIONS).collect()}
    assert all(out.values()), out
    keys = {r.column for r in IO.verify_schema(t.transactions_a, S.TRANSACTIONS).collect() if not r.ok}
    assert keys == {"customer_id", "merchant_id", "bank_id"}  # numbers in the adapter, text in files
    counts = {r.table_name: r.n for r in IO.row_counts({"banks": t.banks, "devices": t.devices}).collect()}
    assert counts == {"banks": t.banks.count(), "devices": 12}


def test_write_features_formats_timestamp(spark):
    d = tempfile.mkdtemp(prefix="ll-feat-")
    tf = spark.createDataFrame([(1, "2024-01-02 03:04:05")], "a int, t string") \
        .select("a", F.to_timestamp("t").cast("timestamp_ntz").alias("txn_dt"))
    paths = IO.write_features(tf, tf.select("a"), d)
    back = spark.read.parquet(paths["transactions_features"]).collect()[0]
    assert back.txn_dt == "2024-01-02 03:04:05"


def test_customer_features_may_be_built_from_the_written_ones(spark):
    d = tempfile.mkdtemp(prefix="ll-feat-")
    tf = spark.createDataFrame([(" a ", "2024-01-02 03:04:05"), ("a", "2024-01-02 03:04:05"), (None, "2024-01-02 03:04:05")], "a string, t string") \
        .select("a", F.to_timestamp("t").cast("timestamp_ntz").alias("txn_dt"))
    read = lambda path: spark.read.schema(tf.schema).option("header", True).csv(path)
    paths = IO.write_features(tf, lambda written: read(written).select("a", F.lit(1).alias("n")), d, fmt="csv")
    assert sorted(map(repr, read(paths["transactions_features"]).collect())) == sorted(map(repr, tf.collect()))
    assert {r.a for r in spark.read.option("header", True).csv(paths["customer_features"]).collect()} == {" a ", "a", None}


def test_incremental_load_cleans_and_dedupes(spark):
    base = tempfile.mkdtemp(prefix="ll-stream-")
    landing, target, ckpt = (os.path.join(base, x) for x in ("landing", "target", "ckpt"))
    os.makedirs(landing)
    _write_csv(os.path.join(landing, "a.csv"),
               [_row(1), _row(2), _row(3, amount="-1"), _row(4, ts="not-a-date"), _row(5, status="succes"), _row(7, ts="2025-06-01 00:00:00")])
    q = load_incrementally(spark, landing, target, ckpt)
    q.awaitTermination(120)
    _write_csv(os.path.join(landing, "b.csv"), [_row(2), _row(6, status=" success "), _row(8, ts="2019-01-01 00:00:00"), _row(8, ts="2019-01-01 00:00:00")])
    q = load_incrementally(spark, landing, target, ckpt)
    q.awaitTermination(120)
    ids = sorted(r.transaction_id for r in spark.read.parquet(target).collect())
    assert ids == ["T1", "T2", "T6", "T7", "T8"]  # T8 is years late


def test_export_star_schema_and_rebuild(spark):
    from ledgerlens.plans import views as V
    t = tables(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="ll-export-")
    e = V.enrich(t.transactions_a, t.customers, t.merchants, t.banks, t.devices, devices_rows=12)
    paths = IO.export_star_schema(e, {"customers": t.customers, "banks": t.banks}, V.dim_date_for(t.transactions_a), d)
    fact = spark.read.parquet(paths["fact_transactions"])
    assert fact.count() == e.count()
    assert fact.where("txn_year_month = '1996-01'").count() == e.where("txn_year_month = '1996-01'").count()
    rebuilt = IO.rebuild({"banks": t.banks, "devices": t.devices}, os.path.join(d, "db"))
    assert spark.read.parquet(rebuilt["devices"]).count() == 12


FILES = {
    "banks": "bank_id,bank_name,bank_type,market_share,base_failure_rate\nBANK01,First,Public,0.6,0.1\nBANK02,Second,Private,0.4,0.2\n",
    "devices": "device_id,os_name,os_version,device_model\nDEV1,Android,14,X\n",
    "merchants": "merchant_id,merchant_name,category,city,state,commission_rate,popularity\nMER001,Shop,Food,Pune,MH,0.0150,1.0\nMER002,Mart,Travel,Agra,UP,0.0200,2.0\n",
    "campaigns": "campaign_id,campaign_name,target_category,start_date,end_date,cashback_rate,max_cashback,attach_rate\nCAMP1,Spring,Food,2024-01-01,2024-02-01,0.05,50.00,1.0\n",
    "customers": "customer_id,customer_name,age,gender,city,state,registration_date,primary_bank_id,device_id\nCUST00001,Ann,30,F,Pune,MH,2023-05-01,BANK01,DEV1\nCUST00002,Bob,40,M,Agra,UP,2023-06-01,BANK02,DEV1\n",
    "transactions": "transaction_id,customer_id,merchant_id,bank_id,device_id,amount,status,failure_reason,payment_mode,txn_timestamp\n"
                    "T1,CUST00001,MER001,BANK01,DEV1,100.00,SUCCESS,,UPI,2024-01-05 10:00:00\nT2,CUST00002,MER002,BANK02,DEV1,1000000000.50,SUCCESS,,CARD,2024-02-05 11:00:00\n"
                    "T2,CUST00002,MER002,BANK02,DEV1,1000000000.50,SUCCESS,,CARD,2024-02-05 11:00:00\nT3,CUST00001,MER002,BANK01,DEV1,50.00,FAILED,Timeout,UPI,2024-02-06 12:00:00\n"
                    "T4,CUST00001,MER002,BANK01,DEV1,oops,SUCCESS,,UPI,2024-02-06 12:00:00\n",
    "cashback": "cashback_id,transaction_id,campaign_id,cashback_amount,cashback_date\nCB1,T1,CAMP1,5.00,2024-01-05\n",
}


def test_files_with_text_keys_end_to_end(spark, tmp_path):
    from ledgerlens.plans import executive as E
    from ledgerlens.plans import quality as C
    from ledgerlens.plans import views as V
    for name, text in FILES.items():
        (tmp_path / f"{name}.csv").write_text(text)
    raw = IO.load_raw(spark, str(tmp_path))
    audit = {r.check: r.value for r in C.data_quality_report(raw["transactions"]).collect()}
    assert audit["rows"] == 5 and audit["duplicate_txn_ids"] == audit["full_duplicate_rows"] == 1
    tx = C.clean_transactions(raw["transactions"]).withColumn("txn_timestamp", F.col("txn_dt"))
    dims = {k: raw[k] for k in ("customers", "merchants", "banks", "devices")}
    e = V.enrich(tx, **dims)
    assert {r.transaction_id: (r.customer_id, float(r.revenue)) for r in e.collect()} == {
        "T1": ("CUST00001", 1.5), "T2": ("CUST00002", 20000000.01), "T3": ("CUST00001", 0.0)}
    months = {r.txn_year_month: r.gpv for r in E.mom_growth(e).collect()}
    assert months == {"2024-01": 100.0, "2024-02": 1000000001.0} or months == {"2024-01": 100.0, "2024-02": 1000000000.5}
    assert V.join_dimensions(tx, **dims).where("merchant_category = 'Travel'").count() == 2
    # Views by name; a wrong header is an error.
    IO.register_views(raw, e)
    assert IO.read_view(spark, "v_transaction_enriched").count() == 3 and IO.read_view(spark, "banks").count() == 2
    assert all(r.same for r in IO.round_trip({k: raw[k] for k in ("banks", "devices", "customers")}, str(tmp_path / "out")).collect())
    (tmp_path / "banks.csv").write_text(FILES["banks"].replace("bank_id,bank_name", "bank_name,bank_id"))
    with pytest.raises(Exception):
        IO.load_raw(spark, str(tmp_path))["banks"].collect()
