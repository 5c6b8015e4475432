"""The load over files, end to end: raw CSV with defects, audit, cleaning, load, views, exports.

``write_raw`` writes the star schema as CSV files with text keys, as the loaders expect them, and plants
defects in the fact by a rule on its keys (``DEFECTS``).  Each query then runs the library's own steps on
these files: raw read, audit, cleaning, the cleaned files, their typed load, and what is built on it.
Each run writes into a folder of its own below the shared one.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X
from ledgerlens.operators.joins import with_proven_key
from ledgerlens.plans import features as FE
from ledgerlens.plans import quality as C
from ledgerlens.plans import views as V
from ledgerlens.session import ensure_checkpoint_dir
from ledgerlens.sources import io as IO
from ledgerlens.sources import schemas as S

#: (customer_id + merchant_id) % MODULUS -> the defect; the other remainders are clean.
MODULUS = 97
DEFECTS = {"copy": 1, "same_id_later": 2, "bad_amount": 3, "negative_amount": 4, "no_amount": 5, "blanks_around_amount": 6, "unknown_status": 7,
           "lower_case_status": 8, "bad_timestamp": 9, "no_timestamp": 10, "reason_without_failure": 11, "no_customer": 12}


def planted(txn: DataFrame) -> DataFrame:
    """The fact as raw text, with the defects of ``DEFECTS`` and, for two of them, further rows."""
    k = (F.col("customer_id") + F.col("merchant_id")) % MODULUS
    has = {name: k == at for name, at in DEFECTS.items()}
    money = F.col("amount").cast("decimal(18,2)").cast("string")
    time = F.date_format("txn_timestamp", IO.TIMESTAMP_TEXT)
    rows = txn.select(
        "transaction_id",
        F.when(~has["no_customer"], F.col("customer_id").cast("string")).alias("customer_id"),
        *[F.col(c).cast("string").alias(c) for c in ("merchant_id", "bank_id", "device_id")],
        F.when(has["bad_amount"], "oops").when(has["negative_amount"], F.concat(F.lit("-"), money)).when(has["no_amount"], F.lit(None))
        .when(has["blanks_around_amount"], F.concat(F.lit(" "), money, F.lit(" "))).otherwise(money).alias("amount"),
        F.when(has["unknown_status"], "UNKNOWN").when(has["lower_case_status"], F.concat(F.lit(" "), F.lower("status"), F.lit(" "))).otherwise(F.col("status")).alias("status"),
        F.when(has["reason_without_failure"], "PLANTED").otherwise(F.col("failure_reason")).alias("failure_reason"),
        "payment_mode",
        F.when(has["bad_timestamp"], "not a date").when(has["no_timestamp"], F.lit(None)).otherwise(time).alias("txn_timestamp"),
        F.when(has["copy"], "copy").when(has["same_id_later"], "later").alias("__more"),
        F.date_format(F.col("txn_timestamp") + F.expr("INTERVAL 1 DAY"), IO.TIMESTAMP_TEXT).alias("__later"))
    # A row and what is planted beside it come from one read of the fact.
    plain = [F.col(c) for c in S.RAW_TRANSACTIONS.fieldNames()]
    again = [F.when(F.col("__more") == "later", F.lit("1.00")).otherwise(F.col("amount")).alias(c) if c == "amount"
             else F.when(F.col("__more") == "later", F.col("__later")).otherwise(F.col(c)).alias(c) if c == "txn_timestamp" else F.col(c)
             for c in S.RAW_TRANSACTIONS.fieldNames()]
    both = F.when(F.col("__more").isNotNull(), F.array(F.struct(*plain), F.struct(*again))).otherwise(F.array(F.struct(*plain)))
    return rows.select(F.explode(both).alias("r")).select("r.*")


def write_files(tables: Mapping[str, DataFrame], out_dir: str) -> str:
    """Each table as compressed CSV in ``<name>.csv``, blanks kept."""
    for name in [n for n in S.LOAD_ORDER if n in tables]:
        w = tables[name].write.mode("overwrite").option("header", True).option("compression", "gzip")
        w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{out_dir}/{name}.csv")
    return out_dir


def _typed(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.TABLES[name].fields])


def _folder(spark: SparkSession, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def raw_files(spark: SparkSession, txn: DataFrame) -> DataFrame:
    """The planted fact, written and read back as raw text."""
    folder = write_files({"transactions": planted(txn)}, _folder(spark, "raw"))
    return IO.load_raw(spark, folder, names=["transactions"])["transactions"]


def load(spark: SparkSession, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Plant and write the raw fact, read and clean it, write the cleaned files, load them with their types."""
    cleaned = C.clean_transactions(raw_files(spark, tables["transactions"]))
    fact = cleaned.withColumn("txn_timestamp", F.date_format("txn_dt", IO.TIMESTAMP_TEXT)).select(*S.TRANSACTIONS.fieldNames())
    files = {name: _typed(df, name) for name, df in tables.items() if name != "transactions"} | {"transactions": fact}
    return IO.load_tables(spark, write_files(files, _folder(spark, "clean")))


def _derived(txn: DataFrame) -> DataFrame:
    return txn.withColumns({"txn_dt": F.col("txn_timestamp"), "amount_cents": (F.col("amount") * 100).cast("long")})


def _fact(loaded: Mapping[str, DataFrame]) -> DataFrame:
    return _derived(loaded["transactions"])


def _joined(loaded: Mapping[str, DataFrame]) -> DataFrame:
    """V3 of the loaded tables.  What follows from a row's columns is added after the joins, so it is not moved, and a
    dimension without repeated keys is left out where nobody reads it (the pass for F6's limit)."""
    dims = {n: with_proven_key(df, V.DIMENSION_KEYS[n]) if n in V.DIMENSION_KEYS else df for n, df in _dims(loaded).items()}
    return _derived(V.with_basis_points(V.join_dimensions(loaded["transactions"], **dims, basis_points=False)))


def _dims(loaded: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {k: loaded[k] for k in ("customers", "merchants", "banks", "devices")}


def loaded_tables(loaded: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and distinct keys of each loaded table, and whether its schema is the declared one."""
    out = None
    for name in S.LOAD_ORDER:
        df = loaded[name]
        same = all((df.schema[f.name].dataType == f.dataType) for f in S.TABLES[name].fields)
        row = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(df.columns[0]).alias("ids")).select(F.lit(name).alias("table_name"), "n", "ids", F.lit(same).alias("typed"))
        out = row if out is None else out.unionByName(row)
    return out


def feature_files(spark: SparkSession, loaded: Mapping[str, DataFrame]) -> DataFrame:
    """Both feature tables written as CSV and read back as text: rows and revenue by the month that the text names."""
    feats = FE.engineer_transaction_features(_joined(loaded))

    def customers(written: str) -> DataFrame:
        """The customer features, built from the transaction features as they are on disk.

        Their text came from files of this form, so it reads back as it was (an empty text is null there too).
        """
        tf = spark.read.schema(feats.schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(written)
        return FE.engineer_customer_features(tf, loaded["customers"], stored=True)

    paths = IO.write_features(feats, customers, _folder(spark, "features"), fmt="csv")
    text = {name: spark.read.option("header", True).csv(path) for name, path in paths.items()}
    money = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double").alias("revenue")
    tx = text["transactions_features"].groupBy(F.substring("txn_dt", 1, 7).alias("month")).agg(
        F.count(F.lit(1)).alias("n"), money("revenue"), F.min("txn_dt").alias("first_txn"), F.max("txn_dt").alias("last_txn"))
    cu = text["customer_features"].agg(F.count(F.lit(1)).alias("n"), money("revenue_contributed"))
    none = F.lit(None).cast("string")
    return tx.select(F.lit("transactions_features").alias("file"), "month", "n", "revenue", "first_txn", "last_txn").unionByName(
        cu.select(F.lit("customer_features").alias("file"), none.alias("month"), "n", "revenue", none.alias("first_txn"), none.alias("last_txn")))


def star_files(spark: SparkSession, loaded: Mapping[str, DataFrame]) -> DataFrame:
    """The star schema exported and read back: rows of each file and the revenue of the fact."""
    fact = V.enrich(_fact(loaded), **_dims(loaded))
    paths = IO.export_star_schema(fact, _dims(loaded), V.dim_date_for(loaded["transactions"]), _folder(spark, "star"))
    out = None
    for name, path in paths.items():
        df = spark.read.parquet(path)
        revenue = X.money_sum("revenue_cents") if name == "fact_transactions" else F.lit(None)
        row = df.agg(F.count(F.lit(1)).alias("n"), revenue.cast("double").alias("revenue")).select(F.lit(name).alias("file"), "n", "revenue")
        out = row if out is None else out.unionByName(row)
    return out


def view_answer(spark: SparkSession, loaded: Mapping[str, DataFrame]) -> DataFrame:
    """SQL over the registered tables and reporting views."""
    fact = V.enrich(_fact(loaded), **_dims(loaded))
    IO.register_views(loaded, fact, V.monthly_summary(fact))
    return spark.sql("""
SELECT m.txn_year_month, x.bank_type, x.n, m.total_txns, m.gpv
FROM (SELECT e.txn_year_month, b.bank_type, COUNT(*) AS n FROM v_transaction_enriched e JOIN banks b ON b.bank_id = e.bank_id GROUP BY ALL) x
JOIN v_monthly_summary m ON m.txn_year_month = x.txn_year_month""")
