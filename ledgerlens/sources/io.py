"""Sources and sinks.

Readers always pass an explicit schema (no inference pass over the files);
writers are whole-partition overwrites, so a retried task or a re-run
replaces its output instead of appending duplicates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources import schemas as S

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"


# ----------------------------------------------------------------- S1 / S2
def load_raw(spark: SparkSession, raw_dir: str, fmt: str = "csv",
             names: Iterable[str] = S.LOAD_ORDER, raw_text: bool = True) -> dict[str, DataFrame]:
    """Read every raw table with its declared schema.

    With ``raw_text`` the transaction amount and timestamp stay strings, so
    the audit (C1) can count values that do not parse.
    """
    out = {}
    for name in names:
        schema = S.RAW_TRANSACTIONS if (name == "transactions" and raw_text) else S.TABLES[name]
        path = f"{raw_dir.rstrip('/')}/{name}.{fmt}"
        reader = spark.read.schema(schema)
        if fmt != "csv":
            out[name] = reader.parquet(path)
            continue
        # The header must name the columns in order, and a value that doesn't parse is an error
        # (the audited text columns always parse).
        out[name] = reader.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    return out


def load_tables(spark: SparkSession, raw_dir: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """Load in parent-first order; a missing file raises before anything is read (Spark looks for it, in any store)."""
    out = {}
    for name in S.LOAD_ORDER:
        try:
            out |= load_raw(spark, raw_dir, fmt, [name], raw_text=False)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            raise FileNotFoundError(f"{raw_dir.rstrip('/')}/{name}.{fmt} not found") from e
    return out


def round_trip(tables: Mapping[str, DataFrame], out_dir: str, fmt: str = "parquet") -> DataFrame:
    """Write all tables, read them back and compare: (table_name, n, n_back, same).

    ``same`` compares counts and an order-free checksum of the rows' text.
    """
    def mark(df: DataFrame) -> list:
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns])
        return [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(text).cast("decimal(38,0)")).alias("sum")]

    out = None
    for name, path in rebuild(tables, out_dir, fmt).items():
        reader = tables[name].sparkSession.read.schema(tables[name].schema)
        back = reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
        a = tables[name].agg(*mark(tables[name])).select("n", "sum")
        b = back.agg(*mark(back)).select(F.col("n").alias("n_back"), F.col("sum").alias("sum_back"))
        row = a.crossJoin(b).select(F.lit(name).alias("table_name"), "n", "n_back", (F.col("n") == F.col("n_back")) & F.col("sum").eqNullSafe(F.col("sum_back")))
        row = row.toDF("table_name", "n", "n_back", "same")
        out = row if out is None else out.unionByName(row)
    return out


def register_views(tables: Mapping[str, DataFrame], enriched: DataFrame | None = None,
                   monthly: DataFrame | None = None) -> None:
    """Temp views for SQL users: the seven tables plus the two reporting views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    if enriched is not None:
        enriched.createOrReplaceTempView("v_transaction_enriched")
    if monthly is not None:
        monthly.createOrReplaceTempView("v_monthly_summary")


def read_view(spark: SparkSession, name: str) -> DataFrame:
    """SELECT * FROM a registered view."""
    return spark.table(name)


# ----------------------------------------------------------------- S3-S5
def rebuild(tables: Mapping[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """S3: full rebuild: every table overwritten, parents first."""
    paths = {}
    for name in [n for n in S.LOAD_ORDER if n in tables]:
        path = f"{out_dir.rstrip('/')}/{name}"
        w = tables[name].write.mode("overwrite")
        (w.option("header", True).option("compression", "gzip").csv(path) if fmt == "csv" else w.parquet(path))
        paths[name] = path
    return paths


def write_features(txn_features: DataFrame, customer_features: DataFrame | Callable[[str], DataFrame], out_dir: str,
                   fmt: str = "parquet") -> dict[str, str]:
    """Write both feature tables, blanks kept; the timestamp becomes 'yyyy-MM-dd HH:mm:ss' text.

    ``customer_features`` may be a function that builds them from the path of the written transaction features.
    """
    tf = txn_features.withColumn("txn_dt", F.date_format("txn_dt", TIMESTAMP_TEXT))
    out = {}
    for name, df in (("transactions_features", tf), ("customer_features", customer_features)):
        path = f"{out_dir.rstrip('/')}/{name}"
        w = (df if isinstance(df, DataFrame) else df(out["transactions_features"])).write.mode("overwrite")
        text = w.option("header", True).option("compression", "gzip").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        (text.csv(path) if fmt == "csv" else w.parquet(path))
        out[name] = path
    return out


def export_star_schema(enriched: DataFrame, dims: Mapping[str, DataFrame], calendar: DataFrame,
                       out_dir: str, customer_features: DataFrame | None = None,
                       fmt: str = "parquet", partition_by_month: bool = True) -> dict[str, str]:
    """Flattened fact + dimensions + calendar (+ customer features when present).

    The fact is partitioned by ``txn_year_month`` so month slicers prune
    files instead of scanning them.
    """
    out = {}
    items = [("dim_date", calendar, None), ("fact_transactions", enriched,
                                             "txn_year_month" if partition_by_month else None)]
    items += [(f"dim_{k}", v, None) for k, v in dims.items()]
    if customer_features is not None:
        items.append(("customer_features", customer_features, None))
    for name, df, part in items:
        path = f"{out_dir.rstrip('/')}/{name}"
        w = df.write.mode("overwrite")
        if part:
            w = w.partitionBy(part)
        (w.option("header", True).option("compression", "gzip").csv(path) if fmt == "csv" else w.parquet(path))
        out[name] = path
    return out


# ----------------------------------------------------------------- S7 / S8
def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n) for every table, as one union of count aggregates."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(F.lit(name).alias("table_name"), "n")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verify_schema(df: DataFrame, expected: T.StructType, strict_nullability: bool = False) -> DataFrame:
    """One row per expected column: present, actual type, expected type, ok."""
    actual = {f.name: f for f in df.schema.fields}
    rows = []
    for f in expected.fields:
        a = actual.get(f.name)
        ok = a is not None and a.dataType == f.dataType and (not strict_nullability or a.nullable == f.nullable)
        rows.append((f.name, a is not None, a.dataType.simpleString() if a else None,
                     f.dataType.simpleString(), bool(ok)))
    return df.sparkSession.createDataFrame(
        rows, "column string, present boolean, actual_type string, expected_type string, ok boolean")
