"""Incremental load of raw transaction files (S2 + C2-C5 on a stream).

When files keep landing, the load is a Structured Streaming query: a file
source with the declared raw schema, and for each batch the cleaning rules,
the batch dedupe, and an append of ids that the target doesn't hold yet.
``trigger(availableNow=True)`` processes whatever has landed and stops; the
checkpoint folder makes a restarted or failed run resume without loss or
duplicates.  No row is dropped for being late.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.functions.exprs import VALID_STATUSES, year_month
from ledgerlens.plans.quality import dedupe_first
from ledgerlens.sources import schemas as S


def raw_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw transaction CSV files as a stream (amount and timestamp kept as text)."""
    reader = spark.readStream.schema(S.RAW_TRANSACTIONS).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(landing_dir)


def clean_rows(raw: DataFrame) -> DataFrame:
    """C3-C5 per row."""
    typed = raw.select(
        "transaction_id", "customer_id", "merchant_id", "bank_id", "device_id",
        F.trim(F.col("amount")).try_cast(S.MONEY).alias("amount"),
        F.trim(F.upper(F.col("status"))).alias("status"),
        "failure_reason", "payment_mode",
        F.try_to_timestamp(F.trim(F.col("txn_timestamp"))).cast("timestamp_ntz").alias("txn_timestamp"),
    )
    valid = typed.where(F.col("txn_timestamp").isNotNull() & F.col("amount").isNotNull()
                        & (F.col("amount") > 0) & F.col("status").isin(*VALID_STATUSES))
    return valid.withColumn("txn_year_month", year_month("txn_timestamp"))


def load_incrementally(spark: SparkSession, landing_dir: str, target_dir: str, checkpoint_dir: str,
                       available_now: bool = True) -> StreamingQuery:
    """Start the load; with ``available_now`` it drains the landed files and stops.

    Each batch keeps the first row of each id (C2) that the target doesn't hold
    yet, however late it comes.  A batch that is run again finds its rows there.
    """
    def append(batch: DataFrame, _: int) -> None:
        new = dedupe_first(clean_rows(batch))
        try:
            known = batch.sparkSession.read.parquet(target_dir).select("transaction_id")
        except AnalysisException:  # the first batch
            known = None
        if known is not None:
            new = new.join(known, "transaction_id", "left_anti")
        new.write.mode("append").partitionBy("txn_year_month").parquet(target_dir)

    q = raw_stream(spark, landing_dir).writeStream.foreachBatch(append).option("checkpointLocation", checkpoint_dir)
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()
