"""Campaign cashback.

B1 is an interval join: a transaction qualifies for a campaign when its
merchant category is the campaign's target and its timestamp lies in
[start, end + 1 day).  It runs on the interval index (``operators/intervals``),
so any number of overlapping campaigns in one category spreads over buckets
of days instead of meeting in one task.  B2 replaces the reference's seeded sample by a repeatable
per-(transaction, campaign) hash threshold, independent of partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X
from ledgerlens.operators.intervals import days, interval_join
from ledgerlens.plans.quality import clean_transactions
from ledgerlens.sources import schemas as S

HASH_BUCKETS = 10_000


def selection_hash(transaction_id: str = "transaction_id", campaign_id: str = "campaign_id"):
    """0..9999 from the first 32 bits of md5(campaign || ':' || transaction)."""
    key = F.concat_ws(":", F.col(campaign_id), F.col(transaction_id))
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(HASH_BUCKETS))


def eligible(txn: DataFrame, merchants: DataFrame | None, campaigns: DataFrame) -> DataFrame:
    """B1: successful transactions inside a campaign window of their category.

    ``merchants=None`` when ``txn`` already carries ``merchant_category``.
    """
    if merchants is None:
        tx = txn.where(X.is_success()).select("transaction_id", "amount", "txn_timestamp",
                                              F.col("merchant_category").alias("category"))
    else:
        tx = txn.where(X.is_success()).select("transaction_id", "merchant_id", "amount", "txn_timestamp")
        tx = tx.join(merchants.select("merchant_id", "category"), "merchant_id")
    c = campaigns.select("campaign_id", F.col("target_category").alias("category"), "cashback_rate", "max_cashback", "attach_rate",
                         days(F.col("start_date")).alias("first_day"), (days(F.col("end_date")) + 1).alias("after_day"))
    tx = tx.withColumn("day", days(F.to_date("txn_timestamp")))
    return interval_join(tx, c, "category", "day", "first_day", "after_day")


def on_campaign_days(txn: DataFrame, campaigns: DataFrame) -> DataFrame:
    """The rows of days on which a campaign runs, whatever its category: no others can qualify."""
    days_on = campaigns.select(F.explode(F.sequence("start_date", F.greatest("start_date", "end_date"))).alias("__day")).distinct()
    # A row for each day of the calendar, at most.
    return txn.join(F.broadcast(days_on), F.to_date("txn_timestamp") == F.col("__day"), "left_semi")


def campaign_totals(elig: DataFrame) -> DataFrame:
    """Eligible transactions of each campaign and the cashback that they would earn."""
    g = elig.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("amount") * 100).cast("long")).alias("cents"),
        F.sum((F.least(F.round(F.col("amount") * F.col("cashback_rate"), 2), F.col("max_cashback")) * 100).cast("long")).alias("earned"))
    return g.select("campaign_id", F.col("n").cast("bigint").alias("eligible"), F.col("cents").alias("amount_cents"), F.col("earned").alias("cashback_cents"))


def monthly_campaigns(e: DataFrame) -> DataFrame:
    """A campaign for each category and month with sales, from the month's first day on, 10 to 65 days long: they overlap."""
    month = F.to_date(F.date_trunc("month", "txn_date"))
    g = e.select(F.col("merchant_category").alias("target_category"), month.alias("start_date")).distinct()
    length = 10 + 5 * (F.month("start_date") % 12)
    return g.select(
        F.concat_ws(":", "target_category", F.date_format("start_date", "yyyy-MM")).alias("campaign_id"), "target_category", "start_date",
        F.date_add("start_date", length - 1).alias("end_date"), F.lit("0.0500").cast("decimal(6,4)").alias("cashback_rate"),
        F.lit("75.00").cast(S.MONEY).alias("max_cashback"), F.lit(1.0).alias("attach_rate"))


def attached(elig: DataFrame) -> DataFrame:
    """B2: the share ``attach_rate`` of eligible rows, chosen by hash."""
    return elig.where(selection_hash() < F.round(F.col("attach_rate") * HASH_BUCKETS))


def cashback_rows(sel: DataFrame) -> DataFrame:
    """min(amount x rate rounded to 2 places, cap)."""
    amt = F.least(F.round(F.col("amount") * F.col("cashback_rate"), 2), F.col("max_cashback"))
    return sel.select(
        F.concat_ws(":", "campaign_id", "transaction_id").alias("cashback_id"),
        "transaction_id", "campaign_id",
        amt.cast(S.MONEY).alias("cashback_amount"),
        F.to_date("txn_timestamp").alias("cashback_date"))


def cashback_table(txn: DataFrame, merchants: DataFrame, campaigns: DataFrame,
                   dedupe: bool = True) -> DataFrame:
    """The cashback fact (B1-B3) over (cleaned, id-unique) transactions."""
    base = clean_transactions(txn) if dedupe else txn
    return cashback_rows(attached(eligible(base, merchants, campaigns)))


def cashback_from_frame(frame: DataFrame, campaigns: DataFrame) -> DataFrame:
    """B1-B3 over the cleaned analysis frame (V3), which already has the category."""
    return cashback_rows(attached(eligible(frame, None, campaigns)))


def cashback_summary(cb: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Per campaign and month: rows and cashback total."""
    g = cb.groupBy("campaign_id", F.date_format("cashback_date", "yyyy-MM").alias("cashback_month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cashback_amount").alias("amt"))
    names = campaigns.select("campaign_id", "campaign_name")
    return g.join(names, "campaign_id", "left").select(
        "campaign_id", "campaign_name", "cashback_month",
        F.col("n").cast("bigint").alias("cashbacks"),
        F.col("amt").cast("double").alias("cashback_total"),
    ).orderBy("campaign_id", "cashback_month")


def cashback_total(cb: DataFrame) -> DataFrame:
    """Overall cashback rows and amount."""
    return cb.agg(F.count(F.lit(1)).cast("bigint").alias("cashbacks"),
                  F.coalesce(F.sum("cashback_amount"), F.lit(0)).cast("double").alias("cashback_total"))
