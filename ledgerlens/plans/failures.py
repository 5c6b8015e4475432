"""05 Failure analytics (Q5.1-Q5.8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X
from ledgerlens.operators.ranking import sql_rank


def status_breakdown(e: DataFrame) -> DataFrame:
    """Q5.1: transactions per status and share."""
    g = e.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return g.select("status", F.col("n").cast("bigint").alias("txns"),
                    X.pct_of_total(F.col("n"), 2).alias("pct")) \
        .orderBy(F.col("txns").desc(), "status")


def bank_failure_rank(e: DataFrame) -> DataFrame:
    """Q5.2: failure rate per bank with RANK worst-first over all banks (G1 RANK)."""
    g = e.groupBy("bank_id").agg(
        F.min("bank_name").alias("bank_name"),
        F.min("bank_type").alias("bank_type"),
        F.count(F.lit(1)).alias("n"),
        X.count_failed().alias("failed"))
    g = g.withColumn("ratio", F.col("failed").cast("double") / F.col("n").cast("double"))
    ranked = sql_rank(g, "ratio", ascending=False, out="worst_rank")
    return ranked.select(
        "bank_name", "bank_type",
        F.col("n").cast("bigint").alias("txns"),
        F.col("failed").cast("bigint"),
        X.round_ratio(F.col("failed"), F.col("n"), 2, 100).alias("failure_rate_pct"),
        "worst_rank",
    ).orderBy(F.col("failure_rate_pct").desc(), "worst_rank", "bank_name")


def failure_reasons(e: DataFrame) -> DataFrame:
    """Q5.3: failure reasons with share and amount at risk."""
    g = e.where(X.is_failed()).groupBy("failure_reason").agg(
        F.count(F.lit(1)).alias("n"), X.money_sum("amount_cents").alias("amt"))
    return g.select("failure_reason", F.col("n").cast("bigint").alias("occurrences"),
                    X.pct_of_total(F.col("n"), 2).alias("pct_of_failures"),
                    X.round_money(F.col("amt"), 0).alias("failed_gpv_at_risk")) \
        .orderBy(F.col("occurrences").desc(), "failure_reason")


def reason_mix_by_bank_type(e: DataFrame) -> DataFrame:
    """Q5.4: reason mix within each bank type."""
    g = e.where(X.is_failed()).groupBy("bank_type", "failure_reason").agg(F.count(F.lit(1)).alias("n"))
    within = F.sum("n").over(Window.partitionBy("bank_type"))
    return g.select("bank_type", "failure_reason", F.col("n").cast("bigint").alias("failures"),
                    X.round_ratio(F.col("n"), within, 2, 100).alias("pct_within_type")) \
        .orderBy("bank_type", F.col("failures").desc(), "failure_reason")


def failure_by_os(e: DataFrame, min_txns: int = 500) -> DataFrame:
    """Q5.5: failure rate per OS and version (the null device group included)."""
    g = e.groupBy("os_name", "os_version").agg(F.count(F.lit(1)).alias("n"), X.count_failed().alias("f"))
    return g.where(F.col("n") >= min_txns).select(
        "os_name", "os_version", F.col("n").cast("bigint").alias("txns"),
        X.round_ratio(F.col("f"), F.col("n"), 2, 100).alias("failure_rate_pct"),
    ).orderBy(F.col("failure_rate_pct").desc(), "os_name", "os_version")


def failure_by_ticket_band(e: DataFrame, edges: Sequence[float] = X.SQL_BAND_EDGES) -> DataFrame:
    """Q5.6: failure rate per ticket band (lower bound inclusive)."""
    g = e.groupBy(X.sql_ticket_band("amount", edges).alias("ticket_band")).agg(
        F.count(F.lit(1)).alias("n"), X.count_failed().alias("f"))
    return g.select("ticket_band", F.col("n").cast("bigint").alias("txns"),
                    X.round_ratio(F.col("f"), F.col("n"), 2, 100).alias("failure_rate_pct")) \
        .orderBy("ticket_band")


def failure_by_hour(e: DataFrame) -> DataFrame:
    """Q5.7: failure rate per hour, worst first."""
    g = e.groupBy("txn_hour").agg(F.count(F.lit(1)).alias("n"), X.count_failed().alias("f"))
    return g.select(F.col("txn_hour").cast("int"), F.col("n").cast("bigint").alias("txns"),
                    X.round_ratio(F.col("f"), F.col("n"), 2, 100).alias("failure_rate_pct")) \
        .orderBy(F.col("failure_rate_pct").desc(), "txn_hour")


def gpv_lost(e: DataFrame, merchants: DataFrame) -> DataFrame:
    """Q5.8: failed GPV per month and x the unweighted mean merchant commission."""
    rate_sum = merchants.agg(F.sum("commission_rate")).scalar()
    n_merch = merchants.agg(F.count("commission_rate")).scalar()
    g = e.groupBy("txn_year_month").agg(
        X.money_sum(F.when(X.is_failed(), F.col("amount_cents")).otherwise(F.lit(0))).alias("lost"))
    return g.select(
        "txn_year_month",
        X.round_money(F.col("lost"), 0).alias("gpv_lost"),
        X.round_ratio(F.col("lost") * rate_sum, n_merch, 0).alias("est_revenue_lost"),
    ).orderBy("txn_year_month")
