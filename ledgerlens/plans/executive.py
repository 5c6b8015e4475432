"""01 Executive overview (Q1.1-Q1.5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X


def headline_kpis(e: DataFrame) -> DataFrame:
    """Q1.1: all-time KPIs, one row.

    Merchants are counted in an aggregate of their own: two distinct counts in one would expand every row.
    """
    g = e.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_success").alias("succ"),
        X.sum_success("amount").alias("gpv"),
        F.count(F.when(X.is_success(), F.col("amount"))).alias("n_succ_amount"),
        X.money_sum("revenue_cents").alias("rev"),
        F.count_distinct("customer_id").alias("active_customers"),
    ).crossJoin(e.agg(F.count_distinct("merchant_id").alias("active_merchants")))  # one row each
    return g.select(
        F.col("n").cast("bigint").alias("total_transactions"),
        F.col("succ").cast("bigint").alias("successful_transactions"),
        X.round_ratio(F.col("succ"), F.col("n"), 2, 100).alias("success_rate_pct"),
        X.round_money(F.col("gpv"), 0).alias("gross_payment_value"),
        X.round_ratio(F.col("gpv"), F.col("n_succ_amount"), 0).alias("avg_ticket_size"),
        X.round_money(F.col("rev"), 0).alias("total_revenue"),
        F.col("active_customers").cast("bigint"),
        F.col("active_merchants").cast("bigint"),
    )


def monthly_trend(e: DataFrame) -> DataFrame:
    """Q1.2: monthly volume, success rate, GPV, revenue, active customers."""
    g = e.groupBy("txn_year_month").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_success").alias("succ"),
        X.sum_success("amount").alias("gpv"),
        X.money_sum("revenue_cents").alias("rev"),
        F.count_distinct("customer_id").alias("active_customers"),
    )
    return g.select(
        "txn_year_month",
        F.col("n").cast("bigint").alias("txns"),
        X.round_ratio(F.col("succ"), F.col("n"), 2, 100).alias("success_rate_pct"),
        X.round_money(F.col("gpv"), 0).alias("gpv"),
        X.round_money(F.col("rev"), 0).alias("revenue"),
        F.col("active_customers").cast("bigint"),
    ).orderBy("txn_year_month")


def mom_growth(e: DataFrame) -> DataFrame:
    """Q1.3: month-over-month GPV growth (previous row, as LAG)."""
    monthly = e.groupBy("txn_year_month").agg(X.sum_success("amount").alias("gpv"))
    # One row per month: the ordered window is small by construction.
    w = Window.orderBy("txn_year_month")
    prev = F.lag("gpv").over(w)
    return monthly.select(
        "txn_year_month",
        X.round_money(F.col("gpv"), 0).alias("gpv"),
        X.round_money(prev, 0).alias("prev_month_gpv"),
        X.round_ratio(F.col("gpv") - prev, prev, 2, 100).alias("mom_growth_pct"),
    ).orderBy("txn_year_month")


def quarterly_summary(e: DataFrame) -> DataFrame:
    """Q1.4: year x quarter."""
    quarter = (F.call_function("div", F.col("txn_month") - 1, F.lit(3)) + 1).cast("int")
    g = e.groupBy("txn_year", quarter.alias("quarter")).agg(
        F.count(F.lit(1)).alias("n"), X.money_sum("revenue_cents").alias("rev"), F.sum("is_success").alias("succ"))
    return g.select(
        F.col("txn_year").cast("int"), "quarter",
        F.col("n").cast("bigint").alias("txns"),
        X.round_money(F.col("rev"), 0).alias("revenue"),
        X.round_ratio(F.col("succ"), F.col("n"), 2, 100).alias("success_rate_pct"),
    ).orderBy("txn_year", "quarter")


def payment_mode_mix(e: DataFrame) -> DataFrame:
    """Q1.5: payment-mode share of all transactions."""
    g = e.groupBy("payment_mode").agg(F.count(F.lit(1)).alias("n"), X.sum_success("amount").alias("gpv"))
    return g.select(
        "payment_mode",
        F.col("n").cast("bigint").alias("txns"),
        X.pct_of_total(F.col("n"), 2).alias("pct_of_txns"),
        X.round_money(F.col("gpv"), 0).alias("gpv"),
    ).orderBy(F.col("txns").desc(), "payment_mode")
