"""06 Regional analytics (Q6.1-Q6.5) and the README's city example (R2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X
from ledgerlens.plans.measures import months_of


def state_scorecard(e: DataFrame) -> DataFrame:
    """Q6.1: per state; RANK by revenue over the (bounded) set of states."""
    g = e.groupBy("customer_state").agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count(F.lit(1)).alias("n"),
        X.sum_success("amount").alias("gpv"),
        X.money_sum("revenue_cents").alias("rev"),
        F.sum("is_success").alias("succ"))
    return g.select(
        F.col("customer_state").alias("state"),
        F.col("customers").cast("bigint"),
        F.col("n").cast("bigint").alias("txns"),
        X.round_money(F.col("gpv"), 0).alias("gpv"),
        X.round_money(F.col("rev"), 0).alias("revenue"),
        X.round_ratio(F.col("succ"), F.col("n"), 2, 100).alias("success_rate_pct"),
        X.round_ratio(F.col("gpv"), F.col("customers"), 0).alias("gpv_per_customer"),
        F.rank().over(Window.orderBy(F.col("rev").desc())).alias("revenue_rank"),
    ).orderBy(F.col("revenue").desc(), "state")


def top_cities(e: DataFrame, n: int = 15) -> DataFrame:
    """Q6.2: top cities by GPV (a city lies in one state: min(state))."""
    g = e.groupBy("customer_city").agg(
        F.min("customer_state").alias("state"),
        F.count(F.lit(1)).alias("n"),
        X.sum_success("amount").alias("gpv"),
        F.sum("is_success").alias("succ"))
    return g.select(
        F.col("customer_city").alias("city"), "state",
        F.col("n").cast("bigint").alias("txns"),
        X.round_money(F.col("gpv"), 0).alias("gpv"),
        X.round_ratio(F.col("succ"), F.col("n"), 2, 100).alias("success_rate_pct"),
    ).orderBy(F.col("gpv").desc_nulls_last(), "city").limit(n)


def state_revenue_share(e: DataFrame) -> DataFrame:
    """Q6.3: state share of national revenue and the cumulative share."""
    g = e.groupBy("customer_state").agg(X.money_sum("revenue_cents").alias("rev"))
    run = Window.orderBy(F.col("rev").desc(), F.col("customer_state")) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("rev").over(Window.partitionBy())
    return g.select(
        F.col("customer_state").alias("state"),
        X.round_money(F.col("rev"), 0).alias("revenue"),
        X.round_ratio(F.col("rev"), total, 2, 100).alias("pct_of_national"),
        X.round_ratio(F.sum("rev").over(run), total, 2, 100).alias("cumulative_pct"),
    ).orderBy(F.col("revenue").desc(), "state")


def top_category_per_state(e: DataFrame) -> DataFrame:
    """Q6.4: the category with the most GPV in each state.

    ``min_by`` over (gpv is null, -gpv, category) is the ROW_NUMBER() = 1 row
    of the reference (NULL gpv last in DESC), computed as a partial aggregate.
    """
    per = e.groupBy("customer_state", "merchant_category").agg(X.sum_success("amount").alias("gpv"))
    best = per.groupBy("customer_state").agg(
        F.min_by(F.struct("merchant_category", "gpv"),
                 F.struct(F.col("gpv").isNull(), -F.col("gpv"), F.col("merchant_category"))).alias("b"))
    return best.select(F.col("customer_state").alias("state"),
                       F.col("b.merchant_category").alias("top_category"),
                       X.round_money(F.col("b.gpv"), 0).alias("gpv")) \
        .orderBy(F.col("gpv").desc_nulls_last(), "state")


def state_success_rates(e: DataFrame, min_txns: int = 1000) -> DataFrame:
    """Q6.5: states by success rate with a minimum volume."""
    g = e.groupBy("customer_state").agg(F.count(F.lit(1)).alias("n"), F.sum("is_success").alias("succ"))
    return g.where(F.col("n") >= min_txns).select(
        F.col("customer_state").alias("state"),
        F.col("n").cast("bigint").alias("txns"),
        X.round_ratio(F.col("succ"), F.col("n"), 2, 100).alias("success_rate_pct"),
    ).orderBy(F.col("success_rate_pct").desc(), "state")


def city_segmentation(e: DataFrame, customers: DataFrame, since: str = "2025-01-01") -> DataFrame:
    """R2: customers, transactions, spend and average per customer city since a date."""
    f = months_of(e, F.lit(since).cast("date")).where(F.col("txn_date") >= F.lit(since).cast("date")).select("customer_id", "amount_cents")
    per = f.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), X.money_sum("amount_cents").alias("amt"))
    j = per.join(customers.select("customer_id", "city"), "customer_id")
    g = j.groupBy("city").agg(F.count(F.lit(1)).alias("customers"), F.sum("n").alias("n"),
                              F.sum("amt").alias("amt"))
    return g.select(
        "city",
        F.col("customers").cast("bigint").alias("customer_count"),
        F.col("n").cast("bigint").alias("transaction_count"),
        F.col("amt").cast("double").alias("total_spend"),
        X.round_ratio(F.col("amt"), F.col("n"), 2).alias("avg_transaction"),
    ).orderBy(F.col("customer_count").desc(), "city")
