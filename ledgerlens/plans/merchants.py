"""03 Merchant analytics (Q3.1-Q3.5) and the README's merchant example."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from decimal import Decimal

from ledgerlens.functions import exprs as X
from ledgerlens.operators.ranking import Key, global_rank


def _per_merchant(e: DataFrame) -> DataFrame:
    return e.groupBy("merchant_id").agg(
        F.min("merchant_name").alias("merchant_name"),
        F.min("merchant_category").alias("merchant_category"),
        F.count(F.lit(1)).alias("n"),
        F.sum("is_success").alias("succ"),
        X.sum_success("amount").alias("gpv"),
        X.money_sum("revenue_cents").alias("rev"),
        X.money_sum("amount_cents").alias("amt"))


def top_merchants(e: DataFrame, n: int = 10) -> DataFrame:
    """Q3.1: top merchants by revenue with RANK over all merchants.

    Top-k first (distributed TakeOrderedAndProject), then RANK on the k rows:
    every merchant with more revenue than a top-k row is itself in the top k,
    so the rank equals the rank over all merchants.
    """
    top = _per_merchant(e).orderBy(F.col("rev").desc(), F.col("merchant_id").asc()).limit(n)
    return top.select(
        "merchant_id", "merchant_name", "merchant_category",
        F.col("n").cast("bigint").alias("txns"),
        X.round_money(F.col("gpv"), 0).alias("gpv"),
        X.round_money(F.col("rev"), 2).alias("revenue"),
        F.rank().over(Window.orderBy(F.col("rev").desc())).alias("revenue_rank"),
    )


def category_performance(e: DataFrame) -> DataFrame:
    """Q3.2: category totals and share of all revenue."""
    g = e.groupBy("merchant_category").agg(
        F.count_distinct("merchant_id").alias("merchants"),
        F.count(F.lit(1)).alias("n"),
        X.sum_success("amount").alias("gpv"),
        F.count(F.when(X.is_success(), F.col("amount"))).alias("n_gpv"),
        X.money_sum("revenue_cents").alias("rev"),
        F.sum("is_success").alias("succ"))
    return g.select(
        "merchant_category",
        F.col("merchants").cast("bigint"),
        F.col("n").cast("bigint").alias("txns"),
        X.round_money(F.col("gpv"), 0).alias("gpv"),
        X.round_money(F.col("rev"), 0).alias("revenue"),
        X.pct_of_total(F.col("rev"), 2).alias("pct_of_total_revenue"),
        X.round_ratio(F.col("succ"), F.col("n"), 2, 100).alias("success_rate_pct"),
        X.round_ratio(F.col("gpv"), F.col("n_gpv"), 0).alias("avg_ticket"),
    ).orderBy(F.col("revenue").desc(), "merchant_category")


def top_merchant_per_category(e: DataFrame, k: int = 1) -> DataFrame:
    """Q3.3: best merchant by revenue in each category (ties: lowest merchant id).

    k = 1 is an aggregate (``max_by``) with a map-side partial step, so a
    category holding a third of all merchants is never sorted in one task.
    """
    per = e.groupBy("merchant_category", "merchant_id").agg(
        F.min("merchant_name").alias("merchant_name"), X.money_sum("revenue_cents").alias("rev"))
    if k == 1:
        best = per.groupBy("merchant_category").agg(
            F.min_by(F.struct("merchant_name", "rev"),
                     F.struct(-F.col("rev"), F.col("merchant_id"))).alias("b"))
        out = best.select("merchant_category", F.col("b.merchant_name").alias("merchant_name"),
                          X.round_money(F.col("b.rev"), 0).alias("revenue"))
    else:
        w = Window.partitionBy("merchant_category").orderBy(F.col("rev").desc(), "merchant_id")
        out = per.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k) \
            .select("merchant_category", "merchant_name", X.round_money(F.col("rev"), 0).alias("revenue"))
    return out.orderBy(F.col("revenue").desc(), "merchant_category")


def pareto(e: DataFrame, share: float = 0.80) -> DataFrame:
    """Q3.4: how many merchants (ranked by revenue) reach ``share`` of all revenue."""
    merch = e.groupBy("merchant_id").agg(X.money_sum("revenue_cents").alias("revenue"))
    ranked = global_rank(merch, [Key("revenue", ascending=False), Key("merchant_id")],
                         sum_cols=["revenue"])
    total = ranked.agg(F.sum("revenue")).scalar()
    hit = ranked.where(F.col("__cum_revenue") >= F.lit(Decimal(str(share))) * total)
    g = hit.agg(F.min("__rn").alias("k"), F.max("__n").alias("n_all"))
    n_all = ranked.agg(F.max("__n")).scalar()
    return g.select(
        F.col("k").cast("bigint").alias("merchants_to_80pct"),
        n_all.cast("bigint").alias("total_merchants"),
        X.round_ratio(F.col("k"), n_all, 1, 100).alias("pct_of_merchants"),
    )


def merchant_success_rates(e: DataFrame, min_txns: int = 100, n: int = 10,
                           ascending: bool = False) -> DataFrame:
    """Q3.5: merchants by success rate with a minimum volume (best first by default)."""
    g = _per_merchant(e).where(F.col("n") >= min_txns)
    rate = X.round_ratio(F.col("succ"), F.col("n"), 1, 100)
    out = g.select("merchant_name", "merchant_category", F.col("n").cast("bigint").alias("txns"),
                   rate.alias("success_rate_pct"), "merchant_id")
    order = F.col("success_rate_pct").asc() if ascending else F.col("success_rate_pct").desc()
    return out.orderBy(order, "merchant_id").limit(n).drop("merchant_id")


def readme_top_merchants(e: DataFrame, n: int = 10) -> DataFrame:
    """Top merchants by revenue with count and average amount (all statuses)."""
    top = _per_merchant(e).orderBy(F.col("rev").desc(), F.col("merchant_id").asc()).limit(n)
    return top.select(
        "merchant_id", "merchant_name",
        F.col("rev").cast("double").alias("total_revenue"),
        F.col("n").cast("bigint").alias("transaction_count"),
        X.round_ratio(F.col("amt"), F.col("n"), 2).alias("avg_amount"),
    )
