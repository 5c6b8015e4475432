"""Dashboard visual queries (P1-P23) that are not already a Q or M query.

Pivots always receive their value list, so Spark does not run an extra job
to discover the distinct values; hierarchies use ``rollup`` (one pass for
both levels); top-N visuals use a total order so the limit is repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X
from ledgerlens.operators.histogram import width_bucket_counts

WEEKDAY_SHORT = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def _cnt():
    return F.count(F.lit(1))


def revenue_by_payment_mode(e: DataFrame) -> DataFrame:
    """P1."""
    return e.groupBy("payment_mode").agg(X.money_sum("revenue_cents").cast("double").alias("revenue")) \
        .orderBy(F.col("revenue").desc(), "payment_mode")


def revenue_by_quarter(e: DataFrame) -> DataFrame:
    """P2 (first half): revenue per year and quarter."""
    return e.groupBy(F.col("txn_year").cast("int").alias("txn_year"),
                     F.quarter("txn_date").alias("quarter")) \
        .agg(X.money_sum("revenue_cents").cast("double").alias("revenue")).orderBy("txn_year", "quarter")


def customers_per_segment(cf: DataFrame) -> DataFrame:
    """P3."""
    return cf.groupBy("segment").agg(_cnt().cast("bigint").alias("customers")) \
        .orderBy(F.col("customers").desc(), "segment")


def rfm_scatter(cf: DataFrame) -> DataFrame:
    """P4."""
    return cf.select("customer_id", "n_txns", F.col("lifetime_spend").cast("double"), "segment", "recency_days")


def clv_top(cf: DataFrame, n: int = 20) -> DataFrame:
    """P5."""
    return cf.select("customer_id", F.col("lifetime_spend").cast("double"), "n_txns", "segment", "state") \
        .orderBy(F.col("lifetime_spend").desc(), "customer_id").limit(n)


def customers_by_gender(cf: DataFrame, high_value_min_f: int = 3) -> DataFrame:
    """Customers and high value customers (f_score >= 3) by gender."""
    return cf.groupBy("gender").agg(
        _cnt().cast("bigint").alias("customers"),
        F.count_if(F.col("f_score") >= high_value_min_f).cast("bigint").alias("high_value_customers"),
    ).orderBy("gender")


def recency_histogram(cf: DataFrame, bins: int = 20) -> DataFrame:
    """Equal-width histogram of recency days."""
    return width_bucket_counts(cf, "recency_days", bins)


def new_customers_by_month(customers: DataFrame) -> DataFrame:
    """P8."""
    return customers.groupBy(F.date_format("registration_date", "yyyy-MM").alias("year_month")) \
        .agg(F.count_distinct("customer_id").cast("bigint").alias("new_customers")).orderBy("year_month")


def category_merchant_hierarchy(e: DataFrame) -> DataFrame:
    """GPV at category and category x merchant level in one rollup pass."""
    g = e.rollup("merchant_category", "merchant_id").agg(
        X.money_sum(F.when(X.is_success(), F.col("amount_cents"))).cast("double").alias("gpv"),
        F.grouping_id().alias("level"))
    return g.where(F.col("level") < 3).select(
        "merchant_category", "merchant_id",
        F.when(F.col("level") == 1, "category").otherwise("merchant").alias("level"), "gpv")


def category_matrix(e: DataFrame) -> DataFrame:
    """P10: revenue, GPV, success %, average ticket per category."""
    succ_amt = F.when(X.is_success(), F.col("amount_cents"))
    return e.groupBy("merchant_category").agg(
        X.money_sum("revenue_cents").cast("double").alias("revenue"),
        X.money_sum(succ_amt).cast("double").alias("gpv"),
        X.round_ratio(F.sum("is_success"), _cnt(), 4, 100).alias("success_rate_pct"),
        X.round_ratio(X.money_sum(succ_amt), F.count(succ_amt), 4).alias("avg_ticket"),
    ).orderBy("merchant_category")


def merchant_scatter(e: DataFrame, merchants: DataFrame) -> DataFrame:
    """Per merchant volume, success rate and popularity."""
    g = e.groupBy("merchant_id").agg(_cnt().alias("n"), F.sum("is_success").alias("s"))
    return g.join(merchants.select("merchant_id", "popularity"), "merchant_id").select(
        "merchant_id", F.col("n").cast("bigint").alias("txns"),
        X.round_ratio(F.col("s"), F.col("n"), 4, 100).alias("success_rate_pct"), "popularity")


def month_weekday_heatmap(e: DataFrame) -> DataFrame:
    """Transactions per month x weekday (Monday first)."""
    day = F.date_format("txn_date", "EEE")
    return e.withColumn("day", day).groupBy("txn_year_month").pivot("day", list(WEEKDAY_SHORT)) \
        .agg(_cnt().cast("bigint")).fillna(0).orderBy("txn_year_month")


OTHER = "other"


def _listed(col: str, values: Sequence[str]) -> Column:
    """The value if it is listed, else "other", so that a matrix keeps the total."""
    return F.when(F.col(col).isin(*values), F.col(col)).otherwise(F.lit(OTHER))


def bank_type_reason_matrix(e: DataFrame, reasons: Sequence[str]) -> DataFrame:
    """Failures per bank type x listed reason, with a column for all other reasons."""
    return e.where(X.is_failed()).withColumn("reason", _listed("failure_reason", reasons)).groupBy("bank_type") \
        .pivot("reason", [*reasons, OTHER]).agg(_cnt().cast("bigint")).fillna(0).orderBy("bank_type")


def state_category_matrix(e: DataFrame, categories: Sequence[str]) -> DataFrame:
    """GPV per state x listed category, with a column for all other categories."""
    return e.where(X.is_success()).withColumn("category", _listed("merchant_category", categories)).groupBy("customer_state") \
        .pivot("category", [*categories, OTHER]).agg(X.money_sum("amount_cents").cast("double")).orderBy("customer_state")


def top_merchants_revenue(e: DataFrame, n: int = 5) -> DataFrame:
    """P15 (a): top n merchants by revenue."""
    g = e.groupBy("merchant_id").agg(F.min("merchant_name").alias("merchant_name"),
                                     X.money_sum("revenue_cents").alias("r"))
    return g.orderBy(F.col("r").desc(), "merchant_id").limit(n) \
        .select("merchant_id", "merchant_name", F.col("r").cast("double").alias("revenue"))


def success_failed_split(e: DataFrame) -> DataFrame:
    """P15 (b): transactions per status group."""
    return e.groupBy("status").agg(_cnt().cast("bigint").alias("txns")).orderBy("status")


def revenue_trend(e: DataFrame) -> DataFrame:
    """P15 (c): revenue per month."""
    return e.groupBy("txn_year_month").agg(X.money_sum("revenue_cents").cast("double").alias("revenue")) \
        .orderBy("txn_year_month")


def txns_by_city(e: DataFrame) -> DataFrame:
    """P16 (a)."""
    return e.groupBy("customer_city").agg(_cnt().cast("bigint").alias("txns")).orderBy("customer_city")


def avg_amount_by_age(e: DataFrame) -> DataFrame:
    """P16 (b)."""
    return e.groupBy("customer_age").agg(X.round_ratio(X.money_sum("amount_cents"), _cnt(), 4).alias("avg_amount")) \
        .orderBy("customer_age")


def commission_by_merchant(e: DataFrame) -> DataFrame:
    """P17 (a): average commission rate per merchant (per transaction)."""
    return e.groupBy("merchant_id").agg(
        X.round_ratio(F.sum("commission_rate"), F.count("commission_rate"), 8).alias("avg_commission_rate"))


def txns_by_category(e: DataFrame) -> DataFrame:
    """P17 (b)."""
    return e.groupBy("merchant_category").agg(_cnt().cast("bigint").alias("txns")).orderBy("merchant_category")


def bank_volume_share(e: DataFrame, banks: DataFrame) -> DataFrame:
    """P18 (a): transactions and market share per bank."""
    g = e.groupBy("bank_id").agg(_cnt().cast("bigint").alias("txns"))
    return g.join(banks.select("bank_id", "bank_name", "market_share"), "bank_id") \
        .select("bank_id", "bank_name", "txns", "market_share")


def os_share(e: DataFrame) -> DataFrame:
    """P18 (b): share of transactions per device OS (null OS included)."""
    g = e.groupBy("os_name").agg(_cnt().alias("n"))
    return g.select("os_name", F.col("n").cast("bigint").alias("txns"),
                    X.round_ratio(F.col("n"), F.sum("n").over(Window.partitionBy()), 4, 100).alias("pct"))


def transaction_detail(e: DataFrame, customers: DataFrame, after: tuple | None = None,
                       page_size: int = 100) -> DataFrame:
    """Detail rows, keyset-paged by (date, transaction id) after the given key."""
    d = e.select("txn_date", "transaction_id", "customer_id", "merchant_name",
                 F.col("amount").cast("double").alias("amount"), "status")
    d = d.join(customers.select("customer_id", "customer_name"), "customer_id")
    if after is not None:
        d = d.where((F.col("txn_date") > F.lit(after[0]).cast("date"))
                    | ((F.col("txn_date") == F.lit(after[0]).cast("date")) & (F.col("transaction_id") > after[1])))
    return d.select("txn_date", "transaction_id", "customer_name", "merchant_name", "amount", "status") \
        .orderBy("txn_date", "transaction_id").limit(page_size)


def failure_rate_by_date(e: DataFrame) -> DataFrame:
    """P20."""
    return e.groupBy("txn_date").agg(_cnt().cast("bigint").alias("txns"),
                                     X.round_ratio(X.count_failed(), _cnt(), 4, 100).alias("failure_rate_pct")) \
        .orderBy("txn_date")


def bank_reason_failures(e: DataFrame) -> DataFrame:
    """Failures per bank and reason."""
    return e.where(X.is_failed()).groupBy("bank_name", "failure_reason") \
        .agg(_cnt().cast("bigint").alias("failures")).orderBy("bank_name", "failure_reason")


def regional_table(e: DataFrame) -> DataFrame:
    """State, city, customers, txns, revenue, success %."""
    return e.groupBy("customer_state", "customer_city").agg(
        F.count_distinct("customer_id").cast("bigint").alias("customers"),
        _cnt().cast("bigint").alias("txns"),
        X.money_sum("revenue_cents").cast("double").alias("revenue"),
        X.round_ratio(F.sum("is_success"), _cnt(), 4, 100).alias("success_rate_pct"),
    ).orderBy("customer_state", "customer_city")


def top_n_share(e: DataFrame, n: int = 10) -> DataFrame:
    """The top-n merchants' share of all revenue."""
    per = e.groupBy("merchant_id").agg(X.money_sum("revenue_cents").alias("r"))
    top = per.orderBy(F.col("r").desc(), "merchant_id").limit(n).agg(F.sum("r").alias("top"))
    total = per.agg(F.sum("r")).scalar()
    return top.select(F.col("top").cast("double").alias(f"top{n}_revenue"),
                      X.round_ratio(F.col("top"), total, 4, 100).alias(f"top{n}_share_pct"))
