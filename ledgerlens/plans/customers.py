"""02 Customer analytics (Q2.1-Q2.6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X
from ledgerlens.operators.bitsets import active, month_number, month_sets
from ledgerlens.operators.ranking import Key, materialize, ntile_from_rank, tile_scores


def newest_date(txn: DataFrame) -> Column:
    """'Now' of the queries: the newest transaction date, as a scalar subquery."""
    return txn.agg(F.to_date(F.max("txn_timestamp"))).scalar()


def clv_leaderboard(e: DataFrame, customers: DataFrame, as_of: Column, n: int = 20) -> DataFrame:
    """Q2.1: top customers by successful spend (aggregate first, then join the dimension)."""
    per = e.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_txns"),
        F.sum("is_success").alias("successful_txns"),
        X.sum_success("amount").alias("spend"),
        X.money_sum("revenue_cents").alias("rev"))
    cus = customers.select("customer_id", "customer_name", "state", "registration_date")
    j = per.join(cus, "customer_id")
    out = j.select(
        "customer_id", "customer_name", "state",
        F.col("total_txns").cast("bigint"),
        F.col("successful_txns").cast("bigint"),
        X.round_money(F.col("spend"), 0).alias("lifetime_spend"),
        X.round_money(F.col("rev"), 2).alias("revenue_contributed"),
        F.datediff(as_of, F.col("registration_date")).cast("bigint").alias("tenure_days"),
    )
    return out.orderBy(F.col("lifetime_spend").desc_nulls_last(), F.col("customer_id").asc()).limit(n)


def repeat_rate(txn: DataFrame) -> DataFrame:
    """Q2.2: share of active customers with more than one transaction."""
    per = txn.groupBy("customer_id").agg(F.count(F.lit(1)).alias("txns"))
    g = per.agg(F.count(F.lit(1)).alias("active"),
                F.count_if(F.col("txns") > 1).alias("rep"),
                F.sum("txns").alias("all_txns"))
    return g.select(
        F.col("active").cast("bigint").alias("active_customers"),
        F.col("rep").cast("bigint").alias("repeat_customers"),
        X.round_ratio(F.col("rep"), F.col("active"), 2, 100).alias("repeat_rate_pct"),
        X.round_ratio(F.col("all_txns"), F.col("active"), 1).alias("avg_txns_per_customer"),
    )


def rfm_scores_ntile(e: DataFrame, as_of: Column, buckets: int = 5) -> DataFrame:
    """Per-customer recency / frequency / monetary with NTILE scores (ties by customer id)."""
    cust = e.groupBy("customer_id").agg(
        F.max("txn_date").alias("last_txn"),
        F.count(F.lit(1)).alias("frequency"),
        X.sum_success("amount").alias("monetary"),
    ).withColumn("recency_days", F.datediff(as_of, F.col("last_txn")).cast("bigint"))
    def tile(rank, n):
        return ntile_from_rank(rank, n, buckets)
    return tile_scores(materialize(cust), {
        "r_score": ([Key("recency_days", ascending=False), Key("customer_id")], tile),
        "f_score": ([Key("frequency"), Key("customer_id")], tile),
        "m_score": ([Key("monetary", nulls_first=True), Key("customer_id")], tile),
    })


def rfm_segments(e: DataFrame, as_of: Column, buckets: int = 5) -> DataFrame:
    """Q2.3: RFM segments with NTILE(5) scores; counts and averages per segment."""
    scored = rfm_scores_ntile(e, as_of, buckets)
    g = scored.groupBy(X.rfm_segment().alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("recency_days").alias("sr"),
        F.sum("frequency").alias("sf"),
        F.sum("monetary").alias("sm"),
        F.count("monetary").alias("nm"))
    return g.select(
        "segment",
        F.col("customers").cast("bigint"),
        X.round_ratio(F.col("sr"), F.col("customers"), 0).alias("avg_recency_days"),
        X.round_ratio(F.col("sf"), F.col("customers"), 1).alias("avg_frequency"),
        X.round_ratio(F.col("sm"), F.col("nm"), 0).alias("avg_monetary"),
    ).orderBy(F.col("customers").desc(), "segment")


def inactive_customers(txn: DataFrame, customers: DataFrame, days: int = 90) -> DataFrame:
    """Q2.4: never-transacted and inactive (> days before the newest data date) customers."""
    last = txn.groupBy("customer_id").agg(F.max(F.to_date("txn_timestamp")).alias("last_txn"))
    data_max = newest_date(txn)
    seen = customers.select("customer_id").join(last, "customer_id", "left")
    inactive = F.col("last_txn").isNotNull() & (F.datediff(data_max, F.col("last_txn")) > days)
    g = seen.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.col("last_txn").isNull()).alias("never"),
                 F.count_if(inactive).alias("inactive"))
    return g.select(
        F.col("total").cast("bigint").alias("total_customers"),
        F.col("never").cast("bigint").alias("never_transacted"),
        F.col("inactive").cast("bigint").alias(f"inactive_{days}d"),
        X.round_ratio(F.col("inactive"), F.col("total"), 2, 100).alias("inactive_rate_pct"),
    )


def cohort_retention(txn: DataFrame, customers: DataFrame, start: str = "2023-01", n: int = 24,
                     offsets: tuple[int, ...] = (1, 3, 6), with_signups: bool = False) -> DataFrame:
    """Q2.5: signup-month cohorts; customers active k months after signing up.

    Transactions are reduced to one set of active months a customer (bits), and
    every offset is a shift on it: no offset adds a shuffle or an ``Expand``.
    """
    months = month_sets(txn, "customer_id", F.col("txn_timestamp"))
    firsts = customers.select(
        "customer_id",
        F.date_format("registration_date", "yyyy-MM").alias("cohort"),
        month_number(F.col("registration_date")).alias("signup"),
    ).where(F.col("cohort") >= start)
    per = months.join(firsts, "customer_id")
    g = per.groupBy("cohort").agg(F.count(F.lit(1)).alias("cohort_size"),
                                  *[F.sum(active(F.col("months"), F.col("signup") + k)).alias(f"m{k}_active") for k in offsets])
    out = g.select("cohort", F.col("cohort_size").cast("bigint"),
                   *[F.col(f"m{k}_active").cast("bigint") for k in offsets])
    if with_signups:
        signups = firsts.groupBy("cohort").agg(F.count(F.lit(1)).cast("bigint").alias("cohort_signups"))
        out = out.join(signups, "cohort", "left")
    return out.orderBy("cohort").limit(n)


def demographics(e: DataFrame) -> DataFrame:
    """Q2.6: age band x gender."""
    g = e.groupBy(X.age_band().alias("age_band"), "customer_gender").agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count(F.lit(1)).alias("txns"),
        X.sum_success("amount").alias("gpv"))
    return g.select("age_band", "customer_gender",
                    F.col("customers").cast("bigint"), F.col("txns").cast("bigint"),
                    X.round_money(F.col("gpv"), 0).alias("gpv")) \
        .orderBy("age_band", "customer_gender")
