"""Transaction features (F1-F10) and customer features.

The reference computes these eagerly in pandas; here they are lazy
DataFrame transforms.  The two global facts they need (the p90 ticket and the
newest timestamp) are scalar subqueries planned once, not driver collects.
Customer features are one ``groupBy(customer_id)`` with conditional
aggregates (the reference groups twice), and the quintile scores use the G1
global rank instead of a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X
from ledgerlens.operators.ranking import Key, materialize, qcut_from_rank, quantiles, tile_scores

TXN_FEATURE_COLUMNS = (
    "transaction_id", "customer_id", "merchant_id", "bank_id", "device_id", "amount", "status",
    "failure_reason", "payment_mode", "txn_timestamp", "txn_dt", "merchant_name", "merchant_category",
    "commission_rate", "merchant_state", "merchant_city", "age", "gender", "customer_state",
    "customer_city", "registration_date", "bank_name", "bank_type", "os_name", "os_version",
    "txn_hour", "txn_day", "txn_month", "txn_year", "txn_year_month", "txn_dow", "txn_day_name",
    "is_weekend", "is_success", "is_failed", "revenue", "high_value_flag", "ticket_band", "daypart",
)

CUSTOMER_FEATURE_COLUMNS = (
    "customer_id", "n_txns", "n_success", "n_failed", "first_txn", "last_txn", "distinct_merchants",
    "high_value_txns", "lifetime_spend", "avg_ticket", "revenue_contributed", "success_rate",
    "high_value_share", "recency_days", "active_lifespan_days", "is_inactive", "registration_date",
    "tenure_days", "age", "gender", "state", "r_score", "f_score", "m_score", "segment",
)

#: What U1-U8 read of F10.
CUSTOMER_FEATURE_INPUTS = ("customer_id", "merchant_id", "txn_dt", "is_success", "is_failed", "high_value_flag", "amount_cents", "revenue_cents")


def percentile(df: DataFrame, col: str, p: float, approximate: bool = False) -> Column:
    """Quantile of ``col`` as a scalar subquery: linear interpolation (pandas .quantile) or Spark's sketch."""
    if approximate:
        return df.agg(F.percentile_approx(F.col(col).cast("double"), p, 100_000)).scalar()
    return quantiles(df, F.col(col), [p]).agg(F.max(F.col("q")[0])).scalar()


def engineer_transaction_features(frame: DataFrame, hv_quantile: float = X.HIGH_VALUE_QUANTILE,
                                  band_edges=X.PANDAS_BAND_EDGES, approximate: bool = False,
                                  high_value: bool = True) -> DataFrame:
    """F1-F8 on the analysis frame (V3); returns the 39 columns of F10.

    ``approximate`` takes the high-value limit (F6) from Spark's quantile sketch.  Without ``high_value``
    that limit, a pass of its own, is not computed and F6 is left out, for readers of other columns.
    """
    dt = F.col("txn_dt")
    out = frame.withColumns({
        "txn_hour": F.hour(dt),
        "txn_day": F.dayofmonth(dt),
        "txn_month": F.month(dt),
        "txn_year": F.year(dt),
        "txn_year_month": X.year_month(dt),
        "txn_dow": F.weekday(dt),
        "txn_day_name": F.date_format(dt, "EEEE"),
    })
    out = out.withColumns({
        "is_weekend": F.when(F.col("txn_dow") >= 5, 1).otherwise(0),
        "is_success": X.success_flag(),
        "is_failed": X.failed_flag(),
    })
    out = out.withColumns({
        "revenue": F.when(F.col("is_success") == 1, X.commission("amount", "commission_rate"))
        .otherwise(F.lit(0).cast("decimal(18,2)")),
        "ticket_band": X.pandas_ticket_band("amount", band_edges),
        "daypart": X.daypart("txn_hour"),
    })
    out = out.withColumn("revenue_cents", X.revenue_cents_expr())
    if high_value:
        out = with_high_value(out, frame, hv_quantile, approximate)
    return out.select(*[c for c in TXN_FEATURE_COLUMNS if high_value or c != "high_value_flag"], "amount_cents", "revenue_cents")


def with_high_value(out: DataFrame, frame: DataFrame, hv_quantile: float = X.HIGH_VALUE_QUANTILE, approximate: bool = False) -> DataFrame:
    """whether a ticket reaches the quantile of all tickets of ``frame``."""
    p90 = percentile(frame, "amount", hv_quantile, approximate)
    return out.withColumn("high_value_flag", F.when(F.col("amount").cast("double") >= p90, 1).otherwise(0))


def success_amount(txn_feat: DataFrame) -> DataFrame:
    """amount * is_success helper column."""
    return txn_feat.withColumn("success_amount", F.col("amount") * F.col("is_success"))


def engineer_customer_features(txn_feat: DataFrame, customers: DataFrame,
                               inactive_days: int = X.INACTIVE_DAYS, bins: int = 5, stored: bool = False) -> DataFrame:
    """One row per transacting customer (25 columns).

    Where ``txn_feat`` is ``stored``, so that reading it twice costs little, pairs of customer and merchant are
    counted on their own: no partial sums are moved for each pair.
    """
    succ_amt = F.when(F.col("is_success") == 1, F.col("amount_cents"))
    g = txn_feat.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_txns"),
        F.sum("is_success").alias("n_success"),
        F.sum("is_failed").alias("n_failed"),
        F.min("txn_dt").alias("first_txn"),
        F.max("txn_dt").alias("last_txn"),
        *([] if stored else [F.count_distinct("merchant_id").alias("distinct_merchants")]),
        F.sum("high_value_flag").alias("high_value_txns"),
        X.money_sum(succ_amt).alias("__spend"),
        F.count(succ_amt).alias("__nspend"),
        X.money_sum("revenue_cents").alias("revenue_contributed"),
    )
    if stored:
        pairs = txn_feat.select(F.col("customer_id").alias("__of"), "merchant_id").where(F.col("merchant_id").isNotNull()).distinct()
        pairs = pairs.groupBy("__of").agg(F.count(F.lit(1)).alias("__merchants"))
        g = g.join(pairs, F.col("customer_id").eqNullSafe(F.col("__of")), "left") \
            .withColumn("distinct_merchants", F.coalesce("__merchants", F.lit(0))).drop("__of", "__merchants")
    # A row for each customer, kept: the newest date comes from them, without a further pass over the fact.
    g = materialize(g)
    data_max = g.agg(F.max("last_txn")).scalar()
    cus = customers.select("customer_id", "registration_date", "age", "gender", "state")
    j = g.join(cus, "customer_id", "left")
    feats = j.select(
        "customer_id",
        F.col("n_txns").cast("bigint"),
        F.col("n_success").cast("bigint"),
        F.col("n_failed").cast("bigint"),
        "first_txn", "last_txn",
        F.col("distinct_merchants").cast("bigint"),
        F.col("high_value_txns").cast("bigint"),
        F.coalesce(F.col("__spend"), F.lit(0).cast("decimal(28,2)")).alias("lifetime_spend"),
        F.coalesce(F.try_divide(F.col("__spend").cast("double"), F.col("__nspend").cast("double")),
                   F.lit(0.0)).alias("avg_ticket"),
        "revenue_contributed",
        X.round_ratio_even(F.col("n_success"), F.col("n_txns"), 4).alias("success_rate"),
        X.round_ratio_even(F.col("high_value_txns"), F.col("n_txns"), 4).alias("high_value_share"),
        X.whole_days_between(F.col("last_txn"), data_max).alias("recency_days"),
        X.whole_days_between(F.col("first_txn"), F.col("last_txn")).alias("active_lifespan_days"),
        F.when(X.whole_days_between(F.col("last_txn"), data_max) > inactive_days, 1).otherwise(0)
        .alias("is_inactive"),
        F.col("registration_date"),
        X.whole_days_between(F.col("registration_date").cast("timestamp_ntz"), data_max).alias("tenure_days"),
        "age", "gender", "state",
    )
    def tile(rank, n):
        return qcut_from_rank(rank, n, bins)
    scored = tile_scores(materialize(feats), {
        "r_score": ([Key("recency_days"), Key("customer_id")], tile),
        "f_score": ([Key("n_txns"), Key("customer_id")], tile),
        "m_score": ([Key("lifetime_spend"), Key("customer_id")], tile),
    })
    scored = scored.withColumn("r_score", (F.lit(bins + 1) - F.col("r_score")).cast("int"))
    return scored.withColumn("segment", X.rfm_segment()).select(*CUSTOMER_FEATURE_COLUMNS)
