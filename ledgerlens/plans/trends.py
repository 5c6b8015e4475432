"""04 Transaction trends (Q4.1-Q4.6).

Ordered windows here run over one row per hour, day or month: their size is
bounded by the calendar, not by the data, so a single window partition is
the right plan.  Frames over transactions (``moving_ticket``) go by blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X
from ledgerlens.operators.distinct import bound, counts, estimate, exact, merged, sketches
from ledgerlens.operators.ranking import Key
from ledgerlens.operators.sliding import global_lag, sliding


def hourly_distribution(e: DataFrame) -> DataFrame:
    """Q4.1: transactions per hour, share of the day, success rate."""
    g = e.groupBy("txn_hour").agg(F.count(F.lit(1)).alias("n"), F.sum("is_success").alias("succ"))
    return g.select(
        F.col("txn_hour").cast("int"),
        F.col("n").cast("bigint").alias("txns"),
        X.pct_of_total(F.col("n"), 2).alias("pct_of_day"),
        X.round_ratio(F.col("succ"), F.col("n"), 2, 100).alias("success_rate_pct"),
    ).orderBy("txn_hour")


def weekday_pattern(e: DataFrame) -> DataFrame:
    """Q4.2: day-of-week pattern (0 = Sunday)."""
    g = e.groupBy("txn_dow").agg(
        F.count(F.lit(1)).alias("n"),
        X.sum_success("amount").alias("gpv"),
        F.count(F.when(X.is_success(), F.col("amount"))).alias("n_gpv"))
    return g.select(
        X.sql_day_name().alias("day_name"),
        F.col("txn_dow").cast("int"),
        F.col("n").cast("bigint").alias("txns"),
        X.round_money(F.col("gpv"), 0).alias("gpv"),
        X.round_ratio(F.col("gpv"), F.col("n_gpv"), 0).alias("avg_ticket"),
    ).orderBy("txn_dow")


def _moving_avg(x: str, window_rows: int, order: str = "txn_date"):
    w = Window.orderBy(order).rowsBetween(-(window_rows - 1), Window.currentRow)
    return X.round_ratio(F.sum(x).over(w), F.count(x).over(w), 1)


def daily_volume(e: DataFrame, window_rows: int = 7, n: int = 30) -> DataFrame:
    """Q4.3: daily volume with a 7-row moving average; the newest n days."""
    d = e.groupBy("txn_date").agg(F.count(F.lit(1)).alias("txns"), X.sum_success("amount").alias("gpv"))
    return d.select(
        "txn_date",
        F.col("txns").cast("bigint"),
        _moving_avg("txns", window_rows).alias("ma7_txns"),
        X.round_money(F.col("gpv"), 0).alias("gpv"),
    ).orderBy(F.col("txn_date").desc()).limit(n)


def daily_volume_spine(e: DataFrame, window_rows: int = 7, n: int = 30) -> DataFrame:
    """Q4.3 on a date spine: a day without transactions counts as 0 in the window."""
    d = e.groupBy("txn_date").agg(F.count(F.lit(1)).alias("txns"), X.sum_success("amount").alias("gpv"))
    bounds = d.agg(F.min("txn_date").alias("s"), F.max("txn_date").alias("e"))
    spine = bounds.select(F.explode(F.sequence("s", "e")).alias("txn_date"))
    full = spine.join(d, "txn_date", "left").fillna(0, subset=["txns"])
    return full.select(
        "txn_date",
        F.col("txns").cast("bigint"),
        _moving_avg("txns", window_rows).alias("ma7_txns"),
        X.round_money(F.col("gpv"), 0).alias("gpv"),
    ).orderBy(F.col("txn_date").desc()).limit(n)


def cumulative_revenue(e: DataFrame) -> DataFrame:
    """Q4.4: monthly revenue and its running total."""
    m = e.groupBy("txn_year_month").agg(X.money_sum("revenue_cents").alias("rev"))
    w = Window.orderBy("txn_year_month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return m.select(
        "txn_year_month",
        X.round_money(F.col("rev"), 0).alias("monthly_revenue"),
        X.round_money(F.sum("rev").over(w), 0).alias("cumulative_revenue"),
    ).orderBy("txn_year_month")


def daily_active_users(e: DataFrame, window_rows: int = 7, n: int = 30) -> DataFrame:
    """Q4.5: distinct customers per day and their 7-row average; the newest n days."""
    d = e.select("txn_date", "customer_id").distinct().groupBy("txn_date") \
        .agg(F.count(F.lit(1)).alias("dau"))
    return d.select(
        "txn_date",
        F.col("dau").cast("bigint"),
        _moving_avg("dau", window_rows).alias("dau_ma7"),
    ).orderBy(F.col("txn_date").desc()).limit(n)


def stickiness(e: DataFrame) -> DataFrame:
    """Q4.6 as written: MAU, MAU / active days, and (MAU / days) / MAU in %.

    Customers and days are counted apart, each from its own distinct pairs (no row is expanded).
    """
    mau = e.groupBy("txn_year_month").agg(F.count_distinct("customer_id").alias("mau"))
    days = e.groupBy(F.col("txn_year_month").alias("month")).agg(F.count_distinct("txn_date").alias("days"))
    g = mau.join(days, F.col("txn_year_month").eqNullSafe(F.col("month")))
    return g.select(
        "txn_year_month",
        F.col("mau").cast("bigint"),
        X.round_ratio(F.col("mau"), F.col("days"), 0).alias("avg_daily_active"),
        X.round_ratio(F.col("mau"), F.col("mau") * F.col("days"), 1, 100).alias("stickiness_pct"),
    ).orderBy("txn_year_month")


def true_stickiness(e: DataFrame) -> DataFrame:
    """Q4.6 with true average DAU: mean daily distinct customers / MAU."""
    dd = e.select("txn_year_month", "txn_date", "customer_id").distinct()
    daily = dd.groupBy("txn_year_month", "txn_date").agg(F.count(F.lit(1)).alias("dau"))
    per_m = daily.groupBy("txn_year_month").agg(F.sum("dau").alias("sum_dau"), F.count(F.lit(1)).alias("days"))
    mau = dd.groupBy("txn_year_month").agg(F.count_distinct("customer_id").alias("mau"))
    j = per_m.join(mau, "txn_year_month")
    return j.select(
        "txn_year_month",
        F.col("mau").cast("bigint"),
        X.round_ratio(F.col("sum_dau"), F.col("days"), 0).alias("avg_daily_active"),
        X.round_ratio(F.col("sum_dau"), F.col("days") * F.col("mau"), 1, 100).alias("stickiness_pct"),
    ).orderBy("txn_year_month")


def moving_ticket(txn: DataFrame, window_rows: int = 7) -> DataFrame:
    """Q4.3's moving average over transactions instead of days: each one's amount, the one before and the average of the last rows.

    The order has a row for each transaction, so the frames run over frozen ranges with halos (``operators/sliding``).
    """
    rows = txn.select("transaction_id", "txn_timestamp", "amount_cents")
    keys = [Key("txn_timestamp"), Key("transaction_id"), Key("amount_cents")]
    out = sliding(rows, keys, {"total": F.sum("amount_cents"), "n": F.count("amount_cents")}, window_rows - 1)
    out = global_lag(out, keys, "amount_cents", 1, "prev_cents")
    return out.select("transaction_id", F.to_date("txn_timestamp").alias("txn_date"), "amount_cents", "prev_cents",
                      X.round_ratio(F.col("total"), F.col("n"), 2).alias("ma7_cents"))


def sketched_active_users(e: DataFrame) -> DataFrame:
    """Q4.5 and Q4.6 from daily sketches: monthly users by merging days, each estimate held against the exact count.

    ``mau_within`` and ``days_within`` say whether (and on how many days) the estimate lies within the sketch's bound.
    """
    most = bound()
    daily = sketches(e, ["txn_year_month", "txn_date"], "customer_id")
    monthly = merged(daily, ["txn_year_month"]).select("txn_year_month", estimate().alias("about"))
    pairs = exact(e, ["txn_year_month", "txn_date"], "customer_id")
    near = lambda about, n: F.abs(F.col(about) - F.col(n)) <= F.greatest(F.lit(1.0), F.col(n) * most)
    mau = counts(pairs, ["txn_year_month"], "customer_id", "mau")
    dau = counts(pairs, ["txn_year_month", "txn_date"], "customer_id", "dau")
    days = daily.select("txn_year_month", "txn_date", estimate().alias("about")).join(dau, ["txn_year_month", "txn_date"])
    days = days.groupBy("txn_year_month").agg(F.count(F.lit(1)).alias("days"), F.count_if(near("about", "dau")).alias("days_within"))
    return monthly.join(mau, "txn_year_month").join(days, "txn_year_month").select(
        "txn_year_month", F.col("mau").cast("bigint"), near("about", "mau").alias("mau_within"), F.col("days").cast("bigint"), F.col("days_within").cast("bigint")).orderBy("txn_year_month")
