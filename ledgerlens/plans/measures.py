"""DAX-style measures (M1-M51) and filter context.

A measure is a named aggregate Column; ``measure_query`` evaluates any set of
them globally or under a group-by and a slicer set, in one aggregation pass.
Measures that need two steps (previous month, YTD, ranks, top-1) are plans
of their own below.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X
from ledgerlens.operators.ranking import sql_rank


@dataclass(frozen=True)
class Measure:
    """A named aggregate; ``expr`` builds the Column (built lazily, per query)."""

    name: str
    expr: Callable[[], Column]

    def column(self) -> Column:
        return self.expr().alias(self.name)


def _cnt() -> Column:
    return F.count(F.lit(1))


def _div0(num: Column, den: Column, digits: int, scale: int = 1) -> Column:
    """DIVIDE(num, den, 0): alternate result 0 on an empty denominator."""
    return F.coalesce(X.round_ratio(num, den, digits, scale), F.lit(0.0))


def _succ_amount() -> Column:
    return F.when(X.is_success(), F.col("amount_cents"))


# Simple measures over the enriched fact (one aggregation pass for any subset).
FACT_MEASURES: tuple[Measure, ...] = (
    Measure("total_transactions", lambda: _cnt().cast("bigint")),                                  # M1
    Measure("successful_transactions", lambda: F.count_if(F.col("is_success") == 1).cast("bigint")),  # M2
    Measure("failed_transactions", lambda: X.count_failed().cast("bigint")),                       # M3
    Measure("failed_transactions_readme", lambda: F.count_if(F.col("is_success") == 0).cast("bigint")),
    Measure("pending_transactions", lambda: F.count_if(F.col("status") == "PENDING").cast("bigint")),  # M4
    Measure("success_rate", lambda: X.round_ratio(F.count_if(F.col("is_success") == 1), _cnt(), 6)),  # M5
    Measure("success_rate_pct", lambda: _div0(F.count_if(F.col("is_success") == 1), _cnt(), 4, 100)),
    Measure("failure_rate_pct", lambda: _div0(X.count_failed(), _cnt(), 4, 100)),                   # M6
    Measure("total_amount", lambda: X.money_sum("amount_cents").cast("double")),                                # M7
    Measure("gpv", lambda: X.money_sum(_succ_amount()).cast("double")),                                   # M8
    Measure("total_revenue", lambda: X.money_sum("revenue_cents").cast("double")),                              # M9
    Measure("avg_ticket_size", lambda: X.round_ratio(X.money_sum(_succ_amount()), F.count(_succ_amount()), 4)),  # M10
    Measure("avg_transaction_amount", lambda: _div0(X.money_sum("amount_cents"), _cnt(), 4)),                   # M11
    Measure("active_customers", lambda: F.count_distinct("customer_id").cast("bigint")),            # M12
    Measure("active_merchants", lambda: F.count_distinct("merchant_id").cast("bigint")),            # M13
    Measure("avg_txns_per_customer", lambda: _div0(_cnt(), F.count_distinct("customer_id"), 4)),    # M22
    Measure("arpu", lambda: X.round_ratio(X.money_sum("revenue_cents"), F.count_distinct("customer_id"), 4)),  # M23
    Measure("avg_spend_per_customer",
            lambda: X.round_ratio(X.money_sum(_succ_amount()), F.count_distinct("customer_id"), 4)),      # M24
    Measure("failed_gpv", lambda: X.money_sum(F.when(X.is_failed(), F.col("amount_cents"))).cast("double")),   # M31
    Measure("est_revenue_lost",
            lambda: F.sum(F.when(X.is_failed(), F.col("amount").cast("decimal(18,2)") * F.col("commission_rate"))).cast("double")),  # M32
    Measure("txns_per_merchant", lambda: _div0(_cnt(), F.count_distinct("merchant_id"), 4)),        # M37
    Measure("merchants_with_success",
            lambda: F.count_distinct(F.when(F.col("is_success") == 1, F.col("merchant_id"))).cast("bigint")),  # M39
    Measure("total_banks", lambda: F.count_distinct("bank_id").cast("bigint")),                     # M41
    Measure("total_devices", lambda: F.count_distinct("device_id").cast("bigint")),                 # M44
    Measure("mobile_txn_pct",
            lambda: X.round_ratio(F.count_if(F.col("os_name").isin("Android", "iOS")), _cnt(), 4, 100)),  # M45
    Measure("weekend_txn_pct", lambda: X.round_ratio(F.count_if(F.col("is_weekend") == 1), _cnt(), 4, 100)),  # M46
    Measure("avg_commission_rate",
            lambda: X.round_ratio(F.sum("commission_rate"), F.count("commission_rate"), 8)),       # M48
    Measure("revenue_per_transaction", lambda: _div0(X.money_sum("revenue_cents"), _cnt(), 4)),                 # M49
)

# Measures over customer_features.
CUSTOMER_MEASURES: tuple[Measure, ...] = (
    Measure("total_customers_cf", lambda: _cnt().cast("bigint")),                                   # M26
    Measure("inactive_customers", lambda: F.count_if(F.col("is_inactive") == 1).cast("bigint")),    # M27
    Measure("inactive_rate_pct", lambda: X.round_ratio(F.count_if(F.col("is_inactive") == 1), _cnt(), 4, 100)),
    Measure("avg_clv", lambda: X.round_ratio(F.sum("lifetime_spend"), F.count("lifetime_spend"), 4)),  # M28
    Measure("avg_recency_days", lambda: X.round_ratio(F.sum("recency_days"), F.count("recency_days"), 4)),  # M29
    Measure("high_value_customers",
            lambda: F.count_distinct(F.when(F.col("f_score") >= 3, F.col("customer_id"))).cast("bigint")),  # M34
    Measure("churn_risk_customers",
            lambda: F.count_distinct(F.when(F.col("f_score") <= 1, F.col("customer_id"))).cast("bigint")),  # M36
    Measure("avg_rfm_score", lambda: X.round_ratio(F.sum("f_score"), F.count("f_score"), 4)),       # M47
)

MEASURES = {m.name: m for m in FACT_MEASURES + CUSTOMER_MEASURES}


def apply_slicers(df: DataFrame, slicers: Mapping[str, object] | None) -> DataFrame:
    """Conjunctive filters from {column: value or list of values}; pushed to the scan."""
    for col, val in (slicers or {}).items():
        many = list(val) if isinstance(val, (list, tuple, set, frozenset)) else [val]
        if not many:
            continue  # nothing selected: everything
        known = [v for v in many if v is not None]
        hit = F.col(col).isin(*known) if known else F.lit(False)
        df = df.where(hit if len(known) == len(many) else F.coalesce(hit, F.lit(False)) | F.col(col).isNull())
        if col == "txn_year" and known and len(known) == len(many) and "txn_year_month" in df.columns:
            df = df.where(F.substring("txn_year_month", 1, 4).isin(*[str(v) for v in known]))  # prunes month folders
    return df


def months_of(df: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Months from one date to another, on the column that the stored fact is partitioned by."""
    if "txn_year_month" in df.columns:
        for bound, keep in ((start, F.col("txn_year_month").__ge__), (end, F.col("txn_year_month").__le__)):
            if bound is not None:
                df = df.where(keep(F.date_format(bound, "yyyy-MM")))
    return df


def measure_query(df: DataFrame, measures: Iterable[Measure | str], by: Sequence[str] = (),
                  slicers: Mapping[str, object] | None = None) -> DataFrame:
    """Evaluate measures under slicers, globally or per group."""
    ms = [MEASURES[m] if isinstance(m, str) else m for m in measures]
    f = apply_slicers(df, slicers)
    cols = [m.column() for m in ms]
    out = f.groupBy(*by).agg(*cols) if by else f.agg(*cols)
    return out.orderBy(*by) if by else out


def kpi_card(e: DataFrame, slicers: Mapping[str, object] | None = None) -> DataFrame:
    """All simple fact measures in one row (one aggregation pass)."""
    return measure_query(e, FACT_MEASURES, slicers=slicers)


def customer_card(cf: DataFrame, e: DataFrame) -> DataFrame:
    """Customer-feature measures plus High Value Customer %."""
    one = measure_query(cf, CUSTOMER_MEASURES)
    total_customers = e.agg(F.count_distinct("customer_id")).scalar()
    return one.withColumn("high_value_customer_pct",
                          _div0(F.col("high_value_customers"), total_customers, 4, 100))


# ----------------------------------------------------------- nested measures
def previous_month(e: DataFrame, value: str = "revenue") -> DataFrame:
    """Value per month, previous calendar month (DATEADD -1 MONTH) and MoM %.

    A month without data has no row, so the next month's previous value is
    blank: a self-join on the month key, not a LAG over rows.
    """
    agg = {"revenue": X.money_sum("revenue_cents"), "gpv": X.money_sum(_succ_amount()), "transactions": _cnt()}[value]
    m = e.groupBy(F.trunc(F.col("txn_date"), "month").alias("month_start")).agg(agg.alias("v"))
    prev = m.select(F.add_months("month_start", 1).alias("month_start"), F.col("v").alias("pv"))
    j = m.join(prev, "month_start", "left")
    return j.select(
        F.date_format("month_start", "yyyy-MM").alias("year_month"),
        F.col("v").cast("double").alias(value),
        F.col("pv").cast("double").alias(f"{value}_pm"),
        X.round_ratio(F.col("v") - F.col("pv"), F.col("pv"), 4, 100).alias(f"{value}_mom_pct"),
    ).orderBy("year_month")


def year_to_date(e: DataFrame) -> DataFrame:
    """Revenue, GPV and transactions YTD at each month end."""
    m = e.groupBy("txn_year", "txn_month").agg(X.money_sum("revenue_cents").alias("rev"),
                                                X.money_sum(_succ_amount()).alias("gpv"), _cnt().alias("n"))
    w = Window.partitionBy("txn_year").orderBy("txn_month") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return m.select(
        F.col("txn_year").cast("int"), F.col("txn_month").cast("int"),
        F.sum("rev").over(w).cast("double").alias("revenue_ytd"),
        F.coalesce(F.sum("gpv").over(w), F.lit(0)).cast("double").alias("gpv_ytd"),
        F.sum("n").over(w).cast("bigint").alias("transactions_ytd"),
    ).orderBy("txn_year", "txn_month")


def cumulative_revenue_in_range(e: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Running revenue by date inside the selected date range."""
    as_date = lambda x: F.lit(x).cast("date") if x else None
    f = months_of(e, as_date(start), as_date(end))
    if start:
        f = f.where(F.col("txn_date") >= F.lit(start).cast("date"))
    if end:
        f = f.where(F.col("txn_date") <= F.lit(end).cast("date"))
    d = f.groupBy("txn_date").agg(X.money_sum("revenue_cents").alias("rev"))
    w = Window.orderBy("txn_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return d.select("txn_date", F.col("rev").cast("double").alias("revenue"),
                    F.sum("rev").over(w).cast("double").alias("cumulative_revenue")).orderBy("txn_date")


def repeat_customers(e: DataFrame, by: Sequence[str] = (), slicers=None) -> DataFrame:
    """Customers with more than one transaction, and their share (in the filter context)."""
    f = apply_slicers(e, slicers)
    per = f.groupBy(*by, "customer_id").agg(_cnt().alias("n"))
    g = per.groupBy(*by).agg(F.count_if(F.col("n") > 1).alias("rep"), _cnt().alias("cust")) if by \
        else per.agg(F.count_if(F.col("n") > 1).alias("rep"), _cnt().alias("cust"))
    return g.select(*by, F.col("rep").cast("bigint").alias("repeat_customers"),
                    X.round_ratio(F.col("rep"), F.col("cust"), 4, 100).alias("repeat_rate_pct"))


def new_customers_by_date(calendar: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers per registration date on the calendar (role-playing date)."""
    reg = customers.groupBy(F.col("registration_date").alias("date")).agg(
        F.count_distinct("customer_id").alias("n"))
    return calendar.select("date").join(reg, "date", "left") \
        .select("date", F.coalesce("n", F.lit(0)).cast("bigint").alias("new_customers")).orderBy("date")


def merchant_revenue_rank(e: DataFrame) -> DataFrame:
    """RANK of each merchant's revenue over ALL merchants (G1, no single partition)."""
    per = e.groupBy("merchant_id").agg(X.money_sum("revenue_cents").alias("revenue"))
    ranked = sql_rank(per, "revenue", ascending=False, out="merchant_revenue_rank")
    return ranked.select("merchant_id", F.col("revenue").cast("double"), "merchant_revenue_rank")


def peak_hour(e: DataFrame) -> DataFrame:
    """Hour with the most transactions (ties: the larger hour)."""
    h = e.groupBy("txn_hour").agg(_cnt().alias("n"))
    return h.agg(F.max_by("txn_hour", F.struct("n", "txn_hour")).cast("int").alias("peak_hour"),
                 F.max("n").cast("bigint").alias("peak_hour_txns"))


def top_merchant_revenue(e: DataFrame) -> DataFrame:
    """The largest per-merchant revenue."""
    per = e.groupBy("merchant_id").agg(X.money_sum("revenue_cents").alias("r"))
    return per.agg(F.max("r").cast("double").alias("top_merchant_revenue"))


def most_common_failure_reason(e: DataFrame) -> DataFrame:
    """Reason with most occurrences among non-null reasons (ties: the larger text)."""
    r = e.where(F.col("failure_reason").isNotNull()).groupBy("failure_reason").agg(_cnt().alias("n"))
    return r.agg(F.max_by("failure_reason", F.struct("n", "failure_reason")).alias("most_common_failure_reason"),
                 F.max("n").cast("bigint").alias("occurrences"))


def active_customers_last_days(e: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Distinct customers with a transaction on or after as_of - days."""
    f = months_of(e, F.date_sub(as_of, days)).where(F.col("txn_date") >= F.date_sub(as_of, days))
    return f.agg(F.count_distinct("customer_id").cast("bigint").alias(f"active_customers_{days}d"))


def base_failure_rate_avg(banks: DataFrame) -> DataFrame:
    """Mean base failure rate over the bank dimension."""
    return banks.agg(F.round(F.avg("base_failure_rate"), 10).alias("base_failure_rate_avg"))


def bank_success_rate(e: DataFrame) -> DataFrame:
    """Success rate % per bank."""
    return measure_query(e, ["total_transactions", "success_rate_pct"], by=["bank_name"])


def ticket_band_column(e: DataFrame, edges=X.SQL_BAND_EDGES) -> DataFrame:
    """The ticket band calculated column and the country constant."""
    return e.select("transaction_id", "amount", X.sql_ticket_band("amount", edges).alias("ticket_band"),
                    F.lit(X.COUNTRY).alias("country"))


# -------------------------------------------------------- X2-X4 visual helpers
def drill_through(e: DataFrame, key: str, value, columns: Sequence[str] = (
        "transaction_id", "txn_timestamp", "customer_id", "merchant_name", "bank_name", "amount", "status",
        "failure_reason")) -> DataFrame:
    """All transactions of one merchant or bank (a pushed-down equality filter)."""
    return e.where(F.col(key) == F.lit(value)).select(*columns)


def visual_top_n(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """Top-N by a measure with a total order (measure desc, key)."""
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(key)).limit(n)


def star(t) -> DataFrame:
    """The fact left-joined to its four dimensions (the BI model's relationships)."""
    from ledgerlens.plans.views import analysis_frame
    return analysis_frame(t)


def sorted_labels(e: DataFrame) -> DataFrame:
    """Transactions by weekday name and by month name, each with its sort-by column (label_kind, label, sort_by, txns)."""
    def count(kind: str, label: Column, order: Column) -> DataFrame:
        return e.groupBy(label.alias("label"), order.cast("int").alias("sort_by")).agg(F.count(F.lit(1)).cast("bigint").alias("txns")) \
            .select(F.lit(kind).alias("label_kind"), "label", "sort_by", "txns")

    days = count("weekday", X.sql_day_name(), F.col("txn_dow"))
    months = count("month", F.date_format("txn_date", "MMM"), F.col("txn_month"))
    return days.unionByName(months).orderBy("label_kind", "sort_by")
