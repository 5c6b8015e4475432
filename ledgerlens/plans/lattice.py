"""Aggregate lattice: partial aggregates by grouping set, and a navigator that picks the coarsest that suffices.

A dashboard asks the same additive measures under ever new slicers and groupings.  The lattice stores, for each
of ``GROUPINGS``, the partial sums that all additive measures are made of (counts and sums of minor units by
status).  A question names the columns that it groups or slices by; ``navigate`` takes the stored grouping that
holds them all with the fewest columns, and ``answer`` finishes the measures from its rows.  Only a question that
no grouping covers reads facts.  Distinct customers and merchants don't add up: they are counted from stored
distinct pairs of the grouping and the id.

The partials are sums of longs, so an answer equals the one from the facts to the last digit.  Coarser groupings
are built from the finest that covers them: the facts are read once for each grouping that none covers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X
from ledgerlens.operators.distinct import exact
from ledgerlens.plans.measures import apply_slicers
from ledgerlens.plans.store import materialized

MONTH = ("txn_year", "txn_month", "txn_year_month")
#: Finest first; each is built from an earlier one that covers it, or from the facts.
GROUPINGS: tuple[tuple[str, ...], ...] = (
    (*MONTH, "payment_mode", "customer_state", "merchant_category"),
    (*MONTH, "payment_mode", "customer_state"),
    (*MONTH, "merchant_category"),
    (*MONTH, "payment_mode"),
    MONTH,
    ("payment_mode",),
    ("bank_id",),
    ("os_name",),
)


def _partials() -> list[Column]:
    cents, revenue = F.col("amount_cents"), F.col("revenue_cents")
    won, lost = F.col("is_success") == 1, X.is_failed()
    half = lambda name, value: [F.sum(F.call_function("div", value, F.lit(1_000_000))).alias(f"{name}_high"), F.sum(value % 1_000_000).alias(f"{name}_low")]
    return [F.count(F.lit(1)).alias("n"), F.count_if(won).alias("n_success"), F.count_if(lost).alias("n_failed"),
            F.count_if(F.col("status") == "PENDING").alias("n_pending"), F.count(cents).alias("n_amount"), F.count(F.when(won, cents)).alias("n_success_amount"),
            *half("amount", cents), *half("success", F.when(won, cents)), *half("failed", F.when(lost, cents)), *half("revenue", revenue)]


PARTIALS = ("n", "n_success", "n_failed", "n_pending", "n_amount", "n_success_amount", *(f"{x}_{h}" for x in ("amount", "success", "failed", "revenue") for h in ("high", "low")))


def _again() -> list[Column]:
    return [F.sum(c).alias(c) for c in PARTIALS]


def _money(name: str) -> Column:
    """The exact sum of minor units as decimal(28,2): a sum of millions and a sum of rests, so that no count of rows overflows."""
    high, low = F.sum(f"{name}_high").cast("decimal(20,0)"), F.sum(f"{name}_low").cast("decimal(20,0)")
    return ((high * F.lit(1_000_000) + low).cast("decimal(30,0)") / F.lit(100)).cast("decimal(28,2)")


def _count(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


def _div0(num: Column, den: Column, digits: int, scale: int = 1) -> Column:
    return F.coalesce(X.round_ratio(num, den, digits, scale), F.lit(0.0))


#: The additive measures, finished from partials.
FINISH = {
    "total_transactions": lambda: _count("n").cast("bigint"),
    "successful_transactions": lambda: _count("n_success").cast("bigint"),
    "failed_transactions": lambda: _count("n_failed").cast("bigint"),
    "pending_transactions": lambda: _count("n_pending").cast("bigint"),
    "success_rate": lambda: X.round_ratio(_count("n_success"), _count("n"), 6),
    "success_rate_pct": lambda: _div0(_count("n_success"), _count("n"), 4, 100),
    "failure_rate_pct": lambda: _div0(_count("n_failed"), _count("n"), 4, 100),
    "total_amount": lambda: _money("amount").cast("double"),
    "gpv": lambda: _money("success").cast("double"),
    "total_revenue": lambda: _money("revenue").cast("double"),
    "failed_gpv": lambda: _money("failed").cast("double"),
    "avg_ticket_size": lambda: X.round_ratio(_money("success"), _count("n_success_amount"), 4),
    "avg_transaction_amount": lambda: _div0(_money("amount"), _count("n"), 4),
    "revenue_per_transaction": lambda: _div0(_money("revenue"), _count("n"), 4),
}

#: Measures that don't add up: answered from stored distinct pairs of a grouping and this column.
DISTINCT = {"active_customers": "customer_id", "active_merchants": "merchant_id"}


class Lattice:
    """Stored groupings of one enriched fact; ``name`` and ``sources`` key them in the store."""

    def __init__(self, fact: DataFrame, name: str, sources: Sequence[str], groupings: Sequence[Sequence[str]] = GROUPINGS):
        self.fact, self.name, self.sources = fact, name, sources
        self.groupings = [tuple(g) for g in groupings]

    @property
    def spark(self) -> SparkSession:
        return self.fact.sparkSession

    def navigate(self, columns: Sequence[str]) -> tuple[str, ...] | None:
        """The stored grouping with the fewest columns that holds all of ``columns``; None if none does."""
        covering = [g for g in self.groupings if set(columns) <= set(g)]
        return min(covering, key=lambda g: (len(g), self.groupings.index(g)), default=None)

    def stored(self, grouping: tuple[str, ...]) -> DataFrame:
        """The rows of a grouping, written once for the present inputs."""
        def build():
            finer = [g for g in self.groupings[:self.groupings.index(grouping)] if set(grouping) < set(g)]
            if finer:
                return self.stored(min(finer, key=len)).groupBy(*grouping).agg(*_again())
            return self.fact.groupBy(*grouping).agg(*_partials())
        return materialized(self.spark, f"lattice-{self.name}-{'-'.join(grouping)}", self.sources, build)

    def pairs(self, grouping: tuple[str, ...], value: str) -> DataFrame:
        """The distinct (grouping, value) rows, written once for the present inputs."""
        return materialized(self.spark, f"pairs-{self.name}-{'-'.join(grouping)}-{value}", self.sources, lambda: exact(self.fact, grouping, value))

    def answer(self, measures: Sequence[str], by: Sequence[str | tuple[str, Column, Sequence[str]]] = (), slicers: Mapping[str, object] | None = None) -> DataFrame:
        """``measures`` under ``slicers``, globally or by columns; an entry of ``by`` may be (name, expression, columns that it reads).

        Raises LookupError if no stored grouping holds the columns; ``measure_query`` then answers from facts.
        """
        named = [(b, F.col(b), [b]) if isinstance(b, str) else b for b in by]
        slicers = {c: v for c, v in (slicers or {}).items() if not isinstance(v, (list, tuple, set, frozenset)) or v}  # nothing selected: everything
        needed = [c for _, _, cs in named for c in cs] + list(slicers)
        grouping = self.navigate(needed)
        if grouping is None or any(m not in FINISH and m not in DISTINCT for m in measures):
            raise LookupError(f"no stored grouping answers {list(measures)} by {needed}")
        keys = [name for name, _, _ in named]
        grouped = lambda rows: apply_slicers(rows, slicers).groupBy(*[e.alias(name) for name, e, _ in named])
        out = grouped(self.stored(grouping)).agg(*[FINISH[m]().alias(m) for m in measures if m in FINISH])
        for m in measures:
            if m in DISTINCT:  # every group has pairs, unless the value is null throughout
                more = grouped(self.pairs(grouping, DISTINCT[m])).agg(F.count_distinct(DISTINCT[m]).alias(m)).select(*[F.col(k).alias(f"__{k}") for k in keys], m)
                same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
                out = (out.join(more, same, "left") if same else out.crossJoin(more)).withColumn(m, F.coalesce(m, F.lit(0)).cast("bigint")).drop(*[f"__{k}" for k in keys])  # without keys: one row each
        return out.select(*keys, *measures)


def revenue_by_payment_mode(lattice: Lattice) -> DataFrame:
    """P1."""
    out = lattice.answer(["total_revenue"], ["payment_mode"]).withColumnRenamed("total_revenue", "revenue")
    return out.orderBy(F.col("revenue").desc(), "payment_mode")


def revenue_by_quarter(lattice: Lattice) -> DataFrame:
    """P2 (first half): revenue per year and quarter."""
    by = [("txn_year", F.col("txn_year").cast("int"), ["txn_year"]), ("quarter", F.ceil(F.col("txn_month") / 3).cast("int"), ["txn_month"])]
    return lattice.answer(["total_revenue"], by).withColumnRenamed("total_revenue", "revenue").orderBy("txn_year", "quarter")


def bank_volume_share(lattice: Lattice, banks: DataFrame) -> DataFrame:
    """P18 (a): transactions and market share per bank."""
    g = lattice.answer(["total_transactions"], ["bank_id"]).withColumnRenamed("total_transactions", "txns")
    return g.join(banks.select("bank_id", "bank_name", "market_share"), "bank_id").select("bank_id", "bank_name", "txns", "market_share")


def os_share(lattice: Lattice) -> DataFrame:
    """P18 (b): share of transactions per device OS (null OS included)."""
    g = lattice.answer(["total_transactions"], ["os_name"]).withColumnRenamed("total_transactions", "txns")
    return g.select("os_name", "txns", X.round_ratio(F.col("txns"), F.sum("txns").over(Window.partitionBy()), 4, 100).alias("pct"))
