"""Data-quality audit, cleaning and load checks.

The audit is one aggregation pass; the cleaner tags each row with the first
rule it fails and filters once, so the action log costs one small
``groupBy(rule)`` instead of a re-scan per step.  Duplicates are resolved by
an aggregate (``min_by`` over a total order) rather than a window: the
partial aggregate runs map-side, so a single transaction id holding a third
of the rows is reduced inside every map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.exprs import VALID_STATUSES
from ledgerlens.sources import schemas as S

# Order of the audit checks.
AUDIT_CHECKS = ("rows", "duplicate_txn_ids", "full_duplicate_rows", "missing_customer_id",
                "missing_amount", "non_positive_amount", "invalid_timestamps", "invalid_status",
                "reason_without_failure", "failure_without_reason")
# Order of the cleaning steps.
CLEAN_STEPS = ("dropped_duplicate_ids", "dropped_bad_timestamps", "dropped_bad_amounts",
               "dropped_bad_status")
# Columns that fix "first" among rows sharing an id (a total order on the fixture).
DEFAULT_FIRST_ORDER = ("txn_timestamp", "merchant_id", "bank_id", "amount")


def parsed_timestamp(col: str, dtype: T.DataType) -> F.Column:
    """pd.to_datetime(errors='coerce'): text is parsed, bad text becomes null."""
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(F.trim(F.col(col))).cast("timestamp_ntz")
    return F.col(col).cast("timestamp_ntz")


def parsed_amount(col: str, dtype: T.DataType) -> F.Column:
    """pd.to_numeric(errors='coerce') into the money type."""
    if isinstance(dtype, T.StringType):
        return F.trim(F.col(col)).try_cast(S.MONEY)
    return F.col(col).cast(S.MONEY)


def _dtype(df: DataFrame, col: str) -> T.DataType:
    return df.schema[col].dataType


# ------------------------------------------------------------------ C1 / C7
def data_quality_report(txn: DataFrame) -> DataFrame:
    """The ten audit checks as (check, value) rows.

    One pass over the raw fact and one shuffle, on the id.
    """
    ts = parsed_timestamp("txn_timestamp", _dtype(txn, "txn_timestamp"))
    amount = F.col("amount") if not isinstance(_dtype(txn, "amount"), T.StringType) \
        else F.trim(F.col("amount")).try_cast("double")
    status = F.col("status")
    reason = F.col("failure_reason")
    flags = {
        "missing_customer_id": F.col("customer_id").isNull(),
        "missing_amount": F.col("amount").isNull(),
        "non_positive_amount": amount <= 0,
        "invalid_timestamps": ts.isNull(),
        "invalid_status": ~F.coalesce(status.isin(*VALID_STATUSES), F.lit(False)),
        "reason_without_failure": (~F.coalesce(status == "FAILED", F.lit(False))) & reason.isNotNull(),
        "failure_without_reason": (status == "FAILED") & reason.isNull(),
    }
    # One exchange on the id serves both groupings: equal rows first (they share the id), then ids.
    rows = txn.select(*txn.columns, *[F.coalesce(c, F.lit(False)).alias(f"__{k}") for k, c in flags.items()]).repartition("transaction_id")
    distinct = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__n"))
    # duplicated() counts every occurrence after the first: sum(n - 1) per key.
    per_id = distinct.groupBy("transaction_id").agg(
        F.sum("__n").alias("__n"), F.sum(F.col("__n") - 1).alias("__again"),
        *[F.sum(F.when(F.col(f"__{k}"), F.col("__n")).otherwise(0)).alias(k) for k in flags])
    one = per_id.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_txn_ids"),
        F.coalesce(F.sum("__again"), F.lit(0)).alias("full_duplicate_rows"),
        *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in flags],
    )
    stack = ", ".join(f"'{c}', cast(`{c}` as bigint)" for c in AUDIT_CHECKS)
    return one.select(F.expr(f"stack({len(AUDIT_CHECKS)}, {stack}) as (check, value)"))


def audit_issues(report: DataFrame) -> DataFrame:
    """Checks that found something (value > 0), without the row count."""
    return report.where((F.col("check") != "rows") & (F.col("value") > 0))


def total_issues(report: DataFrame) -> DataFrame:
    """Number of failing checks and the sum of their values."""
    iss = audit_issues(report)
    return iss.agg(F.count(F.lit(1)).cast("bigint").alias("issues_found"),
                   F.coalesce(F.sum("value"), F.lit(0)).cast("bigint").alias("issue_rows"))


# ------------------------------------------------------------------ C2-C6
def _first_per_key(txn: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first row under a total order, plus the key's row count."""
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in txn.columns if c not in keys]
    order_cols = [c for c in order if c in others] + [c for c in others if c not in order]
    # One struct is both the row and its order.
    first = F.min(F.struct(*order_cols)).alias("__r")
    return (txn.groupBy(*keys).agg(first, F.count(F.lit(1)).alias("__copies"))
            .select(*keys, *[F.col(f"__r.{c}").alias(c) for c in others], "__copies"))


def dedupe_first(txn: DataFrame, key: str | Sequence[str] = "transaction_id",
                 order: Sequence[str] = DEFAULT_FIRST_ORDER) -> DataFrame:
    """Keep the first row per key under a total order (order columns, then all others).

    ``min`` of a struct is an aggregate with a map-side partial step, so a hot
    key never lands whole in one task.
    """
    return _first_per_key(txn, key, order).select(*txn.columns)


def first_in_place(txn: DataFrame, key: Sequence[str], carried: Sequence[str], order: Sequence[str] = DEFAULT_FIRST_ORDER) -> DataFrame:
    """C2 for rows whose equal keys lie in one partition: the row that ``dedupe_first`` keeps.

    ``carried`` columns follow from the others: they pass by, take no part in the order and may be pruned.
    """
    return numbered_in_place(txn, key, carried, order).where("__nth = 1").drop("__nth")


def numbered_in_place(txn: DataFrame, key: Sequence[str], carried: Sequence[str] = (), order: Sequence[str] = DEFAULT_FIRST_ORDER) -> DataFrame:
    """All rows with their place ``__nth`` among those of equal key, which lie in one partition; ``dedupe_first`` keeps the first."""
    others = [c for c in txn.columns if c not in key and c not in carried]
    w = Window.partitionBy(*key).orderBy(*[c for c in order if c in others], *[c for c in others if c not in order])
    return txn.withColumn("__nth", F.row_number().over(w))


def _tag_rules(txn: DataFrame) -> DataFrame:
    """Parse, normalise and tag each row with the first failing cleaning rule."""
    ts = parsed_timestamp("txn_timestamp", _dtype(txn, "txn_timestamp"))
    amt = parsed_amount("amount", _dtype(txn, "amount"))
    status = F.trim(F.upper(F.col("status")))
    tagged = txn.withColumns({"txn_dt": ts, "amount": amt, "status": status})
    if "amount_cents" not in txn.columns:
        tagged = tagged.withColumn("amount_cents", (F.col("amount") * 100).cast("long"))
    rule = (F.when(F.col("txn_dt").isNull(), "dropped_bad_timestamps")
            .when(F.col("amount").isNull() | (F.col("amount") <= 0), "dropped_bad_amounts")
            .when(~F.coalesce(F.col("status").isin(*VALID_STATUSES), F.lit(False)), "dropped_bad_status"))
    return tagged.withColumn("__rule", rule)


def clean_transactions(txn: DataFrame, order: Sequence[str] = DEFAULT_FIRST_ORDER,
                       key: str | Sequence[str] = "transaction_id") -> DataFrame:
    """Dedupe by id or the columns that it is made of (keep first), coerce timestamp and amount, normalise status."""
    return clean_rows(dedupe_first(txn, key, order))


def clean_rows(firsts: DataFrame) -> DataFrame:
    """C3-C5 on rows without repeated ids."""
    out = _tag_rules(firsts)
    return out.where(F.col("__rule").isNull()).drop("__rule")


def cleaning_actions(txn: DataFrame, order: Sequence[str] = DEFAULT_FIRST_ORDER) -> DataFrame:
    """Rows dropped at each step, in order (duplicates, timestamps, amounts, status).

    One grouping by id yields both the surviving rows and the duplicate count.
    """
    firsts = _first_per_key(txn, "transaction_id", order)
    tagged = _tag_rules(firsts)
    g = tagged.groupBy(F.coalesce(F.col("__rule"), F.lit("kept")).alias("action")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("__copies") - 1).alias("dups"))
    dups = g.agg(F.coalesce(F.sum("dups"), F.lit(0)).cast("bigint").alias("n")) \
        .select(F.lit("dropped_duplicate_ids").alias("action"), "n")
    by_rule = g.where(F.col("action") != "kept").select("action", F.col("n").cast("bigint"))
    steps = txn.sparkSession.createDataFrame(
        [(s, i) for i, s in enumerate(CLEAN_STEPS)], "action string, step int")
    counts = dups.unionByName(by_rule)
    return (steps.join(counts, "action", "left")
            .select("step", "action", F.coalesce("n", F.lit(0)).cast("bigint").alias("rows_dropped")))


# ------------------------------------------------------------------ C8-C11
def orphan_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """For every foreign key, rows whose non-null key has no parent.

    Each table is read once, for the keys that it uses and those that it holds; keys are
    counted before the one shuffle that meets them, so a hot key is one row for each task.
    """
    keys = [(i, *k) for i, k in enumerate(S.FOREIGN_KEYS) if k[0] in tables and k[2] in tables]

    def seen(name: str) -> DataFrame:
        entry = lambda k, col, n, parents: F.struct(
            F.lit(k[0]).alias("i"), F.col(col).cast("string").alias("k"), F.lit(n).cast("bigint").alias("n"), F.lit(parents).alias("parents"))
        mine = [entry(k, k[2], 1, 0) for k in keys if k[1] == name] + [entry(k, k[4], 0, 1) for k in keys if k[3] == name]
        return tables[name].select(F.explode(F.array(*mine)).alias("x")).select("x.*").where(F.col("k").isNotNull())

    every = None
    for name in dict.fromkeys([k[1] for k in keys] + [k[3] for k in keys]):
        every = seen(name) if every is None else every.unionByName(seen(name))
    lost = every.groupBy("i", "k").agg(F.sum("n").alias("n"), F.max("parents").alias("parents")).where("parents = 0").groupBy("i").agg(F.sum("n").alias("n"))
    names = next(iter(tables.values())).sparkSession.createDataFrame([k[:4] for k in keys], "i int, child_table string, child_column string, parent_table string")
    return names.join(lost, "i", "left").select("child_table", "child_column", "parent_table", F.coalesce("n", F.lit(0)).cast("bigint").alias("orphans"))


def load_kpis(enriched: DataFrame) -> DataFrame:
    """Txns, success rate, GPV, revenue, active customers after the load."""
    from ledgerlens.functions import exprs as X
    from ledgerlens.functions.exprs import count_success, round_money, round_ratio, sum_success
    return enriched.agg(
        F.count(F.lit(1)).alias("txns"),
        count_success().alias("successes"),
        sum_success("amount").alias("gpv"),
        X.money_sum("revenue_cents").alias("revenue"),
        F.count_distinct("customer_id").alias("active_customers"),
    ).select(
        F.col("txns").cast("bigint"),
        round_ratio(F.col("successes"), F.col("txns"), 2, 100).alias("success_rate_pct"),
        round_money(F.col("gpv"), 0).alias("gpv"),
        round_money(F.col("revenue"), 0).alias("revenue"),
        F.col("active_customers").cast("bigint"),
    )


def worst_banks(enriched: DataFrame, n: int = 5) -> DataFrame:
    """The n banks with the lowest success rate (ties by bank id)."""
    from ledgerlens.functions.exprs import count_success, round_ratio
    g = enriched.groupBy("bank_id").agg(
        F.min("bank_name").alias("bank_name"),
        F.count(F.lit(1)).alias("txns"),
        count_success().alias("succ"))
    return (g.select("bank_name", F.col("txns").cast("bigint"),
                     round_ratio(F.col("succ"), F.col("txns"), 2, 100).alias("success_rate_pct"),
                     "succ", "bank_id")
            .orderBy((F.col("succ") / F.col("txns")).asc(), F.col("bank_id").asc())
            .limit(n).drop("succ", "bank_id"))


def key_completeness(txn: DataFrame, min_amount: float | None = None, max_amount: float | None = None,
                     success_band: tuple[float, float] | None = None) -> DataFrame:
    """C11: null counts on the fact keys, amount range, success rate inside a band."""
    keys = ("transaction_id", "customer_id", "merchant_id", "bank_id")
    row = txn.agg(
        *[F.count_if(F.col(k).isNull()).cast("bigint").alias(f"null_{k}") for k in keys],
        F.min("amount").cast("double").alias("min_amount"),
        F.max("amount").cast("double").alias("max_amount"),
        F.count(F.lit(1)).alias("__n"),
        F.count_if(F.col("status") == "SUCCESS").alias("__s"),
    )
    rate = F.col("__s") / F.col("__n")
    lo_ok = F.lit(True) if min_amount is None else F.col("min_amount") >= min_amount
    hi_ok = F.lit(True) if max_amount is None else F.col("max_amount") <= max_amount
    band_ok = F.lit(True) if success_band is None else rate.between(*success_band)
    null_ok = F.lit(True)
    for k in keys:
        null_ok = null_ok & (F.col(f"null_{k}") == 0)
    return row.select(*[f"null_{k}" for k in keys], "min_amount", "max_amount",
                      (null_ok & lo_ok & hi_ok & band_ok).alias("passed"))
