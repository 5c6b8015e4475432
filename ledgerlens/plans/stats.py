"""Exploratory (N1-N14) and statistical (T1-T21) operators.

Every test reduces the data to a constant-size row of sums with Spark
aggregates (partial aggregation map-side, no collect); only the closed-form
tail probability runs in Python, inside ``mapInPandas`` on that one row.
Floating statistics are rounded to 6 places for display and comparison.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import dist
from ledgerlens.functions import exprs as X
from ledgerlens.operators.contingency import chi_square_stat, long_table, pivot_table, with_p_value
from ledgerlens.operators.histogram import width_bucket_counts
from ledgerlens.operators.ranking import Key, global_rank, materialize, quantiles

ALPHA = 0.05
STAT_DIGITS = 6
# Customer features of the phase-4 correlation matrix (N12) and phase-5.
N12_FEATURES = ("n_txns", "lifetime_spend", "avg_ticket", "success_rate", "high_value_share",
                "recency_days", "tenure_days", "age", "distinct_merchants", "revenue_contributed")
T10_FEATURES = ("n_txns", "lifetime_spend", "avg_ticket", "success_rate", "high_value_share",
                "recency_days", "tenure_days", "age")


def r6(c: Column) -> Column:
    return F.round(c, STAT_DIGITS)


def _cnt() -> Column:
    return F.count(F.lit(1))


def _quantiles(df: DataFrame, value: Column, probs: Sequence[float], times: Column | None = None) -> Column:
    """Exact quantiles as an array from a scalar subquery (one row of G1's result)."""
    return quantiles(df, value, probs, times=times).agg(F.max("q")).scalar()


def successful_amounts(tf: DataFrame) -> DataFrame:
    return tf.where(F.col("is_success") == 1)


# ------------------------------------------------------------------ N
def describe(df: DataFrame, col: str = "amount") -> DataFrame:
    """Count, mean, std, min, quartiles, max (pandas describe)."""
    x = F.col(col)
    g = df.agg(_cnt().alias("n"), F.sum(x).alias("s"), F.stddev_samp(x.cast("double")).alias("sd"),
               F.min(x).alias("mn"), F.max(x).alias("mx")).withColumn("q", _quantiles(df, x, [0.25, 0.5, 0.75]))
    return g.select(F.col("n").cast("bigint").alias("count"),
                    X.round_ratio(F.col("s"), F.col("n"), STAT_DIGITS).alias("mean"),
                    r6(F.col("sd")).alias("std"),
                    F.col("mn").cast("double").alias("min"),
                    r6(F.col("q")[0]).alias("q25"), r6(F.col("q")[1]).alias("q50"),
                    r6(F.col("q")[2]).alias("q75"),
                    F.col("mx").cast("double").alias("max"))


def amount_histogram_p99(tf: DataFrame, bins: int = 60) -> DataFrame:
    """Amounts clipped at p99, equal-width bins."""
    p99 = _quantiles(tf, F.col("amount"), [0.99])[0]
    return width_bucket_counts(tf, F.least(F.col("amount").cast("double"), p99), bins)


def log10_histogram(tf: DataFrame, bins: int = 60) -> DataFrame:
    """log10(amount), equal-width bins."""
    return width_bucket_counts(tf, F.log10(F.col("amount").cast("double")), bins)


def status_share(tf: DataFrame) -> DataFrame:
    """Status share in %."""
    g = tf.groupBy("status").agg(_cnt().alias("n"))
    return g.select("status", F.col("n").cast("bigint").alias("txns"),
                    X.round_ratio(F.col("n"), F.sum("n").over(Window.partitionBy()), 4, 100).alias("pct")) \
        .orderBy(F.col("txns").desc(), "status")


def monthly_eda(tf: DataFrame) -> DataFrame:
    """Monthly txns, GPV and mean success."""
    g = tf.groupBy("txn_year_month").agg(_cnt().alias("n"),
                                         X.money_sum(F.col("amount_cents") * F.col("is_success")).alias("gpv"),
                                         F.sum("is_success").alias("s"))
    return g.select("txn_year_month", F.col("n").cast("bigint").alias("txns"),
                    F.col("gpv").cast("double").alias("gpv"),
                    X.round_ratio(F.col("s"), F.col("n"), STAT_DIGITS).alias("success_mean")) \
        .orderBy("txn_year_month")


def txns_by_hour(tf: DataFrame) -> DataFrame:
    """N6."""
    return tf.groupBy(F.col("txn_hour").cast("int").alias("txn_hour")) \
        .agg(_cnt().cast("bigint").alias("txns")).orderBy("txn_hour")


def txns_by_weekday(tf: DataFrame) -> DataFrame:
    """Monday-first weekday names; a day without rows shows null (reindex)."""
    spine = tf.sparkSession.createDataFrame(
        [(i, name) for i, name in enumerate(X.WEEKDAY_NAMES)], "day_index int, txn_day_name string")
    g = tf.groupBy("txn_day_name").agg(_cnt().cast("bigint").alias("txns"))
    return F.broadcast(spine).join(g, "txn_day_name", "left") \
        .select("day_index", "txn_day_name", "txns").orderBy("day_index")


def category_eda(tf: DataFrame) -> DataFrame:
    """Revenue, GPV, txns and success rate per category, by revenue."""
    g = tf.groupBy("merchant_category").agg(
        X.money_sum("revenue_cents").alias("rev"), X.money_sum(F.col("amount_cents") * F.col("is_success")).alias("gpv"),
        _cnt().alias("n"), F.sum("is_success").alias("s"))
    return g.select("merchant_category", F.col("rev").cast("double").alias("revenue"),
                    F.col("gpv").cast("double").alias("gpv"), F.col("n").cast("bigint").alias("txns"),
                    X.round_ratio(F.col("s"), F.col("n"), 1, 100).alias("success_rate_pct")) \
        .orderBy(F.col("revenue").desc(), "merchant_category")


def state_eda(tf: DataFrame) -> DataFrame:
    """GPV, success rate and distinct customers per customer state."""
    g = tf.groupBy("customer_state").agg(
        X.money_sum(F.col("amount_cents") * F.col("is_success")).alias("gpv"), _cnt().alias("n"),
        F.sum("is_success").alias("s"), F.count_distinct("customer_id").alias("customers"))
    return g.select("customer_state", F.col("gpv").cast("double").alias("gpv"),
                    X.round_ratio(F.col("s"), F.col("n"), 2, 100).alias("success_rate_pct"),
                    F.col("customers").cast("bigint")) \
        .orderBy(F.col("gpv").desc(), "customer_state")


def bank_failure_mean(tf: DataFrame) -> DataFrame:
    """Failure mean per bank name, worst first."""
    g = tf.groupBy("bank_name").agg(F.sum("is_failed").alias("f"), _cnt().alias("n"))
    return g.select("bank_name", X.round_ratio(F.col("f"), F.col("n"), STAT_DIGITS, 100).alias("failure_rate_pct")) \
        .orderBy(F.col("failure_rate_pct").desc(), "bank_name")


def failure_reason_counts(tf: DataFrame) -> DataFrame:
    """value_counts of reasons on failed rows."""
    return tf.where(F.col("is_failed") == 1).groupBy("failure_reason") \
        .agg(_cnt().cast("bigint").alias("count")).orderBy(F.col("count").desc(), "failure_reason")


def correlation_matrix(cf: DataFrame, features: Sequence[str] = N12_FEATURES,
                       dropna: bool = False) -> DataFrame:
    """Pearson r for every feature pair, long form (x, y, r), one aggregation.

    Without ``dropna`` each pair uses the rows where both are present
    (pandas pairwise); with it, rows with any null feature are dropped first.
    """
    df = cf.select(*[F.col(c).cast("double").alias(c) for c in features])
    if dropna:
        df = df.na.drop()
    half = [(a, b) for i, a in enumerate(features) for b in features[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in half])
    cells = [(x, y, f"{a}__{b}") for a, b in half for x, y in dict.fromkeys(((a, b), (b, a)))]
    stack = ", ".join(f"'{x}', '{y}', `{c}`" for x, y, c in cells)
    return row.select(F.expr(f"stack({len(cells)}, {stack}) as (x, y, r)")).select("x", "y", r6(F.col("r")).alias("r"))


def first_rows(df: DataFrame, columns: Sequence[str], order: Sequence[str], n: int = 5) -> DataFrame:
    """head() with an explicit order."""
    return df.select(*columns).orderBy(*order).limit(n)


def append_frames(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ------------------------------------------------------------------ T
def shape_stats(tf: DataFrame) -> DataFrame:
    """Skewness, excess kurtosis (population) and skewness of log(amount)."""
    s = successful_amounts(tf)
    x = F.col("amount").cast("double")
    return s.agg(r6(F.skewness(x)).alias("skewness"), r6(F.kurtosis(x)).alias("kurtosis"),
                 r6(F.skewness(F.ln(x))).alias("skewness_log"))


def log_histogram(tf: DataFrame, bins: int = 60) -> DataFrame:
    """T3."""
    return width_bucket_counts(successful_amounts(tf), F.ln(F.col("amount").cast("double")), bins)


def qq_points(tf: DataFrame, points: int = 99) -> DataFrame:
    """T4: sample quantiles of log(amount) at Filliben plotting positions vs normal quantiles (all rows)."""
    m = [0.0] * points
    m[-1] = 0.5 ** (1.0 / points)
    m[0] = 1 - m[-1]
    for i in range(2, points):
        m[i - 1] = (i - 0.3175) / (points + 0.365)
    theo = [dist.norm_ppf(p) for p in m]
    s = successful_amounts(tf)
    q = quantiles(s, F.ln(F.col("amount").cast("double")), m)
    spine = tf.sparkSession.createDataFrame(
        [(i + 1, float(p), float(t)) for i, (p, t) in enumerate(zip(m, theo))],
        "point int, prob double, theoretical double")
    sample = q.select(F.posexplode("q").alias("pos", "sample"))
    return sample.join(F.broadcast(spine), F.col("pos") + 1 == F.col("point")).select(
        "point", r6(F.col("prob")).alias("prob"), r6(F.col("theoretical")).alias("theoretical"),
        r6(F.col("sample")).alias("sample")).orderBy("point")


def iqr_outliers(tf: DataFrame) -> DataFrame:
    """T5: Q1, Q3, IQR fences, count and share of successful amounts outside them."""
    s = successful_amounts(tf).select(F.col("amount").cast("double").alias("x"))
    q = _quantiles(s, F.col("x"), [0.25, 0.75])
    q1, q3 = q[0], q[1]
    lo, hi = q1 - (q3 - q1) * 1.5, q3 + (q3 - q1) * 1.5
    g = s.agg(F.count_if((F.col("x") < lo) | (F.col("x") > hi)).alias("k"), _cnt().alias("n"))
    return g.select(r6(q1).alias("q1"), r6(q3).alias("q3"), r6(q3 - q1).alias("iqr"),
                    r6(lo).alias("lower_fence"), r6(hi).alias("upper_fence"),
                    F.col("k").cast("bigint").alias("outliers"),
                    X.round_ratio(F.col("k"), F.col("n"), 4, 100).alias("outlier_pct"))


def zscore_outliers(tf: DataFrame, threshold: float = 3.0) -> DataFrame:
    """|z| > 3 with the population standard deviation (ddof 0)."""
    s = successful_amounts(tf).select(F.col("amount").cast("double").alias("x"))
    mu = s.agg(F.avg("x")).scalar()
    sd = s.agg(F.stddev_pop("x")).scalar()
    z = F.abs((F.col("x") - mu) / sd)
    g = s.agg(F.count_if(z > threshold).alias("k"), _cnt().alias("n"))
    return g.select(r6(mu).alias("mean"), r6(sd).alias("std_pop"), F.col("k").cast("bigint").alias("outliers"),
                    X.round_ratio(F.col("k"), F.col("n"), 4, 100).alias("outlier_pct"))


def boxplot_stats(tf: DataFrame, clip_q: float = 0.999) -> DataFrame:
    """T7 (a): box statistics of successful amounts clipped at p99.9 (Tukey whiskers)."""
    s = successful_amounts(tf).select(F.col("amount").cast("double").alias("a"))
    cap = _quantiles(s, F.col("a"), [clip_q])[0]
    c = s.select(F.least(F.col("a"), cap).alias("x"))
    q = _quantiles(c, F.col("x"), [0.25, 0.5, 0.75])
    lo_f = q[0] - (q[2] - q[0]) * 1.5
    hi_f = q[2] + (q[2] - q[0]) * 1.5
    g = c.agg(F.min(F.when(F.col("x") >= lo_f, F.col("x"))).alias("wl"),
              F.max(F.when(F.col("x") <= hi_f, F.col("x"))).alias("wh"),
              F.count_if((F.col("x") < lo_f) | (F.col("x") > hi_f)).alias("fl"))
    return g.select(r6(cap).alias("clip_at"), r6(F.col("wl")).alias("whisker_low"), r6(q[0]).alias("q1"),
                    r6(q[1]).alias("median"), r6(q[2]).alias("q3"), r6(F.col("wh")).alias("whisker_high"),
                    F.col("fl").cast("bigint").alias("fliers"))


def abs_z_histogram(tf: DataFrame, bins: int = 60, clip: float = 6.0) -> DataFrame:
    """T7 (b): histogram of |z| clipped at 6."""
    s = successful_amounts(tf).select(F.col("amount").cast("double").alias("x"))
    mu = s.agg(F.avg("x")).scalar()
    sd = s.agg(F.stddev_pop("x")).scalar()
    z = F.least(F.abs((F.col("x") - mu) / sd), F.lit(clip))
    return width_bucket_counts(s, z, bins)


def _with_python(stat: DataFrame, fn, extra: str) -> DataFrame:
    """Append columns computed by ``fn(row: dict) -> dict`` on a (tiny) statistic frame."""
    names = [f.strip().split()[0] for f in extra.split(",")]

    def run(batches):
        for pdf in batches:
            rows = [fn(r) for r in pdf.to_dict("records")]
            for n in names:
                pdf[n] = [r[n] for r in rows]
            yield pdf
    fields = list(stat.schema.fields)
    for f in extra.split(","):
        n, t = f.strip().split()
        fields.append(T.StructField(n, T._parse_datatype_string(t)))
    return stat.mapInPandas(run, T.StructType(fields))


def _rounded(df: DataFrame, /, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def _mean_ci_raw(tf: DataFrame) -> DataFrame:
    s = successful_amounts(tf)
    g = s.agg(_cnt().alias("n"), F.sum("amount").alias("sx"), F.stddev_samp(F.col("amount").cast("double")).alias("sd"))
    return g.select(F.col("n").cast("bigint").alias("n"), X.round_ratio(F.col("sx"), F.col("n"), STAT_DIGITS).alias("mean"),
                    F.col("sd").alias("std"), (F.col("sd") / F.sqrt(F.col("n"))).alias("sem"))


def mean_ci_stat(tf: DataFrame) -> DataFrame:
    """T8 (statistic part): n, mean, sample std, standard error of successful amounts."""
    return _rounded(_mean_ci_raw(tf), std=STAT_DIGITS, sem=STAT_DIGITS)


def mean_ci(tf: DataFrame, level: float = 0.95) -> DataFrame:
    """T interval of the mean ticket (t quantile on the one-row frame)."""
    def fn(r):
        t = dist.t_ppf(0.5 + level / 2.0, r["n"] - 1)
        return {"ci_low": r["mean"] - t * r["sem"], "ci_high": r["mean"] + t * r["sem"]}
    out = _with_python(_mean_ci_raw(tf), fn, "ci_low double, ci_high double")
    return _rounded(out, std=STAT_DIGITS, sem=STAT_DIGITS, ci_low=4, ci_high=4)


# Poisson(1) cumulative probabilities P(K <= k), k = 0..19.
_POISSON1_CDF = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(20)])


def _splitmix64(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15)) & np.uint64(0xFFFFFFFFFFFFFFFF)
    x = ((x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)) & np.uint64(0xFFFFFFFFFFFFFFFF)
    x = ((x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)) & np.uint64(0xFFFFFFFFFFFFFFFF)
    return x ^ (x >> np.uint64(31))


def bootstrap_replicates(values: DataFrame, value_col: str, key_col: str, replicates: int = 500,
                         seed: int = 0, chunk: int = 50) -> DataFrame:
    """T9 core: Poisson(1) bootstrap means, one row per replicate.

    Each row's weight in replicate b is a Poisson(1) draw from a counter
    hash of (row key, b), so the result does not depend on partitioning or
    task retries.  Every partition emits ``replicates`` partial sums, which
    one small ``groupBy(replicate)`` adds up.
    """
    base = values.select(F.xxhash64(F.col(key_col).cast("string"), F.lit(seed)).alias("h"),
                         F.col(value_col).cast("double").alias("x"))

    def fn(batches):
        sw = np.zeros(replicates)
        swx = np.zeros(replicates)
        with np.errstate(over="ignore"):
            for pdf in batches:
                h = pdf["h"].to_numpy().astype(np.int64).view(np.uint64)
                x = pdf["x"].to_numpy()
                for r0 in range(0, replicates, chunk):
                    rs = np.arange(r0, min(replicates, r0 + chunk), dtype=np.uint64)
                    mixed = _splitmix64(h[:, None] ^ _splitmix64(rs + np.uint64(seed))[None, :])
                    u = (mixed >> np.uint64(11)).astype(np.float64) / float(1 << 53)
                    w = np.searchsorted(_POISSON1_CDF, u, side="right").astype(np.float64)
                    sw[r0:r0 + len(rs)] += w.sum(axis=0)
                    swx[r0:r0 + len(rs)] += (w * x[:, None]).sum(axis=0)
        yield pd.DataFrame({"replicate": np.arange(replicates, dtype=np.int32), "sw": sw, "swx": swx})

    parts = base.mapInPandas(fn, "replicate int, sw double, swx double")
    return parts.groupBy("replicate").agg((F.sum("swx") / F.sum("sw")).alias("mean"))


def bootstrap_ci(tf: DataFrame, replicates: int = 500, seed: int = 0, level: float = 0.95) -> DataFrame:
    """Percentile interval of the bootstrap means of successful amounts."""
    reps = bootstrap_replicates(successful_amounts(tf), "amount", "transaction_id", replicates, seed)
    lo, hi = (1 - level) / 2, 1 - (1 - level) / 2
    return reps.agg(F.count(F.lit(1)).cast("bigint").alias("replicates"),
                    F.round(F.percentile("mean", lo), 4).alias("ci_low"),
                    F.round(F.percentile("mean", hi), 4).alias("ci_high"))


def pearson_pairs_stat(cf: DataFrame) -> DataFrame:
    """T11 (statistic part): r and n for (n_txns, spend) and (tenure with null as 0, spend)."""
    return _rounded(_pearson_raw(cf), r=STAT_DIGITS)


def _pearson_raw(cf: DataFrame) -> DataFrame:
    d = cf.select(F.col("n_txns").cast("double").alias("a"),
                  F.coalesce(F.col("tenure_days"), F.lit(0)).cast("double").alias("b"),
                  F.col("lifetime_spend").cast("double").alias("y"))
    row = d.agg(F.corr("a", "y").alias("r1"), F.corr("b", "y").alias("r2"), _cnt().alias("n"))
    return row.select(F.explode(F.array(F.struct(F.lit("n_txns").alias("x"), F.col("r1").alias("r")), F.struct(F.lit("tenure_days").alias("x"), F.col("r2").alias("r")))).alias("p"),
                      F.col("n").cast("bigint").alias("n")).select("p.x", "p.r", "n")


def pearson_pairs(cf: DataFrame) -> DataFrame:
    """With the two-sided p-value."""
    return _rounded(_with_python(_pearson_raw(cf), lambda r: {"p_value": dist.pearson_p(r["r"], int(r["n"]))}, "p_value double"), r=STAT_DIGITS)


def _weekend_moments(tf: DataFrame) -> DataFrame:
    """is_weekend, n, mean and sample variance of successful tickets, exact but for the last divisions.

    One pass sums amounts and their squares as whole numbers, far inside 38 digits (10^12 rows of
    10^9); partial sums merge exactly.  The sums around the whole-cent mean follow from them as
    whole numbers too, so nothing cancels.
    """
    s = successful_amounts(tf).select(F.col("is_weekend").cast("int").alias("is_weekend"), F.col("amount_cents").cast("decimal(18,0)").alias("x"))
    whole = lambda x: x.cast("decimal(38,0)")
    sums = s.groupBy("is_weekend").agg(_cnt().alias("n"), F.sum("x").alias("sx"), F.sum(whole(F.col("x") * F.col("x"))).alias("sxx"))
    g = sums.withColumn("k", F.col("n").cast("decimal(20,0)")).withColumn("c", F.call_function("div", F.col("sx"), F.col("k")).cast("decimal(18,0)"))
    nc = whole(F.col("k") * F.col("c"))
    g = g.withColumns({"sd": whole(F.col("sx") - nc), "sdd": whole(F.col("sxx") - whole(whole(F.col("c") * F.col("sx")) * F.lit(2)) + whole(F.col("c") * nc))})
    n = F.col("n").cast("double")
    var = (F.col("sdd").cast("double") - F.col("sd").cast("double") * F.col("sd").cast("double") / n) / (n - 1) / 10000
    return g.select("is_weekend", F.col("n").cast("bigint").alias("n"), F.col("sx"), (F.col("sx").cast("double") / 100 / n).alias("mean"), var.alias("var"))


def weekend_groups(tf: DataFrame) -> DataFrame:
    """T12 (statistic part): count, mean, sample variance of successful tickets per weekend flag."""
    return _weekend_moments(tf).select("is_weekend", "n", r6(F.col("mean")).alias("mean"), r6(F.col("var")).alias("var"))


def _welch_raw(tf: DataFrame) -> DataFrame:
    g = _weekend_moments(tf)
    of = lambda c, k: F.max(F.when(F.col("is_weekend") == k, F.col(c))).alias(f"{c}{2 - k}")
    one = g.agg(*[of(c, k) for c in ("n", "mean", "var") for k in (1, 0)])
    a, b = F.col("var1") / F.col("n1"), F.col("var2") / F.col("n2")
    gap = F.col("mean1") - F.col("mean2")
    return one.select((gap / F.sqrt(a + b)).alias("t"), ((a + b) * (a + b) / (a * a / (F.col("n1") - 1) + b * b / (F.col("n2") - 1))).alias("df"),
                      (gap / F.sqrt((F.col("var1") + F.col("var2")) / 2)).alias("cohens_d"))


def welch_stat(tf: DataFrame) -> DataFrame:
    """T12 + T14 (statistic part): Welch t, Satterthwaite df and Cohen's d (weekend vs weekday)."""
    return _rounded(_welch_raw(tf), t=STAT_DIGITS, df=4, cohens_d=STAT_DIGITS)


def welch_test(tf: DataFrame) -> DataFrame:
    """T12 + T14 + T21: with p and decision."""
    def fn(r):
        p = dist.t_two_sided_p(r["t"], r["df"])
        return {"p_value": p, "reject_h0": bool(p < ALPHA)}
    return _rounded(_with_python(_welch_raw(tf), fn, "p_value double, reject_h0 boolean"), t=STAT_DIGITS, df=4, cohens_d=STAT_DIGITS)


def mann_whitney_stat(tf: DataFrame) -> DataFrame:
    """T13 (statistic part): U of the weekend sample, on all rows, with tie correction.

    Rows are reduced to distinct amounts with per-group counts (a partial
    aggregate, so a hot amount is absorbed map-side); mid-ranks come from a
    global running count over the distinct amounts (G1, no single
    partition).
    """
    s = successful_amounts(tf)
    x = F.col("amount")
    wk = F.col("is_weekend") == 1
    vals = s.groupBy(x.alias("v")).agg(F.count_if(wk).alias("c1"), F.count_if(~wk).alias("c2")) \
        .withColumn("t", F.col("c1") + F.col("c2"))
    ranked = global_rank(vals, [Key("v")], sum_cols=["t"])
    mid = F.col("__cum_t").cast("double") - (F.col("t").cast("double") - 1.0) / 2.0
    g = ranked.agg(F.sum(F.col("c1") * mid).alias("r1"), F.sum("c1").alias("n1"), F.sum("c2").alias("n2"),
                   F.sum(F.col("t").cast("double") ** 3 - F.col("t")).alias("ties"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    u1 = F.col("r1") - n1 * (n1 + 1) / 2
    n = n1 + n2
    sigma = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    return g.select(F.col("n1").cast("bigint"), F.col("n2").cast("bigint"), r6(u1).alias("u_statistic"),
                    r6(sigma).alias("sigma"))


def mann_whitney(tf: DataFrame) -> DataFrame:
    """Two-sided asymptotic p with continuity correction (SciPy's large-sample method)."""
    def fn(r):
        mu = r["n1"] * r["n2"] / 2.0
        u = max(r["u_statistic"], r["n1"] * r["n2"] - r["u_statistic"])
        z = (u - mu - 0.5) / r["sigma"] if r["sigma"] > 0 else 0.0
        p = min(1.0, 2.0 * dist.norm_sf(z))
        return {"z": z, "p_value": p, "reject_h0": bool(p < ALPHA)}
    return _with_python(mann_whitney_stat(tf), fn, "z double, p_value double, reject_h0 boolean")


def anova_stat(tf: DataFrame, group: str = "merchant_category") -> DataFrame:
    """T15 (statistic part): one-way ANOVA F across groups of successful amounts."""
    return _rounded(_anova_raw(tf, group), f_statistic=4)


def _anova_raw(tf: DataFrame, group: str) -> DataFrame:
    s = successful_amounts(tf).select(group, F.col("amount").cast("double").alias("x"))
    g = s.groupBy(group).agg(_cnt().alias("n"), F.sum("x").alias("sx"), F.var_samp("x").alias("v"))
    tot = g.agg(F.sum("n").alias("N"), F.sum("sx").alias("SX"), F.count(F.lit(1)).alias("k"),
                F.sum(F.col("sx") * F.col("sx") / F.col("n")).alias("s2n"),
                F.sum(F.coalesce(F.col("v"), F.lit(0.0)) * (F.col("n") - 1)).alias("ssw"))
    ssb = F.col("s2n") - F.col("SX") * F.col("SX") / F.col("N")
    dfb = F.col("k") - 1
    dfw = F.col("N") - F.col("k")
    f = (ssb / dfb) / (F.col("ssw") / dfw)
    return tot.select(F.col("k").cast("bigint").alias("groups"), dfb.cast("bigint").alias("df_between"),
                      dfw.cast("bigint").alias("df_within"), f.alias("f_statistic"))


def anova(tf: DataFrame, group: str = "merchant_category") -> DataFrame:
    """T15 + T21: F, p and decision."""
    def fn(r):
        p = dist.f_sf(r["f_statistic"], r["df_between"], r["df_within"])
        return {"p_value": p, "reject_h0": bool(p < ALPHA)}
    return _rounded(_with_python(_anova_raw(tf, group), fn, "p_value double, reject_h0 boolean"), f_statistic=4)


def category_ticket_stats(tf: DataFrame, upper_q: float = 0.95) -> DataFrame:
    """Mean ticket and box statistics per category (sorted by mean); the p95 display limit.

    One pass counts equal amounts of a category; mean, quartiles and limit come from these counts.
    """
    counts = materialize(successful_amounts(tf).groupBy("merchant_category", F.col("amount").alias("a")).agg(_cnt().alias("c")))
    x, c = F.col("a").cast("double"), F.col("c")
    limit = _quantiles(counts, x, [upper_q], c)[0]
    q = quantiles(counts, x, [0.25, 0.5, 0.75], by="merchant_category", times=c).withColumnRenamed("merchant_category", "of")
    g = counts.groupBy("merchant_category").agg(F.sum("c").alias("n"), F.sum(F.col("a") * c).alias("sa")) \
        .join(q, F.col("merchant_category").eqNullSafe(F.col("of")), "left")
    return g.select("merchant_category", F.col("n").cast("bigint"),
                    X.round_ratio(F.col("sa"), F.col("n"), 0).alias("mean_ticket"),
                    r6(F.col("q")[0]).alias("q1"), r6(F.col("q")[1]).alias("median"), r6(F.col("q")[2]).alias("q3"),
                    r6(limit).alias("display_limit_p95")) \
        .orderBy(F.col("mean_ticket").desc(), "merchant_category")


def bank_type_status_table(tf: DataFrame, statuses: Sequence[str] = X.VALID_STATUSES) -> DataFrame:
    """Crosstab bank type x status."""
    return pivot_table(tf, "bank_type", "status", sorted(statuses))


def bank_type_chi_square_stat(tf: DataFrame) -> DataFrame:
    """T18 (statistic part): chi-square, dof and Cramér's V of bank type x status."""
    return _rounded(_bank_type_raw(tf), chi2=STAT_DIGITS, cramers_v=STAT_DIGITS)


def _bank_type_raw(tf: DataFrame) -> DataFrame:
    return chi_square_stat(long_table(tf, "bank_type", "status")).select("chi2", "dof", "n", "cramers_v")


def bank_type_chi_square(tf: DataFrame) -> DataFrame:
    """T18 + T21."""
    return _rounded(with_p_value(_bank_type_raw(tf), ALPHA), chi2=STAT_DIGITS, cramers_v=STAT_DIGITS)


def failure_rate_by_bank_type(tf: DataFrame) -> DataFrame:
    """T19."""
    g = tf.groupBy("bank_type").agg(F.sum("is_failed").alias("f"), _cnt().alias("n"))
    return g.select("bank_type", X.round_ratio(F.col("f"), F.col("n"), 2, 100).alias("failure_rate_pct")) \
        .orderBy("bank_type")


def os_failure_table(tf: DataFrame) -> DataFrame:
    """T20 (a): crosstab OS x failed flag (null OS left out) and failure rate by OS."""
    g = tf.where(F.col("os_name").isNotNull()).groupBy("os_name").agg(
        F.count_if(F.col("is_failed") == 0).alias("not_failed"), F.count_if(F.col("is_failed") == 1).alias("failed"))
    return g.select("os_name", F.col("not_failed").cast("bigint").alias("failed_0"),
                    F.col("failed").cast("bigint").alias("failed_1"),
                    X.round_ratio(F.col("failed"), F.col("failed") + F.col("not_failed"), 2, 100)
                    .alias("failure_rate_pct")).orderBy("os_name")


def os_chi_square_stat(tf: DataFrame) -> DataFrame:
    """T20 (b): chi-square of OS x failed with Yates' correction for the 2 x 2 table."""
    return _rounded(_os_raw(tf), chi2=STAT_DIGITS)


def _os_raw(tf: DataFrame) -> DataFrame:
    return chi_square_stat(long_table(tf, "os_name", "is_failed")).select("chi2", "dof", "n")


def os_chi_square(tf: DataFrame) -> DataFrame:
    """T20 + T21."""
    return _rounded(with_p_value(_os_raw(tf), ALPHA), chi2=STAT_DIGITS)


#: What the tests of T21 read of F10, besides the customer features.
DECISION_INPUTS = ("is_success", "is_weekend", "amount", "amount_cents", "merchant_category", "bank_type", "status", "os_name", "is_failed")


def decisions(tf: DataFrame, cf: DataFrame) -> DataFrame:
    """The decision of every test at 5 %, from its p-value."""
    out = None
    for name, df in (("welch", welch_test(tf)), ("mann_whitney", mann_whitney(tf)), ("anova", anova(tf)),
                     ("bank_type_chi_square", bank_type_chi_square(tf)), ("os_chi_square", os_chi_square(tf))):
        row = df.select(F.lit(name).alias("test"), (F.col("p_value") < ALPHA).alias("reject_h0"))
        out = row if out is None else out.unionByName(row)
    return out.unionByName(pearson_pairs(cf).select(F.concat(F.lit("pearson_"), "x").alias("test"), (F.col("p_value") < ALPHA).alias("reject_h0")))
