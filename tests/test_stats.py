"""Statistics: hand-computed constants, brute force on small fixtures, tail functions."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import dist
from ledgerlens.functions import exprs as X
from ledgerlens.operators.contingency import chi_square_stat, long_table
from ledgerlens.operators.histogram import width_bucket_counts
from ledgerlens.operators.ranking import quantiles
from ledgerlens.plans import stats as ST


def _tf(spark, amounts, weekend=None, category=None):
    rows = []
    for i, a in enumerate(amounts):
        rows.append((f"T{i}", Decimal(str(a)), 1, (weekend[i] if weekend else i % 2),
                     (category[i] if category else "C"), 0))
    return spark.createDataFrame(rows, "transaction_id string, amount decimal(18,2), is_success int, "
                                       "is_weekend int, merchant_category string, is_failed int")


def test_moments_fixture(spark):
    df = _tf(spark, [1, 2, 3, 10, 11])
    row = ST.shape_stats(df).collect()[0]
    assert row.skewness == pytest.approx(0.3573648, abs=1e-6)
    assert row.kurtosis == pytest.approx(-1.7602707, abs=1e-6)
    p90 = df.agg(F.percentile(F.col("amount").cast("double"), 0.9)).collect()[0][0]
    assert p90 == pytest.approx(10.6)


def test_distribution_tails_known_values():
    assert dist.norm_sf(1.959963984540054) == pytest.approx(0.025, rel=1e-9)
    assert dist.norm_ppf(0.975) == pytest.approx(1.959963984540054, rel=1e-9)
    assert dist.t_two_sided_p(2.0, 10) == pytest.approx(0.07338803477074, rel=1e-8)
    assert dist.t_ppf(0.975, 9) == pytest.approx(2.2621571627409915, rel=1e-7)
    assert dist.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-8)
    assert dist.chi2_sf(10.0, 4) == pytest.approx(0.04042768199451279, rel=1e-8)
    # d1 = 2 has the closed form (1 + 2 f / d2) ** (-d2 / 2).
    assert dist.f_sf(3.0, 2, 20) == pytest.approx(1.3 ** -10, rel=1e-10)


def test_chi_square_2x2_yates_and_3x3(spark):
    # 2x2: [[10, 20], [30, 40]] -> Yates chi2 = 0.4464285714 (hand computed)
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 40
    df = spark.createDataFrame(rows, "r string, c string")
    st = chi_square_stat(long_table(df, "r", "c")).collect()[0]
    assert st.dof == 1 and st.n == 100
    assert st.chi2 == pytest.approx(0.4464285714285714, rel=1e-9)
    plain = chi_square_stat(long_table(df, "r", "c"), yates=False).collect()[0]
    assert plain.chi2 == pytest.approx(0.7936507936507936, rel=1e-9)
    # 3x3 with an empty cell: [[5, 0, 5], [2, 8, 0], [3, 2, 5]]
    cells = {("p", "u"): 5, ("p", "w"): 5, ("q", "u"): 2, ("q", "v"): 8, ("r", "u"): 3, ("r", "v"): 2, ("r", "w"): 5}
    rows = [k for k, v in cells.items() for _ in range(v)]
    st = chi_square_stat(long_table(spark.createDataFrame(rows, "r string, c string"), "r", "c")).collect()[0]
    obs = [[5, 0, 5], [2, 8, 0], [3, 2, 5]]
    n = 30.0
    rt = [sum(r) for r in obs]
    ct = [sum(c) for c in zip(*obs)]
    ref = sum((obs[i][j] - rt[i] * ct[j] / n) ** 2 / (rt[i] * ct[j] / n) for i in range(3) for j in range(3))
    assert st.dof == 4
    assert st.chi2 == pytest.approx(ref, rel=1e-9)


def test_mann_whitney_matches_brute_force(spark):
    rnd = random.Random(3)
    amounts = [rnd.choice([5, 10, 10, 20, 35, 35, 35, 50]) + rnd.choice([0, 0.5]) for _ in range(120)]
    weekend = [rnd.randint(0, 1) for _ in range(120)]
    df = _tf(spark, amounts, weekend)
    got = ST.mann_whitney_stat(df).collect()[0]
    x = [a for a, w in zip(amounts, weekend) if w == 1]
    y = [a for a, w in zip(amounts, weekend) if w == 0]
    u = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in x for b in y)
    assert got.u_statistic == pytest.approx(u, abs=1e-9)
    assert got.n1 == len(x) and got.n2 == len(y)


def test_anova_matches_hand_formula(spark):
    groups = {"A": [1, 2, 3], "B": [4, 5, 6, 7], "C": [10, 10.5]}
    amounts, cats = [], []
    for g, vals in groups.items():
        amounts += vals
        cats += [g] * len(vals)
    row = ST.anova_stat(_tf(spark, amounts, category=cats)).collect()[0]
    allv = [v for vals in groups.values() for v in vals]
    gm = sum(allv) / len(allv)
    ssb = sum(len(v) * (sum(v) / len(v) - gm) ** 2 for v in groups.values())
    ssw = sum(sum((x - sum(v) / len(v)) ** 2 for x in v) for v in groups.values())
    f = (ssb / 2) / (ssw / (len(allv) - 3))
    assert row.f_statistic == pytest.approx(round(f, 4), abs=1e-4)


def test_bootstrap_independent_of_partitioning(spark):
    df = _tf(spark, [float(i % 97) + 0.25 for i in range(2000)])
    a = ST.bootstrap_ci(df.repartition(1), replicates=50).collect()[0]
    b = ST.bootstrap_ci(df.repartition(7), replicates=50).collect()[0]
    assert (a.ci_low, a.ci_high) == (b.ci_low, b.ci_high)
    mean = sum(float(i % 97) + 0.25 for i in range(2000)) / 2000
    assert a.ci_low < mean < a.ci_high


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 4, 10)], "x double")
    got = {r.bin: r["count"] for r in width_bucket_counts(df, "x", 5).collect()}
    assert got == {1: 2, 2: 2, 3: 1, 5: 1}


def test_tails_at_the_ends():
    assert abs(dist.t_ppf(0.9999, 1) - 3183.0987) < 1e-2
    assert abs(dist.t_two_sided_p(1.96, 1e12) - 0.0499958) < 1e-7
    assert abs(dist.t_two_sided_p(2.0, 1e7 - 1) - dist.t_two_sided_p(2.0, 1e7 + 1)) < 1e-8
    assert abs(dist.f_sf(2.3719, 4, 1e9) - 0.05) < 1e-4


def test_welch_interval_and_quantiles_against_plain_formulas(spark):
    import statistics as st

    import numpy as np
    rng = np.random.default_rng(3)
    amounts = [round(float(x), 2) for x in rng.lognormal(6, 1, 400)]
    rows = [(i, Decimal(str(a)), int(round(a * 100)), i % 3 == 0, 1) for i, a in enumerate(amounts)]
    tf = spark.createDataFrame([(str(i), a, c, int(w), s) for i, a, c, w, s in rows],
                               "transaction_id string, amount decimal(18,2), amount_cents long, is_weekend int, is_success int")
    x, y = [a for i, a in enumerate(amounts) if i % 3 == 0], [a for i, a in enumerate(amounts) if i % 3]
    got = ST.welch_test(tf).collect()[0]
    a, b = st.variance(x) / len(x), st.variance(y) / len(y)
    t = (st.mean(x) - st.mean(y)) / (a + b) ** 0.5
    df = (a + b) ** 2 / (a * a / (len(x) - 1) + b * b / (len(y) - 1))
    assert abs(got.t - t) < 1e-5 and abs(got.df - df) < 1e-3 and abs(got.p_value - dist.t_two_sided_p(t, df)) < 1e-9
    assert abs(got.cohens_d - (st.mean(x) - st.mean(y)) / ((st.variance(x) + st.variance(y)) / 2) ** 0.5) < 1e-5
    ci = ST.mean_ci(tf).collect()[0]
    half = dist.t_ppf(0.975, 399) * st.stdev(amounts) / 20
    assert abs(ci.ci_low - (st.mean(amounts) - half)) < 1e-3 and abs(ci.ci_high - (st.mean(amounts) + half)) < 1e-3
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    for col, by in (("amount", None), ("is_weekend", None), ("amount", "is_weekend")):
        out = quantiles(tf, F.col(col), probs, by=by, partitions=6).collect()
        for r in out:
            values = [float(v) for i, v in enumerate(amounts) if by is None or int(i % 3 == 0) == r.is_weekend] if col == "amount" else [float(i % 3 == 0) for i in range(400)]
            assert np.allclose(r.q, np.quantile(values, probs), rtol=1e-12)


def test_rates_round_half_to_even(spark):
    got = spark.createDataFrame([(1, 32), (5, 32), (3, 32), (2, 3), (0, 7), (7, 7)], "a long, n long").select(
        X.round_ratio_even(F.col("a"), F.col("n"), 4).alias("r")).collect()
    assert [g.r for g in got] == [0.0312, 0.1562, 0.0938, 0.6667, 0.0, 1.0]


def test_sums_hold_huge_counts(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000_000,)] * 5, "c long")
    assert df.agg(X.money_sum("c").alias("s")).first().s == Decimal("450000000000000000.00")
