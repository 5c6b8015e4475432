"""G1: global rank / ntile / qcut / running sum equal the single-partition window."""

import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators.ranking import Key, global_rank, ntile_from_rank, qcut_from_rank, sql_rank


def _frame(spark, n=1500, distinct=4, seed=7):
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(1, distinct), rnd.choice([None, 1.5, 2.5, 7.0, 7.0])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, k int, m double")


def test_global_rank_matches_window_with_many_buckets(spark):
    df = _frame(spark)
    ranked = global_rank(df, [Key("k", ascending=False), Key("id")], sum_cols=["k"], partitions=10)
    w = Window.orderBy(F.col("k").desc(), "id")
    ref = df.select("id", F.row_number().over(w).alias("rn"),
                    F.sum("k").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    got = {r.id: (r["__rn"], r["__cum_k"], r["__n"]) for r in ranked.select("id", "__rn", "__cum_k", "__n").collect()}
    for r in ref.collect():
        assert got[r.id][:2] == (r.rn, r.cum)
        assert got[r.id][2] == 1500


def test_nulls_first_ordering(spark):
    df = _frame(spark, n=300)
    ranked = global_rank(df, [Key("m", nulls_first=True), Key("id")], partitions=7)
    ref = df.select("id", F.row_number().over(Window.orderBy(F.col("m").asc_nulls_first(), "id")).alias("rn"))
    got = {r.id: r["__rn"] for r in ranked.select("id", "__rn").collect()}
    assert all(got[r.id] == r.rn for r in ref.collect())


def test_ntile_formula_matches_sql_ntile(spark):
    for n in (1, 3, 5, 7, 8, 12, 13, 101):
        df = spark.range(1, n + 1).withColumnRenamed("id", "r")
        got = df.select("r", ntile_from_rank(F.col("r"), F.lit(n), 5).alias("t"),
                        F.ntile(5).over(Window.orderBy("r")).alias("ref")).collect()
        assert all(x.t == x.ref for x in got), n


def _pandas_qcut_bins(n, k=5):
    # Edges at linear-interpolation quantiles of ranks 1..n, right-closed bins.
    edges = [1 + (n - 1) * j / k for j in range(k + 1)]
    out = []
    for r in range(1, n + 1):
        b = next(j for j in range(1, k + 1) if r <= edges[j] + 1e-12)
        out.append(b)
    return out


def test_qcut_formula_matches_pandas_rule(spark):
    for n in (5, 7, 8, 9, 23, 100, 2999):
        df = spark.range(1, n + 1).withColumnRenamed("id", "r")
        got = [x.b for x in df.select(qcut_from_rank(F.col("r"), F.lit(n), 5).alias("b")).orderBy("r").collect()]
        assert got == _pandas_qcut_bins(n), n


def test_sql_rank_matches_rank_window(spark):
    df = _frame(spark, n=800, distinct=6)
    got = sql_rank(df, "k", ascending=False, out="rk", partitions=5)
    ref = df.select("id", F.rank().over(Window.orderBy(F.col("k").desc())).alias("rk"))
    a = {r.id: r.rk for r in got.select("id", "rk").collect()}
    assert all(a[r.id] == r.rk for r in ref.collect())
