"""Interval index join, sliding frames, distinct sketches and month bitsets against plain forms."""

import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import bitsets, distinct, intervals, sliding
from ledgerlens.operators.ranking import Key


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(3)
    ivs = [(i, rng.choice(["a", "a", "b", None]), s := rng.randrange(-500, 500), rng.choice([s, s + 1, s + 7, s + rng.randrange(1, 900), None])) for i in range(400)]
    pts = [(i, rng.choice(["a", "b", "c", None]), rng.choice([None, *range(-600, 1500, 3)])) for i in range(600)] + [(7, "a", 3)] * 3
    want = Counter((p, i) for p, k, at in pts for i, c, s, e in ivs if k is not None and k == c and at is not None and e is not None and s <= at < e)
    points, table = spark.createDataFrame(pts, "p int, k string, at long"), spark.createDataFrame(ivs, "i int, k string, s long, e long")
    for per_part in (1, 10, 100_000):
        got = intervals.interval_join(points, table, "k", "at", "s", "e", per_part).select("p", "i").collect()
        assert Counter((r.p, r.i) for r in got) == want
    assert intervals.interval_join(points.limit(0), table, "k", "at", "s", "e").count() == 0
    assert intervals.interval_join(points, table.limit(0), "k", "at", "s", "e").count() == 0


def test_hundred_thousand_campaigns_in_one_category(spark):
    """One category; a third of the points on one day.  Counts agree with prefix sums, and buckets spread over the tasks."""
    n, span = 100_000, 1 << 20
    table = spark.range(n).select(F.lit("c").alias("k"), F.col("id").alias("i"), (F.pmod(F.xxhash64("id"), F.lit(span))).alias("s"))
    table = table.withColumn("e", F.col("s") + 1 + F.pmod(F.xxhash64("i", "s"), F.lit(64)))
    points = spark.range(30_000).select(F.lit("c").alias("k"), F.col("id").alias("p"), F.when(F.col("id") % 3 == 0, 777).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(span))).alias("at"))
    met = intervals.interval_join(points, table, "k", "at", "s", "e", per_part=1000).withColumn("task", F.spark_partition_id()).cache()
    ivs, at = table.select("s", "e").collect(), [r.at for r in points.select("at").collect()]
    opens = Counter(r.s for r in ivs)
    opens.subtract(Counter(r.e for r in ivs))
    level, running = [], 0
    for day in range(span + 65):
        running += opens.get(day, 0)
        level.append(running)
    assert met.count() == sum(level[x] for x in at)
    # What meets in a bucket is at most a small multiple of the results: no task gets the category.
    index = intervals.indexed(table, "s", "e").groupBy("__level", "__bucket").count().agg(F.max("count")).first()[0]
    assert index < 200
    met.unpersist()


KEYS = [Key("t"), Key("id")]


@pytest.mark.parametrize("before,after,block,ranges", [(6, 0, 10, 7), (2, 3, 4, 5), (0, 0, 1, 3), (9, 9, 3, 16), (6, 0, 100_000, 8)])
def test_sliding_equals_plain_window(spark, before, after, block, ranges):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, *range(20)]), rng.choice([None, rng.random()])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, t int, x double")
    w = Window.orderBy("t", "id").rowsBetween(-before, after)
    want = df.select("id", F.avg("x").over(w).alias("a"), F.count("x").over(w).alias("n"), F.max("t").over(w).alias("m")).collect()
    out = sliding.sliding(df, KEYS, {"a": F.avg("x"), "n": F.count("x"), "m": F.max("t")}, before, after, block, ranges)
    assert sorted(map(tuple, out.select("id", "a", "n", "m").collect())) == sorted(map(tuple, want), key=lambda r: r[0])
    assert "SinglePartition" not in out.drop("id")._jdf.queryExecution().executedPlan().toString().split("Window")[0]


@pytest.mark.parametrize("offset", [1, 3, -2])
def test_lag_equals_plain_window(spark, offset):
    df = spark.range(57).select(F.col("id"), (F.col("id") % 5).alias("t"), (F.col("id") * 3).alias("x"))
    want = df.select("id", F.lag("x", offset).over(Window.orderBy("t", "id")).alias("l")).collect()
    got = sliding.global_lag(df, KEYS, "x", offset, "l", block=5, partitions=4).select("id", "l").collect()
    assert sorted(got) == sorted(want)
    assert sliding.global_lag(df.limit(0), KEYS, "x").count() == 0


def test_sketches_merge_within_their_bound(spark):
    df = spark.range(200_000).select((F.col("id") % 30).alias("day"), F.pmod(F.xxhash64("id"), F.lit(50_000)).alias("who"), (F.col("id") % 3).alias("mode"))
    kept = distinct.sketches(df, ["day", "mode"], "who")
    for keys in (["day"], ["mode"], []):
        about = distinct.merged(kept, keys).select(*keys, distinct.estimate().alias("about"))
        exact = df.groupBy(*keys).agg(F.count_distinct("who").alias("n"))
        pairs = about.join(exact, keys) if keys else about.crossJoin(exact)
        assert all(abs(r.about - r.n) <= distinct.bound() * r.n for r in pairs.collect())
    counted = distinct.counts(distinct.exact(df, ["day", "mode"], "who"), ["mode"], "who")
    assert sorted(counted.collect()) == sorted(df.groupBy("mode").agg(F.count_distinct("who").alias("n")).collect())
    assert distinct.sketches(df.limit(0), ["day"], "who").count() == 0


def test_rolling_sketches(spark):
    df = spark.sql("SELECT date_add(DATE '2024-01-01', CAST(id % 40 AS INT)) AS day, id % 700 AS who FROM range(4000)").where("day <> DATE '2024-01-09'")
    got = {r.day: r.n for r in distinct.rolling(distinct.sketches(df, ["day"], "who"), "day", 7).select("day", distinct.estimate().alias("n")).collect()}
    rows = [(r.day, r.who) for r in df.collect()]
    assert len(got) == 39
    for day, n in got.items():
        exact = len({who for d, who in rows if 0 <= (day - d).days < 7})
        assert abs(n - exact) <= max(1, distinct.bound() * exact)


def test_month_sets(spark):
    rows = [(1, "1970-01-31"), (1, "1975-04-01"), (1, "1975-05-30"), (2, "2039-04-30"), (2, None), (3, None), (1, "1970-01-01")]
    df = spark.createDataFrame(rows, "c int, d string").select("c", F.to_date("d").alias("d"))
    sets = bitsets.month_sets(df, "c", F.col("d"))
    assert {r.c: r.n for r in sets.select("c", bitsets.count(F.col("months")).alias("n")).collect()} == {1: 3, 2: 1, 3: 0}
    at = sets.where("c = 1").select(*[bitsets.active(F.col("months"), F.lit(k)).alias(f"m{k}") for k in (0, 1, 62, 63, 64, 65, 5000, 831)], bitsets.active(F.col("months"), F.lit(-1)).alias("neg")).first()
    assert list(at) == [1, 0, 0, 1, 1, 0, 0, 0, 0]
    with pytest.raises(Exception, match="outside"):
        bitsets.month_sets(spark.sql("SELECT 1 AS c, DATE '1969-12-31' AS d"), "c", F.col("d")).collect()
