"""Unit tests on tiny frames for the expression traps."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlens.functions import exprs as X


def test_sql_band_labels_match_reference_text():
    assert X.sql_band_labels(X.SQL_BAND_EDGES) == [
        "a. <200", "b. 200-500", "c. 500-1k", "d. 1k-3k", "e. 3k-10k", "f. 10k+"]
    assert X.pandas_band_labels(X.PANDAS_BAND_EDGES) == ["<200", "200-500", "500-1k", "1k-3k", "3k-10k", "10k+"]


def test_band_edges_lower_vs_upper_inclusive(spark):
    rows = [(Decimal(v),) for v in ("199.99", "200.00", "200.01", "10000.00", "10000.01")]
    df = spark.createDataFrame(rows, "amount decimal(18,2)")
    out = df.select(X.sql_ticket_band().alias("s"), X.pandas_ticket_band().alias("p")).collect()
    assert [r.s for r in out] == ["a. <200", "b. 200-500", "b. 200-500", "f. 10k+", "f. 10k+"]
    assert [r.p for r in out] == ["<200", "<200", "200-500", "3k-10k", "10k+"]


def test_weekday_codes(spark):
    # 2024-01-07 is a Sunday; one week from it.
    days = [(dt.datetime(2024, 1, 7) + dt.timedelta(days=i),) for i in range(7)]
    df = spark.createDataFrame(days, "ts timestamp_ntz")
    out = df.select(X.sql_dow("ts").alias("sql"), X.iso_weekday("ts").alias("iso"),
                    F.date_format("ts", "EEEE").alias("name")).collect()
    assert [r.sql for r in out] == [0, 1, 2, 3, 4, 5, 6]
    assert [r.iso for r in out] == [6, 0, 1, 2, 3, 4, 5]
    assert out[0].name == "Sunday"


def test_round_ratio_is_exact_half_up(spark):
    df = spark.createDataFrame([(1005, 1000), (1, 8), (-1, 8), (2, 3), (1, 0), (None, 3)], "a long, b long")
    got = [r.v for r in df.select(X.round_ratio(F.col("a"), F.col("b"), 2).alias("v")).collect()]
    assert got == [1.01, 0.13, -0.13, 0.67, None, None]
    pct = df.select(X.round_ratio(F.col("a"), F.col("b"), 2, 100).alias("v")).collect()[1].v
    assert pct == 12.5


def test_revenue_rounds_per_row(spark):
    df = spark.createDataFrame([(Decimal("100.50"), Decimal("0.0125"), "SUCCESS"),
                                (Decimal("100.50"), Decimal("0.0125"), "FAILED")],
                               "amount decimal(18,2), commission_rate decimal(6,4), status string")
    got = [r.r for r in df.select(X.revenue_expr().alias("r")).collect()]
    assert got == [Decimal("1.26"), Decimal("0.00")]


def test_daypart_and_age_band(spark):
    df = spark.createDataFrame([(h,) for h in (0, 5, 6, 11, 12, 16, 17, 20, 21, 23)], "txn_hour int")
    got = [r.d for r in df.select(X.daypart().alias("d")).collect()]
    assert got == ["Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening",
                   "LateEve", "LateEve"]
    ages = spark.createDataFrame([(a,) for a in (18, 25, 34, 35, 55, 70)], "customer_age int")
    assert [r.b for r in ages.select(X.age_band().alias("b")).collect()] == [
        "18-24", "25-34", "25-34", "35-44", "55+", "55+"]


def test_whole_days_floor(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 3, 11)),
                                (dt.datetime(2024, 1, 3, 11), dt.datetime(2024, 1, 1, 12))],
                               "a timestamp_ntz, b timestamp_ntz")
    got = [r.d for r in df.select(X.whole_days_between(F.col("a"), F.col("b")).alias("d")).collect()]
    assert got == [1, -2]
