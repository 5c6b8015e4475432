"""Queries plan from the sources with the columns that they read: no wide table is written on the way, and the rows are the same."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from ledgerlens import catalog
from ledgerlens.sources import adapter
from ledgerlens.operators.joins import with_proven_key
from ledgerlens.plans import cashback as B
from ledgerlens.plans import features as FE
from ledgerlens.plans import loading as LD
from ledgerlens.plans import views as V
from ledgerlens.plans.quality import clean_transactions, orphan_counts
from ledgerlens.plans import stats as ST
from ledgerlens.sources.adapter import ROW_KEY, SOURCE_SCHEMAS, tables

DAY = dt.datetime(1996, 1, 5)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Repeated lines, orders, customers and parts; keys without a partner; null keys and line numbers."""
    line = lambda order, part, number, price, flag="A": (order, part, 1, number, 1.0, price, 0.0, 0.0, flag, "F", DAY)
    rows = {
        "region": [(0, "R")], "nation": [(0, "N", 0)],
        "customer": [(1, "a", 0, 0.0, "X"), (1, "a2", 0, 0.0, "Y"), (2, "b", 0, 0.0, None), (None, "c", 0, 0.0, "Z")],
        "supplier": [(1, "s", 0, 0.0)],
        "part": [(1, "p", "b", "PROMO", 1, 2.0), (1, "p2", "b", "SMALL", 1, 2.0), (2, "q", "b", "LARGE", 1, 2.0)],
        "orders": [(1, 1, "F", 1.0, DAY, "1-URGENT"), (1, 1, "F", 1.0, DAY, "1-URGENT"), (2, 2, "O", 1.0, DAY, "5-LOW"), (3, 9, "O", 1.0, DAY, None), (4, None, "P", 1.0, DAY, "5-LOW")],
        "lineitem": [line(1, 1, 1, 5.25), line(1, 1, 1, 5.25), line(1, 2, 1, 4.5, "R"), line(1, 1, 7, 3.0), line(2, 1, None, 2.0), line(2, 9, 2, 8.0), line(3, 1, 1, 1.0), line(4, 2, 1, 6.0),
                     line(None, 1, 1, 1.0), line(2, None, 3, 7.0, "N")],
        "events": [],
    }
    folder = tmp_path_factory.mktemp("odd")
    for name, values in rows.items():
        spark.createDataFrame(values, SOURCE_SCHEMAS[name]).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def rows(df, columns=None):
    return sorted(map(repr, df.select(*(columns or df.columns)).collect()))


def test_queries_write_no_wide_tables(spark):
    for name in ("q1_5_payment_mode_mix", "n11_failure_reason_counts", "t8_mean_ci_stat"):
        files = entry.queries()[name](spark, SF_SMALL).inputFiles()
        assert files and all(f.startswith(f"file://{SF_SMALL}/") for f in files)


def test_stored_tables_are_read_where_they_were_written(spark, odd):
    name = "q1_5_payment_mode_mix"
    want = rows(entry.queries()[name](spark, odd))
    catalog.build_store(spark, odd)
    got = entry.queries()[name](spark, odd)
    assert all("/ledgerlens-store/" in f for f in got.inputFiles()) and rows(got) == want


def test_enriched_rows_are_those_of_the_plain_joins(spark, odd):
    t = tables(spark, odd)
    want = V.enrich(t.transactions_a, t.customers, t.merchants, t.banks, t.devices)
    assert rows(V.enriched(t, "A"), want.columns) == rows(want) and want.count() > 10


def test_first_rows_by_row_key_are_those_by_id(spark, odd):
    t = tables(spark, odd)
    want = V.join_dimensions(clean_transactions(t.transactions_a), t.customers, t.merchants, t.banks, t.devices)
    got = V.analysis_frame(t)
    assert rows(got, want.columns) == rows(want) and set(got.columns) == set(want.columns)
    plan = clean_transactions(t.fact_a(), key=ROW_KEY).groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(transaction_id" not in plan


def test_joins_that_nobody_reads_are_dropped(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, v int")
    once, twice = (spark.createDataFrame(r, "k int, x string") for r in ([(1, "a"), (None, "n"), (None, "m")], [(1, "a"), (1, "b")]))
    joined = fact.join(with_proven_key(once, "k"), "k", "left")
    assert rows(joined) == rows(fact.join(once, "k", "left"))
    assert "Join" not in joined.agg(F.sum("v"))._jdf.queryExecution().optimizedPlan().toString()
    assert rows(fact.join(with_proven_key(twice, "k"), "k", "left")) == rows(fact.join(twice, "k", "left"))


def test_partitions_of_the_fact_hold_so_many_rows_at_any_size(spark, odd, monkeypatch):
    want = rows(V.analysis_frame(tables(spark, odd)))
    monkeypatch.setattr(adapter, "ROWS_A_PARTITION", 1)
    monkeypatch.setattr(adapter, "FEW_PARTITIONS", 1)
    t = tables(spark, odd)
    assert t.fact_a().rdd.getNumPartitions() == t.src("lineitem").count() == 10
    assert rows(V.analysis_frame(t)) == want  # first rows are taken within these partitions


@pytest.fixture(scope="module")
def plain(spark, odd, tmp_path_factory):
    """``odd`` with merchants and customers that come once, so that they are joined early; two copies of a line that differ."""
    folder = tmp_path_factory.mktemp("plain")
    for name, schema in SOURCE_SCHEMAS.items():
        df = spark.read.schema(schema).parquet(f"{odd}/{name}.parquet")
        if name in ("part", "customer"):
            df = df.groupBy(df.columns[0]).agg(*[F.min(c).alias(c) for c in df.columns[1:]])
        if name == "lineitem":
            df = df.unionByName(df.where("l_partkey = 9").withColumn("l_partkey", F.lit(1).cast("long")))
        df.select([f.split()[0] for f in schema.split(", ")]).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("few, small", [(32, 100_000), (1, 0)])
def test_dimensions_meet_narrow_rows_and_nothing_is_moved_after(spark, plain, monkeypatch, few, small):
    monkeypatch.setattr(adapter, "ROWS_A_PARTITION", 2)
    monkeypatch.setattr(adapter, "FEW_PARTITIONS", few)
    monkeypatch.setattr(adapter, "MAX_PROVEN_BROADCAST_ROWS", small)
    t = tables(spark, plain)
    want = V.join_dimensions(clean_transactions(t.transactions_a), t.customers, t.merchants, t.banks, t.devices)
    got = V.analysis_frame(t)
    assert rows(got) == rows(want) and got.columns == want.columns and got.dtypes == want.dtypes
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Window")]
    assert "RepartitionByExpression" not in above and above.count("Join") == 1  # devices
    assert plan.count("strategy=shuffle_hash") == (0 if small else 3)
    amounts = got.agg(F.sum("amount"))._jdf.queryExecution().optimizedPlan().toString()
    assert amounts.count("Join") == 2  # orders, devices: unread dimensions are dropped


def test_category_tickets_take_one_pass(spark):
    values = [("A", "1.00", 1), ("A", "1.00", 1), ("A", "4.00", 1), ("A", "9.00", 0), (None, "2.00", 1), ("B", None, 1), ("B", "5.00", 1)]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    tf = spark.createDataFrame(values, "merchant_category string, amount string, is_success int") \
        .mapInArrow(counted, "merchant_category string, amount string, is_success int").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    got = {r[0]: tuple(r)[1:] for r in ST.category_ticket_stats(tf).collect()}
    assert got == {"A": (3, 2.0, 1.0, 1.0, 2.5, 4.8), None: (1, 2.0, 2.0, 2.0, 2.0, 4.8), "B": (2, 3.0, 5.0, 5.0, 5.0, 4.8)}
    assert seen.value == len(values)


def test_orphans_move_each_key_once(spark):
    frame = lambda values, columns: spark.createDataFrame(values, columns)
    given = {
        "banks": frame([(1,), (None,)], "bank_id int"),
        "customers": frame([(1, 1, "a"), (2, 9, None), (2, 9, None)], "customer_id int, primary_bank_id int, device_id string"),
        "transactions": frame([("t", 1, 1), ("t", 7, 2), (None, None, 2)], "transaction_id string, customer_id int, bank_id int"),
        "cashback": frame([("t",), ("u",), ("u",), (None,)], "transaction_id string"),
    }
    keys = {("customers", "primary_bank_id"): 2, ("transactions", "customer_id"): 1, ("transactions", "bank_id"): 2, ("cashback", "transaction_id"): 2}
    out = orphan_counts(given)
    assert {(r[0], r[1]): r[3] for r in out.collect()} == keys
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == len(given) and plan.count("Aggregate [i") == 2


def test_decisions_read_the_fact_once(spark):
    """The rows themselves are held against SQL in test_oracle."""
    files = entry.queries()["t21_decisions"](spark, SF_SMALL).inputFiles()
    assert any("/decision-inputs-" in f for f in files)
    assert not any(f"/{name}.parquet" in f for f in files for name in ("lineitem", "orders"))


def test_customer_features_of_stored_rows_are_the_same(spark):
    values = [("a", "m", 1, 0, 100), ("a", "m", 0, 1, 50), ("a", None, 1, 0, 7), ("b", None, 0, 1, 9), (None, "m", 1, 0, 30), (None, "n", 1, 0, 40), ("", "n", 1, 0, 60)]
    tf = spark.createDataFrame([(*v, v[4] // 10, DAY, int(v[4] > 50)) for v in values],
                               "customer_id string, merchant_id string, is_success int, is_failed int, amount_cents long, revenue_cents long, txn_dt timestamp_ntz, high_value_flag int")
    customers = spark.createDataFrame([("a", DAY.date(), 30, "F", "S"), (None, DAY.date(), 31, "M", "T")], "customer_id string, registration_date date, age int, gender string, state string")
    want = FE.engineer_customer_features(tf, customers)
    got = FE.engineer_customer_features(tf, customers, stored=True)
    assert got.columns == want.columns and got.dtypes == want.dtypes and rows(got) == rows(want)
    assert {r.customer_id: r.distinct_merchants for r in got.collect()} == {"a": 1, "b": 0, None: 2, "": 1}


@pytest.mark.parametrize("folder", ["odd", "plain"])  # repeated keys of customers and merchants repeat rows
def test_cashback_moves_only_rows_of_a_campaign_day(spark, request, folder):
    t = tables(spark, request.getfixturevalue(folder))
    campaigns = spark.createDataFrame([("c1", "PROMO", DAY.date(), DAY.date(), 1.0), ("c2", "LARGE", DAY.date(), DAY.date() - dt.timedelta(2), 1.0), ("c3", "LARGE", None, DAY.date(), 1.0)],
                                      "campaign_id string, target_category string, start_date date, end_date date, attach_rate double")
    campaigns = campaigns.selectExpr("*", "cast(0.05 as decimal(6,4)) cashback_rate", "cast(75 as decimal(18,2)) max_cashback")
    want = B.cashback_from_frame(V.analysis_frame(t), campaigns)
    got = catalog._cashback_of(t, V.cleaned(t), campaigns)
    assert rows(got) == rows(want) and want.count() > 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftOuter") < plan.index("LeftSemi") < plan.index("Window")  # rows are picked before they meet a dimension


def test_loaded_dimensions_are_left_out_where_nobody_reads_them(spark, plain):
    t = tables(spark, plain)
    loaded = catalog._loaded(t)
    got, want = LD._joined(loaded), V.join_dimensions(LD._fact(loaded), **LD._dims(loaded))
    assert rows(got, want.columns) == rows(want) and set(got.columns) == set(want.columns) and want.count() > 0
    amounts = got.agg(F.sum("amount"))._jdf.queryExecution().optimizedPlan().toString()
    assert amounts.count("Join") == 1  # devices
