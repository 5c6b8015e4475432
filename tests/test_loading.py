"""The load over files: every planted defect is found, and the values of ``quantiles`` and the audit agree with plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators.ranking import quantiles
from ledgerlens.plans import loading as LD
from ledgerlens.plans import quality as C
from ledgerlens.sources import io as IO
from ledgerlens.sources.adapter import tables


def test_every_planted_defect_is_found(spark):
    txn = tables(spark, SF_SMALL).transactions_a
    raw = LD.raw_files(spark, txn)
    audit = {r.check: r.value for r in C.data_quality_report(raw).collect()}
    of = {r.k: r["count"] for r in txn.groupBy(((F.col("customer_id") + F.col("merchant_id")) % LD.MODULUS).alias("k")).count().collect()}
    n = {name: of.get(at, 0) for name, at in LD.DEFECTS.items()}
    assert all(n.values())
    assert audit["rows"] == sum(of.values()) + n["copy"] + n["same_id_later"]
    assert audit["missing_customer_id"] == n["no_customer"] and audit["missing_amount"] == n["no_amount"]
    assert audit["non_positive_amount"] == n["negative_amount"] and audit["invalid_timestamps"] == n["bad_timestamp"] + n["no_timestamp"]
    assert audit["invalid_status"] == n["unknown_status"] + n["lower_case_status"] and audit["full_duplicate_rows"] >= n["copy"]
    steps = {r.action: r.rows_dropped for r in C.cleaning_actions(raw).collect()}
    assert steps["dropped_duplicate_ids"] == audit["duplicate_txn_ids"] and steps["dropped_bad_status"] <= n["unknown_status"]
    assert all(v > 0 for v in steps.values())
    kept = C.clean_transactions(raw)
    assert kept.count() == audit["rows"] - sum(steps.values()) and kept.where("status <> upper(trim(status)) OR amount <= 0").count() == 0


def test_a_missing_file_is_an_error_in_any_store(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        IO.load_tables(spark, f"file:{tmp_path}")


@pytest.mark.parametrize("by", [None, "g"])
def test_quantiles_at_many_positions(spark, by):
    rng = random.Random(3)
    probs = [0.0, 1.0, 0.5, 0.001, 0.999] + [rng.random() for _ in range(150)]
    groups = {"a": [round(rng.gauss(0, 3), 1) for _ in range(700)], "b": [7.0] * 40, "c": [1.5], None: [rng.random() for _ in range(90)]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("a", None)]
    got = {r[by] if by else 0: r.q for r in quantiles(spark.createDataFrame(rows, "g string, v double"), F.col("v"), probs, by, partitions=5).collect()}
    want = groups if by else {0: [v for vs in groups.values() for v in vs]}
    assert got.keys() == want.keys()
    for g, vs in want.items():
        s = sorted(vs)
        for p, q in zip(probs, got[g]):
            at = p * (len(s) - 1)
            lo, hi = s[int(at)], s[min(int(at) + (at > int(at)), len(s) - 1)]
            assert abs(q - (lo + (hi - lo) * (at - int(at)))) < 1e-9
