"""The lattice answers like the facts, and from the coarsest grouping."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from ledgerlens.catalog import _lattice
from ledgerlens.plans import lattice as LA
from ledgerlens.plans import measures as M
from ledgerlens.plans import views as V
from ledgerlens.sources.adapter import tables

ADDITIVE = list(LA.FINISH)


@pytest.fixture(scope="module")
def stored(spark):
    return _lattice(tables(spark, SF_SMALL))


@pytest.mark.parametrize("by,slicers", [((), None), (("payment_mode",), None), (("txn_year", "merchant_category"), {"txn_year": [1996, 1997], "merchant_category": ["ECONOMY"]}),
                                        (("payment_mode",), {"txn_month": [1, 2], "customer_state": [], "txn_year": 1996}), (("os_name",), None), (("bank_id",), {"bank_id": [1, None]}),
                                        (("customer_state",), {"payment_mode": "O", "txn_year": [1900]}), ((), {"merchant_category": ["none such"]})])
def test_answers_equal_the_facts(spark, stored, by, slicers):
    fact = V.enriched(tables(spark, SF_SMALL), "A")
    names = [*ADDITIVE, "active_customers", "active_merchants"]
    want = M.measure_query(fact, names, by, slicers).collect()
    got = stored.answer(names, by, slicers).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_the_coarsest_grouping_is_taken_and_no_fact_is_read(stored):
    assert stored.navigate(["payment_mode"]) == ("payment_mode",)
    assert stored.navigate(["txn_year"]) == LA.MONTH
    assert stored.navigate(["merchant_category", "txn_year"]) == (*LA.MONTH, "merchant_category")
    assert stored.navigate(["merchant_category", "payment_mode"]) == LA.GROUPINGS[0]
    assert stored.navigate(["merchant_name"]) is None
    files = stored.answer(["gpv", "active_customers"], ["txn_year"], {"txn_year": 1996}).inputFiles()
    assert files and all("/lattice-A-" in f or "/pairs-A-" in f for f in files)
    with pytest.raises(LookupError):
        stored.answer(["gpv"], ["merchant_name"])
    with pytest.raises(LookupError):
        stored.answer(["arpu"], ["payment_mode"])


def test_empty_fact(spark, stored):
    empty = LA.Lattice(stored.fact.where(F.lit(False)), "none", stored.sources)
    assert empty.answer(ADDITIVE, ["payment_mode"]).count() == 0
    assert empty.answer(["total_transactions", "active_customers"]).first()[:] == (0, 0)
