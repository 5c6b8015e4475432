"""The load's CSV files are compressed."""

import os

from conftest import SF_SMALL
from ledgerlens.plans import loading as LD
from ledgerlens.sources.adapter import tables


def test_csv_files_are_compressed(spark, tmp_path):
    txn = tables(spark, SF_SMALL).transactions_a.limit(50)
    folder = LD.write_files({"transactions": LD.planted(txn)}, str(tmp_path))
    parts = [f for f in os.listdir(f"{folder}/transactions.csv") if f.startswith("part-")]
    assert parts and all(f.endswith(".csv.gz") for f in parts)
