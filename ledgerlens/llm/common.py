"""Helpers shared by the operators: stored intermediate tables, running totals, shared files, text blocks."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the folder that the driver and all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back (cuts the lineage)."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, which may not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(), "ledgerlens.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(root)))
        sc.addPyFile(path)
        _shipped.add(sc.applicationId)


#: Whole texts travel in small batches: at most so many rows, and bytes, in one (a longer row is one of its own).
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def map_arrow(df: DataFrame, work, schema: str) -> DataFrame:
    """``df.mapInArrow``, with this package at hand on the executors and batches that workers can hold."""
    spark = df.sparkSession
    ship(spark)
    for key, most in BATCH.items():
        now = int("".join(c for c in spark.conf.get(key) if c.isdigit()) or 0)
        if not 0 < now <= most:
            spark.conf.set(key, most)
    return df.mapInArrow(work, schema)


def running_totals(df: DataFrame, order: list[Column], sums: list[str]) -> DataFrame:
    """Add ``before_<c>`` for each ``c`` of ``sums``: its sum over all earlier rows in ``order``.

    The rows are dealt out by range and frozen, each range is summed on its own, and only the
    totals of the ranges (one row each) meet in one task.  Rows equal in ``order`` stand in any order.
    """
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).checkpoint()
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_total_{c}") for c in sums]).select(
        "_range", *[F.coalesce(F.sum(f"_total_{c}").over(earlier), F.lit(0)).alias(f"_offset_{c}") for c in sums])
    out = ranged.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_inside_{c}") for c in sums])
    # One row for each range: no more than there are shuffle partitions.
    out = out.join(F.broadcast(offsets), "_range")
    return out.select(*df.columns, *[(F.col(f"_inside_{c}") + F.col(f"_offset_{c}")).alias(f"before_{c}") for c in sums])


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and inner path of a path in the shared folder (file, hdfs, s3, ...)."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def blocks(texts: Iterable[str | None], size: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts in blocks of about ``size`` characters (a longer text is a block of its own).

    Yields the index of the first text of the block and the texts; null counts as empty.
    """
    first, held, n = 0, [], 0
    for i, t in enumerate(texts):
        t = t if isinstance(t, str) else ""
        if held and n + len(t) > size:
            yield first, held
            first, held, n = i, [], 0
        held.append(t)
        n += len(t)
    if held:
        yield first, held


def segment_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over consecutive segments of the given lengths (0 for an empty segment)."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]
