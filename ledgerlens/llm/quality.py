"""Quality classifier: logistic regression on hashed word n-grams, learned by follow-the-regularised-leader.

Features are the n-grams of ``words.ngrams``, hashed to 2^``BITS`` weights; a text's value of a feature
is its share of the text's tokens times ``SCALE``.  Learning is one pass over labelled texts in the
order of a hash of doc_id, with a learning rate for each weight and lasso, so that most weights are
zero (McMahan et al., 2013).  The pass is sequential, so it runs in one task over a sample with a bound:
``most_rows`` labelled rows, those with the lowest hash.  The model is at most 2^BITS weights.
Scores are sparse dot products over all rows, in Arrow batches, without shuffle.

Null text counts as empty; an empty text's score is that of the bias.  Repeated labels of a doc_id count
once, as the largest; null labels and labels without a document are left out.  Without labels all
scores are 0.5.  Repeated rows are scored each; an empty table gives no rows.  Only ``doc_id`` and ``text``
are read; ``keep`` returns all columns of its input, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_arrow, segment_sums
from ledgerlens.llm.words import ngrams, token_blocks

BITS = 18
SCALE = 10.0
MOST_ROWS = 20_000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
THRESHOLD = 0.3
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a document is in the fold that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


class Ftrl:
    """Weights of a logistic regression (the last is the bias)."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = MOST_ROWS, bits: int = BITS) -> np.ndarray:
    """Weights learned from ``labels`` (doc_id, ``label``) of ``docs`` (doc_id, text); 2^bits of them and the bias."""
    none = 1 << bits

    def learn(batches):
        model = Ftrl(none + 1)
        for batch in batches:
            ys, row = batch.column(1).to_pylist(), 0
            for counts, h, shape in token_blocks(batch.column(0).to_pylist()):
                found, at = ngrams(counts, h, shape, bits), 0
                for n in counts.tolist():
                    features, times = np.unique(found[at:at + n], return_counts=True)
                    real = features < none
                    model.learn(np.append(features[real], none), np.append(times[real] * (SCALE / max(n, 1)), 1.0), ys[row])
                    at, row = at + n, row + 1
        w = model.weights()
        kept = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(w[kept])], names=["at", "w"])

    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("__id")).agg(
        F.max(label).cast("int").alias("__y")).withColumn("__order", F.xxhash64("__id")).orderBy("__order", "__id").limit(most_rows)
    # No more than most_rows short rows.
    sample = docs.select(F.col("doc_id").cast("long").alias("__id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "__id")
    sample = sample.repartition(1).sortWithinPartitions("__order", "__id", "text").select("text", "__y")
    w = np.zeros(none + 1)
    for r in map_arrow(sample, learn, "at long, w double").collect():  # at most 2^bits + 1 rows
        w[r.at] = r.w
    return w


def scores(texts, w: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Probability of label 1 for each text."""
    bias, table = w[-1], np.append(w[:-1], 0.0)
    out = [np.zeros(0)]
    for counts, h, shape in token_blocks(texts):
        z = bias + SCALE * segment_sums(table[ngrams(counts, h, shape, bits)].sum(1), counts) / np.maximum(counts, 1)
        out.append(1 / (1 + np.exp(-np.clip(z, -35, 35))))
    return np.concatenate(out)


def score(docs: DataFrame, w: np.ndarray, bits: int = BITS) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(w)  # 2 MB

    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(batch.column(1).to_pylist(), held.value, bits))], names=["doc_id", "score"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, "doc_id long, score double")


def keep(docs: DataFrame, w: np.ndarray, threshold: float = THRESHOLD, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, with all their columns."""
    held, at = docs.sparkSession.sparkContext.broadcast(w), docs.columns.index("text")

    def work(batches):
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(at).to_pylist(), held.value, bits) >= threshold))

    return map_arrow(docs, work, docs.schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of query op2."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
