"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's ``docs``.  All but the last return the columns of ``documents``.

1. quality classifier: learned from ``labels``; rows scored under 0.3 go.
2. language ID: rows without a language of at least even odds go.
3. SimHash near-dedup: of each group of near-duplicates, the row with the smallest doc_id stays.
4. mixing sources to target weights: each row as often as the mix takes it (none, once or twice).
5. best-fit packing: a row for each piece, with its sequence and offset there.
"""

from __future__ import annotations

from ledgerlens.llm import langid, mixing, packing, quality, simhash
from ledgerlens.llm.common import stored, table


def quality_classifier(spark, docs, sf_dir):
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def language_id(spark, docs, sf_dir):
    return langid.keep(docs, langid.fit(docs))


def simhash_near_dedup(spark, docs, sf_dir):
    return simhash.keep_one(docs)


def mixing_sources(spark, docs, sf_dir):
    return mixing.mixed(docs)


def best_fit_packing(spark, docs, sf_dir):
    return packing.pack(docs)


STAGES = [(f.__name__, f) for f in (quality_classifier, language_id, simhash_near_dedup, mixing_sources, best_fit_packing)]
#: Trained scores, hashes and token ids are beyond SQL; the tests hold the stages' operators one by one.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
