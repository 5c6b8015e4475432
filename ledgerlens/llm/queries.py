"""The queries of the dealt operators: name -> (spark, sf_dir) -> DataFrame, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from ledgerlens.llm import ann, divergence, fingerprint, infill, langid, mixing, packing, quality, setjoin, simhash, tokens, urlfilter, warc
from ledgerlens.llm.common import table


def op1_document_fingerprints(spark, sf_dir):
    return fingerprint.digest(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark, sf_dir):
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash_near_dedup(spark, sf_dir):
    return simhash.digest(table(spark, sf_dir, "documents"))


def op4_warc_fixity(spark, sf_dir):
    return warc.fixity(table(spark, sf_dir, "pages"))


def op5_language_id(spark, sf_dir):
    return langid.digest(table(spark, sf_dir, "documents"))


def llm_language_id_pages(spark, sf_dir):
    """Operator 5 over web pages, which have all its kinds of evidence."""
    return langid.page_digest(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op6_mixing_sources(spark, sf_dir):
    return mixing.digest(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_token_shards(spark, sf_dir):
    return tokens.token_shards(spark, table(spark, sf_dir, "documents"))


def op9_url_filter(spark, sf_dir):
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op10_nearest_neighbours(spark, sf_dir):
    return ann.digest(table(spark, sf_dir, "embeddings"))


def op11_fill_in_middle(spark, sf_dir):
    return infill.digest(table(spark, sf_dir, "documents"))


def op12_ngram_jaccard_join(spark, sf_dir):
    return setjoin.digest(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


def registry():
    return {f.__name__: f for f in (op1_document_fingerprints, op2_quality_classifier, op3_simhash_near_dedup, op4_warc_fixity, op5_language_id, llm_language_id_pages, op6_mixing_sources, op7_best_fit_packing, op8_token_shards, op9_url_filter, op10_nearest_neighbours, op11_fill_in_middle, op12_ngram_jaccard_join, op13_source_divergence)}


def oracle():
    return {"op6_mixing_sources": mixing.ORACLE, "op9_url_filter": urlfilter.ORACLE, "op11_fill_in_middle": infill.ORACLE, "op13_source_divergence": divergence.ORACLE}
