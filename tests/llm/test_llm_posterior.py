"""Language evidence against plain Python sums, and nearest neighbours of wide vectors over many shards."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import ann, langid

SF = "/root/testdata/sf0.001"


def _grams(text):
    b = bytes(c + 32 if 65 <= c <= 90 else c for c in " ".join((text or "").split()).encode("utf-8", "surrogatepass"))
    return [(((b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 2654435761) & 0xFFFFFFFF) >> 16 for i in range(len(b) - 2)]


def _posteriors(rows, logs, least):
    """For (text, host, declared) rows: the chance of each language, by the operator's docstring."""
    n = len(logs)
    scored = []
    for text, host, declared in rows:
        g = _grams(text)
        weight = langid.EFFECTIVE / (langid.EFFECTIVE + len(g))
        e = [math.fsum(float(logs[k][x]) for x in g) * weight for k in range(n)]
        e.append(len(g) * weight * least[max(range(n), key=lambda k: e[k])] + math.log(langid.DOUBT))
        host = (host or "").lower()
        labels = host.split(".")
        value = {"host": host, "domain": ".".join(labels[-2:]) if len(labels) > 1 else "", "suffix": labels[-1] if len(labels) > 1 else "", "declared": (declared or "").lower()}
        scored.append((e, max(range(n + 1), key=lambda k: e[k]) if g else -1, value))
    whole, tally = Counter(), defaultdict(Counter)
    for _, guess, value in scored:
        if guess >= 0:
            whole[guess] += 1
            for level, v in value.items():
                tally[level, v][guess] += 1
    out = []
    for e, guess, value in scored:
        others = lambda counts: [counts[k] - (k == guess) for k in range(n + 1)]
        among = others(whole)
        share = [(a + 1) / (sum(among) + n + 1) for a in among]
        for level in ("domain", "host"):
            left = others(tally[level, value[level]])
            share = [(c + langid.STRENGTH * s) / (sum(left) + langid.STRENGTH) for c, s in zip(left, share)]
        post = [x + math.log(s) for x, s in zip(e, share)]
        for level in ("declared", "suffix"):
            left = others(tally[level, value[level]])
            rate = (sum(left) + langid.SMOOTH) / (sum(among) + 2 * langid.SMOOTH)
            for k in range(n):
                post[k] += math.log((left[k] + langid.SMOOTH) / (among[k] + 2 * langid.SMOOTH))
            post[n] += math.log((left[n] + rate) / (among[n] + 1))
        top = max(post)
        total = math.fsum(math.exp(x - top) for x in post)
        out.append([math.exp(x - top) / total for x in post[:n]])
    return out


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return langid.fit(documents)


def test_text_model_is_smoothed_counts(documents, model):
    rows = documents.select("text", "lang").collect()
    assert model.languages == sorted({r.lang for r in rows})
    for k, lang in enumerate(model.languages):
        counts = Counter(x for r in rows if r.lang == lang for x in _grams(r.text))
        total = sum(counts.values()) + langid.SMOOTH * (1 << langid.BITS)
        want = np.log([(counts[x] + langid.SMOOTH) / total for x in range(1 << langid.BITS)]).astype(np.float32)
        assert np.allclose(model.logs[k], want, rtol=0, atol=1e-6)


def _agree(got, rows, model):
    wants = _posteriors([r[1:] for r in rows], model.logs, model.least)
    assert len(got) == len(rows)
    for (key, *_), want in zip(rows, wants):
        best = max(range(len(want)), key=lambda k: want[k])
        assert got[key].language == model.languages[best] and abs(got[key].confidence - want[best]) < 1e-9


def test_documents_against_plain_sums(documents, model):
    rows = [(r.doc_id, r.text, r.source, re.match("[A-Za-z]*", r.lang or "").group()) for r in documents.collect()]
    found = langid.identify(langid.document_evidence(documents), model).select("row.doc_id", "language", "confidence").collect()
    _agree({r.doc_id: r for r in found}, rows, model)


def test_pages_against_plain_sums(spark, model):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    rows = []
    for r in pages.collect():
        html = r.html or ""
        text = re.sub(r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ", html)
        host, lang = re.search("://([^/?#:]*)", r.url or ""), re.search(r"""(?i)<html[^>]*\blang\s*=\s*["']?([A-Za-z]+)""", html)
        rows.append((r.page_id, text, host and host[1], lang and lang[1]))
    found = langid.identify(langid.page_evidence(pages), model).select("row.page_id", "language", "confidence").collect()
    _agree({r.page_id: r for r in found}, rows, model)


@pytest.mark.parametrize("scale", [1.0, 1e150])
def test_double_vectors_over_many_shards(spark, scale):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2400, 12)) * rng.uniform(0.5, 2, (2400, 1)) * scale
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = ann.usable(table)
    graphs = ann.index(rows, shard=300)
    assert graphs.count() >= 8
    hits = []
    got = {}
    for r in ann.search(graphs, rows.where(F.col("vec_id") % 20 == 0)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(0, 2400, 20):
        s = x @ x[q]
        s[q] = -np.inf
        found = sorted(got[q])
        assert all(math.isclose(f[2], s[f[1]], rel_tol=0, abs_tol=1e-13 * scale * scale) for f in found)
        hits.append(len({f[1] for f in found} & set(np.lexsort((np.arange(2400), -s))[:20].tolist())) / 20)
    assert np.mean(hits) >= 0.9
