"""Fill in the middle, the n-gram Jaccard join and the source divergence audit: brute force, round trips, edge cases; repairs of earlier operators."""

import hashlib
import os
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import divergence, infill, mixing, packing, setjoin, warc

DOCS = "doc_id long, text string, lang string, source string, n long, c long, form string, output string, kept int, size long, k long, b long"
LONG = " ".join(f"word{i % 977}" + ("\n" if i % 50 == 0 else "") for i in range(250_000))  # over 2 MB


def row(i, text, lang="en", source="a"):
    return (i, text, lang, source, 5, 6, "psm", "<P>", 1, 2, 3, 4)


ODD = [row(1, "One two three four.\nFive six seven!\n"), row(2, None), row(3, ""), row(4, "One two three four.\nFive six seven!\n", None, None), row(4, "other text here"), row(5, " \n\t \n\n"),
       row(6, "née ß 日本 \U0001f600 x\nÀ la carte", "", None), row(None, "no id at all\nreally", None, "b"), row(7, "same same"), row(7, "same same"), row(8, LONG, "en", "b"),
       row(9, "has a <S> in it\nand more\n"), row(10, "<\n<P\n>S>\n<M\n"), row(11, "a b c d e f g h"), row(None, "A B c d e f g h")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)


# 11

def _infill(doc_id, text, fim=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, digits = len(units), hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * k:8 * k + 8], 16) for k in range(4)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < spm else "psm"
    return doc_id, n, form, len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"), sha(text)


def test_infill_equals_strings(docs, odd, none):
    for frame in (docs, odd):
        want = [_infill(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        assert sorted(map(tuple, infill.digest(frame).collect()), key=str) == sorted(want, key=str)
    assert infill.digest(none).count() == 0
    assert {r.form for r in infill.digest(docs).collect()} >= {"psm", "spm"}


def test_infill_restores_outputs_and_pieces(odd):
    out = infill.rendered(odd)
    texts = Counter(r.text or "" for r in odd.collect())
    assert Counter(r.restored for r in infill.restored(out).collect()) == texts
    for r in out.collect():
        pieces = [(x.buffer, x.start, x.stop) for x in r.pieces]
        assert sum(stop - start for buffer, start, stop in pieces if buffer == 0) == len(r.output.encode()) - (9 if r.form != "plain" else 0)
        assert hashlib.sha256(r.output.encode()).hexdigest() == r.output_sha256
    half = infill.rendered(odd, fim_percent=50, spm_percent=0).collect()
    want = {(r.doc_id, r.text): _infill(r.doc_id, r.text, 50, 0)[2] for r in odd.collect()}
    assert Counter(r.form for r in half) == Counter(want[r.doc_id, r.text] for r in odd.collect())


# 12

def _joined(rows, percent=80):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x] if j != i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                links[i] += 1
                parent[find(i)] = find(j)
    group = defaultdict(list)
    for i in range(len(rows)):
        group[find(i)].append(rows[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in group.items()}
    return sorted([(rows[i][0], len(sets[i]), least[find(i)], links[i]) for i in range(len(rows))], key=key)


def _near_copies(seed, groups=12):
    """Chains and clouds of edited copies around the threshold, exact copies, and a passage that a third of all texts share."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for g in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([4, 9, 40, 120]))]
        if g % 3 == 0:
            base = passage + base[:rng.randrange(1, 30)]
        for _ in range(rng.choice([1, 2, 3, 25])):
            rows.append(" ".join(base))
            base = list(base) if rng.random() < 0.5 else base[rng.randrange(0, 2):]
            for _ in range(rng.randrange(0, 3)):
                base[rng.randrange(len(base))] = rng.choice(words)
    ids = rng.sample(range(1000), len(rows))
    return list(zip(ids, rows)) + [(ids[0], rows[0]), (None, rows[1]), (5000, None), (5001, " \n"), (5002, "x"), (5003, "X")]


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"bits": 6, "block": 200}), (3, {"percent": 60, "block": 50}), (4, {"percent": 95, "bits": 10}), (5, {"block": 1})])
def test_setjoin_equals_brute_force(spark, seed, options):
    rows = _near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = setjoin.join(docs, **({"bits": 12} | options)).select("doc_id", "n_shingles", "component_id", "links").collect()
    assert sorted(map(tuple, got), key=key) == _joined(rows, options.get("percent", 80))


def test_setjoin_of_documents_and_odd_rows(docs, odd, none):
    for frame in (docs, odd):
        rows = [(r.doc_id, r.text) for r in frame.collect()]
        assert sorted(map(tuple, setjoin.digest(frame).collect()), key=key) == _joined(rows)
    assert setjoin.digest(none).count() == 0


def test_list_skipping_loses_no_pair():
    rng = np.random.default_rng(3)
    for percent in (50, 80, 95):
        reach = setjoin.Reach(percent)
        for _ in range(200):
            n = np.sort(rng.integers(1, 40, rng.integers(3, 30)))
            pos = rng.integers(0, np.maximum(n // 4, 1))
            order = np.lexsort((pos, n))
            n, pos = n[order].astype(np.int64), pos[order].astype(np.int64)
            stay, run = reach.survivors(n, pos), None
            run = np.full(len(n), -1)
            run[stay] = reach.runs(n[stay]) if stay.any() else []
            for i in range(len(n)):
                for j in range(i + 1, len(n)):
                    if reach.pair(n[i], pos[i], n[j], pos[j]):
                        assert stay[i] and stay[j] and run[i] == run[j]


def test_answers_are_overlaps():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(40)]
    answers = setjoin.Answers(np.concatenate(sets), np.array([len(s) for s in sets]))
    seen = dict((x, ov) for x, ov in answers.overlaps(np.arange(40)))
    assert sorted(seen) == list(range(40))
    assert all(seen[x][y] == len(np.intersect1d(sets[x], sets[y])) for x in range(40) for y in range(40))


# 13

def _audited(rows, least=10):
    at = [((lang or ""), (source or ""), re.findall(rb"[a-z\x80-\xff]+", (text or "").encode().lower())) for lang, source, text in rows]
    df, out = Counter((lang, t) for lang, _, ts in at for t in set(ts)), []
    groups = sorted({(lang, source) for lang, source, _ in at})
    for lang in sorted({g[0] for g in groups}):
        kept = sorted(t for (x, t), n in df.items() if x == lang and n >= least)
        n = {s: Counter() for x, s in groups if x == lang}
        for x, s, ts in at:
            if x == lang:
                n[s].update(t for t in ts if (lang, t) in df and df[lang, t] >= least)
        whole = sum(n.values(), Counter())
        share = lambda c: {t: 1 + int(Fraction(10**9 * (c[t] + 2), sum(c.values()) + 2 * len(kept))) for t in kept}
        p, q = {s: share(c) for s, c in n.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in n:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in n if o != s)
            terms = sorted((-f(p[s][t], q[t]), t) for t in kept if n[s][t] > 0 and p[s][t] > q[t])[:10]
            out += [(lang, s, part, item.decode(), -v, k + 1) for part, found in (("pair", pairs), ("term", terms)) for k, (v, item) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"group_block": 2, "term_block": 3, "least_docs": 3}, {"group_block": 1, "term_block": 1, "least_docs": 10**6}])
def test_divergence_equals_brute_force(spark, options):
    rng = random.Random(6)
    words = ["a", "B", "été", "日本", "x1y", "it's", "Zed", "zed", "Été"] + [f"t{chr(97 + i)}" for i in range(20)]
    rows = [(rng.choice(["en", "fr", "", None]), rng.choice(["s1", "s2", "S2", "", None, "日"]), rng.choice([None, "", " ".join(rng.choices(words, k=rng.randrange(1, 30)))])) for _ in range(300)]
    frame = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("term", F.lit("clash")).withColumn("value", F.lit(1)).repartition(3)
    got = divergence.audit(frame, **options).collect()
    assert sorted(map(tuple, got)) == _audited(rows, options.get("least_docs", 10))


def test_divergence_edges(odd, none):
    assert divergence.audit(none).count() == 0
    rows = [(r.lang, r.source, r.text) for r in odd.collect()]
    assert sorted(map(tuple, divergence.audit(odd, least_docs=1, term_block=100).collect())) == _audited(rows, 1)


def test_a_cell_runs_in_a_worker_that_did_nothing_before(tmp_path):
    """At size, workers that sat idle during the joins are replaced; a new one has loaded the operator's module only and reads its table from a stream."""
    n, term = [2, 3, 2, 3], [None, None, "x", "x"]
    columns = dict(lang=["en"] * 4, gi=[0] * 4, gj=[0] * 4, t=[0] * 4, g=[0] * 4, source=["a", "b"] * 2, term=term, n=n, lang_n=[5] * 4, in_block=[1] * 4, total=n, n_kept=[1] * 4, lang_total=[5] * 4)
    table = pa.table(columns)
    with pa.ipc.new_stream(str(tmp_path / "cell.arrow"), table.schema) as out:
        out.write_table(table)
    program = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))!r})
import pyarrow as pa
from ledgerlens.llm import divergence
print(divergence.cell(pa.ipc.open_stream({str(tmp_path / "cell.arrow")!r}).read_all()).column("part").to_pylist())
"""
    done = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.strip() == str(divergence.cell(table).column("part").to_pylist())


def test_long_division_is_exact():
    count, total = np.array([0, 3, 10**14, 7]), np.array([10**15 - 1, 7, 3 * 10**14 + 1, 9])
    assert divergence.shares(count, total).tolist() == [1 + 10**9 * (c + 2) // t for c, t in zip(count.tolist(), total.tolist())]


# Repairs

def test_mix_comes_near_its_target_with_a_huge_document(spark):
    short = lambda i, s, k: [(i + j, "w " * 100, s) for j in range(k)]
    for many, huge in ((1000, 100_000), (2000, 445_000)):
        rows = short(0, "a", 2000) + short(10_000, "b", 2000) + short(20_000, "c", many) + [(30_000, "w " * huge, "c")]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4).checkpoint()
        for seed in (17, 187, 3):
            for r in mixing.mix(docs, seed=seed).groupBy("source", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("copies").alias("most")).collect():
                assert abs(r.taken - r.target) <= 100 and r.most <= 2


def test_mix_of_a_single_document_and_of_equal_rows(spark):
    rows = [(1, "w " * 1000, "a"), (2, "w " * 10, "b")] + [(None, "w w w", "c")] * 500 + [(7, "w w", "c")] * 400 + [(7, "w w w", "c")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sums = {r.source: (r.target, r.taken) for r in mixing.mix(docs).groupBy("source", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()}
    assert abs(sums["c"][0] - sums["c"][1]) <= 2 and sums["a"][1] in (1000, 2000)
    kept = mixing.mixed(docs)
    assert kept.columns == docs.columns
    taken = kept.groupBy("source").agg(F.sum(F.size(F.regexp_extract_all("text", F.lit(mixing.WORD), F.lit(0)))).alias("n"))
    assert {r.source: r.n for r in taken.collect()} == {s: t for s, (_, t) in sums.items()}


def test_fixity_of_dropped_inserted_and_damaged_records(spark):
    pages = spark.range(100).select(F.col("id").alias("page_id"), F.concat(F.lit("http://x/"), "id").alias("url"), F.sha2(F.col("id").cast("string"), 256).alias("html")).coalesce(1)
    files = warc.write_archive(pages)
    ours = warc.leaves(files).checkpoint()

    def outcome(edit):
        rows = warc.compared(ours, warc.leaves(warc.copy_records(files, edit))).collect()
        return Counter(r.status for r in rows), {(r.status, r.record) for r in rows if r.status != "same"}

    foreign = warc.record(None, "urn:x", b"x", "0")
    damaged = lambda raw: raw[:len(raw) // 2] + bytes([raw[len(raw) // 2] ^ 0x55]) + raw[len(raw) // 2 + 1:]
    assert outcome(lambda f, n, at, raw: raw) == ({"same": 100}, set())
    assert outcome(lambda f, n, at, raw: b"" if n == 10 else raw) == ({"same": 99, "missing": 1}, {("missing", 10)})
    assert outcome(lambda f, n, at, raw: foreign + raw if n == 40 else raw) == ({"same": 100, "extra": 1}, {("extra", 40)})
    assert outcome(lambda f, n, at, raw: b"" if n == 10 else damaged(raw) if n in (5, 60, 61) else raw) == (
        {"same": 96, "missing": 1, "changed": 3}, {("missing", 10), ("changed", 5), ("changed", 60), ("changed", 61)})
    assert outcome(lambda f, n, at, raw: b"") == ({"missing": 100}, {("missing", k) for k in range(100)})


def test_packing_deals_equal_rows_apart(spark):
    rows = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a b c").alias("text"))
    packed = packing.pack(rows, per_partition=2500)
    assert packed.count() == 20_000
    length = packed.first().length
    assert packed.select("sequence_id").distinct().count() == -(-20_000 // (1024 // length))
    pieces = packing.cut(rows).withColumn("x", F.lit(1))
    spread = packing.dealt(pieces, 8, 0).groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert spread[0] <= 2 * 2500 and spread[1] == 8
