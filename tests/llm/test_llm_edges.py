"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import hashlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlens.llm import ann, fingerprint, langid, mixing, packing, quality, simhash, tokenize, tokens, urlfilter, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, size long, row string, label int, copies int"
LONG = " ".join(f"word{i % 977}" for i in range(250_000))  # over 2 MB


def doc(i, text, lang="en", source="a"):
    return (i, text, lang, source, 0, "w", 1, "r", 2, 3)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [doc(1, "One two three four. Five six!"), doc(2, None), doc(3, ""), doc(4, "One two three four. Five six!", None, None), doc(4, "other text here"),
            doc(5, " \n\t "), doc(6, "née ß 日本 \U0001f600 x"), doc(None, "no id at all", None, "b"), doc(7, "same same"), doc(7, "same same"), doc(8, LONG, "en", "b")]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (3, 0), (None, 1), (6, None), (99, 1), (7, 1)], "doc_id long, quality int")


PER_ROW = {
    "fingerprint": lambda d, l: fingerprint.digest(d), "quality": quality.digest, "simhash": lambda d, l: simhash.digest(d), "langid": lambda d, l: langid.digest(d),
    "mixing": lambda d, l: mixing.digest(d), "tokens": lambda d, l: tokens.token_shards(d.sparkSession, d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_each_row(docs, none, labels, name):
    got = PER_ROW[name](docs, labels)
    assert sorted(str(r.doc_id) for r in got.select("doc_id").collect()) == sorted(str(r.doc_id) for r in docs.select("doc_id").collect())
    assert PER_ROW[name](none, labels.limit(0)).count() == 0


def test_fingerprint_next_of_last_is_first_and_null_is_empty(docs):
    rows = {r.doc_id: r for r in fingerprint.digest(docs.where("doc_id <> 4 AND doc_id <> 7 OR doc_id IS NULL")).collect()}
    assert rows[2].n_chars == 0 and rows[2].fingerprint == rows[3].fingerprint == rows[2].edited_fingerprint and rows[2].near_next == 0.0
    # Descending: 8 6 5 3 2 1 null; the next of null is 8, and of 3 it is 2.
    text = "no id at all"
    assert rows[None].edited_sha256 == hashlib.sha256((text[:6] + LONG[:6]).encode()).hexdigest()
    assert rows[3].edited_sha256 == hashlib.sha256(b"").hexdigest() and rows[3].near_next == 1.0
    assert rows[8].n_chars == len(LONG)


def test_fingerprints_of_many_repeats(spark):
    others = "".join(f"Line {i}.\n" for i in range(50))
    rows = [("P.\n" * 4096, "Q.\n" * 4096, False), *[("One line.\n" * n, "One line.\n" * (n // 2) + others, True) for n in (4096, 5000, 8000)]]
    a, b = (fingerprint.of_text(F.col(c)) for c in ("x", "y"))
    got = spark.createDataFrame(rows, "x string, y string, near boolean").select("near", fingerprint.likeness(a, b).alias("l"), fingerprint.as_text(a).alias("a"), fingerprint.as_text(b).alias("b")).collect()
    assert all(r.a != r.b and (r.l > 0.95 if r.near else r.l < 0.5) for r in got)


def test_quality_keeps_columns(docs, labels, none):
    w = quality.fit(docs, labels)
    kept = quality.keep(docs, w, 0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count() and quality.keep(none, w).count() == 0
    assert {r.score for r in quality.score(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}


def test_langid_without_labels_identifies_nothing(docs):
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.language, r.confidence, r.keep) for r in langid.digest(bare).collect()} == {(None, 0.0, False)}
    kept = langid.keep(docs, langid.fit(docs), confidence=0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()


FOREIGN = ["Все люди рождаются свободными и равными в своем достоинстве и правах", "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待",
           "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw", "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan",
           "8f3a09bc77e1d2045ab6cf90817e3d5526b4a90cc1f7e8d3" * 3, "?;:!.,-)(#;;:.?!--,.:;)(##!?" * 5]


def test_langid_rejects_what_is_in_none_of_the_languages(spark):
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    texts = [(10**9 + i, t, None, "planted") for i, t in enumerate(FOREIGN)]
    got = langid.digest(known.unionByName(spark.createDataFrame(texts, known.schema))).collect()
    assert {r.doc_id: r.keep for r in got if r.doc_id >= 10**9} == {t[0]: False for t in texts}
    assert {r.text_language for r in got if r.doc_id >= 10**9} == {None}
    assert all(r.keep and r.text_language == r.language for r in got if r.doc_id < 10**9)


def test_langid_texts_without_trigrams_do_not_vote(spark):
    text = {"de": "das haus und der garten des königs", "en": "the house and the garden of the king", "fr": "la maison et le jardin du roi"}
    rows = [(i, t + f" {i}", x, "s" + x) for i in range(40) for x, t in text.items()]
    rows += [(1000 + i, text["en"] + f" {i}", "en", "hot") for i in range(10)] + [(2000 + i, (None, "", "ab", " \n\t ")[i % 4], "en", "hot") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = langid.digest(docs).collect()
    assert {(r.language, r.text_language, r.keep) for r in got if r.doc_id >= 2000} == {("en", None, True)}
    assert {r.language for r in got if 1000 <= r.doc_id < 2000} == {"en"} and sorted({r.language for r in got if r.doc_id < 40}) == ["de", "en", "fr"]


def test_langid_knows_rare_languages(spark):
    rows = [(i, f"the house and the garden of the king {i}", "en", "s") for i in range(1000)] + [(5000 + i, f"das haus und der garten des königs {i}", "de", "s") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = langid.fit(docs, most_rows=20)
    assert model.languages == ["de", "en"]
    assert {(r.row.lang, r.language) for r in langid.identify(langid.document_evidence(docs), model).collect()} == {("de", "de"), ("en", "en")}


def test_simhash_keeps_one_of_each_group(docs, none):
    kept = simhash.keep_one(docs)
    # 1 and its copy; null, empty and blank; the repeated row; each once.
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "4", "6", "7", "8", "None"]
    assert simhash.keep_one(none).count() == 0


def test_mixing_takes_whole_rows(docs, none):
    got = mixing.mix(docs)
    assert {r.copies for r in got.collect()} <= {0, 1, 2}
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mixed(docs).count() == got.agg(F.sum("copies")).first()[0] and mixing.mixed(none).count() == 0


def test_packing_loses_no_token(docs, none):
    cut = packing.cut(docs).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    rows = packing.pack(docs).collect()
    assert sum(r.n for r in cut) == sum(r.length for r in rows) and packing.pack(none).count() == 0
    assert [(r.length, r.start) for r in rows if r.doc_id == 2] == [(1, 0)]


def test_added_tokens_in_texts_are_the_librarys():
    texts = ["a<|endoftext|>b", "plain text", "<|endoftext|>" * 3, "日本<|endoftext|> x", "<|endoftext", None]
    fresh = Tokenizer.from_file(tokenize.default_path())
    got = [x.tolist() for x in tokenize.Encoder.at(None).encode(texts)]
    assert got == [fresh.encode(t or "", add_special_tokens=False).ids for t in texts] and got[0] == [64, 50256, 65]


def test_url_filter_defined_for_all(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "example.net/en/x", 1), (None, "http://A.net", 1), (5, "http://x.org/fr/?casino", 1), (5, "http://x.org/fr/?casino", 1), (6, "h://" + "a" * 3_000_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host long")
    got = sorted((str(r.page_id), r.host[:9], r.path, r.rule, r.verdict) for r in urlfilter.judge(pages).collect())
    assert got == [("1", "", "", None, "allow"), ("2", "", "", None, "allow"), ("3", "", "", None, "allow"), ("5", "x.org", "/fr/", "org/fr/", "allow"),
                   ("5", "x.org", "/fr/", "org/fr/", "allow"), ("6", "aaaaaaaaa", "", None, "allow"), ("None", "a.net", "", None, "allow")]
    assert urlfilter.judge(pages.limit(0)).count() == 0


def test_warc_defined_for_all(spark):
    pages = spark.createDataFrame([(1, None, None, 1), (None, "http://a\nb", "x", 1), (2, "", "", 1), (2, "", "", 1), (3, "u", LONG, 1)], "page_id long, url string, html string, digest long")
    got = warc.fixity(pages, damage_every=10**6).collect()
    assert len(got) == 5 and {r.status for r in got} <= {"same", "changed"} and warc.fixity(pages.limit(0)).count() == 0


def test_neighbours_leave_out_what_has_no_direction(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (3, [0.5, 0.5], 1), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1),
            (9, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (3, [0.5, 0.5], 1), (40, None, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = sorted(tuple(r) for r in ann.digest(table).collect())
    assert got == [(0, 1, 20, 1.0), (0, 2, 3, 0.5), (20, 1, 0, 1.0), (20, 2, 3, 0.5)]
    assert ann.digest(table.limit(0)).count() == 0


def test_pipeline_stages_defined_for_all(spark, docs, none, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for start in (docs, none):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, str(tmp_path))
            assert name == corpus_pipeline.STAGES[-1][0] or now.columns == start.columns
        now.count()
