"""Language identification by Bayesian fusion of text, markup, address and host evidence.

For each language, the log of its posterior is a sum of

* the text's likelihood: byte trigrams (ASCII letters in lower case) under a smoothed model for each
  language, tempered to the weight of at most ``EFFECTIVE`` independent trigrams;
* the declared language: how often texts of the language (by their text alone) declare it so;
* the address suffix: how often texts of the language stand under it;
* the host's prior: shares of languages among the host's texts, smoothed by its domain's, those by the
  corpus's, each as strong as ``STRENGTH`` texts.

Beside the languages stands one more class, none of these: a text whose trigrams are on average less likely
under its best language than that language's ``least`` is rather in none.  ``least`` is calibrated in ``fit`` on
labelled rows left out of the count: a part ``MARGIN`` of the way from how well texts of the other languages
fit the language (at least a uniform model's fit plus ``FLOOR``) to how well its own do.  By the text alone, none
starts at odds of ``DOUBT``; it has its own shares and its own declared languages and suffixes, like a language.

The last three come from one grouped count of (host, domain, suffix, declared, text guess) over all rows;
each row leaves itself out.  The text model is fit on labelled rows.  Its languages are all labels of
all rows; the sample has a bound for each of them, the ``most_rows`` ids with the lowest hash.  A row is kept if its best language is wanted and has
at least ``CONFIDENCE``, of which none of these takes its part.

Rows are scored where they lie: only counts are shuffled, and counts are joined to rows by host, domain,
suffix and declared language (a hot host's rows are split by adaptive execution, or its counts broadcast
by size).  Null evidence is a value of its own, the empty string.  White space counts as one blank, and none
at the ends.  Texts without trigrams (null, empty, blank, under 3 bytes) have an even likelihood and no
guess, and are in no count, so the other evidence decides.  Repeated rows count and are scored each; an empty table gives no rows;
without labelled rows nothing is identified (null, confidence 0).  All columns of the input go along in one struct, so no name clashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import blocks, map_arrow, segment_sums, stored

BITS = 16
MOST_ROWS = 8_000
EFFECTIVE = 60.0
STRENGTH = 8.0
SMOOTH = 0.5
CONFIDENCE = 0.5
MARGIN, FLOOR, DOUBT = 0.125, 0.25, 0.01
HELD_OUT = 5   # one in so many rows of the sample calibrates
LEVELS = ("host", "domain", "suffix", "declared")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32
PIECE = 1 << 20


def _grams(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all texts in a row, and the number of each."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    points = _LOWER[np.frombuffer(b"\0\0".join([*data, b""]), np.uint8)].astype(np.uint32)
    size = np.array([len(d) for d in data])
    n = np.maximum(size - 2, 0)
    start = np.cumsum(size + 2) - size - 2
    at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    key = (points[at] << np.uint32(16)) | (points[at + 1] << np.uint32(8)) | points[at + 2]
    return (key * np.uint32(2654435761)) >> np.uint32(32 - BITS), n


def grams(texts):
    """Hashed trigrams of blocks of texts, as a list of arrays, and the number of each text.

    Memory is bounded: a text longer than a block is one of its own and comes in several arrays.
    White space in a row is one blank, and none at the ends: markup leaves much of it.
    """
    for _, held in blocks((" ".join(t.split()) if t else "" for t in texts), 1 << 18):
        if len(held) > 1 or len(held[0]) <= PIECE:
            found, n = _grams(held)
            yield [found], n
        else:
            parts = [_grams([held[0][i:i + PIECE]])[0] for i in range(0, len(held[0]), PIECE)]
            yield parts, np.array([sum(map(len, parts))])


class TextModel:
    """Log likelihoods of trigrams: a row for each language, a column for each trigram."""

    def __init__(self, languages: list[str], counts: np.ndarray, held: np.ndarray | None = None):
        """``counts`` of trigrams by language, and of these the ones in rows held out for calibration."""
        self.languages = languages
        self.logs = self._fit(counts)
        self.least = self._calibrated(counts, np.zeros_like(counts) if held is None else held)

    @staticmethod
    def _fit(counts: np.ndarray) -> np.ndarray:
        p = (counts + SMOOTH) / (counts.sum(0) + SMOOTH * len(counts))
        return np.ascontiguousarray(np.log(p).astype(np.float32).T)

    def _calibrated(self, counts: np.ndarray, held: np.ndarray) -> np.ndarray:
        """The least mean log likelihood of a trigram for a text of each language."""
        n, uniform = len(self.languages), -np.log(len(counts))
        total = held.sum(0)
        # Row: the model without the rows held out; column: whose rows these are.
        mean = self._fit(counts - held).astype(np.float64) @ held / np.maximum(total, 1)
        mean[:, total == 0] = uniform
        own = mean.diagonal()
        others = np.where(np.eye(n, dtype=bool), -np.inf, mean).max(1, initial=-np.inf)
        # Wrong labels can't raise it above halfway to the language's own texts.
        others = np.maximum(np.minimum(others, (own + uniform) / 2), uniform + FLOOR)
        return others + MARGIN * np.maximum(own - others, 0)

    def _weighed(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Tempered log likelihood of each language for each text, and the tempered number of its trigrams."""
        sizes = [np.zeros(0)]
        out = [np.zeros((0, len(self.languages)))]
        for found, n in grams(texts):
            sums = np.zeros((len(n), len(self.languages)))
            for k in range(len(self.languages)):
                logs = self.logs[k]
                sums[:, k] = segment_sums(logs[found[0]], n) if len(found) == 1 else sum(logs[f].sum(dtype=np.float64) for f in found)
            out.append(sums * (EFFECTIVE / (EFFECTIVE + n))[:, None])
            sizes.append(n * (EFFECTIVE / (EFFECTIVE + n)))
        return np.concatenate(out), np.concatenate(sizes)

    def evidence(self, texts) -> np.ndarray:
        """Tempered log likelihood of each language for each text."""
        return self._weighed(texts)[0]

    def judged(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The evidence with a last column for none of these, and the best class by the text alone (-1: no trigrams)."""
        e, size = self._weighed(texts)
        if not self.languages:
            return e, np.full(len(e), -1)
        none = size * self.least[e.argmax(1)] + np.log(DOUBT)
        e = np.column_stack((e, none))
        return e, np.where(size > 0, e.argmax(1), -1)


def _cuts(rows: DataFrame, most_rows: int) -> DataFrame:
    """For each language the hash that is the ``most_rows``-th lowest of its ids (or the highest)."""
    ids = stored(rows.select("__lang", "__order").distinct(), "label-hashes")
    sizes = ids.groupBy("__lang").agg(F.count("*").alias("size"))
    # Hashes are even, so twice the wanted part holds the wanted rows: a label of any size puts few into its window.
    low = ids.join(F.broadcast(sizes), "__lang").where(F.col("__order") / F.lit(2.0 ** 63) * F.col("size") <= 2 * most_rows + 100)
    first = low.withColumn("place", F.row_number().over(Window.partitionBy("__lang").orderBy("__order"))).where(F.col("place") <= most_rows)
    return stored(first.groupBy("__lang").agg(F.max("__order").alias("__cut")), "label-cuts")


def fit(docs: DataFrame, label: str = "lang", most_rows: int = MOST_ROWS) -> TextModel:
    """A text model from the labelled rows of ``docs`` (doc_id, text, ``label``), with a language for each label."""
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), F.coalesce("text", F.lit("")).alias("__text"), F.col(label).alias("__lang")).where("__lang IS NOT NULL")
    rows = rows.where("__id IS NOT NULL").withColumn("__order", F.call_function("shiftrightunsigned", F.xxhash64("__id"), F.lit(1)))
    rows = rows.withColumn("__held", F.pmod(F.xxhash64(F.lit("held out"), "__id"), F.lit(HELD_OUT)) == 0)
    cuts = _cuts(rows, most_rows)

    def count(batches):
        total = {}
        for batch in batches:
            kinds = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            for kind in sorted(set(kinds)):
                mine = total.setdefault(kind, np.zeros(1 << BITS, np.int64))
                for found, _ in grams([t for t, x in zip(batch.column(0).to_pylist(), kinds) if x == kind]):
                    for f in found:
                        mine += np.bincount(f, minlength=1 << BITS)
        for (lang, held), mine in total.items():
            at = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array([held] * len(at), pa.bool_()), pa.array(at), pa.array(mine[at])], names=["lang", "held", "gram", "n"])

    # A row for each language; the counts are no more than languages times trigrams.
    sample = rows.join(F.broadcast(cuts), "__lang").where("__order <= __cut").select("__text", "__lang", "__held")
    counts = map_arrow(sample, count, "lang string, held boolean, gram long, n long").groupBy("lang", "held", "gram").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(counts["lang"].to_pylist()))
    place = {lang: i for i, lang in enumerate(languages)}
    at = counts["gram"].to_numpy(), np.array([place[x] for x in counts["lang"].to_pylist()], np.int64)
    table, left_out = np.zeros((1 << BITS, len(languages))), np.zeros((1 << BITS, len(languages)))
    np.add.at(table, at, counts["n"].to_numpy())
    np.add.at(left_out, at, np.where(counts["held"].to_numpy(), counts["n"].to_numpy(), 0))
    return TextModel(languages, table, left_out)


def with_evidence(rows: DataFrame, text: Column, host: Column | None = None, declared: Column | None = None, carry=None) -> DataFrame:
    """``row`` (a struct of the columns ``carry`` of ``rows``, by default all) and the evidence; the host's domain and suffix are its last two labels and its last."""
    empty = F.lit("")
    host = F.coalesce(F.lower(host), empty) if host is not None else empty
    dotted = F.contains(host, F.lit("."))
    declared = F.coalesce(F.lower(F.regexp_extract(declared, "^[A-Za-z]+", 0)), empty) if declared is not None else empty
    return rows.select(F.struct(*(carry or rows.columns)).alias("row"), F.coalesce(text, empty).alias("text"), host.alias("host"), F.when(dotted, F.substring_index(host, ".", -2)).otherwise(empty).alias("domain"),
                       F.when(dotted, F.substring_index(host, ".", -1)).otherwise(empty).alias("suffix"), declared.alias("declared"))


def page_evidence(pages: DataFrame, carry=None) -> DataFrame:
    """Evidence of web pages (url, html): visible text, the host of the address, the language that the markup declares."""
    text = F.regexp_replace("html", "(?is)<(script|style)\\b.*?</\\1>|<!--.*?-->|<[^>]*>", " ")
    host = F.regexp_extract("url", "://([^/?#:]*)", 1)
    return with_evidence(pages, text, host, F.regexp_extract("html", "(?i)<html[^>]*\\blang\\s*=\\s*[\"']?([A-Za-z]+)", 1), carry)


def document_evidence(docs: DataFrame, carry=None) -> DataFrame:
    """Evidence of documents (text, source, lang): the source stands for the host, ``lang`` for the declared language."""
    return with_evidence(docs, F.col("text"), F.col("source").cast("string"), F.col("lang").cast("string"), carry)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def identify(rows: DataFrame, model: TextModel) -> DataFrame:
    """``row`` of each of ``rows`` (from ``with_evidence``) with its language, confidence and guess (by the text alone)."""
    n = len(model.languages)
    classes = n + 1 if n else 0  # the last is none of these
    held = rows.sparkSession.sparkContext.broadcast(model)  # trigrams times languages

    def guess(batches):
        for batch in batches:
            _, g = held.value.judged(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(g.astype(np.int32))], names=[*LEVELS, "guess"])

    guesses = map_arrow(rows.select("text", *LEVELS), guess, ", ".join(f"{c} string" for c in LEVELS) + ", guess int")
    tallies = guesses.groupBy(*LEVELS, "guess").agg(F.count("*").alias("n"))
    tallies = stored(tallies, "language-tallies")  # as files their size is known, so small counts are broadcast and texts stay where they are
    by = lambda c: tallies.groupBy(c).agg(F.array(*[F.sum(F.when(F.col("guess") == i, F.col("n")).otherwise(0)) for i in range(classes)]).alias(f"{c}_n")) if n else tallies.groupBy(c).agg(F.array().cast("array<bigint>").alias(f"{c}_n"))
    whole = np.zeros(classes)
    for r in tallies.groupBy("guess").agg(F.sum("n").alias("n")).collect():  # a row for each class
        if r["guess"] >= 0:
            whole[r["guess"]] = r.n
    joined = rows
    for c in LEVELS:
        joined = joined.join(by(c), c)

    def fuse(batches):
        for batch in batches:
            rows_n = batch.num_rows
            if not rows_n:
                continue
            e, g = held.value.judged(batch.column("text").to_pylist())
            counts = {c: np.array(batch.column(f"{c}_n").to_pylist(), np.float64).reshape(rows_n, classes) for c in LEVELS}
            if not n:
                made = [pa.nulls(rows_n, pa.string()), pa.array(np.zeros(rows_n)), pa.nulls(rows_n, pa.string())]
            else:
                own = np.eye(classes)[g] * (g >= 0)[:, None]
                share = (whole - own + 1) / (whole - own + 1).sum(1, keepdims=True)
                for c in ("domain", "host"):
                    others = counts[c] - own
                    share = (others + STRENGTH * share) / (others.sum(1, keepdims=True) + STRENGTH)
                post = e + np.log(share)
                for c in ("declared", "suffix"):  # of the texts of each language, how many have this value
                    left, among = counts[c] - own, whole - own
                    has = (left + SMOOTH) / (among + 2 * SMOOTH)
                    # None of these may be empty: it starts from how many of all texts have this value.
                    rate = (left.sum(1) + SMOOTH) / (among.sum(1) + 2 * SMOOTH)
                    has[:, n] = (left[:, n] + rate) / (among[:, n] + 1)
                    post = post + np.log(has)
                post = np.exp(_log_softmax(post))[:, :n]
                best = post.argmax(1)
                name = np.array([*held.value.languages, None], object)
                made = [pa.array(name[best], pa.string()), pa.array(post.max(1)), pa.array(name[g], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *made], names=["row", "language", "confidence", "guess"])

    schema = rows.select("row", F.lit("").alias("language"), F.lit(0.0).alias("confidence"), F.lit("").alias("guess")).schema
    for f in schema.fields:
        f.nullable = True
    return map_arrow(joined, fuse, schema)


def wanted(languages=None, confidence: float = CONFIDENCE) -> Column:
    """Whether an identified row is kept."""
    good = F.coalesce(F.col("confidence") >= confidence, F.lit(False)) & F.col("language").isNotNull()
    return good if languages is None else good & F.col("language").isin(*languages)


def keep(docs: DataFrame, model: TextModel, languages=None, confidence: float = CONFIDENCE) -> DataFrame:
    """The rows of ``docs`` in a wanted language (all known ones by default), with their columns."""
    return identify(document_evidence(docs), model).where(wanted(languages, confidence)).select("row.*")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op5: every document with its language, the confidence, and whether it is kept."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")
    found = identify(document_evidence(rows, ["doc_id", "lang"]), fit(rows))
    return found.select("row.doc_id", F.col("row.lang").alias("declared"), "language", "confidence", F.col("guess").alias("text_language"), wanted().alias("keep"))


def page_digest(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Every page with its language, by a text model fit on ``docs``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    found = identify(page_evidence(rows, ["page_id"]), fit(docs))
    return found.select("row.page_id", "language", "confidence", F.col("guess").alias("text_language"), wanted().alias("keep"))
