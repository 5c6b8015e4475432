"""Document fingerprints: a homomorphic multiset hash of paragraphs, in built-in functions only.

A fingerprint is an array of longs: the number of pieces, ``DENSE`` words that are sums modulo 2^61,
and ``LANES`` lanes that are plain sums.

* A paragraph is what stands between line breaks.  Each adds 61 bits of a seeded hash of the whole
  paragraph to each word.  Words that agree mean equal multisets of paragraphs: 2^k repeats of one
  paragraph cost each word k of its 61 bits and no more.
* A paragraph's pieces are phrases of about three words, cut where the text itself says so, so that an edit moves
  only the cuts beside it: at blanks after punctuation, after a letter outside ASCII or after a word that ends in
  d, r, s, 0 or 5; before each letter of scripts that are written without blanks; and 40 characters after the last
  cut at most.  Each piece adds a 0 or 1 (a hash bit) to each of the 128 lanes.  A lane less half the number of
  pieces is a sum of +-1/2 over the pieces, so the products of two documents' lanes estimate the
  inner product of their counts of pieces, and from it the cosine: that is the likeness (standard error about
  0.09).  Lanes don't wrap, however long the text.

Sums don't depend on order, and ``plus`` and ``minus`` insert and delete paragraphs without the
rest of the text.  Null text counts as empty; the empty text has the zero fingerprint, and two empty
texts have likeness 1.  A very long text is one row's work, without shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DENSE, LANES = 4, 128
MASK = (1 << 61) - 1                                  # a word is a sum modulo 2^61
BIT_OF_4 = sum(1 << 4 * i for i in range(16))         # the lowest bit of each 4-bit field
FIELD_4 = sum(15 << 16 * i for i in range(4))         # the lowest 4-bit field of each 16-bit field
FEW, MANY = 7, 4681                                   # so many ones (sevens) fill a 4-bit (16-bit) field but for its sign
PARAGRAPH_BREAK = "[\\r\\n]+"
PIECE_BREAK = ("[\\r\\n]+|[ \\t](?<=(?:[^a-zA-Z0-9\\s]|[drsDRS05])[ \\t])[ \\t]*"
               "|(?=[\\u0E00-\\u0EFF\\u1000-\\u109F\\u1780-\\u17FF\\u3040-\\u30FF\\u3400-\\u9FFF])|(?<=\\G[^\\r\\n]{40})")
FIELDS = 1 + DENSE + LANES
SALTS = 32   # rows without a doc_id are dealt over so many keys


def of_text(text: Column) -> Column:
    """The fingerprint of a text."""
    text = F.coalesce(text, F.lit(""))
    parts = lambda pattern: F.filter(F.split(text, pattern), lambda x: x != "")
    zero = F.lit(0).cast("long")
    steps = lambda use, by: F.transform(F.array(*[F.lit(by * i) for i in range(4)]), use)
    bind = lambda value, use: F.transform(F.array(value), use)[0]  # noqa: E731  (a lambda's variable is computed once)

    def word(pars: Column, seed: int) -> Column:
        return F.aggregate(pars, zero, lambda a, x: (a + F.xxhash64(F.lit(seed), x).bitwiseAND(F.lit(MASK))).bitwiseAND(F.lit(MASK)))

    def chunks(values: Column, n: int) -> Column:
        count = F.floor((F.size(values) + (n - 1)) / n).cast("int")
        return F.when(count == 0, F.array_repeat(values, 0)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.slice(values, (i - 1) * n + 1, F.lit(n))))

    def fields(values: Column, shift: Column, mask: int) -> Column:
        return F.aggregate(values, zero, lambda a, v: a + F.call_function("shiftrightunsigned", v, shift).bitwiseAND(F.lit(mask)))

    def lanes(pieces: Column, seed: int) -> Column:
        # Bits k, k + 4, .. of up to 7 hashes are added in 4-bit fields, up to 4,681 such sums in 16-bit fields, and these as longs.
        hashes = F.transform(pieces, lambda x: F.xxhash64(F.lit(seed), x))
        fours = bind(hashes, lambda h: bind(chunks(h, FEW), lambda groups: steps(lambda k: F.transform(groups, lambda g: fields(g, k, BIT_OF_4)), 1)))
        wide = lambda groups, j: F.transform(groups, lambda g: fields(g, j, FIELD_4))
        split = lambda words: steps(lambda f: fields(words, f, 65535), 16)
        return F.flatten(F.transform(fours, lambda sums: bind(chunks(sums, MANY), lambda groups: F.flatten(steps(lambda j: bind(wide(groups, j), split), 4)))))

    return bind(F.struct(parts(PARAGRAPH_BREAK).alias("pars"), parts(PIECE_BREAK).alias("pieces")), lambda z: F.concat(
        F.array(F.size(z["pieces"]).cast("long"), *[word(z["pars"], j) for j in range(DENSE)]), lanes(z["pieces"], 101), lanes(z["pieces"], 102)))


def _is_word(i: Column) -> Column:
    return (i > 0) & (i <= DENSE)


def plus(a: Column, b: Column) -> Column:
    """Fingerprint of both texts' paragraphs together."""
    added = F.zip_with(a, b, lambda x, y: x + y)
    return F.transform(added, lambda v, i: F.when(_is_word(i), v.bitwiseAND(F.lit(MASK))).otherwise(v))


def minus(a: Column, b: Column) -> Column:
    """Fingerprint of the first text without the second's paragraphs, which it has."""
    left = F.zip_with(a, b, lambda x, y: x - y)
    return F.transform(left, lambda v, i: F.when(_is_word(i), v.bitwiseAND(F.lit(MASK))).otherwise(v))


def likeness(a: Column, b: Column) -> Column:
    """Estimated cosine of the two texts' counts of pieces, 0 to 1; 1 for equal fingerprints."""

    centred = lambda x: F.transform(F.slice(x, 2 + DENSE, LANES), lambda v: v - x[0] / 2)
    lanes = F.zip_with(centred(a), centred(b), lambda x, y: F.array(x, y))
    sums = F.aggregate(lanes, F.array(*[F.lit(0.0)] * 3), lambda s, x: F.array(s[0] + x[0] * x[1], s[1] + x[0] * x[0], s[2] + x[1] * x[1]))
    cosine = F.transform(F.array(sums), lambda s: F.when(s[1] * s[2] == 0, F.lit(0.0)).otherwise(s[0] / F.sqrt(s[1] * s[2])))[0]
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def as_text(words: Column) -> Column:
    """The fingerprint's fields as lower-case hexadecimal digits with points between them."""
    return F.lower(F.array_join(F.transform(words, lambda w: F.hex(w)), "."))


def _askers(docs: DataFrame) -> DataFrame:
    """For each doc_id the one whose next it is in descending order (null last, the first after the last), and how long that is.

    Only ids and lengths move: they are dealt out by range and frozen, and the ranges' first ids
    (one row each) join them up.
    """
    ids = docs.groupBy("doc_id").agg(F.max(F.length("text")).alias("n")).select(F.struct("doc_id").alias("id"), F.coalesce("n", F.lit(0)).alias("n"))
    ranged = ids.repartitionByRange(F.col("id").desc()).withColumn("range", F.spark_partition_id()).checkpoint()
    firsts = ranged.groupBy("range").agg(F.max("id").alias("first"))
    by_range = Window.orderBy("range")
    top = F.first("first").over(by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = firsts.select("range", F.coalesce(F.lead("first").over(by_range), top).alias("after"))
    inside = F.lead("id").over(Window.partitionBy("range").orderBy(F.col("id").desc()))
    linked = ranged.withColumn("inside", inside).join(F.broadcast(after), "range").withColumn("next", F.coalesce("inside", "after"))
    return linked.select(F.col("next.doc_id").alias("next"), F.col("id.doc_id").alias("asker"), F.col("n").alias("needs"))


def _key(prefix: str, doc_id: Column, salt: Column) -> list[Column]:
    """Three columns that stand for a doc_id or null in joins, null in ``SALTS`` parts."""
    return [F.coalesce(doc_id, F.lit(0)).alias(prefix + "k"), doc_id.isNull().alias(prefix + "z"), F.when(doc_id.isNull(), salt).otherwise(F.lit(0)).alias(prefix + "s")]


def _in_all_parts(rows: DataFrame, prefix: str, doc_id: str) -> DataFrame:
    """The rows with the key of ``doc_id``: one row each, or one in every part where it is null."""
    salted = rows.withColumn("salt", F.explode(F.when(F.col(doc_id).isNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return salted.select("*", *_key(prefix, F.col(doc_id), F.col("salt"))).drop("salt", doc_id)


def with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprint every text of ``docs`` (doc_id, text) and its edited text.

    The edited text replaces the last floor(n/2) characters by the first as many (or all) of the next
    document, in descending doc_id with null last; the last document's next is the first.  Rows that
    share a doc_id have the same next: of several rows with the next id, the smallest text.  An empty
    table gives no rows; only ``doc_id`` and ``text`` are read, whatever other columns exist.

    Texts are shuffled by doc_id once, and at most half of each once more, to the row whose next it is.
    Rows without a doc_id are dealt over ``SALTS`` keys by their text's hash, and the smallest of all parts'
    texts is the next of the one id that asks for it.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    salt = F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int")
    base = docs.select(*_key("", F.col("doc_id"), salt), "text", of_text(F.col("text")).alias("words"))
    earlier = F.lag(F.lit(1)).over(Window.partitionBy("k", "z", "s").orderBy("text"))
    asked = _in_all_parts(_in_all_parts(_askers(docs), "", "next"), "a_", "asker")
    heads = base.withColumn("earlier", earlier).where("earlier IS NULL").join(asked, ["k", "z", "s"]).select(
        "a_k", "a_z", "a_s", F.expr("substring(text, 1, CAST(needs DIV 2 AS INT))").alias("head"), F.col("words").alias("next_words"), F.when(F.col("z"), F.col("text")).alias("rank"))
    smaller = F.lag(F.lit(1)).over(Window.partitionBy("a_k", "a_z", "a_s").orderBy("rank"))
    given = heads.withColumn("smaller", smaller).where("smaller IS NULL")
    both = base.join(given, (F.col("k") == F.col("a_k")) & (F.col("z") == F.col("a_z")) & (F.col("s") == F.col("a_s")))
    edited = both.select(F.when(~F.col("z"), F.col("k")).alias("doc_id"), F.length("text").cast("long").alias("n_chars"), "words", "next_words", F.expr(
        "concat(substring(text, 1, CAST(length(text) - length(text) DIV 2 AS INT)), substring(head, 1, CAST(length(text) DIV 2 AS INT)))").alias("edited"))
    edited = edited.withColumn("edited_words", of_text(F.col("edited")))
    return edited.select("doc_id", "n_chars", "edited", "words", "edited_words", "next_words")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op1 from ``with_edits``."""
    own, new, after = F.col("words"), F.col("edited_words"), F.col("next_words")
    return with_edits(docs).select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(own).alias("fingerprint"),
                                   as_text(new).alias("edited_fingerprint"), likeness(own, new).alias("near_edited"), likeness(own, after).alias("near_next"))
