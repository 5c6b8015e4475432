"""Source divergence audit by three-dimensional cube partitioning.

Within a language, how far do the sources' vocabularies lie apart, and which terms set a source apart from
its language?  Counts of kept terms become smoothed integer shares p, and a term's divergence is the
triangular discrimination floor((p - q)^2 / (p + q)).  All arithmetic is in integers, so any order of
summing gives the same result.

* Terms are counted in each task over all its texts before anything is shuffled, so a hot source sends
  about as much as its vocabulary for each task.
* The cube: a language's groups are dealt into blocks of ``GROUP_BLOCK`` and its kept terms into blocks of
  ``TERM_BLOCK``, both by hash.  A slice (group block, term block) is replicated to the cells (group block,
  group block, term block) that need it, once for each other group block.  A task owns a cell, puts its two
  slices as matrices side by side and sums the divergences of its pairs over its terms; on the diagonal
  it also finds the best terms of each group against the language.  A cell's size does not grow with the input.
* Partial sums of a pair meet along the term axis in a grouped sum, the best terms of the cells in a
  ranking of ten from each.

Terms that a cell's groups don't have count too (a share of the smoothing alone): both absent, they add
a product.  Null text, lang and source are ''.  Texts without terms make groups without counts; a language
without kept terms has pairs of value 0.  Ties in value go by the item's UTF-8 bytes.  Repeated rows count
each; very long texts are read in pieces.  An empty table gives no rows.  Only ``text``, ``lang`` and
``source`` are read, whatever other columns exist.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_arrow, ship, stored

LEAST_DOCS = 10       # of its language, for a term to be kept
SMOOTHING = 2
GROUP_BLOCK = 16
TERM_BLOCK = 4096
TOP = 10
PIECE = 1 << 20
#: Counters of a task are handed on when they hold so many terms.
HELD = 200_000
COUNTS = "lang string, source string, term string, n long, docs long"
CELL = "lang string, a string, b string, part string, item string, value long"
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^a-z\x80-\xff]")


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in lists: runs of ASCII letters (in lower case) and of what is beyond ASCII."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):  # not within a term
            cut = _BREAK.search(text[end:end + PIECE].lower())
            while cut is None and end < len(text):
                end += PIECE
                cut = _BREAK.search(text[end:end + PIECE].lower())
            end += cut.start() if cut else 0
        yield _TERM.findall(text[at:end].lower())
        at = end


def counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it) over all of ``docs``."""

    def out(held):
        rows = [(lang, source, term, n, found[1][term]) for (lang, source), found in held.items() for term, n in found[0].items()]
        columns = list(zip(*rows)) if rows else [[]] * 5
        yield from pa.Table.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.binary()).cast(pa.string(), safe=False),
                                         pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())], names=["lang", "source", "term", "n", "docs"]).to_batches(max_chunksize=20_000)

    def work(batches):
        held, size = {}, 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if not text.is_valid:
                    continue
                n, docs_with = held.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(n), set()
                for part in terms(text.as_py()):
                    n.update(part)
                    own.update(part)
                docs_with.update(own)
                size += len(n) - before
            if size > HELD:
                yield from out(held)
                held, size = {}, 0
        yield from out(held)

    rows = docs.select(_named("lang").alias("lang"), _named("source").alias("source"), F.col("text").cast("string").cast("binary").alias("text"))
    return map_arrow(rows, work, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _named(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shares(count: np.ndarray, total) -> np.ndarray:
    """1 + floor(10^9 * (count + SMOOTHING) / total), exact for totals below 10^15: a long division, three digits at a time."""
    left = np.asarray(count, np.int64) + SMOOTHING
    total = np.asarray(total, np.int64)
    out = left // total
    left = left % total
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // total
        left = left % total
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def cell(table: pa.Table) -> pa.Table:
    """Partial divergences of the pairs of a cell, and on the diagonal the best terms of each group.

    Rows without a term name the groups of the two blocks; the others are their counts.
    """
    named = table.filter(pc.is_null(table.column("term")))
    found = table.filter(pc.is_valid(table.column("term")))
    gi, gj = table.column("gi")[0].as_py(), table.column("gj")[0].as_py()
    lang, kept = table.column("lang")[0].as_py(), named.column("in_block")[0].as_py()
    source, block = named.column("source").to_pylist(), named.column("g").to_numpy()
    order = {s: k for k, s in enumerate(source)}
    total = named.column("total").to_numpy() + SMOOTHING * named.column("n_kept").to_numpy()
    words = pc.dictionary_encode(found.column("term").combine_chunks()) if found.num_rows else None
    names = words.dictionary if words is not None else pa.array([], pa.string())
    column = words.indices.to_numpy() if words is not None else np.zeros(0, np.int64)
    row = np.array([order[s] for s in found.column("source").to_pylist()], np.int64)
    n = np.zeros((len(source), len(names)), np.int64)
    n[row, column] = found.column("n").to_numpy()
    safe = np.maximum(total, 1)
    p, none = shares(n, safe[:, None]), shares(np.zeros(len(source), np.int64), safe)
    out = []
    for x in np.flatnonzero(block == gi).tolist():
        others = np.flatnonzero(block == gj)
        others = others[others > x] if gi == gj else others
        if len(others):
            value = apart(p[x], p[others]).sum(1) + (kept - len(names)) * apart(none[x], none[others])
            out += [(lang, *sorted((source[x], source[y]), key=str.encode), "pair", None, int(v)) for y, v in zip(others.tolist(), value)]
    if gi == gj and len(names):
        whole = np.zeros(len(names), np.int64)
        whole[column] = found.column("lang_n").to_numpy()
        q = shares(whole, named.column("lang_total").to_numpy()[0] + SMOOTHING * named.column("n_kept").to_numpy()[0])
        text = names.to_pylist()
        for x in range(len(source)):
            wanted = np.flatnonzero((n[x] > 0) & (p[x] > q))
            value = apart(p[x, wanted], q[wanted])
            if len(wanted) > TOP:  # ties with the last stay
                stay = value >= np.partition(value, -TOP)[-TOP]
                wanted, value = wanted[stay], value[stay]
            best = sorted(zip((-value).tolist(), (text[k].encode() for k in wanted.tolist())))[:TOP]
            out += [(lang, source[x], None, "term", word.decode(), -v) for v, word in best]
    columns = list(zip(*out)) if out else [[]] * 6
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.string()] * 5 + [pa.int64()])], names=["lang", "a", "b", "part", "item", "value"])


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """lang, source, part, item, value, rank: the other sources by divergence, and the ten terms that set the source most apart."""
    spark = docs.sparkSession
    found = stored(counts(docs), "term-counts")
    groups = docs.select(_named("lang").alias("lang"), _named("source").alias("source")).distinct()
    kept = found.groupBy("lang", "term").agg(F.sum("docs").alias("df"), F.sum("n").alias("lang_n")).where(F.col("df") >= least_docs).drop("df")
    by_lang = kept.groupBy("lang").agg(F.count("*").alias("n_kept"), F.sum("lang_n").alias("lang_total"))
    by_lang = groups.groupBy("lang").agg(F.count("*").alias("n_groups")).join(by_lang, "lang", "left").fillna(0, ["n_kept", "lang_total"])
    many = lambda n, size: F.greatest(F.ceil(F.col(n) / size), F.lit(1)).cast("int")
    by_lang = stored(by_lang.select("*", many("n_groups", group_block).alias("g_blocks"), many("n_kept", term_block).alias("t_blocks")), "languages")
    dealt = lambda c, n: F.pmod(F.xxhash64(F.lit(11), c), F.col(n)).cast("int")
    kept = kept.join(by_lang.select("lang", "t_blocks"), "lang").select("lang", "term", "lang_n", dealt("term", "t_blocks").alias("t"))
    entries = stored(found.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n", "t"), "kept-counts")
    in_block = entries.groupBy("lang", "t").agg(F.count_distinct("term").alias("in_block"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(by_lang, "lang").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), "n_kept", "lang_total",
                                                                                         dealt("source", "g_blocks").alias("g"), "g_blocks", "t_blocks")
    # A slice's groups by name in every term block, then its counts.
    named = groups.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("t_blocks") - 1))).join(in_block, ["lang", "t"], "left").select(
        "lang", "source", "g", "g_blocks", "t", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("lang_n"),
        F.coalesce("in_block", F.lit(0)).cast("long").alias("in_block"), "total", "n_kept", "lang_total")
    nothing = [F.lit(0).cast("long").alias(c) for c in ("in_block", "total", "n_kept", "lang_total")]
    sliced = entries.join(by_lang.select("lang", "g_blocks"), "lang").select("lang", "source", dealt("source", "g_blocks").alias("g"), "g_blocks", "t", "term", "n", "lang_n", *nothing)
    cells = named.unionByName(sliced).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("g_blocks") - 1)))
    cells = cells.select("lang", F.least("g", "x").alias("gi"), F.greatest("g", "x").alias("gj"), "t", "g", "source", "term", "n", "lang_n", "in_block", "total", "n_kept", "lang_total")
    ship(spark)
    partial = stored(cells.groupBy("lang", "gi", "gj", "t").applyInArrow(cell, CELL), "cells")
    pairs = partial.where("part = 'pair'").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = pairs.select("lang", both.alias("x"), F.lit("pair").alias("part"), "value").select("lang", "x.source", "part", "x.item", "value")
    best = partial.where("part = 'term'").select("lang", F.col("a").alias("source"), "part", "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(top)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
g AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
k AS (SELECT lang, term FROM d GROUP BY ALL HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM d SEMI JOIN k USING (lang, term) GROUP BY ALL),
t AS (SELECT g.lang, g.source, coalesce((SELECT sum(n) FROM c WHERE c.lang = g.lang AND c.source = g.source), 0) + 2 * v AS total FROM g JOIN v USING (lang)),
p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 2) // t.total AS p
      FROM t JOIN k USING (lang) LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
l AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
q AS (SELECT lang, term, 1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q FROM l JOIN v USING (lang)),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(pair.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
best AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
u AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM best)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM u QUALIFY part = 'pair' OR rank <= 10
"""
