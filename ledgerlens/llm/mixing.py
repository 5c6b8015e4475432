"""Mixing sources to target weights by Pareto order sampling, in built-in functions only.

Each source gets a share of the mix by its weight, at most ``most`` copies of itself; what is over
goes to the others by weight.  A source's documents are all copied as often as the target holds the
whole source (certain copies).  The rest of the target, in words, is a sample without repeats:

* Inclusion probabilities p grow with the square root of a document's size (by octaves of size), are 1 at
  most, and make the expected words of the sample the wanted words.  Documents longer than all that is
  wanted have none.
* A document's rank is the odds of its random number divided by the odds of p; documents with p = 1 come
  first.  In order of rank, each document that still fits what is left of the wanted words is taken.
* At last the shortest document left is taken too, if the words then come nearer to the target.

So a source misses its target by at most half the shortest document left, whatever its longest is.  The
random number comes from a hash of doc_id, size and a number among equal rows, so reruns agree.

Scale: only ids, sizes and ranks move.  Taking what fits goes in rounds: a round takes everything up to the
first document that is too long, which a histogram of ``BINS`` bins of the rank finds for each source, with
only that bin put in order; the next round goes on with documents that fit the words left, few enough to
end after some rounds.  A source with a third of all rows is summed in parts everywhere.  A round's outcome
is one row for each source, and a document is taken if one of its source's rounds reaches it.

Null text has size 0; documents of size 0 are taken 0 words of.  Null sources are one source, last in
order.  Rows that share a doc_id have random numbers of their own; equal rows are counted first and numbered,
so any number of them is dealt out evenly; each is a document.  An empty table gives no rows.  Only
``doc_id``, ``source`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import running_totals, stored

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)       # of all words, as a fraction
MOST = 2             # copies of a document
BINS = 1 << 12
ALIKE = 100_000      # equal rows that a task numbers at once
SEED = 17
WORD = "[^\\x20\\x09-\\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and number of words of each row."""
    words = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0)))
    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words.cast("long").alias("size")), "sizes")


def targets(by_source: DataFrame, weights=WEIGHTS, share=SHARE, most: int = MOST) -> DataFrame:
    """``by_source`` (source, source_size) with ``target``; sources in order of their code points, null last, take the weights in turn.

    A source is full if the words for each unit of weight, were all sources no sooner full to share
    what is left, are at least what it can take: so sources are put in order of that, and filled as long as it holds.
    """
    ordered = running_totals(by_source.withColumn("one", F.lit(1).cast("long")), [F.col("source").asc_nulls_last()], ["one"])
    turn = (F.col("before_one") % len(weights)).cast("int")
    rows = ordered.select("source", "source_size", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn + 1).alias("weight"))
    rows = rows.withColumn("room", F.col("source_size") * most)
    fill = (F.col("room") / F.col("weight")).alias("fill")
    rows = running_totals(rows.select("*", fill), [F.col("fill").asc(), F.col("source").asc_nulls_last()], ["room", "weight"])
    whole = rows.agg((F.sum("source_size") * share[0] / share[1]).alias("whole"), F.sum("weight").alias("all_weight"))
    rows = rows.crossJoin(F.broadcast(whole))  # one row
    level = (F.col("whole") - F.col("before_room")) / (F.col("all_weight") - F.col("before_weight"))
    rows = rows.withColumn("full", F.col("fill") <= level)
    left = rows.agg(F.coalesce(F.sum(F.when(F.col("full"), F.col("room"))), F.lit(0)).alias("used"), F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0)).alias("open"))
    rows = rows.crossJoin(F.broadcast(left))  # one row
    target = F.when(F.col("full"), F.col("room").cast("double")).otherwise((F.col("whole") - F.col("used")) * F.col("weight") / F.col("open"))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def _random(seed: int) -> Column:
    """Uniform in (0, 1), from 52 bits of a hash of the doc_id, the size and the number among equal rows."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "size", "again")
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, source, size) with ``again``, a number from 0 among equal rows: counted, then dealt out in parts."""
    counted = rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    parts = counted.select("doc_id", "source", "size", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / ALIKE))).alias("part"))
    dealt = parts.repartition("doc_id", "source", "size", "part")
    upto = F.least(F.col("n"), (F.col("part") + 1) * ALIKE) - 1
    return dealt.select("doc_id", "source", "size", F.explode(F.sequence(F.col("part") * ALIKE, upto)).alias("again"))


def _octave(size: Column) -> Column:
    return F.length(F.bin(size))


def _growth(octave: Column) -> Column:
    """What inclusion probabilities are in proportion to: about the square root of the size, as an integer."""
    return F.floor(F.pow(F.lit(2.0), octave / 2.0) * 1000).cast("decimal(38,0)")


def inclusion(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """of, octave, p: the inclusion probability for each source (``of``) and octave of size.

    The octaves from some size on are certain (p = 1), and the others share what is left of the wanted
    words in proportion to their growth: the longest octave that needn't be certain is looked for.
    """
    sized = rows.join(goal, F.col("source").eqNullSafe(F.col("of"))).where("size > 0 AND size <= wanted")
    by = sized.groupBy("of", _octave(F.col("size")).alias("octave")).agg(F.sum("size").alias("words"), F.first("wanted").alias("wanted"))
    by = by.withColumn("growth", _growth(F.col("octave")))
    longer = Window.partitionBy("of").orderBy(F.desc("octave")).rowsBetween(Window.unboundedPreceding, -1)  # a row for each octave: 63 at most
    upto = Window.partitionBy("of").orderBy("octave").rowsBetween(Window.unboundedPreceding, 0)
    share = (F.col("wanted") - F.col("sure").cast("double")) / F.col("rest").cast("double")
    by = by.withColumn("sure", F.coalesce(F.sum("words").over(longer), F.lit(0))).withColumn("rest", F.sum(F.col("growth") * F.col("words")).over(upto)).withColumn("share", share)
    fits = by.withColumn("open", (F.col("share") * F.col("growth").cast("double") < 1) & (F.col("share") >= 0))
    cut = Window.partitionBy("of")
    fits = fits.withColumn("best", F.max(F.when(F.col("open"), F.struct("octave", "share"))).over(cut))
    p = F.when(F.col("best").isNull() | (F.col("octave") > F.col("best.octave")), 1.0).otherwise(F.col("best.share") * F.col("growth").cast("double"))
    return stored(fits.select("of", "octave", p.alias("p")), "inclusion")


#: The place of a document in its source's order.
PLACE = ("o", "unnamed", "named", "size", "again")


def ranked(rows: DataFrame, goal: DataFrame, seed: int) -> DataFrame:
    """``rows`` with their source's goal, ``o`` (the order, from -1 to 1) and ``place``."""
    odds = inclusion(rows, goal).withColumnRenamed("of", "source_of")
    rows = rows.join(goal, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = rows.join(odds, F.col("source").eqNullSafe(F.col("source_of")) & (_octave(F.col("size")) == F.col("octave")), "left").drop("source_of", "octave")
    rows = rows.withColumn("u", _random(seed))
    rank = F.col("u") / (1 - F.col("u")) * (1 - F.col("p")) / F.col("p")
    rows = rows.withColumn("o", F.when(F.col("p") >= 1, F.col("u") - 1).when(F.col("p") > 0, rank / (1 + rank)).otherwise(1.0))  # 1: no chance
    rows = rows.withColumn("unnamed", F.col("doc_id").isNull()).withColumn("named", F.coalesce("doc_id", F.lit(0)))
    return stored(rows.drop("u", "p").withColumn("place", F.struct(*PLACE)).drop("unnamed", "named"), "ranked")


def rounds(rows: DataFrame, goal: DataFrame, most: int = 100) -> DataFrame:
    """of, steps, left: for each source the rounds (words left before, place of the first document too long, or null) and the words left at last."""
    kind = f"{rows.schema['place'].dataType.simpleString()}"
    state = goal.select("of", F.col("wanted").alias("left"), F.lit(None).cast(kind).alias("after"), F.expr(f"cast(array() AS array<struct<had:double,stop:{kind}>>)").alias("steps"), F.lit(True).alias("goes_on"))
    state = stored(state, "round")
    for _ in range(most):
        fits = rows.join(state.where("goes_on").drop("steps", "goes_on"), F.col("source").eqNullSafe(F.col("of"))).where((F.col("size") > 0) & (F.col("size") <= F.col("left")) & (F.col("o") < 1))
        fits = fits.where(F.col("after").isNull() | (F.col("place") > F.col("after"))).withColumn("bin", F.floor(F.col("o") * BINS)).select("of", "left", "bin", "size", "place")
        upto = Window.partitionBy("of").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = fits.groupBy("of", "bin").agg(F.sum("size").alias("in_bin"), F.first("left").alias("left")).withColumn("before", F.coalesce(F.sum("in_bin").over(upto), F.lit(0)))
        whole = bins.groupBy("of").agg(F.sum("in_bin").alias("all"))
        cut = bins.where("before <= left AND before + in_bin > left").select(F.col("of").alias("cut_of"), F.col("bin").alias("cut_bin"), "before")
        cut = stored(cut, "cuts")
        inside = Window.partitionBy("of").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        edge = fits.join(cut, F.col("of").eqNullSafe(F.col("cut_of")) & (F.col("bin") == F.col("cut_bin")))
        edge = edge.withColumn("ahead", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        stop = edge.where("ahead + size > left").groupBy("of").agg(F.min("place").alias("stop"), F.min("ahead").alias("ahead"))
        stop, whole = stop.withColumnRenamed("of", "stop_of"), whole.withColumnRenamed("of", "all_of")
        state = state.join(whole, F.col("of").eqNullSafe(F.col("all_of")), "left").join(stop, F.col("of").eqNullSafe(F.col("stop_of")), "left")
        had = F.struct(F.col("left").alias("had"), F.col("stop"))
        steps = F.when(F.col("all").isNull(), F.col("steps")).otherwise(F.concat("steps", F.array(had)))
        left = F.col("left") - F.coalesce(F.when(F.col("stop").isNotNull(), F.col("ahead")).otherwise(F.col("all")), F.lit(0))
        state = stored(state.select("of", left.alias("left"), F.coalesce("stop", "after").alias("after"), steps.alias("steps"), F.col("stop").isNotNull().alias("goes_on")), "round")
        if state.where("goes_on").isEmpty():
            return state.select("of", "steps", "left")
    raise RuntimeError(f"no end after {most} rounds")


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target (its source's) and copies of each row of ``docs``."""
    rows = sizes(docs)
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("certain", whole).withColumn("wanted", F.col("target") - F.col("certain") * F.col("source_size"))
    # As files, tables with a row for each source have a known size: Spark broadcasts them while they are small.
    goal = stored(goal.select(F.col("source").alias("of"), "source_size", "target", "certain", "wanted"), "targets")
    rows = ranked(numbered(rows), goal, seed)
    rows = rows.join(rounds(rows, goal), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    reached = F.exists("steps", lambda x: (F.col("size") <= x["had"]) & (x["stop"].isNull() | (F.col("place") < x["stop"])))
    rows = stored(rows.withColumn("chosen", (F.col("size") > 0) & (F.col("o") < 1) & reached).drop("steps"), "chosen")
    # The shortest document left, if it brings the words nearer.
    last = rows.where("size > 0 AND NOT chosen").groupBy("source").agg(F.min(F.struct("size", "place")).alias("x"), F.first("left").alias("words"))
    last = stored(last.where("x.size < 2 * words").select(F.col("source").alias("of"), F.col("x.place").alias("extra")), "extra")
    rows = rows.join(last, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    chosen = F.col("chosen") | F.coalesce(F.col("place") == F.col("extra"), F.lit(False))
    copies = F.when(F.col("size") == 0, 0).otherwise(F.col("certain") + chosen.cast("long"))
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op6."""
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (its columns only).

    Copies are looked up by (doc_id, source, size).  Rows that share all three share their copies: of n such rows
    the first ones by a hash of the text (equal texts in any order) are taken once more than the others.
    """
    key = ["z", "k", "s", "n"]
    words = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))).cast("long")

    def keyed(df: DataFrame, *columns: Column, size: Column) -> DataFrame:
        return df.select(*columns, F.col("doc_id").isNull().alias("z"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("k"),
                         F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("s"), size.alias("n"))

    taken = keyed(mix(docs, **options), F.col("copies"), size=F.col("size"))
    taken = taken.groupBy(*key).agg(F.count("*").alias("alike"), F.min("copies").alias("least"), F.sum("copies").alias("copies"))
    taken = taken.withColumn("more", F.col("copies") - F.col("alike") * F.col("least")).where("copies > 0").drop("copies")
    rows = keyed(docs, F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("tie"), size=words).join(taken, key)
    repeat = lambda df, copies: df.withColumn("copy", F.explode(F.sequence(F.lit(1), copies.cast("int")))).select("row.*")
    sure = rows.where("more = 0 OR alike = 1")
    open_ = rows.where("more > 0 AND alike > 1").withColumn("one", F.lit(1).cast("long")).withColumn("spread", F.monotonically_increasing_id())
    open_ = running_totals(open_, [F.col(c) for c in (*key, "tie", "spread")], ["one"])
    # The place of a key's first row: a row for each key that several rows share.
    first = stored(open_.groupBy(*key).agg(F.min("before_one").alias("first")), "first-places")
    open_ = open_.join(first, key)
    copies = F.col("least") + (F.col("before_one") - F.col("first") < F.col("more")).cast("long")
    open_ = open_.withColumn("copies", copies).where("copies > 0")
    return repeat(sure, F.col("least") + F.col("more")).unionByName(repeat(open_, F.col("copies")))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 2 * source_size AS room,
             CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
-- The words for each unit of weight: the largest level at which what the sources take is no more than all.
c AS (SELECT a.source, a.room / a.weight AS fill, (SELECT sum(least(b.room, b.weight * (a.room / a.weight))) FROM w b) AS taken FROM w a),
t AS (SELECT CAST(sum(source_size) AS DOUBLE) * 3 / 2 AS whole FROM w),
f AS (SELECT w.*, c.taken <= t.whole AS is_full FROM w JOIN c ON w.source IS NOT DISTINCT FROM c.source, t),
g AS (SELECT source, source_size, CASE WHEN is_full THEN CAST(room AS DOUBLE) ELSE
             ((SELECT whole FROM t) - (SELECT coalesce(sum(room), 0) FROM f WHERE is_full)) * weight / (SELECT sum(weight) FROM f WHERE NOT is_full) END AS target FROM f),
h AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS certain FROM g),
-- The contract's mix document by document: down the ranks, each that still fits what is left.
n AS (SELECT doc_id, d.source, size, source_size, target, certain, target - certain * source_size AS wanted, row_number() OVER (PARTITION BY doc_id, d.source, size) - 1 AS again,
             dense_rank() OVER (ORDER BY d.source) AS sn FROM d JOIN h ON d.source IS NOT DISTINCT FROM h.source),
m AS (SELECT *, (CAST(('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || size || ':' || again), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0 AS u, length(bin(size)) AS octave FROM n),
e AS (SELECT sn, octave, CAST(sum(size) AS HUGEINT) AS words, any_value(wanted) AS wanted, CAST(floor(pow(2.0, octave / 2.0) * 1000) AS HUGEINT) AS growth FROM m WHERE size > 0 AND size <= wanted GROUP BY sn, octave),
l AS (SELECT sn, octave, growth, (wanted - (SELECT coalesce(sum(words), 0) FROM e b WHERE b.sn = a.sn AND b.octave > a.octave))
             / CAST((SELECT sum(growth * words) FROM e b WHERE b.sn = a.sn AND b.octave <= a.octave) AS DOUBLE) AS part FROM e a),
z AS (SELECT sn, max(octave) AS top, arg_max(part, octave) AS part FROM l WHERE part * growth < 1 AND part >= 0 GROUP BY sn),
p AS (SELECT l.sn, l.octave, CASE WHEN z.top IS NULL OR l.octave > z.top THEN 1.0::DOUBLE ELSE z.part * l.growth END AS p FROM l LEFT JOIN z ON l.sn = z.sn),
q AS (SELECT m.*, CASE WHEN p.p >= 1 THEN u - 1 WHEN p.p > 0 THEN (u / (1 - u) * (1 - p.p) / p.p) / (1 + (u / (1 - u) * (1 - p.p) / p.p)) ELSE 1.0 END AS o FROM m LEFT JOIN p ON p.sn = m.sn AND p.octave = m.octave),
o AS (SELECT *, row_number() OVER (PARTITION BY sn ORDER BY o, doc_id NULLS LAST, size, again) AS place FROM q WHERE size > 0 AND o < 1),
walk AS (SELECT sn, CAST(0 AS BIGINT) AS place, any_value(wanted) AS words, false AS took FROM m GROUP BY sn
         UNION ALL SELECT w.sn, o.place, CASE WHEN o.size <= w.words THEN w.words - o.size ELSE w.words END, o.size <= w.words FROM walk w JOIN o ON o.sn = w.sn AND o.place = w.place + 1),
f2 AS (SELECT sn, arg_max(words, place) AS words FROM walk GROUP BY sn),
x AS (SELECT q.*, coalesce(w.took, false) AS took, f2.words FROM q JOIN f2 ON f2.sn = q.sn LEFT JOIN o ON o.sn = q.sn AND o.doc_id IS NOT DISTINCT FROM q.doc_id AND o.size = q.size AND o.again = q.again
      LEFT JOIN walk w ON w.sn = o.sn AND w.place = o.place),
y AS (SELECT *, CASE WHEN size > 0 AND NOT took THEN row_number() OVER (PARTITION BY sn, took, size > 0 ORDER BY size, o, doc_id NULLS LAST, again) END AS shortest FROM x)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size = 0 THEN 0 ELSE size * (certain + CASE WHEN took OR shortest = 1 AND size < 2 * words THEN 1 ELSE 0 END) END AS BIGINT) AS taken FROM y
"""
