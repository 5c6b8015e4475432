"""SimHash near-duplicates with pivot distance tables.

A fingerprint has a bit set if it is set in over half of the hashes of the text's word shingles.
Equal fingerprints are grouped first.  Each distinct one gets its row of the pivot distance table:
its Hamming distances to ``PIVOTS`` reference fingerprints, taken segment by segment.

* Two fingerprints within ``max_bits`` agree on all but ``max_bits`` of ``max_bits + 3`` segments, so
  their partial distances to every pivot are equal there.  The vectors of partial distances of each
  choice of three segments are the keys under which pairs are looked for; all others are discarded.
* Under a key, a pair is discarded if any of its whole distances to the pivots differ by more than
  ``max_bits`` (the triangle inequality), and the survivors are verified bit by bit.

Under a key a task links the members into a forest (at most one edge a member), never into all
pairs.  A key with more than ``hot`` members isn't held in a task: its members go to an exact other
way, in which each is sent to all fingerprints within half the distance, and meets there the others
that are near enough.  Components come from the links.

Null, empty and white-space texts have fingerprint zero and link like any other; a text with fewer
words than a shingle is one shingle.  Long texts are hashed in blocks.  Repeated rows are rows of
the result each; a null doc_id takes part, but names a component only (as null) if it has no other.
Only ``doc_id`` and ``text`` are read, whatever other columns exist.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_arrow, stored
from ledgerlens.llm.components import components

SEED = 42
PIVOTS = 16
HOT = 4096
BLOCK = 1 << 20
ONES = np.uint64(0x0101010101010101)


def word_blocks(text: str) -> Iterator[list[bytes]]:
    """The words of a text (ASCII letters lower-cased), in blocks that end between words."""
    data = text.encode("utf-8", "surrogatepass").lower()
    if len(data) <= BLOCK:
        yield data.split()
        return
    rest = b""
    for at in range(0, len(data), BLOCK):
        part = rest + data[at:at + BLOCK]
        end = max(part.rfind(bytes([c])) for c in b" \t\n\r\x0b\x0c") if at + BLOCK < len(data) else len(part)
        rest = part[end:] if end >= 0 else part
        if end > 0:
            yield part[:end].split()


def shingle_hashes(words: list[bytes], n: int) -> np.ndarray:
    """XXH64 of all runs of ``n`` words, joined by a blank."""
    joined, length = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start = (end - length)[:len(words) - n + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start, end[n - 1:].tolist())), np.uint64, len(start))


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set; sums of up to 255 run in bytes side by side."""
    spread = (hashes[:, None] >> np.arange(8, dtype=np.uint64)) & ONES
    sums = np.add.reduceat(spread, np.arange(0, len(hashes), 255), axis=0)
    return sums.view(np.uint8).reshape(-1, 8, 8).sum(0, dtype=np.int64).T.reshape(64)


def fingerprint(text: str | None, n: int) -> int:
    counts, total, held, few = np.zeros(64, np.int64), 0, [], []
    for words in word_blocks(text or ""):
        words = held + words
        if len(words) >= n:
            hashes = shingle_hashes(words, n)
            counts += bit_counts(hashes)
            total += len(hashes)
            held = words[len(words) - n + 1:]
        else:
            held = few = words
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(few), SEED) if few else 0
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, tie (a hash of the text that tells rows with the same doc_id apart), fp (the bits as a signed long)."""

    def work(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found.view(np.int64))], names=["doc_id", "tie", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    return stored(map_arrow(rows, work, "doc_id long, tie long, fp long"), "simhash")


class PivotTable:
    """Distances to the reference fingerprints, whole and by segment."""

    def __init__(self, max_bits: int):
        rng = np.random.Generator(np.random.PCG64(64))
        self.pivots = rng.integers(0, 1 << 64, PIVOTS, dtype=np.uint64)
        self.weights = rng.integers(0, 1 << 63, (max_bits + 3, PIVOTS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        edges = np.linspace(0, 64, max_bits + 4).astype(int)
        self.masks = [sum(1 << b for b in range(x, y)) for x, y in zip(edges[:-1], edges[1:])]
        self.choices = list(combinations(range(max_bits + 3), 3))
        self.max_bits = max_bits

    def distances(self, fp: np.ndarray) -> np.ndarray:
        return np.bitwise_count(fp[:, None] ^ self.pivots).astype(np.int8)

    def keys(self, fp: np.ndarray) -> np.ndarray:
        """A key for each choice of segments: a hash of the partial distances to all pivots."""
        apart = fp[:, None] ^ self.pivots
        codes = [(np.bitwise_count(apart & np.uint64(m)).astype(np.uint64) * w).sum(1, dtype=np.uint64) for m, w in zip(self.masks, self.weights)]
        out = np.empty((len(fp), len(self.choices)), np.uint64)
        for c, three in enumerate(self.choices):
            key = np.full(len(fp), c, np.uint64)
            for s in three:
                key = (key ^ codes[s]) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(32)
            out[:, c] = key
        return out

    def near(self, fp: np.ndarray, table: np.ndarray, one: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` (positions) are within the distance of the one at ``one``."""
        apart = np.abs(table[others] - table[one]).max(1)
        left = np.flatnonzero(apart <= self.max_bits)
        return left[np.bitwise_count(fp[others[left]] ^ fp[one]) <= self.max_bits]

    def forest(self, fp: np.ndarray) -> Iterator[tuple[int, int]]:
        """Edges that connect what the links between the members connect."""
        table, todo = self.distances(fp), np.arange(len(fp))
        while len(todo):
            reached, todo = [int(todo[0])], todo[1:]
            while reached and len(todo):
                x = reached.pop()
                hit = self.near(fp, table, x, todo)
                if len(hit):
                    new = todo[hit]
                    todo = np.delete(todo, hit)
                    reached += new.tolist()
                    yield from ((x, y) for y in new.tolist())


def links(distinct: DataFrame, max_bits: int = 3, hot: int = HOT) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp) that connect all that lie within ``max_bits`` of each other."""
    pivots = PivotTable(max_bits)
    columns = ["choice", "a", "b"]

    def spread(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            keys = pivots.keys(fp.view(np.uint64))
            n = keys.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.tile(np.arange(n, dtype=np.int32), len(fp))), pa.array(np.repeat(fp, n))],
                                             names=["key", "choice", "fp"])

    def out(rows):
        choice, a, b = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(choice, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=columns)

    def match(batches):
        """Rows come sorted by key; the last key of a batch may go on in the next."""
        held, key_now, over = np.zeros((0, 2), np.int64), None, False
        for batch in _and_end(batches):
            if batch is None:
                key, body, done = np.zeros(0, np.int64), np.zeros((0, 2), np.int64), True
            else:
                key = batch.column(0).to_numpy()
                body, done = np.stack([batch.column(1).to_numpy().astype(np.int64), batch.column(2).to_numpy()], 1), False
            rows = []
            if len(key):
                starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                ends = np.append(starts[1:], len(key))
            else:
                starts = ends = np.zeros(0, np.int64)
            if len(starts) and key_now is not None and key[0] == key_now:
                held = np.concatenate([held, body[:ends[0]]])
                starts, ends = starts[1:], ends[1:]
            if over or len(held) > hot:  # too many for a task: on to the other way, as they come
                rows += [(int(c), int(f), None) for c, f in held]
                held, over = held[:0], True
            if len(starts) or done:
                rows += _linked(held)
                over = False
                sizes = (ends - starts)[:-1] if not done else ends - starts
                inner, last = starts[:len(sizes)], None if done or not len(starts) else (starts[-1], ends[-1])
                two = inner[sizes == 2]
                rows += _pairs(body, two)
                for s, n in zip(inner[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                    rows += _linked(body[s:s + n]) if n <= hot else [(int(c), int(f), None) for c, f in body[s:s + n]]
                held, key_now = (body[last[0]:last[1]], key[last[0]]) if last else (held[:0], None)
            if rows:
                yield out(rows)

    def _and_end(batches):
        yield from batches
        yield None

    def _linked(body):
        fp = body[:, 1]
        return [(None, int(fp[x]), int(fp[y])) for x, y in pivots.forest(fp.view(np.uint64))] if len(body) > 1 else []

    def _pairs(body, at):
        x, y = body[at, 1], body[at + 1, 1]
        u, v = x.view(np.uint64), y.view(np.uint64)
        near = np.abs(pivots.distances(u) - pivots.distances(v)).max(1, initial=0) <= max_bits
        near[near] = np.bitwise_count(u[near] ^ v[near]) <= max_bits
        return [(None, a, b) for a, b in zip(x[near].tolist(), y[near].tolist())]

    keyed = map_arrow(distinct.select("fp"), spread, "key long, choice int, fp long")
    n = max(8, int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = stored(map_arrow(keyed.repartition(n, "key").sortWithinPartitions("key"), match, "choice int, a long, b long"), "links")
    return found.where("b IS NOT NULL").select("a", "b").unionByName(_hot_links(found.where("b IS NULL").select("choice", F.col("a").alias("fp")), pivots))


def _hot_links(members: DataFrame, pivots: PivotTable) -> DataFrame:
    """Links among members of hot keys, by meeting places instead of comparisons.

    Members of a key may differ in the bits outside its segments only.  Each goes to every place that
    differs from it in at most half of ``max_bits`` of those bits, rounded up.  Two that meet, one of them
    within the half rounded down, are near; any two that are near meet so.
    """
    most, center = (pivots.max_bits + 1) // 2, pivots.max_bits // 2
    flips = []
    for c, three in enumerate(pivots.choices):
        fixed = sum(pivots.masks[s] for s in three)
        free = [b for b in range(64) if not fixed >> b & 1]
        for r in range(most + 1):
            flips += [(c, int(np.uint64(sum(1 << b for b in bits)).view(np.int64)), r) for bits in combinations(free, r)]
    # A table of fixed size: 20 choices of about 560 flips for a distance of 3.
    flips = members.sparkSession.createDataFrame(flips, "choice int, flip long, r int")
    places = members.distinct().join(F.broadcast(flips), "choice").select(F.col("fp").bitwiseXOR(F.col("flip")).alias("place"), "r", "fp")
    # No more than some thousands of fingerprints lie that near to a place.
    met = places.groupBy("place").agg(F.min(F.struct("r", "fp")).alias("m"), F.collect_set("fp").alias("others")).where((F.col("m.r") <= center) & (F.size("others") > 1))
    return met.select(F.col("m.fp").alias("a"), F.explode("others").alias("b")).where("a <> b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, hot: int = HOT) -> DataFrame:
    """Group all documents: doc_id, tie, fp, label (the group), component_id (its smallest doc_id)."""
    rows = fingerprints(docs, shingle)
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    stars = components(links(distinct, max_bits, hot))
    labelled = distinct.join(stars, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    named = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_fp = labelled.select("fp", "label").join(named, "label")
    return rows.join(by_fp, "fp").select("doc_id", "tie", "fp", "label", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` without near-duplicates: of each group the row with the smallest doc_id stays (null last, then by text hash), with all its columns."""
    groups = near_duplicates(docs, shingle, max_bits)
    first = groups.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), F.coalesce("doc_id", F.lit(0)).alias("k"), "tie")).alias("kept"))
    key = ["z", "k", "tie"]
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").isNull().alias("z"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("k"), F.xxhash64("text").alias("tie"))
    kept = keyed.join(first.select("kept.*"), key, "left_semi")
    again = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1)))  # repeated rows
    return kept.withColumn("again", again).where("again = 1").select("row.*")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op3."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
