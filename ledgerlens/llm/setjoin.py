"""Exact Jaccard join of documents' word shingle sets by set-relation skipping.

1. *Sets.*  A document's set holds 64-bit hashes of its distinct shingles.  Equal sets are one class; the join
   runs between classes.  A class is named by a hash of its set, and a second hash checks that no two sets
   share a name (else the names are drawn anew).
2. *Order.*  Shingles are put in order of how many sets hold them, rarest first.  The counts come from a sketch
   of fixed size over all documents (``ORDER_BITS``); a wrong count makes the order less good, never the
   result, as any order that all sets share gives exact results.
3. *Index lists.*  A set enters the lists of its prefix: two sets that link share a shingle there.  A list is
   sorted in blocks by set size and, inside, by position.  Blocks of sizes out of reach are skipped, and so is
   the rest of a block once a position leaves too few shingles for the overlap that a link needs.  What is
   left of a list splits into runs of sizes within reach.
4. *Clusters.*  Runs that share sets make clusters, found as components of one edge for each set and run.  A
   cluster's sets, in order of size, are dealt into blocks of about ``BLOCK`` shingles, and a task gets a cell:
   one block, or two of the same cluster whose sizes are within reach.  A cell's size does not grow with a
   cluster, and no pairs are listed at any step.
5. *Answers.*  In a cell the first set's overlaps with all others are counted over its shingles' lists.  The
   next set is the one most similar to it, and its overlaps are derived from those just computed: only lists
   of shingles that one of the two has and the other hasn't are read.  A cell hands on each set's number of
   linked documents, and a forest of links (at most one for each set).

Components come from the forests.  Null text counts as empty; a document without words has no set and links
with nothing; one with fewer words than a shingle is a single shingle.  Long texts are split into words in
blocks.  Repeated rows are documents each, and copies link; a null doc_id takes part, but names a
component (as null) only if it has no other.  An empty table gives no rows.  Only ``doc_id`` and ``text`` are
read, whatever other columns exist.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_arrow, running_totals, ship, stored
from ledgerlens.llm.components import components
from ledgerlens.llm.simhash import word_blocks

SHINGLE = 5
PERCENT = 80       # of the union that two sets must share
ORDER_BITS = 24    # the sketch of counts has 2^24 places of one byte
CHUNK = 1 << 16
BLOCK = 1 << 19    # shingles in a block of a cluster
LISTED = "token long, c long, n int, pos int"
SHARED = "c long, n int, pivot long"
ANSWERS = "a long, b long, links long"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words, or of all words if there are fewer."""
    digest = xxhash.xxh3_64_intdigest
    found = [np.fromiter(map(digest, words), np.uint64, len(words)) for words in word_blocks(text or "")]
    words = np.concatenate(found) if found else np.zeros(0, np.uint64)
    if not len(words):
        return words
    k = min(size, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) ^ words[j:j + n])
    return np.unique(out)


def name(tokens: np.ndarray, seed: int) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes(), seed)).view(np.int64))


def check(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes(), 1)).view(np.int64))


class Tally:
    """Counts of 64-bit hashes by their first ``bits`` bits, up to 255 for each task."""

    def __init__(self, bits: int):
        self.shift, self.counts = np.uint64(64 - bits), np.zeros(1 << bits, np.uint8)
        self.held, self.size = [], 0

    def add(self, hashes: np.ndarray) -> None:
        self.held.append((hashes >> self.shift).astype(np.uint32))
        self.size += len(hashes)
        if self.size > 1 << 22:
            self.fold()

    def fold(self) -> None:
        if self.held:
            place, n = np.unique(np.concatenate(self.held), return_counts=True)
            self.counts[place] = np.minimum(self.counts[place] + n, 255)
            self.held, self.size = [], 0

    def chunks(self) -> Iterator[tuple[int, bytes]]:
        self.fold()
        for k in range(0, len(self.counts), CHUNK):
            part = self.counts[k:k + CHUNK]
            if part.any():
                yield k // CHUNK, zlib.compress(part.tobytes(), 1)

    @staticmethod
    def order(parts: DataFrame, bits: int) -> np.ndarray:
        """One byte for each place, twice the logarithm of its count over all tasks: 0 for none, more for more."""

        def summed(batches):
            total = {}
            for batch in batches:
                for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    part = np.frombuffer(zlib.decompress(data), np.uint8)
                    total[chunk] = total.get(chunk, 0) + part.astype(np.uint32)
            for chunk, counts in total.items():
                level = np.minimum(np.floor(2 * np.log2(counts + 1.0)), 255).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([zlib.compress(level.tobytes(), 1)], pa.binary())], names=["chunk", "counts"])

        out = np.zeros(1 << bits, np.uint8)  # 2^bits bytes, whatever the input
        for row in map_arrow(parts.select("chunk", "counts").repartition(max(1, min(64, (1 << bits) // CHUNK)), "chunk"), summed, "chunk int, counts binary").collect():
            part = np.frombuffer(zlib.decompress(row.counts), np.uint8)
            out[row.chunk * CHUNK:row.chunk * CHUNK + len(part)] = part
        return out


def _parts(tally: Tally, columns: int):
    """The chunks of a tally as rows behind ``columns`` null columns of longs."""
    rows = list(tally.chunks())
    if rows:
        none = pa.nulls(len(rows), pa.int64())
        return pa.RecordBatch.from_arrays([none] * columns + [pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary())],
                                          names=["doc_id", "n", "c", "again"][:columns] + ["chunk", "counts"])


def classes(docs: DataFrame, shingle: int, bits: int, seed: int = 0) -> tuple[DataFrame, DataFrame, np.ndarray, int]:
    """Rows (doc_id, n, c), classes (c, n, copies, least), the order of shingles and the seed of the names."""

    def work(batches):
        tally, seen = Tally(bits), set()
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                s = shingles(text, shingle)
                c = name(s, seed) if len(s) else None
                out.append((len(s), c, check(s) if len(s) else None))
                if len(s) and c not in seen:
                    seen.add(c)
                    tally.add(s)
            if out:
                n, c, again = zip(*out)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.array(again, pa.int64()), pa.nulls(len(n), pa.int32()),
                                                  pa.nulls(len(n), pa.binary())], names=["doc_id", "n", "c", "again", "chunk", "counts"])
        if (last := _parts(tally, 4)) is not None:
            yield last

    both = stored(map_arrow(_texts(docs), work, "doc_id long, n long, c long, again long, chunk int, counts binary"), "sets")
    rows = both.where("chunk IS NULL")
    found = stored(rows.where("n > 0").groupBy("c").agg(F.first("n").alias("n"), F.count("*").alias("copies"), F.min("doc_id").alias("least"),
                                                        (F.min("again") != F.max("again")).alias("torn")), "classes")
    if not found.where("torn").isEmpty():  # two sets with one name: one in 2^64 pairs
        return classes(docs, shingle, bits, seed + 1)
    return rows.select("doc_id", "n", "c"), found.drop("torn"), Tally.order(both.where("chunk IS NOT NULL"), bits), seed


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _each_set(batches, shingle: int, seed: int):
    """(c, set) of the texts of a task, each set once."""
    seen = set()
    for batch in batches:
        for text in batch.column(1).to_pylist():
            s = shingles(text, shingle)
            if len(s) and (c := name(s, seed)) not in seen:
                seen.add(c)
                yield c, s


def index_lists(docs: DataFrame, order, shingle: int, percent: int, bits: int, seed: int) -> DataFrame:
    """The lists' entries: token, c, n, pos, for the shingles of each prefix."""
    level = docs.sparkSession.sparkContext.broadcast(order)  # 2^bits bytes

    def work(batches):
        at, held, size = level.value, [], 0

        def out():
            yield from pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], names=["token", "c", "n", "pos"]).to_batches(max_chunksize=50_000)

        for c, s in _each_set(batches, shingle, seed):
            kind = at[s >> np.uint64(64 - bits)]
            n = len(s)
            first = np.argsort(kind, kind="stable")[:n - -(-percent * n // 100) + 1]  # s is in order, so equal kinds are by hash
            held.append((s[first].view(np.int64), np.full(len(first), c, np.int64), np.full(len(first), n, np.int32), np.arange(len(first), dtype=np.int32)))
            size += len(first)
            if size > 200_000:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    return map_arrow(_texts(docs), work, LISTED)


class Reach:
    """Which sizes and positions leave a link possible."""

    def __init__(self, percent: int):
        self.percent = percent

    def needed(self, n, m):
        """The least overlap of linked sets of these sizes."""
        return -(-self.percent * (n + m) // (100 + self.percent))

    def sizes(self, small, large):
        return 100 * small >= self.percent * large

    def linked(self, overlap, n, m):
        return 100 * overlap >= self.percent * (n + m - overlap)

    def pair(self, n, pos, m, at):
        """Whether sets of sizes n <= m that share the shingle at these positions can link."""
        need = self.needed(n, m)
        return self.sizes(n, m) & (pos <= n - need) & (at <= m - need)

    def survivors(self, n: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Which entries of a list, in order of (n, pos), have another entry within reach."""
        start = np.flatnonzero(np.append(True, n[1:] != n[:-1]))
        size, least = n[start], pos[start]
        alone = np.diff(np.append(start, len(n))) == 1
        upto = np.full(len(size), -1, np.int64)
        last = np.searchsorted(size, size * 100 // self.percent, "right")
        for k in range(len(size)):  # block by block; those behind last[k] are skipped
            need = self.needed(size[k], size[k:last[k]])
            fits = least[k:last[k]] <= size[k:last[k]] - need
            fits[0] &= not alone[k]
            if fits.any():
                upto[k] = max(upto[k], size[k] - need[fits].min())
            can = size[k:last[k]] - need
            can[least[k] > size[k] - need] = -1
            can[0] = -1
            np.maximum(upto[k:last[k]], can, out=upto[k:last[k]])
        return pos <= np.repeat(upto, np.diff(np.append(start, len(n))))

    def runs(self, n: np.ndarray) -> np.ndarray:
        """Number of the run of each entry: a run goes on while the next size is within reach."""
        return np.cumsum(np.append(False, ~self.sizes(n[:-1], n[1:])))


def shared_lists(lists: DataFrame, reach: Reach) -> DataFrame:
    """What skipping leaves of the lists: c, n and the first set of the run, once for each of them in a task."""

    def settle(token, c, n, pos):
        """Entries sorted by (token, n, pos, c), whole lists: pairs (c, pivot) and sizes of what stays."""
        new = np.append(True, (token[1:] != token[:-1]) | (c[1:] != c[:-1]) | (n[1:] != n[:-1]))
        token, c, n, pos = token[new], c[new], n[new].astype(np.int64), pos[new].astype(np.int64)
        start = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        size = np.diff(np.append(start, len(token)))
        two = start[size == 2]
        two = two[reach.pair(n[two], pos[two], n[two + 1], pos[two + 1])]
        out = [(np.concatenate((c[two], c[two + 1])), np.concatenate((n[two], n[two + 1])), np.tile(c[two], 2))]
        for a, m in zip(start[size > 2].tolist(), size[size > 2].tolist()):
            stay = a + np.flatnonzero(reach.survivors(n[a:a + m], pos[a:a + m]))
            if len(stay) > 1:
                run = reach.runs(n[stay])
                first = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
                many = np.bincount(run)[run] > 1
                out.append((c[stay[many]], n[stay[many]], c[stay[first]][run[many]]))
        return [np.concatenate(x) for x in zip(*out)]

    def work(batches):
        rest, seen = [np.zeros(0, t) for t in (np.int64, np.int64, np.int32, np.int32)], np.zeros((0, 2), np.int64)
        held, size = [], 0

        def entries(last):
            nonlocal rest, held, size
            rest = [np.concatenate(x) for x in zip(rest, *held)]
            held, size = [], 0
            upto = len(rest[0]) if last else int(np.searchsorted(rest[0], rest[0][-1]))
            done, rest = [x[:upto] for x in rest], [x[upto:] for x in rest]
            return done

        def out(done):
            nonlocal seen
            if not len(done[0]):
                return
            c, n, pivot = settle(*done)
            if len(c):
                _, first = np.unique(np.stack((c, pivot), 1), axis=0, return_index=True)
                yield from pa.Table.from_arrays([pa.array(c[first]), pa.array(n[first].astype(np.int32)), pa.array(pivot[first])], names=["c", "n", "pivot"]).to_batches(max_chunksize=50_000)

        for batch in batches:
            held.append([x.to_numpy() for x in batch.columns])
            size += batch.num_rows
            if size > 200_000:
                yield from out(entries(False))
        if held or len(rest[0]):
            yield from out(entries(True))

    partitions = max(8, int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return map_arrow(lists.repartition(partitions, "token").sortWithinPartitions("token", "n", "pos", "c"), work, SHARED)


def clusters(shared: DataFrame, found: DataFrame, block: int) -> DataFrame:
    """c, k (its cluster), b (its block), n and copies of every set that shares a list with another."""
    edges = shared.where("c <> pivot").select(F.col("c").alias("a"), F.col("pivot").alias("b"))
    label = components(edges)
    inside = shared.groupBy("c").agg(F.first("n").cast("long").alias("n")).join(label.withColumnRenamed("node", "c"), "c", "left")
    inside = inside.select("c", "n", F.coalesce("label", "c").alias("k")).join(found.select("c", "copies"), "c")
    placed = running_totals(inside, [F.col("k"), F.col("n"), F.col("c")], ["n"])
    return stored(placed.select("c", "k", "n", "copies", F.floor(F.col("before_n") / block).cast("long").alias("b")), "clusters")


def whole_sets(docs: DataFrame, wanted: DataFrame, shingle: int, bits: int, seed: int) -> DataFrame:
    """(c, tokens) of the wanted classes, once more from the texts; others are mostly left out by a sketch of the names."""

    def mark(batches):
        tally = Tally(bits)
        for batch in batches:
            tally.add(batch.column(0).to_numpy().view(np.uint64))
        if (last := _parts(tally, 0)) is not None:
            yield last

    there = docs.sparkSession.sparkContext.broadcast(Tally.order(map_arrow(wanted.select("c"), mark, "chunk int, counts binary"), bits) > 0)

    def work(batches):
        at = there.value
        held, size = [], 0

        def out():
            flat, sizes = np.concatenate([s for _, s in held]).view(np.int64), [len(s) for _, s in held]
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(flat))
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in held], pa.int64()), lists], names=["c", "tokens"])

        for c, s in _each_set(batches, shingle, seed):
            if at[int(np.int64(c).view(np.uint64)) >> (64 - bits)]:
                held.append((c, s))
                size += len(s)
                if size > 1 << 18:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return map_arrow(_texts(docs), work, "c long, tokens array<long>").dropDuplicates(["c"]).join(wanted, "c")


class Answers:
    """The overlaps of each set of a cluster with all others, each derived from a similar set's."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.sizes, self.m = sizes, len(sizes)
        self.ids = np.unique(flat, return_inverse=True)[1]
        self.ends = np.cumsum(sizes)
        order = np.argsort(self.ids, kind="stable")
        self.who = np.repeat(np.arange(self.m), sizes)[order]
        self.first = np.append(0, np.cumsum(np.bincount(self.ids)))

    def tokens(self, x: int) -> np.ndarray:
        return self.ids[self.ends[x] - self.sizes[x]:self.ends[x]]

    def lists(self, tokens: np.ndarray) -> np.ndarray:
        """How often each set stands in the lists of ``tokens``."""
        start, n = self.first[tokens], self.first[tokens + 1] - self.first[tokens]
        at = np.repeat(start - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        return np.bincount(self.who[at], minlength=self.m)

    def overlaps(self, todo: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(x, its overlaps) for the sets of ``todo``, each followed by the one most similar to it."""
        left = np.zeros(self.m, bool)
        left[todo] = True
        x, now = int(todo[0]), None
        for k in range(len(todo)):
            if now is None:
                now = self.lists(self.tokens(x))
            yield x, now
            left[x] = False
            if k == len(todo) - 1:
                return
            rest = np.flatnonzero(left)
            apart = self.sizes[x] + self.sizes[rest] - 2 * now[rest]
            y = int(rest[np.argmin(apart)])
            if apart.min() < self.sizes[y]:
                a, b = self.tokens(x), self.tokens(y)
                now = now - self.lists(np.setdiff1d(a, b, assume_unique=True)) + self.lists(np.setdiff1d(b, a, assume_unique=True))
            else:
                now = None
            x = y


def cell_answers(reach: Reach):
    """A task's work on a cell: ANSWERS rows (a, b) of a forest of links, and (a, links) with linked documents of each set."""

    def cluster(c, flat, sizes, copies, side, edges, links):
        diagonal = not side.any()
        label = np.arange(len(c))
        answers = Answers(flat, sizes)
        for x, overlap in answers.overlaps(np.flatnonzero(side == 0)):
            hit = reach.linked(overlap, sizes[x], sizes) & (side == (0 if diagonal else 1))
            hit[x] = False
            near = np.flatnonzero(hit)
            if not len(near):
                continue
            links[int(c[x])] = links.get(int(c[x]), 0) + int(copies[near].sum())
            if not diagonal:
                for y in near.tolist():
                    links[int(c[y])] = links.get(int(c[y]), 0) + int(copies[x])
            other, at = np.unique(label[near], return_index=True)
            for lab, y in zip(other.tolist(), near[at].tolist()):
                if lab != label[x]:
                    edges.append((int(c[x]), int(c[y])))
                    label[label == lab] = label[x]

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("k", "ascending"), ("side", "ascending"), ("n", "ascending"), ("c", "ascending")])
        k, c, n, copies, side = (table.column(x).to_numpy() for x in ("k", "c", "n", "copies", "side"))
        tokens = table.column("tokens").combine_chunks()
        flat, ends = tokens.flatten().to_numpy(), np.cumsum(n)
        start = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        edges, links = [], {}
        for a, b in zip(start.tolist(), np.append(start[1:], len(k)).tolist()):
            if b - a > 1:
                cluster(c[a:b], flat[ends[a] - n[a]:ends[b - 1]], n[a:b], copies[a:b], side[a:b], edges, links)
        return pa.Table.from_arrays([pa.array([x[0] for x in edges] + list(links), pa.int64()), pa.array([x[1] for x in edges] + [None] * len(links), pa.int64()),
                                     pa.array([None] * len(edges) + list(links.values()), pa.int64())], names=["a", "b", "links"])

    return work


def join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bits: int = ORDER_BITS, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, class (null without words), links (documents it links with) and component_id of each document."""
    reach = Reach(percent)
    rows, found, order, seed = classes(docs, shingle, bits)
    shared = stored(shared_lists(index_lists(docs, order, shingle, percent, bits, seed), reach), "shared-lists")
    inside = clusters(shared, found, block)
    sets = stored(whole_sets(docs, inside, shingle, bits, seed), "whole-sets")
    # Cells: every block with itself, and blocks of one cluster whose sizes are within reach.
    spans = inside.groupBy("k", "b").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    other = spans.select("k", F.col("b").alias("bj"), F.col("least").alias("least_j"))
    cells = spans.join(other, "k").where((F.col("b") < F.col("bj")) & (100 * F.col("most") >= percent * F.col("least_j"))).select("k", F.col("b").alias("bi"), "bj")
    columns = ["k", "c", "n", "copies", "tokens"]
    own = sets.select(F.col("b").alias("bi"), F.col("b").alias("bj"), F.lit(0).alias("side"), *columns)
    low = sets.join(cells.withColumnRenamed("bi", "b"), ["k", "b"]).select(F.col("b").alias("bi"), "bj", F.lit(0).alias("side"), *columns)
    high = sets.join(cells.withColumnRenamed("bj", "b"), ["k", "b"]).select("bi", F.col("b").alias("bj"), F.lit(1).alias("side"), *columns)
    ship(docs.sparkSession)
    answers = stored(own.unionByName(low).unionByName(high).groupBy("bi", "bj").applyInArrow(cell_answers(reach), ANSWERS), "answers")
    label = components(answers.where("b IS NOT NULL").select("a", "b"))
    links = answers.where("b IS NULL").groupBy(F.col("a").alias("c")).agg(F.sum("links").alias("links"))
    named = found.join(label.withColumnRenamed("node", "c"), "c", "left").join(links, "c", "left")
    named = named.select("c", "copies", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("label", "c").alias("label"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_class = named.join(least, "label").select("c", (F.col("links") + F.col("copies") - 1).alias("links"), "component_id")
    out = rows.join(by_class, "c", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.coalesce("links", F.lit(0)).alias("links"), F.col("c").alias("class"))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op12, and each document's number of links."""
    return join(docs).select("doc_id", "n_shingles", "component_id", "links")
