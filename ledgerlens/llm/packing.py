"""Best-fit packing of token sequences, certified by dual-feasible lower bounds, with exchange between partitions.

Documents become pieces of at most ``capacity`` tokens: only a longer document is cut, its first
piece taking what is over.  The pieces are dealt out by a hash of their row, and each partition packs its own by
best-fit decreasing and computes a lower bound on its bins from two families of dual-feasible
functions.  Bins equal to the bound certify the partition, and all its bins but the emptiest stay.
A partition with a gap keeps its full bins only.  What is left is dealt out again among fewer
partitions, so that partitions exchange documents, and packed anew; the last round keeps all.

Null and empty texts are one piece with the end id alone; repeated rows are documents of their own;
an empty table gives no rows.  Only ``doc_id`` and ``text`` are read, whatever other columns exist.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.common import map_arrow, stored
from ledgerlens.llm.tokenize import END_ID, Encoder, id_crc

CAPACITY = 1024
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long, certified boolean, settled boolean"
#: Pieces in a partition: bounds a task's memory (about 100 bytes each) and is enough for a tight packing.
PER_PARTITION = 200_000
ROUNDS = 4


def cut(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Pieces of the encoded documents, without their ids."""

    def pieces(batches):
        encoder = Encoder.at(vocabulary)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encoder.encode(batch.column(1).to_pylist())):
                ids = np.append(ids, ids.dtype.type(END_ID))
                a, n = 0, len(ids) % capacity or capacity
                k = 0
                while a < len(ids):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(n)
                    crc.append(id_crc(ids[a:a + n]))
                    a, n, k = a + n, capacity, k + 1
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                                              pa.array(crc, pa.int64())], names=names)

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), pieces, PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins needed at least: the best of dual-feasible functions over the histogram of lengths.

    One family rounds up what is over ``capacity - e`` and drops what is under ``e``; the other
    takes multiples of the (k+1)-th part (both from Fekete and Schepers).  Each maps any set of
    lengths that fits one bin to a sum of at most 1, so its total is a bound.
    """
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    best, upto, words = 0, np.cumsum(count), np.cumsum(count * size)
    for e in range(capacity // 2 + 1):
        high, low = capacity - e, e - 1  # lengths over high count 1, those up to low count 0
        middle = words[high] - (words[low] if low >= 0 else 0)
        best = max(best, int(upto[-1] - upto[high]) - int(-middle // capacity))
    for k in range(1, 21):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, scaled * k // (k + 1), scaled // capacity * capacity)  # in units of 1 / (k * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the fill of each bin; rests of bins are found by one bit mask."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by their rest
    mask, made = 0, []
    order = np.argsort(-lengths, kind="stable")
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fits = mask >> n
        if fits:
            rest = n + (fits & -fits).bit_length() - 1
            b = waiting[rest].pop()
            if not waiting[rest]:
                mask &= ~(1 << rest)
        else:
            b, rest = len(made), capacity
            made.append(0)
        bins[i], offsets[i] = b, made[b]
        made[b] += n
        rest -= n
        if rest:
            waiting[rest].append(b)
            mask |= 1 << rest
    return bins, offsets, np.array(made, np.int64)


def dealt(pieces: DataFrame, partitions: int, number: int) -> DataFrame:
    """``pieces`` by a hash of a row's place in the stored files, which a retry reads alike: equal rows are dealt apart."""
    rows = pieces.select(*[c.split()[0] for c in PIECES.split(", ")]).withColumn("deal", F.xxhash64(F.monotonically_increasing_id(), F.lit(number)))
    return rows.repartition(partitions, "deal").drop("deal")


def _round(pieces: DataFrame, number: int, last: bool, partitions: int, capacity: int) -> DataFrame:
    def pack(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        lengths = rows.column("length").to_numpy()
        bins, offsets, fill = best_fit_decreasing(lengths, capacity)
        certified = len(fill) == lower_bound(lengths, capacity)
        settled = np.ones(len(fill), bool)
        if not last:
            settled = fill == capacity
            if certified:
                settled[:] = True
                settled[np.argmin(fill)] = fill.min() == capacity
        first = (number << 56) | (TaskContext.get().partitionId() << 32)
        n = len(lengths)
        rows = rows.append_column("sequence_id", pa.array(first + bins)).append_column("offset", pa.array(offsets))
        rows = rows.append_column("certified", pa.array(np.full(n, certified))).append_column("settled", pa.array(settled[bins]))
        yield from rows.to_batches(max_chunksize=20_000)

    return stored(map_arrow(dealt(pieces, partitions, number), pack, PACKED), "packed")


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, per_partition: int = PER_PARTITION,
         rounds: int = ROUNDS) -> DataFrame:
    """Pack ``docs`` (doc_id, text); returns a row for each piece with its sequence and offset there.

    ``certified`` says that the partition which packed the piece last needed no more bins than its bound.
    """
    left, kept = stored(cut(docs, capacity, vocabulary), "pieces"), []
    for number in range(rounds):
        partitions = -(-left.count() // per_partition) or 1
        last = number == rounds - 1 or partitions == 1  # one partition has none to exchange with
        packed = _round(left, number, last, partitions, capacity)
        kept.append(packed.where("settled"))
        if last:
            break
        left = packed.where("NOT settled")
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")
