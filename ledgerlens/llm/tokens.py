"""Token-id shards in binary files, with a minimal perfect hash index from document keys to offsets.

A shard is two files in the shared folder.  ``<name>.bin`` holds the raw ids, little-endian, 16 bits
wide if the vocabulary fits and 32 bits if not, document after document in ascending ``doc_id``
(null last; rows that share a ``doc_id`` follow the hash of their text).  ``<name>.idx`` is an
``.npz`` with the levels of the hash (bit words and their ranks), and for each slot the stored key
fingerprint, the offset and the length; ``doc_id`` and ``is_null`` list the documents in file order.
A lookup reads one bit for each level that it passes (1.6 on average), one slot and one slice.

Tasks write under names of their own and report them; the manifest lists only what successful tasks
reported, so a repeated task leaves an unread file and nothing else.

Null and empty texts are a document with the end id alone.  Repeated rows are documents of their
own, told apart by their occurrence number.  An empty table gives an empty manifest and no rows.
Only ``doc_id`` and ``text`` are read; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import io
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_arrow, open_fs, shared_path, ship
from ledgerlens.llm.tokenize import END_ID, Encoder, id_crc

MANIFEST = "part int, shard string, n_docs long, n_tokens long, first_doc long, last_doc long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"
GAMMA = 2.0


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit mix of each value (splitmix64 finaliser); one-to-one for a fixed seed."""
    z = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def document_keys(doc_id: np.ndarray, is_null: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    """A 64-bit key for each (doc_id or null, occurrence); one-to-one for first occurrences."""
    again = occurrence.astype(np.uint64) + is_null.astype(np.uint64) * np.uint64(1 << 40)
    key = mixed(doc_id.view(np.uint64))
    return np.where(again == 0, key, mixed(key + again * np.uint64(0xD6E8FEB86659FD93), 1))


def occurrences(doc_id: np.ndarray, is_null: np.ndarray) -> np.ndarray:
    """Number of equal keys before each row, for rows in key order."""
    new = np.ones(len(doc_id), bool)
    new[1:] = (doc_id[1:] != doc_id[:-1]) | (is_null[1:] != is_null[:-1])
    at = np.arange(len(doc_id))
    return at - np.maximum.accumulate(np.where(new, at, 0)) if len(at) else at


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bits that exactly one key hits, and ranks."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        counts = np.bitwise_count(words).astype(np.int64)
        self.rank = np.cumsum(counts) - counts

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, parts, left = [], [], keys
        while len(left):
            m = -(-max(64, int(GAMMA * len(left))) // 64) * 64
            at = (mixed(left, 2 + len(sizes)) % np.uint64(m)).astype(np.int64)
            hits = np.bincount(at, minlength=m)
            sizes.append(m)
            parts.append(np.packbits(hits == 1, bitorder="little").view(np.uint64))
            left = left[hits[at] != 1]
            if len(sizes) > 200:
                raise ValueError("keys are not distinct")
        return cls(np.array(sizes, np.int64), np.concatenate([*parts, np.zeros(1, np.uint64)]))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where the key is surely not one of those indexed."""
        out, todo, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, m in enumerate(self.sizes.tolist()):
            at = base + (mixed(keys[todo], 2 + level) % np.uint64(m)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = ((word >> bit) & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[todo[hit]] = (self.rank[at >> 6] + below)[hit]
            todo, base = todo[~hit], base + m
        return out


class Shard:
    """Keyed reads from one shard."""

    def __init__(self, path: str):
        files, inner = open_fs(path)
        with files.open_input_stream(inner + ".idx") as f:
            self.index = dict(np.load(io.BytesIO(f.read())))
        self.hash = PerfectHash(self.index["sizes"], self.index["words"])
        self.width = np.dtype(str(self.index["width"]))
        self.file = files.open_input_file(inner + ".bin")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each key is in the shard, and its offset and length in ids."""
        slot = self.hash.slots(keys)
        there = slot >= 0
        there[there] = self.index["fingerprint"][slot[there]] == (mixed(keys[there], 1000) >> np.uint64(32)).astype(np.uint32)
        return there, np.where(there, self.index["offset"][slot], -1), np.where(there, self.index["length"][slot], 0)

    def ids(self, offset: int, length: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at(length * self.width.itemsize, offset * self.width.itemsize), self.width)


def write_shards(docs: DataFrame, vocabulary: str | None = None, folder: str | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write the shards; returns the manifest, one row a shard in order.

    The rows are dealt out by ``doc_id`` range, so a shard is a task's share (Spark's partition size)
    and the shards in order of ``part`` are the corpus in order of ``doc_id``.
    """
    folder = folder or shared_path(docs.sparkSession, "token-shards")

    def write(batches):
        encoder, part = Encoder.at(vocabulary), TaskContext.get().partitionId()
        name = f"{folder}/shard-{part:06d}-{uuid.uuid4().hex}"
        files, inner = open_fs(name)
        out, ids, nulls, lengths = None, [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                files.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                out = files.open_output_stream(inner + ".bin")
            key = batch.column(0)
            ids.append(key.fill_null(0).to_numpy())
            nulls.append(key.is_null().to_numpy(zero_copy_only=False))
            for found in encoder.encode(batch.column(1).to_pylist()):
                out.write(np.append(found, found.dtype.type(END_ID)).tobytes())
                lengths.append(len(found) + 1)
        if out is None:
            return
        out.close()
        doc_id, is_null, length = np.concatenate(ids), np.concatenate(nulls), np.array(lengths, np.int64)
        keys = document_keys(doc_id, is_null, occurrences(doc_id, is_null))
        index = PerfectHash.build(keys)
        slot = index.slots(keys)
        put = {"fingerprint": (mixed(keys, 1000) >> np.uint64(32)).astype(np.uint32), "offset": np.cumsum(length) - length, "length": length}
        by_slot = {k: np.empty_like(v) for k, v in put.items()}
        for k, v in put.items():
            by_slot[k][slot] = v
        held = io.BytesIO()
        np.savez(held, sizes=index.sizes, words=index.words, width=np.array(encoder.width.str), doc_id=doc_id, is_null=is_null, **by_slot)
        with files.open_output_stream(inner + ".idx") as f:
            f.write(held.getvalue())
        known = doc_id[~is_null]
        ends = [known[0], known[-1]] if len(known) else [None, None]
        yield pa.RecordBatch.from_pylist([{"part": part, "shard": name, "n_docs": len(doc_id), "n_tokens": int(length.sum()),
                                           "first_doc": None if ends[0] is None else int(ends[0]), "last_doc": None if ends[1] is None else int(ends[1])}],
                                         schema=pa.schema([("part", pa.int32()), ("shard", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("first_doc", pa.int64()), ("last_doc", pa.int64())]))

    key = F.col("doc_id").cast("long").asc_nulls_last()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    dealt = rows.repartitionByRange(key, "tie").sortWithinPartitions(key, "tie")
    # A doc_id's rows may end up in two shards: the occurrence then counts from 0 in each of them.
    return map_arrow(dealt.select("doc_id", "text"), write, MANIFEST).checkpoint()


def _with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest (one row a shard) with the number of ids in all shards before."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_back(manifest: DataFrame) -> DataFrame:
    """Every document of the shards, found by its key through the index: doc_id, start, n_tokens, ids_crc32."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["shard"])
                doc_id, is_null = shard.index["doc_id"], shard.index["is_null"]
                there, offset, length = shard.find(document_keys(doc_id, is_null, occurrences(doc_id, is_null)))
                if not there.all():
                    raise OSError(f"{row['shard']}: the index misses documents of its own shard")
                crc = [id_crc(shard.ids(o, n)) for o, n in zip(offset.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(doc_id, mask=is_null), pa.array(offset + row["start"]), pa.array(length), pa.array(crc, pa.int64())],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_arrow(_with_starts(manifest).repartition(n).select("shard", "start"), read, ROWS)


def lookup(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """Documents asked for by ``doc_id``: doc_id, start, n_tokens, ids_crc32, ids (first occurrence in a shard; unknown keys give no row).

    Keys go to the shards whose range holds them (the manifest has one row a shard), and each
    shard that is asked answers its keys in one task with one slice for each.
    """

    def answer(key, rows):
        shard = Shard(key[0].as_py())
        asked = rows.column("doc_id").to_numpy()
        start = rows.column("start").to_numpy()
        there, offset, length = shard.find(document_keys(asked, np.zeros(len(asked), bool), np.zeros(len(asked), np.int64)))
        found = [shard.ids(o, n) for o, n in zip(offset[there].tolist(), length[there].tolist())]
        return pa.table({"doc_id": asked[there], "start": offset[there] + start[there], "n_tokens": length[there],
                         "ids_crc32": pa.array([id_crc(x) for x in found], pa.int64()), "ids": pa.array([x.astype(np.int64).tolist() for x in found], pa.list_(pa.int64()))})

    ship(manifest.sparkSession)
    shards = _with_starts(manifest).select("shard", "start", "first_doc", "last_doc")
    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    at = asked.join(F.broadcast(shards), F.col("doc_id").between(F.col("first_doc"), F.col("last_doc")))
    return at.select("shard", "doc_id", "start").groupBy("shard").applyInArrow(answer, ROWS + ", ids array<long>")


def token_shards(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write the shards of ``docs`` and read every document back from the files."""
    return read_back(write_shards(docs, vocabulary))
