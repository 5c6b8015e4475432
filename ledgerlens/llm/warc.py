"""WARC archives with a Merkle fixity audit of replicas.

``write_archive`` writes pages as WARC/1.1 files, a task each, every record compressed as a gzip member of
its own.  ``leaves`` reads an archive's files back and hashes each record's bytes as stored; a record whose
bytes can't be taken for one at its place is skipped to the next gzip member.  ``tree`` hashes ordered runs
of ``FANOUT`` nodes, with the offset range that they cover, into the node above, up to a root for each file.
``audit`` compares the roots of two replicas and then only the children of nodes that differ, level by
level, down to the records that differ by place.  ``align`` matches these by digest, record id and order,
so one dropped record is one missing record, though all behind it have moved.

Levels are small joins and groups of at most ``FANOUT`` rows by (file, level, place); alignment sorts the
places of a file that has gaps on both sides.  No more of a file's records meet in one task than in reading
the file, and no tree is collected.

Null urls and texts are written as empty; repeated rows are records each; null ids stay null.  A
very long page is a long record.  An empty table makes an archive without files, and an audit without rows.
Only ``page_id``, ``url`` and ``html`` are read, whatever other columns exist.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_arrow, open_fs, shared_path, stored

FANOUT = 16
MAGIC = b"\x1f\x8b\x08"
SLICE = 1 << 14
FILES = "file int, path string, n_records long, n_bytes long"
LEAVES = "file int, place long, start long, stop long, digest string, page_id long, record_id string, intact boolean"
DATE = "2000-01-01T00:00:00Z"  # fixed, so that equal pages give equal bytes


def record(page_id: int | None, url: str, body: bytes, number: str) -> bytes:
    """A WARC resource record of a page, compressed."""
    head = (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:{number}>\r\nWARC-Date: {DATE}\r\n"
            f"WARC-Target-URI: {' '.join(url.split())}\r\nWARC-Block-Digest: sha256:{hashlib.sha256(body).hexdigest()}\r\n"
            f"X-Page-ID: {'' if page_id is None else page_id}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n").encode()
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(head + body + b"\r\n\r\n") + packer.flush()


def fields(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of an unpacked record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    found = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    return found, rest[:int(found.get("Content-Length", 0))]


def write_archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC files; returns file, path, n_records, n_bytes of each."""
    folder = folder or shared_path(pages.sparkSession, "warc")

    def write(batches):
        part = TaskContext.get().partitionId()
        path, out, n, size = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.warc.gz", None, 0, 0
        files, inner = open_fs(path)
        for batch in batches:
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    files.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                    out = files.open_output_stream(inner, compression=None)
                data = record(page_id, url or "", (html or "").encode("utf-8", "surrogatepass"), str(uuid.uuid5(uuid.NAMESPACE_URL, f"{part}/{n}")))
                out.write(data)
                n, size = n + 1, size + len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([path]), pa.array([n]), pa.array([size])], names=["file", "path", "n_records", "n_bytes"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return map_arrow(rows, write, FILES).checkpoint()


def members(data: bytes):
    """(start, stop, unpacked bytes or None) of each record; damaged bytes reach to the next member that can be read."""
    at = 0
    while at < len(data):
        try:
            unpacker, parts, end = zlib.decompressobj(31), [], at
            while end < len(data) and not unpacker.eof:
                parts.append(unpacker.decompress(data[end:end + SLICE]))
                end = min(end + SLICE, len(data))
            plain = b"".join(parts)
            if unpacker.eof and plain.startswith(b"WARC/"):
                stop = end - len(unpacker.unused_data)
                yield at, stop, plain
                at = stop
                continue
        except zlib.error:
            pass
        stop = data.find(MAGIC, at + 1)
        while 0 <= stop < len(data) and not _starts(data, stop):
            stop = data.find(MAGIC, stop + 1)
        stop = stop if stop > 0 else len(data)
        yield at, stop, None
        at = stop


def _starts(data: bytes, at: int) -> bool:
    try:
        return zlib.decompressobj(31).decompress(memoryview(data)[at:at + 4096], 64).startswith(b"WARC/")
    except zlib.error:
        return False


class _Stream:
    """The members of a file, read in windows: a window holds one record at least."""

    def __init__(self, source, window: int = 1 << 22):
        self.source, self.window = source, window

    def __iter__(self):
        data, base, done = b"", 0, False
        while not done or data:
            if not done:
                more = self.source.read(max(self.window, len(data)))
                done = not more
                data += more
            used = 0
            for start, stop, plain in members(data):
                if stop == len(data) and not done:
                    break  # may go on in the next window
                yield base + start, base + stop, plain, data[start:stop]
                used = stop
            data, base = data[used:], base + used
            if done and not used:
                return


def leaves(files: DataFrame) -> DataFrame:
    """Hash every record of an archive's ``files`` (file, path): place in its file, offsets, digest and identity."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                fs, inner = open_fs(row["path"])
                rows = []
                with fs.open_input_stream(inner, compression=None) as source:
                    for start, stop, plain, raw in _Stream(source):
                        head, body = fields(plain) if plain is not None else ({}, b"")
                        whole = plain is not None and head.get("WARC-Block-Digest") == "sha256:" + hashlib.sha256(body).hexdigest()
                        page = head.get("X-Page-ID", "")
                        rows.append((row["file"], len(rows), start, stop, hashlib.sha256(b"\0" + raw).hexdigest(), int(page) if page.lstrip("-").isdigit() else None,
                                     head.get("WARC-Record-ID"), whole))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 8, kinds)], names=[c.split()[0] for c in LEAVES.split(", ")])

    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(map_arrow(files.select("file", "path").repartition(n), read, LEAVES), "leaves")


def tree(hashed: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """Levels of the trees above ``leaves``, the leaves first: file, place, start, stop, digest; the last holds a root for each file."""
    level = hashed.select("file", "place", "start", "stop", "digest")
    levels = [level]
    most = (hashed.agg(F.max("place")).first()[0] or 0) + 1
    while most > 1:
        child = F.struct("place", "start", "stop", "digest")
        runs = level.groupBy("file", F.floor(F.col("place") / fanout).alias("up")).agg(F.sort_array(F.collect_list(child)).alias("x"))  # fanout at most
        text = F.array_join(F.transform("x", lambda c: F.concat_ws(":", c["start"].cast("string"), c["stop"].cast("string"), c["digest"])), "|")
        level = runs.select("file", F.col("up").cast("long").alias("place"), F.col("x")[0]["start"].alias("start"), F.element_at("x", -1)["stop"].alias("stop"),
                            F.sha2(F.concat(F.lit("\x01"), text).cast("binary"), 256).alias("digest")).checkpoint()
        levels.append(level)
        most = -(-most // fanout)
    return levels


def audit(ours: list[DataFrame], theirs: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """Where two replicas differ: file, place, start, stop, other_start, other_stop, status (changed, missing in theirs, or extra there)."""
    ours, theirs = [[*x, *x[-1:] * (max(len(ours), len(theirs)) - len(x))] for x in (ours, theirs)]
    above = None
    for a, b in zip(reversed(ours), reversed(theirs)):
        b = b.select("file", "place", F.col("start").alias("other_start"), F.col("stop").alias("other_stop"), F.col("digest").alias("other_digest"))
        if above is not None:
            a = a.withColumn("up", F.floor(F.col("place") / fanout)).join(above, ["file", "up"], "left_semi").drop("up")
            b = b.withColumn("up", F.floor(F.col("place") / fanout)).join(above, ["file", "up"], "left_semi").drop("up")
        differ = a.join(b, ["file", "place"], "full").where(~F.col("digest").eqNullSafe(F.col("other_digest"))).checkpoint()
        above = differ.select("file", F.col("place").alias("up"))
    status = F.when(F.col("other_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("changed")
    return differ.select("file", "place", "start", "stop", "other_start", "other_stop", status.alias("status"))


def align(ours: DataFrame, theirs: DataFrame, found: DataFrame) -> DataFrame:
    """Match the records behind the differences of ``audit``: file, place, other_place, status.

    A record that is missing or inserted moves all behind it, so what differs by place is matched anew in
    its file: first by the digest (such records are intact, at whatever place: ``same``), then by record id,
    then, where damage took the id, by order between two matched neighbours (both ``changed``).  What is
    left is ``missing`` or ``extra``.
    """
    nth = lambda *by: F.row_number().over(Window.partitionBy("file", *by).orderBy("place"))
    side = lambda status, leaves: found.where(F.col("status") != status).select("file", "place").join(leaves.select("file", "place", "digest", "record_id"), ["file", "place"]).checkpoint()
    mine, other = side("extra", ours), side("missing", theirs)

    def matched(a, b, *by):
        b = b.withColumn("nth", nth(*by)).select("file", *by, "nth", F.col("place").alias("other_place"))
        return a.withColumn("nth", nth(*by)).join(b, ["file", *by, "nth"]).select("file", "place", "other_place").checkpoint()

    def rest(a, b, pairs):
        return (a.join(pairs, ["file", "place"], "left_anti").checkpoint(), b.join(pairs.select("file", F.col("other_place").alias("place")), ["file", "place"], "left_anti").checkpoint())

    intact = matched(mine, other, "digest")
    a, b = rest(mine, other, intact)
    named = matched(a.where("record_id IS NOT NULL"), b.where("record_id IS NOT NULL"), "record_id")
    a, b = rest(a, b, named)
    # What is left lies in gaps: a gap has the number of our last matched record before it.
    pairs = intact.unionByName(named)
    files = a.select("file").intersect(b.select("file"))
    before = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)

    def in_gaps(left, leaves, differ, anchors):
        at = leaves.select("file", "place").join(files, "file", "left_semi").join(differ.select("file", "place", F.lit(True).alias("differs")), ["file", "place"], "left")
        at = at.join(anchors, ["file", "place"], "left").withColumn("anchor", F.when(F.col("differs").isNull(), F.col("place")).otherwise(F.col("anchor")))
        gap = at.select("file", "place", F.coalesce(F.last("anchor", ignorenulls=True).over(before), F.lit(-1).cast("long")).alias("gap"))
        return left.join(gap, ["file", "place"])

    in_order = matched(in_gaps(a, ours, mine, pairs.select("file", "place", F.col("place").alias("anchor"))),
                       in_gaps(b, theirs, other, pairs.select("file", F.col("other_place").alias("place"), F.col("place").alias("anchor"))), "gap")
    a, b = rest(a, b, in_order)
    status = lambda df, name: df.withColumn("status", F.lit(name))
    none = F.lit(None).cast("long")
    return status(intact, "same").unionByName(status(named.unionByName(in_order), "changed")).unionByName(
        status(a.select("file", "place", none.alias("other_place")), "missing")).unionByName(status(b.select("file", none.alias("place"), F.col("place").alias("other_place")), "extra"))


def copy_records(files: DataFrame, edit, folder: str | None = None) -> DataFrame:
    """Copy an archive record by record; ``edit`` (file, number, offset, bytes) gives the bytes to write instead, for trials."""
    folder = folder or shared_path(files.sparkSession, "warc-edited")

    def copy(batches):
        for batch in batches:
            for row in batch.to_pylist():
                fs, inner = open_fs(row["path"])
                path = f"{folder}/{row['path'].rsplit('/', 1)[1].split('.')[0]}-{uuid.uuid4().hex}.warc.gz"
                to, to_inner = open_fs(path)
                to.create_dir(to_inner.rsplit("/", 1)[0], recursive=True)
                with fs.open_input_stream(inner, compression=None) as source, to.open_output_stream(to_inner, compression=None) as out:
                    for number, (start, _, _, raw) in enumerate(_Stream(source)):
                        out.write(edit(row["file"], number, start, raw))
                yield pa.RecordBatch.from_pylist([row | {"path": path}], schema=batch.schema)

    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_arrow(files.repartition(n), copy, FILES).checkpoint()


def dropped_and_inserted(every: int, drop: int = 10, insert: int = 30, damage_every: int = 0):
    """Edits for trials: of every ``every`` records of a file, one is dropped, and before another a foreign one is inserted.

    With ``damage_every``, the byte in the middle of every so many stretches of 4096 bytes is changed too.
    """

    def edit(file: int, number: int, start: int, raw: bytes) -> bytes:
        if number % every == drop % every:
            return b""
        if damage_every:
            out = np.frombuffer(raw, np.uint8).copy()
            out[(2048 - start) % (4096 * damage_every)::4096 * damage_every] ^= 0x55
            raw = out.tobytes()
        if number % every == insert % every:
            return record(None, "urn:inserted", b"inserted", str(uuid.uuid5(uuid.NAMESPACE_URL, f"inserted/{file}/{number}"))) + raw
        return raw

    return edit


def copy_archive(files: DataFrame, folder: str | None = None, damage=None) -> DataFrame:
    """Copy an archive's files to another folder.  ``damage`` (file, data of a window, its offset) may change the bytes, for trials."""
    folder = folder or shared_path(files.sparkSession, "warc-replica")

    def copy(batches):
        for batch in batches:
            for row in batch.to_pylist():
                fs, inner = open_fs(row["path"])
                path = f"{folder}/{row['path'].rsplit('/', 1)[1].split('.')[0]}-{uuid.uuid4().hex}.warc.gz"
                to, to_inner = open_fs(path)
                to.create_dir(to_inner.rsplit("/", 1)[0], recursive=True)
                at = 0
                with fs.open_input_stream(inner, compression=None) as source, to.open_output_stream(to_inner, compression=None) as out:
                    while data := source.read(1 << 22):
                        out.write(damage(row["file"], data, at) if damage else data)
                        at += len(data)
                yield pa.RecordBatch.from_pylist([row | {"path": path}], schema=batch.schema)

    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_arrow(files.repartition(n), copy, FILES).checkpoint()


def compared(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Every record of two replicas (their ``leaves``) with its status: page_id, file, record, offset, length, digest, status.

    ``same`` if no branch above it differs down to it, or if it is there at another place; ``changed``; ``missing``
    in theirs; ``extra`` there.  Places, offsets and digests are ours, but for extra records, which have theirs.
    """
    found = align(ours, theirs, audit(tree(ours), tree(theirs))).checkpoint()
    out = ours.join(found.where("status <> 'extra'").select("file", "place", "status"), ["file", "place"], "left").withColumn("status", F.coalesce("status", F.lit("same")))
    extra = theirs.join(found.where("status = 'extra'").select("file", F.col("other_place").alias("place"), "status"), ["file", "place"])
    return out.unionByName(extra).select("page_id", "file", F.col("place").alias("record"), F.col("start").alias("offset"), (F.col("stop") - F.col("start")).alias("length"), "digest", "status")


def fixity(pages: DataFrame, damage_every: int = 64, edit_every: int = 97) -> DataFrame:
    """Archive ``pages``, copy the archive with planted damage, dropped and inserted records, and audit the copy: every record of both with its status."""
    files = write_archive(pages)
    replica = copy_records(files, dropped_and_inserted(edit_every, damage_every=damage_every))
    return compared(leaves(files), leaves(replica))
