"""Fill-in-the-middle transformation with piece tables.

A document is never edited as a string.  It becomes a piece table: descriptors (buffer, start, stop) over
two immutable buffers, the text's bytes and the sentinels.  Cutting splits the text's one descriptor at two
line ends, an arrangement permutes the descriptors (with the sentinels' among them), and hashes stream the
descriptors in order.  Only ``rendered`` joins them to an output text.  ``restore`` goes the other way: it
finds the sentinels of an output, describes what is between them, and applies the inverse permutation.

Units are lines with their end, found by bytes; lengths count code points.  The two cuts, the form and
whether a document is rearranged at all come from the sha256 of ``seed:doc_id``, so reruns and retries agree.
All work is a row's own: nothing is shuffled, and a task holds one batch of texts.

Null text counts as empty.  Empty texts and texts that contain a sentinel stay plain: output and text are
equal.  A null doc_id is hashed as the word ``null``; repeated rows are transformed alike, a row for each; a
very long text costs its bytes once as text and once as output.  An empty table gives no rows.  Only
``doc_id`` and ``text`` are read, whatever other columns exist.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import map_arrow

SEED = 7
FIM_PERCENT = 100  # of the documents that can be rearranged
SPM_PERCENT = 50   # of the rearranged
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
TEXT, SENTINEL = 0, 1

PIECES = "array<struct<buffer:int,start:long,stop:long>>"
ARRANGED = f"doc_id long, n long, form string, prefix_chars long, middle_chars long, pieces {PIECES}, output string, output_sha256 string"
RESTORED = "doc_id long, restored string, restored_sha256 string"


class Piece(NamedTuple):
    """Bytes start to stop of a buffer."""

    buffer: int
    start: int
    stop: int

    def split(self, at: int) -> tuple[Piece, Piece]:
        """The piece before and from ``at`` (an offset in the buffer)."""
        return Piece(self.buffer, self.start, at), Piece(self.buffer, at, self.stop)


P, S, M = (Piece(SENTINEL, k, k + 3) for k in (0, 3, 6))
#: Form: what stands at each place; numbers are the pieces of the cut text (prefix, middle, suffix).
ARRANGEMENTS = {"psm": (P, 0, S, 2, M, 1), "spm": (S, 2, P, 0, M, 1)}


def arrange(parts: tuple[Piece, Piece, Piece], form: str) -> list[Piece]:
    """The permutation of a form, with its sentinels."""
    return [parts[x] if isinstance(x, int) else x for x in ARRANGEMENTS[form]]


def line_ends(data: np.ndarray) -> np.ndarray:
    """Offset behind each line; the last line may lack its line break."""
    ends = np.flatnonzero(data == 10) + 1
    return ends if not len(data) or len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


def chars(data: np.ndarray) -> int:
    """Code points in UTF-8 bytes."""
    return int(len(data) - np.count_nonzero((data & 0xC0) == 0x80))


def numbers(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four unsigned 32-bit numbers of a document."""
    digits = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[8 * k:8 * k + 8], 16) for k in range(4)]


def stream(pieces: list[Piece], buffers: tuple[memoryview, memoryview]):
    for x in pieces:
        yield buffers[x.buffer][x.start:x.stop]


def sha256(pieces: list[Piece], buffers) -> str:
    """Of what the pieces describe, without joining it."""
    state = hashlib.sha256()
    for part in stream(pieces, buffers):
        state.update(part)
    return state.hexdigest()


def describe(doc_id: int | None, text, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT):
    """(n, form, prefix_chars, middle_chars, pieces) of a document, given as bytes."""
    data = np.frombuffer(text, np.uint8)
    ends = line_ends(data)
    n, whole = len(ends), Piece(TEXT, 0, len(data))
    h = numbers(doc_id, seed)
    raw = bytes(text)
    if not n or any(x in raw for x in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= fim_percent:
        return n, "plain", None, None, [whole]
    offsets = np.append(0, ends)
    a, b = (int(offsets[k]) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    prefix, rest = whole.split(a)
    middle, suffix = rest.split(b)
    form = "spm" if h[3] % 100 < spm_percent else "psm"
    return n, form, chars(data[:a]), chars(data[a:b]), arrange((prefix, middle, suffix), form)


def original(output: bytes, form: str) -> list[Piece]:
    """The pieces of the text in an output: the places between its sentinels, in the inverse permutation."""
    whole = Piece(TEXT, 0, len(output))
    if form == "plain":
        return [whole]
    order, found, at = ARRANGEMENTS[form], {}, 0
    marks = [x for x in order if not isinstance(x, int)]
    starts = []
    for mark in marks:  # neither text nor a text's border with a sentinel can hold one, so the first is the right one
        at = output.index(SENTINELS[mark.start:mark.stop], at)
        starts.append(at)
        at += mark.stop - mark.start
    parts = [x for x in order if isinstance(x, int)]
    for part, mark, start, stop in zip(parts, marks, starts, [*starts[1:], len(output)]):
        found[part] = Piece(TEXT, start + mark.stop - mark.start, stop)
    return [found[k] for k in sorted(found)]


def rendered(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Arrange ``docs`` (doc_id, text): the columns of ``ARRANGED``, with the pieces in order and the output that they describe."""

    def work(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_buffer() if text.is_valid else pa.py_buffer(b"")
                n, form, before, middle, pieces = describe(doc_id, data, seed, fim_percent, spm_percent)
                buffers = memoryview(data), memoryview(SENTINELS)
                rows.append((doc_id, n, form, before, middle, [x._asdict() for x in pieces], b"".join(stream(pieces, buffers)), sha256(pieces, buffers)))
            columns = list(zip(*rows)) if rows else [[]] * 8
            piece = pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())])
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(piece), pa.binary(), pa.string()]
            arrays = [pa.array(x, t) for x, t in zip(columns, kinds)]
            arrays[6] = arrays[6].cast(pa.string(), safe=False)
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "pieces", "output", "output_sha256"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")), work, ARRANGED)


def restored(outputs: DataFrame) -> DataFrame:
    """The texts again, from ``output`` and ``form`` alone, with every other column kept."""
    kept = [c for c in outputs.columns if c not in ("output", "restored", "restored_sha256")]

    def work(batches):
        for batch in batches:
            texts, digests = [], []
            for form, output in zip(batch.column(1).to_pylist(), batch.column(2)):
                data = output.as_py() or b""
                pieces = original(data, form)
                buffers = memoryview(data), memoryview(SENTINELS)
                texts.append(b"".join(stream(pieces, buffers)))
                digests.append(sha256(pieces, buffers))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string(), safe=False), pa.array(digests, pa.string())], names=["kept", "restored", "restored_sha256"])

    rows = outputs.select(F.struct(*kept).alias("kept"), "form", F.col("output").cast("binary").alias("output"))
    out = map_arrow(rows, work, f"kept {rows.schema['kept'].dataType.simpleString()}, restored string, restored_sha256 string")
    return out.select("kept.*", "restored", "restored_sha256")


def digest(docs: DataFrame) -> DataFrame:
    """The columns of query op11: every output is hashed from its pieces, and restored from the output itself."""
    return restored(rendered(docs).drop("pieces")).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units FROM d),
k AS (SELECT *, CAST(len(units) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM u),
f AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                     WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM k),
p AS (SELECT *, array_to_string(list_slice(units, 1, a), '') AS prefix, array_to_string(list_slice(units, a + 1, b), '') AS middle,
             array_to_string(list_slice(units, b + 1, n), '') AS suffix FROM f),
o AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output FROM p),
r AS (SELECT *, strpos(output, '<P>') AS at_p, strpos(output, '<S>') AS at_s, strpos(output, '<M>') AS at_m FROM o)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
                        WHEN 'psm' THEN substr(output, 4, at_s - 4) || substr(output, at_m + 3) || substr(output, at_s + 3, at_m - at_s - 3)
                        ELSE substr(output, at_p + 3, at_m - at_p - 3) || substr(output, at_m + 3) || substr(output, 4, at_p - 4) END) AS restored_sha256
FROM r
"""
