"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of about ``FRAME`` bytes,
cut between code points, each with the number of units that start before its
end.  A unit is a run of letters A-Z or a-z, or any other code point; a run
may go over into the next frame, it counts where it starts.  So a cut after
any number of units is found by its frame alone: the cumulative counts name
the frame, and only that one is decompressed to find the byte.

The transformed text is written into frames again, by streaming the frames of
its parts in their new order; digests stream those output frames, and the
original is rebuilt from the output and its form, by the markers' places.  At
most a few frames are open at a time, however long a text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_type, scratch, table
from .tokens import slices

FRAME = 64 << 10
LEVEL = 1
SALT = "1:"
PLAIN_SHARE, SPM_SHARE = 10, 20  # of a hundred
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

_LETTER = np.zeros(256, bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True
_START = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point


def unit_starts(data: np.ndarray, inside: bool = False) -> np.ndarray:
    """Which bytes start a unit; ``inside``: the byte before is a letter."""
    letter = _LETTER[data]
    after = np.empty(len(data), bool)
    if len(data):
        after[0], after[1:] = inside, letter[:-1]
    return _START[data] & ~(letter & after)


def frame_ends(data: bytes | memoryview, size: int) -> list[int]:
    """Ends of pieces of about ``size`` bytes (4 at least), each between two
    code points."""
    ends, at, n = [], 0, len(data)
    while n - at > size:
        cut = at + size
        while cut > at + size - 4 and not _START[data[cut]]:
            cut -= 1
        at = cut if _START[data[cut]] else at + size  # no UTF-8: anywhere
        ends.append(at)
    return [*ends, n] if n else ends


class Frames:
    """A text's frames with their cumulative numbers of units and bytes, read
    by byte range; the frame read last is kept."""

    def __init__(self, blobs, units, ends):
        self.blobs, self.units, self.ends = blobs, units, ends
        self.n = units[-1] if len(units) else 0
        self.size = ends[-1] if len(ends) else 0
        self._open, self._data = -1, b""

    def frame(self, i: int) -> bytes:
        if i != self._open:
            self._open, self._data = i, zstandard.ZstdDecompressor().decompress(self.blobs[i])
        return self._data

    def byte_of(self, k: int) -> int:
        """The byte at which unit number ``k`` starts (the end for the last)."""
        if k >= self.n:
            return self.size
        i = int(np.searchsorted(self.units, k, side="right"))
        before, begin = (self.units[i - 1], self.ends[i - 1]) if i else (0, 0)
        data = np.frombuffer(self.frame(i), np.uint8)
        found = np.flatnonzero(unit_starts(data))
        # A run that came over from the frame before starts no unit here.
        return int(begin + found[k - before + len(found) - (self.units[i] - before)])

    def read(self, low: int, high: int) -> Iterator[bytes]:
        i = int(np.searchsorted(self.ends, low, side="right"))
        while low < high:
            begin = self.ends[i - 1] if i else 0
            yield self.frame(i)[low - begin:high - begin]
            low, i = self.ends[i], i + 1

    def chars(self, low: int, high: int) -> int:
        return sum(int(_START[np.frombuffer(x, np.uint8)].sum()) for x in self.read(low, high))


def pressed(chunks: Iterator[bytes], size: int, press) -> tuple[list[bytes], list[int]]:
    """Frames of the joined chunks and their byte ends, ``size`` bytes each."""
    blobs, ends, held, done = [], [], b"", 0
    for chunk in chunks:
        held += chunk
        while len(held) > size:
            cut = frame_ends(held[:size + 4], size)[0]
            blobs.append(press(held[:cut]))
            done += cut
            ends.append(done)
            held = held[cut:]
    if held:
        blobs.append(press(held))
        ends.append(done + len(held))
    return blobs, ends


def _store_type(kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("doc_id", kind), T.StructField("frames", T.ArrayType(T.BinaryType())),
                         T.StructField("units", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType()))])


def write_frames(docs: DataFrame, path: str, size: int = FRAME, id_col: str = "doc_id", text_col: str = "text") -> None:
    """One row for each document: its frames, and for each frame the units
    and bytes up to its end.  A null or empty text has no frames; repeated
    rows are each stored; an empty table gives a folder without rows."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    schema = _store_type(id_type(src))

    def run(batches):
        press = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in (x for whole in batches for x in slices(whole, "text")):
            column = batch.column("text").cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
            offsets = offsets - offsets[0]
            starts = unit_starts(data)
            heads = offsets[:-1][np.diff(offsets) > 0]
            starts[heads] = True  # a text's first byte starts a unit whatever the text before it ends with
            upto = np.concatenate([[0], np.cumsum(starts)])
            view = memoryview(data)
            blobs, units, ends, per = [], [], [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                cuts = frame_ends(view[a:b], size)
                low = a
                for c in cuts:
                    blobs.append(press(view[low:a + c]))
                    low = a + c
                units.extend((upto[[a + c for c in cuts]] - upto[a]).tolist())
                ends.extend(cuts)
                per.append(len(cuts))
            cut = pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.ListArray.from_arrays(cut, pa.array(blobs, pa.binary())),
                pa.ListArray.from_arrays(cut, pa.array(units, pa.int64())), pa.ListArray.from_arrays(cut, pa.array(ends, pa.int64()))], schema.names)

    src.mapInArrow(run, schema).write.option("compression", "uncompressed").parquet(path)


def read_frames(spark: SparkSession, path: str, doc_type: T.DataType | None = None) -> DataFrame:
    return spark.read.schema(_store_type(doc_type or T.LongType())).parquet(path)


def holds_marker(text: Frames) -> bool:
    """Whether a marker stands in the text, over frame borders too."""
    tail = b""
    for chunk in text.read(0, text.size):
        here = tail + chunk[:2]
        if any(m in chunk or m in here for m in (PREFIX, SUFFIX, MIDDLE)):
            return True
        tail = (tail + chunk)[-2:]
    return False


def plan(doc_id, text: Frames, salt: str = SALT) -> tuple[str, int, int]:
    """(form, byte end of the prefix, byte end of the middle)."""
    digest = hashlib.sha256(f"{salt}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text.n or h[2] % 100 >= 100 - PLAIN_SHARE or holds_marker(text):
        return "plain", 0, 0
    low, high = sorted((h[0] % (text.n + 1), h[1] % (text.n + 1)))
    return ("spm" if h[3] % 100 < SPM_SHARE else "psm"), text.byte_of(low), text.byte_of(high)


def output(text: Frames, form: str, a: int, b: int) -> Iterator[bytes]:
    """The transformed text, streamed frame by frame."""
    if form == "plain":
        yield from text.read(0, text.size)
        return
    parts = [(PREFIX, 0, a), (SUFFIX, b, text.size), (MIDDLE, a, b)]
    for mark, low, high in parts if form == "psm" else [parts[1], parts[0], parts[2]]:
        yield mark
        yield from text.read(low, high)


def _find(out: Frames, mark: bytes, low: int) -> int:
    """The first place of ``mark`` at or after ``low``."""
    tail, at = b"", low
    for chunk in out.read(low, out.size):
        held = tail + chunk
        found = held.find(mark)
        if found >= 0:
            return at - len(tail) + found
        at += len(chunk)
        tail = held[-2:]
    raise ValueError(f"the text has no {mark!r}")


def restored(out: Frames, form: str) -> Iterator[bytes]:
    """The original text from the transformed one and its form alone: no part
    has a marker, so each marker's first place is its own."""
    if form == "plain":
        yield from out.read(0, out.size)
        return
    first, second = (SUFFIX, MIDDLE) if form == "psm" else (PREFIX, MIDDLE)
    one = _find(out, first, 3)
    two = _find(out, second, one + 3)
    head, inner, last = (3, one), (one + 3, two), (two + 3, out.size)
    for low, high in (head, last, inner) if form == "psm" else (inner, last, head):
        yield from out.read(low, high)


def _sha256(chunks: Iterator[bytes]) -> str:
    h = hashlib.sha256()
    for x in chunks:
        h.update(x)
    return h.hexdigest()


def transformed(store: DataFrame, give: str = "text", size: int = FRAME) -> DataFrame:
    """Rows (doc_id, n, form, prefix_chars, middle_chars) of every stored
    document, and by ``give``: ``output`` (the text), ``frames`` and ``ends``
    (the text in frames), or ``output_sha256`` and ``restored_sha256``
    (digests of the output's frames and of the text rebuilt from them).

    A text that is empty or holds a marker is plain and has null lengths; a
    null id is hashed as the empty string."""
    more = {"text": [("output", T.StringType())],
            "frames": [("frames", T.ArrayType(T.BinaryType())), ("ends", T.ArrayType(T.LongType()))],
            "digest": [("output_sha256", T.StringType()), ("restored_sha256", T.StringType())]}[give]
    schema = T.StructType([store.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                           *[T.StructField(n, t) for n, t in more]])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        to, press = to_arrow_schema(schema), zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in (x for whole in batches for x in _few(whole, "frames")):
            rows = []
            units, ends = batch.column("units"), batch.column("ends")
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                blobs = [b.as_buffer() for b in batch.column("frames")[i].values or []]
                text = Frames(blobs, units[i].values.to_numpy().tolist(), ends[i].values.to_numpy().tolist())
                form, a, b = plan(doc_id, text)
                row = [text.n, form, *((None, None) if form == "plain" else (text.chars(0, a), text.chars(a, b)))]
                if give == "text":
                    row.append(b"".join(output(text, form, a, b)).decode("utf-8", "replace"))
                else:
                    held, upto = pressed(output(text, form, a, b), size, press)
                    out = Frames(held, [], upto)
                    row += [held, upto] if give == "frames" else [_sha256(out.read(0, out.size)), _sha256(restored(out, form))]
                rows.append(row)
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(to)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], schema=to)

    return store.select("doc_id", "frames", "units", "ends").mapInArrow(run, schema)


def _few(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    """Row ranges whose frames have about ``limit`` bytes."""
    lists = batch.column(column)
    sizes = np.concatenate([[0], np.cumsum(pc.binary_length(lists.flatten()).to_numpy(zero_copy_only=False))])
    upto = sizes[np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)]
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(upto, upto[low] + limit, side="right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def op12_seekable_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch(spark, "fim-frames")
    write_frames(docs, path)
    return transformed(read_frames(spark, path, id_type(docs)), "digest")


OP12_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    [CAST('0x' || substr(sha256('{SALT}' || coalesce(CAST(doc_id AS VARCHAR), '')), 8 * i + 1, 8) AS BIGINT) for i in [0, 1, 2, 3]] AS h
  FROM documents),
c AS (
  SELECT doc_id, t, u, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= {100 - PLAIN_SHARE} THEN 'plain'
         WHEN h[4] % 100 < {SPM_SHARE} THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix
  FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p"""
