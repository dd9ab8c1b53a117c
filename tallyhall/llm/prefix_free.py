"""Repeated long byte strings, by prefix-free parsing.

Every document is parsed into phrases (``parsing.Parse``).  The dictionary of
phrases and the parse are never gathered: they are dealt out by hash to
buckets, and each bucket orders its part, phrase first, then the phrase's
whole context.  In that order equal windows stand side by side:

1. A phrase that occurs once has no repeated window.
2. Phrases whose contexts (all bytes of all windows that begin with the
   phrase's trigger) are equal have repeated windows only; if no other
   context of the phrase exists, nothing more is to be known.
3. What is left, the edges of copies, is ordered window by window.

Strings are ordered by 64-bit fingerprints rather than by letters, which
keeps equal ones together all the same.

A block is some documents of ``block_bytes`` in all; it asks each bucket once
about its distinct phrases, so a very common phrase costs a bucket at most
one entry for each block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_type, partitions, saved, table, texts
from .parsing import Parse
from .tokens import slices

LENGTH = 200
BLOCK_BYTES = 2 << 20
# Answers about a phrase: repeated, its windows to be asked about, both.
REPEATED, ASK = 1, 2

ASKED = "bucket int, block bigint, body binary"
ANSWERED = "block bigint, kind int, bucket int, body binary"


def blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """Rows (block, ids, sizes, data): whole texts as compressed UTF-8."""
    src = texts(docs, id_col, text_col)
    src = src.select("doc_id", F.col("text").cast("binary").alias("text"))
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type(src))),
                           T.StructField("sizes", T.ArrayType(T.LongType(), False)), T.StructField("data", T.BinaryType())])

    def run(batches):
        number, codec = TaskContext.get().partitionId() << 32, pa.Codec("zstd")
        for batch in (x for whole in batches for x in slices(whole, "text", block_bytes)):
            parts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.ListArray.from_arrays([0, len(batch)], batch.column("doc_id")),
                 pa.array([list(map(len, parts))], pa.list_(pa.int64())),
                 pa.array([codec.compress(b"".join(parts), asbytes=True)], pa.binary())], schema.names)
            number += 1

    return src.mapInArrow(run, schema)


class _Block:
    """A block's documents, parsed."""

    def __init__(self, sizes: list[int], data: bytes, length: int):
        self.data = np.frombuffer(pa.Codec("zstd").decompress(data, decompressed_size=sum(sizes), asbytes=True), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.length = length
        self.parses = [Parse(self.data[a:b], length) for a, b in zip(self.starts[:-1], self.starts[1:], strict=True)]
        self.doc = np.repeat(np.arange(len(sizes)), [len(p.first) for p in self.parses])
        phrase = np.concatenate([p.phrase for p in self.parses]) >> np.uint64(16)
        context = np.concatenate([p.context for p in self.parses])
        order = np.lexsort((context, phrase))
        new = np.ones(len(order), bool)
        new[1:] = (phrase[order][1:] != phrase[order][:-1]) | (context[order][1:] != context[order][:-1])
        self.number = np.empty(len(order), np.int64)  # of each phrase's entry
        self.number[order] = np.cumsum(new) - 1
        self.phrase, self.context = phrase[order][new], context[order][new]
        self.many = np.bincount(self.number, minlength=len(self.phrase)) > 1
        self.lead = np.zeros(len(order), bool)
        self.lead[order[new]] = True  # one phrase of each entry

    def entries(self, n_buckets: int):
        """(bucket, body) of the phrase entries."""
        for k, own in _dealt(self.phrase, n_buckets):
            yield k, b"".join([np.packbits(self.many[own]).tobytes(), self.context[own].tobytes(),
                               np.ascontiguousarray(self.phrase[own].view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()])

    def answers(self, bodies: dict[int, bytes], n_buckets: int) -> np.ndarray:
        """The answer to each phrase."""
        out = np.zeros(len(self.phrase), np.uint8)
        for k, own in _dealt(self.phrase, n_buckets):
            out[own] = np.frombuffer(_unpacked(bodies[k], len(own)), np.uint8)
        return out[self.number]

    def asked_windows(self, answer: np.ndarray):
        """(starts in the block, hashes, whether known to be repeated) of the
        windows to ask about; a repeated phrase asks once."""
        repeated = answer & REPEATED > 0
        ask = (answer & ASK > 0) & (~repeated | self.lead)
        starts, hashes, sure, low = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, bool)], 0
        for i, p in enumerate(self.parses):
            own = np.flatnonzero(ask[low:low + len(p.first)])
            if len(own):
                at = p.windows(own)
                starts.append(at + self.starts[i])
                hashes.append(p.hashes.of(at, at + self.length))
                sure.append(np.repeat(repeated[low + own], (p.last - p.first + 1)[own]))
            low += len(p.first)
        return np.concatenate(starts), np.concatenate(hashes), np.concatenate(sure)

    def repeated_windows(self, answer: np.ndarray) -> np.ndarray:
        out, low = [np.zeros(0, np.int64)], 0
        for i, p in enumerate(self.parses):
            own = np.flatnonzero(answer[low:low + len(p.first)] & REPEATED)
            out.append(p.windows(own) + self.starts[i])
            low += len(p.first)
        return np.concatenate(out)


def _packed(x: bytes) -> bytes:
    return pa.Codec("zstd").compress(x, asbytes=True)


def _unpacked(x: bytes, size: int) -> bytes:
    return pa.Codec("zstd").decompress(x, decompressed_size=size, asbytes=True) if size else b""


def _dealt(keys: np.ndarray, n_buckets: int):
    """(bucket, places of its keys) of the buckets that have some."""
    bucket = (keys % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    if not len(order):
        return
    cuts = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]]))
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def _bodies(group: pa.Table, width: int):
    """Entry counts and parts of a bucket's bodies: flags, then 8 bytes an
    entry, then ``width`` bytes an entry."""
    sizes, flags, first, second = [], [], [], []
    for body in group.column("body").to_pylist():
        n = next(k for k in (len(body) * 8 // (8 * (8 + width) + 1) + d for d in (-1, 0, 1)) if -(-k // 8) + (8 + width) * k == len(body))
        at = -(-n // 8)
        sizes.append(n)
        flags.append(np.unpackbits(np.frombuffer(body, np.uint8, at), count=n).astype(bool))
        first.append(np.frombuffer(body, "<u8", n, at))
        if width:
            x = np.zeros((n, 8), np.uint8)
            x[:, :width] = np.frombuffer(body, np.uint8, width * n, at + 8 * n).reshape(n, width)
            second.append(x.view("<u8").ravel())
    return sizes, np.concatenate(flags), np.concatenate(first), np.concatenate(second) if width else None


def _reply(group: pa.Table, kind: int, sizes: list[int], answer: np.ndarray) -> pa.Table:
    ends = np.cumsum(sizes)
    out = [_packed(answer[e - n:e].tobytes()) for n, e in zip(sizes, ends, strict=True)]
    n = group.num_rows
    return pa.table({"block": group.column("block"), "kind": pa.array(np.full(n, kind, np.int32)), "bucket": group.column("bucket"),
                     "body": pa.array(out, pa.binary())})


def _about_phrases(group: pa.Table) -> pa.Table:
    sizes, many, context, phrase = _bodies(group, 6)
    order = np.lexsort((context, phrase))
    p, c = phrase[order], context[order]
    new_phrase = np.concatenate([[True], p[1:] != p[:-1]])
    new = new_phrase | np.concatenate([[True], c[1:] != c[:-1]])
    entry, of = np.cumsum(new) - 1, np.cumsum(new_phrase) - 1
    count = np.bincount(entry, weights=1 + many[order])
    contexts = np.bincount(of[new])
    repeated, others = count[entry] > 1, contexts[of] > 1
    answer = np.empty(len(order), np.uint8)
    answer[order] = REPEATED * repeated + ASK * (others & (~repeated | new))
    return _reply(group, 1, sizes, answer)


def _about_windows(group: pa.Table) -> pa.Table:
    sizes, sure, window, _ = _bodies(group, 0)
    _, entry = np.unique(window, return_inverse=True)
    repeated = np.bincount(entry, weights=1 + sure)[entry] > 1
    return _reply(group, 2, sizes, repeated.astype(np.uint8))


def _with_answers(cut: DataFrame, answers: DataFrame) -> DataFrame:
    """Each block with its answers: one from each bucket and kind at most."""
    return cut.join(answers.groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", "body")).alias("answers")), "block", "left")


def _rows(batches):
    for batch in batches:
        yield from batch.to_pylist()


def _by_bucket(row, kind: int) -> dict[int, bytes]:
    return {x["bucket"]: x["body"] for x in row["answers"] or [] if x["kind"] == kind}


def repeated_spans(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per document: n_bytes, spans (array of start, stop; the maximal runs
    of bytes that a repeated string of ``length`` bytes covers) and kept (the
    other bytes).

    Strings lie within one document and are judged on the input.  A null or
    empty text has no bytes; repeated rows are copies of each other; an empty
    table gives no rows.  A block's memory grows with its longest text."""
    n_buckets = partitions(docs.sparkSession)
    cut = saved(blocks(docs, id_col, text_col, block_bytes), "blocks")

    def ask(batches):
        for row in _rows(batches):
            b = _Block(row["sizes"], row["data"], length)
            found = list(b.entries(n_buckets))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([row["block"]] * len(found), pa.int64()),
                                              pa.array([x for _, x in found], pa.binary())], ["bucket", "block", "body"])

    def ask_again(batches):
        for row in _rows(batches):
            b = _Block(row["sizes"], row["data"], length)
            _, hashes, sure = b.asked_windows(b.answers(_by_bucket(row, 1), n_buckets))
            window, entry = np.unique(hashes, return_inverse=True)
            twice = np.bincount(entry, weights=1 + sure, minlength=len(window)) > 1
            found = [(k, np.packbits(twice[own]).tobytes() + window[own].tobytes()) for k, own in _dealt(window, n_buckets)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([row["block"]] * len(found), pa.int64()),
                                              pa.array([x for _, x in found], pa.binary())], ["bucket", "block", "body"])

    about = saved(cut.select("block", "sizes", "data").mapInArrow(ask, ASKED).groupBy("bucket").applyInArrow(_about_phrases, ANSWERED), "phrases")
    asked = _with_answers(cut.select("block", "sizes", "data"), about).mapInArrow(ask_again, ASKED)
    windows = saved(asked.groupBy("bucket").applyInArrow(_about_windows, ANSWERED), "windows")
    schema = T.StructType([T.StructField("doc_id", cut.schema["ids"].dataType.elementType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))),
                           T.StructField("kept", T.BinaryType())])

    def remove(batches):
        for row in _rows(batches):
            b = _Block(row["sizes"], row["data"], length)
            answer = b.answers(_by_bucket(row, 1), n_buckets)
            starts, hashes, _ = b.asked_windows(answer)
            window, entry = np.unique(hashes, return_inverse=True)
            known, bodies = np.zeros(len(window), bool), _by_bucket(row, 2)
            for k, own in _dealt(window, n_buckets):
                known[own] = np.frombuffer(_unpacked(bodies[k], len(own)), np.uint8) > 0
            at = np.concatenate([b.repeated_windows(answer), starts[known[entry]]])
            edge = np.bincount(at, minlength=len(b.data) + 1) - np.bincount(at + length, minlength=len(b.data) + 1)
            gone = np.cumsum(edge)[:-1] > 0
            spans, kept = [], []
            for low, high in zip(b.starts[:-1].tolist(), b.starts[1:].tolist(), strict=True):
                own = gone[low:high]
                turns = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                spans.append([{"start": x, "stop": y} for x, y in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True)])
                kept.append(b.data[low:high][~own].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa_id), pa.array(row["sizes"], pa.int64()), pa.array(spans, pa_spans), pa.array(kept, pa.binary())], schema.names)

    from pyspark.sql.pandas.types import to_arrow_type

    pa_id, pa_spans = to_arrow_type(schema["doc_id"].dataType), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    return _with_answers(cut, about.union(windows)).mapInArrow(remove, schema)


def op5_prefix_free_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeated_spans(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
