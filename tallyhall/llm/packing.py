"""Best-fit packing by large-item matching.

Only the number of pieces of each length decides a packing, and there are at
most ``capacity`` lengths, so the plan is made from a histogram of bounded
size: lengths above a third of the capacity are matched in pairs (three never
fit), then each smaller length fills the tightest gaps that are left.  The
plan names, for each length, which ranks of its pieces go to which sequences.
A piece's rank among those of its length comes from counts by written part,
never from a sort of one length in one task.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import id_type, saved, texts
from .token_orc import END_ID
from .tokens import encoder, slices

CAPACITY = 1024


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first_rank, n, first_sequence, per_sequence, offset): the
    pieces of that length with ranks first_rank .. first_rank+n-1 go
    ``per_sequence`` to each sequence from first_sequence on, at offset."""
    left = {k: v for k, v in counts.items() if v > 0}
    ranks: dict[int, int] = defaultdict(int)
    plan: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first sequence, how many)
    n_sequences = 0

    def put(length: int, n: int, first: int, each: int, offset: int) -> None:
        plan.append((length, ranks[length], n, first, each, offset))
        ranks[length] += n
        left[length] -= n

    def opened(n: int) -> int:
        nonlocal n_sequences
        n_sequences += n
        return n_sequences - n

    large = sorted((k for k in left if 3 * k > capacity), reverse=True)
    for a in large:
        partners = [b for b in large if b <= min(a, capacity - a)]
        while left[a]:
            b = next((b for b in partners if left[b] and (b != a or left[a] > 1)), None)
            n = left[a] if b is None else left[a] // 2 if b == a else min(left[a], left[b])
            first = opened(n)
            put(a, n, first, 1, 0)
            if b is not None:
                put(b, n, first, 1, a)
            gaps[capacity - a - (b or 0)].append((first, n))
    for s in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        for gap in range(s, capacity):
            each, kept = gap // s, []
            for first, m in gaps.pop(gap, []) if left[s] else []:
                full = min(m, left[s] // each)
                rest = min(left[s] - full * each, each) if full < m else 0
                if full:
                    put(s, full * each, first, each, capacity - gap)
                    gaps[gap - each * s].append((first, full))
                if rest:
                    put(s, rest, first + full, rest, capacity - gap)
                    gaps[gap - rest * s].append((first + full, 1))
                if m > full + (rest > 0):
                    kept.append((first + full + (rest > 0), m - full - (rest > 0)))
            if kept:
                gaps[gap] = [*gaps[gap], *kept]
            if not left[s]:
                break
        each = capacity // s
        if full := left[s] // each:
            first = opened(full)
            put(s, full * each, first, each, 0)
            gaps[capacity - each * s].append((first, full))
        if rest := left[s]:
            first = opened(1)
            put(s, rest, first, rest, 0)
            gaps[capacity - rest * s].append((first, 1))
    return plan


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document's ids (null text: the end id alone), as
    little-endian unsigned 32-bit integers.  A
    document longer than the capacity is cut: its first piece takes what is
    over a multiple of the capacity.  ``rank`` counts the pieces of a length
    within ``part``, the writing task."""
    src = texts(docs, id_col, text_col)
    schema = T.StructType([T.StructField("doc_id", id_type(src)), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("part", T.IntegerType()), T.StructField("rank", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    def cut(batches):
        enc, part, seen = encoder(tokenizer_path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in (x for whole in batches for x in slices(whole, "text")):
            values, upto = enc.batch(batch.column("text"), end_id)
            n = np.diff(upto)
            k = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), k)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(k) - k, k)
            head = n - (k - 1) * capacity
            length = np.where(piece == 0, head[doc], capacity)
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
            order = np.argsort(length, kind="stable")
            by = length[order]
            rank = np.empty(len(doc), np.int64)
            rank[order] = seen[by] + np.arange(len(by)) - np.searchsorted(by, by)
            seen += np.bincount(length, minlength=capacity + 1)
            ends = np.concatenate([[0], 4 * np.cumsum(length)]).astype(np.int32)
            ids = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends), pa.py_buffer(values)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                 pa.array(length), pa.array(np.full(len(doc), part, np.int32)), pa.array(rank), ids], schema.names)

    return src.mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its ids, ``sequence_id`` and ``offset``.

    Sequences are numbered from 0 and filled without gaps from offset 0.
    Repeated rows are packed each; an empty table gives no rows."""
    cut = saved(pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col), "pieces")
    by_part = saved(cut.groupBy("part", "length").agg(F.count("*").alias("n")).repartition("length"), "piece-counts")
    counts = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    plan = sorted(plan_packing(counts, capacity)) or [(0, 0, 0, 0, 1, 0)]
    lengths, ranks, _, firsts, each, offsets = (np.array(x, np.int64) for x in zip(*plan, strict=True))
    keys = (lengths << 44) + ranks
    w = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("part", "length", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    ranked = cut.join(before, ["part", "length"]).withColumn("rank", F.col("before") + F.col("rank"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
        nth = rank - ranks[at]
        return pd.DataFrame({"sequence_id": firsts[at] + nth // each[at], "offset": offsets[at] + nth % each[at] * length})

    placed = ranked.withColumn("place", place("length", "rank"))
    return placed.select("doc_id", "piece", "start", "length", "place.sequence_id", "place.offset", "ids")


def packed_digest(docs: DataFrame) -> DataFrame:
    """Where each piece of ``docs`` is, with the crc32 of its ids."""
    import public_tokenizers

    packed = pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
