"""Token ids of documents as ORC files.

Documents are dealt out by ranges of doc_id and sorted, so every file holds
one range.  ORC run-length encodes the integers; each stripe has a row index
every ``row_stride`` rows and Bloom filters on doc_id, so a read of a few
documents skips files, stripes and row groups by their metadata, and a whole
read is split by stripes.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_type, partitions, scratch, texts
from .tokens import encoder, slices

END_ID = 2


def _file_schema(kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("doc_id", kind), T.StructField("part", T.IntegerType()),
                         T.StructField("part_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                         T.StructField("ids", T.ArrayType(T.IntegerType(), False))])


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text", stripe_bytes: int = 16 << 20, row_stride: int = 1000,
                 n_files: int | None = None) -> None:
    """Write the ids of every whole text, ``end_id`` last, in ascending order
    of doc_id (null ids first; equal ids by a hash of their texts).

    A null or empty text has the end id alone; an empty table gives a folder
    without rows; repeated rows are each written.  ``part`` and
    ``part_start`` are the file's number and the ids before the row in it."""
    src = texts(docs, id_col, text_col)
    n = n_files or partitions(docs.sparkSession)
    tie = F.xxhash64("text")
    ranged = src.repartitionByRange(n, "doc_id", tie).sortWithinPartitions("doc_id", tie)

    def encode(batches):
        enc, part, start = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in (x for whole in batches for x in slices(whole, "text")):
            values, upto = enc.batch(batch.column("text"), end_id)
            ids = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(values.view("<i4")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.full(len(batch), part, np.int32)),
                                              pa.array(start + upto[:-1]), pa.array(np.diff(upto)), ids],
                                             ["doc_id", "part", "part_start", "n_tokens", "ids"])
            start += int(upto[-1])

    (ranged.mapInArrow(encode, _file_schema(id_type(src))).write
     .option("orc.compress", "ZSTD").option("orc.stripe.size", stripe_bytes)
     .option("orc.create.index", "true").option("orc.row.index.stride", row_stride)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path))


def read_tokens(spark: SparkSession, path: str, doc_type: T.DataType | None = None) -> DataFrame:
    """The files' rows; filters on doc_id reach stripes and row groups."""
    return spark.read.schema(_file_schema(doc_type or T.LongType())).orc(path)


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds ``start``: ids of all documents before the row, over all files.
    The broadcast side has one row per written file."""
    w = "sum(ids_in_part) over (order by part rows between unbounded preceding and 1 preceding)"
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("ids_in_part"))
    before = sizes.select("part", F.expr(f"coalesce({w}, 0)").alias("before"))
    return rows.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("part_start"))


def crc32_of_ids(rows: DataFrame, keep: list[str], ids: str = "ids", name: str = "ids_crc32") -> DataFrame:
    """``keep`` and the unsigned crc32 of the ids as little-endian u32."""
    schema = T.StructType([*[rows.schema[k] for k in keep], T.StructField(name, T.LongType())])

    def crc(batches):
        for batch in batches:
            col = batch.column(ids)
            values = np.ascontiguousarray(col.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False))
            ends = col.offsets.to_numpy()
            view = memoryview(values).cast("B")
            sums = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(sums, pa.int64())], [*keep, name])

    return rows.select(*keep, ids).mapInArrow(crc, schema)


def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch(spark, "tokens-orc")
    write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    rows = with_starts(read_tokens(spark, path, id_type(docs)))
    return crc32_of_ids(rows, ["doc_id", "start", "n_tokens"])
