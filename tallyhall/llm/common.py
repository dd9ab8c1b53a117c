"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OWN: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder in ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a folder of its
    own; elsewhere a missing setting is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="tallyhall-llm-"))
        root = _OWN[0]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, schema: T.StructType | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: lineage
    is cut, a lost executor costs no earlier step."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", null_as: str | None = "") -> DataFrame:
    """``doc_id`` and ``text`` only, whatever other columns ``df`` has."""
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).alias("doc_id"),
                     (F.coalesce(text, F.lit(null_as)) if null_as is not None else text).alias("text"))


def lower_az(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, UPPER, UPPER.lower())


def bucket(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n (a null id: 0)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % n, F.lit(0).cast("bigint"))


def id_type(df: DataFrame, name: str = "doc_id") -> T.DataType:
    return df.schema[name].dataType


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
