"""Co-partitioned storage of tables that are joined again and again.

Events and participants in the same number of buckets of the event id, sorted
in each, are joined where they lie, without an exchange; so are aggregates
on the event.  Bucketed tables are catalogue tables; their files are in the
warehouse, which the cluster shares.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """``df`` as a catalogue table in ``buckets`` buckets of ``key``.  Rows
    are dealt out by the bucket first, so each bucket is one file.

    A key with more rows than a task should hold makes its bucket as large;
    give the tables more buckets, or leave such tables to the planner's
    exchanges, which split a hot key."""
    (df.repartition(buckets, F.col(key)).sortWithinPartitions(key)
     .write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("compression", "snappy").saveAsTable(table))


def write_copartitioned(tables: Mapping[str, DataFrame], prefix: str, key: str = "event_id", buckets: int | None = None) -> dict[str, str]:
    """Every table in the same buckets; its catalogue name by logical name."""
    names = {}
    for name, df in tables.items():
        names[name] = f"{prefix}_{name}"
        write_bucketed(df, names[name], key, buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return names


def read_copartitioned(spark: SparkSession, names: Mapping[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.table(table) for name, table in names.items()}
