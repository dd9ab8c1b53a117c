"""Writers.  Output paths are shared storage on a cluster.  Partitioned
tables are rebalanced on their partition columns, so AQE makes as many write
tasks for a partition as its size needs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with a rebalance on ``columns``: AQE splits a large partition
    into several tasks and joins small ones."""
    return df.sparkSession.sql(f"SELECT /*+ REBALANCE({', '.join(columns)}) */ * FROM {{df}}", df=df)


def clustered(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` dealt out by ranges of ``columns`` (nulls last) and sorted in
    each, so the files follow each other in that order and a filter on the
    first columns skips files and row groups.  Give a column that splits a
    hot value last; AQE joins ranges that are small."""
    order = [F.col(c).asc_nulls_last() for c in columns]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_fact_parquet(fact: DataFrame, path: str, partition_col: str = "event_year_month", date_col: str = "event_startdate",
                       max_records_per_file: int = 5_000_000, cluster_by: list[str] | None = None) -> None:
    """Snappy parquet partitioned by event month, with a manifest; replaces
    the whole folder, months that are no longer there included."""
    from .tables import replace_table

    replace_table(fact, path, partition_col, date_col, cluster_by, max_records_per_file)


def write_csv(df: DataFrame, path: str) -> None:
    """Header, RFC-style quoting with doubled quotes, no index."""
    (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
       .option("quoteAll", False).csv(path))


def write_payload_json(df: DataFrame, path: str, partition_col: str = "sub_id") -> None:
    """Nested payload rows as JSON, one folder per subcategory; only the
    subcategories at hand are replaced."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).json(path))


def write_sheets(long_pivot: DataFrame, path: str) -> None:
    """The multi-grain long pivot partitioned by (pillar, grain, sheet).
    Replaces the whole folder: a sheet that has gone stays in no reader's
    sight."""
    columns = ("pillar_name", "grain", "sheet")
    (rebalanced(long_pivot, *columns).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*columns).parquet(path))


def checkpoint_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage through a table in the cluster's shared folder; survives
    executor loss, unlike a local checkpoint.  Every call has a folder of its
    own, so runs of one name do not touch each other."""
    path = f"{shared_dir(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
