"""The logical tables from a store or a database.

A source is a mapping from a table's logical name to its DataFrame.  Each is
made when a plan asks for it, with the columns and types that
:data:`..operators.fact.TABLES` declares: a column that the store does not
have is null, more columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.fact import TABLES
from .readers import jdbc_reader


class Logical(Mapping[str, DataFrame]):
    def __init__(self, read: Callable[[str], DataFrame], tables: Mapping[str, str] = TABLES):
        self._read, self._tables, self._made = read, dict(tables), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            raise KeyError(name)
        if name not in self._made:
            self._made[name] = conformed(self._read(name), self._tables[name])
        return self._made[name]

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


def conformed(df: DataFrame, schema: str) -> DataFrame:
    """``df`` with the declared columns in their declared types, then its
    others.  Naive timestamps are taken as UTC."""
    want = T.StructType.fromDDL(schema)
    have = set(df.columns)
    named = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in want.fields]
    return df.select(*named, *[c for c in df.columns if c not in want.names])


def from_parquet(spark: SparkSession, root: str, tables: Mapping[str, str] = TABLES) -> Logical:
    """``<root>/<table>.parquet``, a file or a folder each."""
    return Logical(lambda name: spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet"), tables)


def from_jdbc(spark: SparkSession, url: str, physical: Mapping[str, str], splits: Mapping[str, tuple[str, int, int, int]],
              user: str | None = None, password: str | None = None, tables: Mapping[str, str] = TABLES) -> Logical:
    """Tables of a database: ``physical`` gives each table's name or SELECT
    text there, ``splits`` the (column, lower, upper, tasks) of its ranges."""
    def read(name: str) -> DataFrame:
        column, lower, upper, n = splits[name]
        return jdbc_reader(spark, url, physical[name], partition_column=column, lower=lower, upper=upper, num_partitions=n,
                           user=user, password=password)
    return Logical(read, tables)
