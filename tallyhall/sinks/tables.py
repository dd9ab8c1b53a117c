"""Fact tables that grow by batches, under one frozen schema.

A table is a folder with data below ``data/batch=<id>/run=<run>`` and commits below
``_commits``.  A commit is one small file, written last: it names the table's
schema and, for each batch, its run's folder, its files with their sizes and
its rows.  So

* a batch that is written again replaces its former run and no other batch
  (the same batch twice equals once);
* a job that dies before its commit leaves the table as it was, and its part
  files belong to no commit;
* a reader sees one commit's files, whatever is written meanwhile.

The schema is that of the first batch.  Later batches are cast to it: a
column that is missing is null, one that is not in the schema is an error,
and a value that cannot be cast fails the job.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import Store
from .writers import clustered, rebalanced

COMMITS = "_commits"
MONTH = "event_year_month"


@dataclass(frozen=True)
class Batch:
    path: str  # below the table's folder
    rows: int
    files: tuple[tuple[str, int], ...]  # below ``path``


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: T.StructType
    partition_by: tuple[str, ...]
    batches: dict[str, Batch]
    modified: int = 0

    @property
    def rows(self) -> int:
        return sum(b.rows for b in self.batches.values())

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "partition_by": list(self.partition_by),
                           "batches": {k: {"path": b.path, "rows": b.rows, "files": b.files} for k, b in self.batches.items()},
                           "complete": True})

    @staticmethod
    def parse(text: str, version: int, modified: int) -> Manifest | None:
        """None for a commit whose writing was cut off."""
        try:
            d = json.loads(text)
        except ValueError:
            return None
        if not d.get("complete"):
            return None
        batches = {k: Batch(b["path"], b["rows"], tuple((f, n) for f, n in b["files"])) for k, b in d["batches"].items()}
        return Manifest(version, T.StructType.fromJson(d["schema"]), tuple(d["partition_by"]), batches, modified)


def _commits(store: Store, root: str) -> list[tuple[int, str, int]]:
    """(version, path, time) of all commit files, the newest first."""
    found = [(int(e.path.rsplit("/", 1)[-1][:-5]), e.path, e.modified) for e in store.glob(f"{root}/{COMMITS}/*.json")]
    return sorted(found, reverse=True)


def manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest | None:
    """The table's newest whole commit, or that of ``version``; None if there
    is none."""
    store = Store(spark, root)
    for v, path, modified in _commits(store, root.rstrip("/")):
        if version is None or v == version:
            m = Manifest.parse(store.read(path), v, modified)
            if m is not None:
                return m
    return None


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``: missing columns are
    null, unknown ones an error, and a value that does not fit fails."""
    unknown = sorted(set(df.columns) - set(schema.names))
    if unknown:
        raise ValueError(f"columns that the table does not have: {unknown}")
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def append_batch(fact: DataFrame, root: str, batch_id: str, partition_by: str | None = MONTH, date_col: str = "event_startdate",
                 cluster_by: list[str] | None = None, attempts: int = 20) -> Manifest:
    """Write ``fact`` as batch ``batch_id`` of the table at ``root``, and
    commit it.  A batch of that name is replaced as a whole.

    Rows are partitioned by event month, which is added from ``date_col`` if
    missing; ``cluster_by`` orders them, so that filters on those columns
    skip files and row groups."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id) or batch_id[0] in "._":
        raise ValueError(f"a batch id is letters, digits, dots, hyphens and underlines: {batch_id!r}")
    spark, root = fact.sparkSession, root.rstrip("/")
    if partition_by and partition_by not in fact.columns:
        fact = fact.withColumn(partition_by, F.date_format(date_col, "yyyy-MM"))
    old = manifest(spark, root)
    schema = old.schema if old else T.StructType([T.StructField(f.name, f.dataType, True) for f in fact.schema.fields])
    parts = old.partition_by if old else ((partition_by,) if partition_by else ())
    rows = conform(fact, schema)
    if cluster_by:
        rows = clustered(rows, [*parts, *[c for c in cluster_by if c not in parts]])
    elif parts:
        rows = rebalanced(rows, *parts)
    path = f"data/batch={batch_id}/run={uuid.uuid4().hex}"
    writer = rows.write.option("compression", "snappy")
    (writer.partitionBy(*parts) if parts else writer).parquet(f"{root}/{path}")
    store = Store(spark, root)
    batch = _written(spark, store, root, path, schema)
    return _commit(spark, store, root, schema, parts, {batch_id: batch}, attempts)


def _written(spark, store: Store, root: str, path: str, schema: T.StructType) -> Batch:
    folder = f"{root}/{path}".removesuffix("/.")
    files = tuple(store.files(folder))
    return Batch(path, spark.read.schema(schema).parquet(folder).count() if files else 0, files)  # counted from the footers


def _commit(spark, store, root, schema, parts, new: dict[str, Batch], attempts: int) -> Manifest:
    """A commit file of the next free number; another writer's commit that
    came between is kept."""
    for _ in range(attempts):
        known = _commits(store, root)
        last = manifest(spark, root)
        if last and (last.schema != schema or last.partition_by != tuple(parts)):
            raise ValueError("another writer has made this table with a schema of its own")
        m = Manifest(known[0][0] + 1 if known else 0, schema, tuple(parts), {**(last.batches if last else {}), **new})
        if store.create(f"{root}/{COMMITS}/{m.version:020d}.json", m.text()):
            return m
    raise RuntimeError(f"no commit of {root} after {attempts} attempts")


def read_table(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of the table's newest commit (or of ``version``); an error if
    there is none, or if a file it names is missing or of another size."""
    root = root.rstrip("/")
    m = manifest(spark, root, version)
    if m is None:
        raise FileNotFoundError(f"{root} has no whole commit" + ("" if version is None else f" {version}"))
    store, paths = Store(spark, root), []
    for b in m.batches.values():
        folder = f"{root}/{b.path}".removesuffix("/.")
        here = store.files(folder)
        gone = sorted(set(b.files) - set(here))
        if gone:
            raise FileNotFoundError(f"{folder} lacks files of commit {m.version}, such as {gone[0][0]}")
        if b.files:  # files of no commit may stand beside: then only those named are read
            paths += [folder] if len(here) == len(b.files) else [f"{folder}/{f}" for f, _ in b.files]
    if not paths:
        return spark.createDataFrame([], m.schema)
    base = root if any(b.path == "." for b in m.batches.values()) else f"{root}/data"
    return spark.read.schema(m.schema).option("basePath", base).parquet(*paths).select(*m.schema.names)


def replace_table(fact: DataFrame, root: str, partition_by: str | None = MONTH, date_col: str = "event_startdate",
                  cluster_by: list[str] | None = None, max_records_per_file: int = 5_000_000) -> Manifest:
    """``fact`` in place of the whole folder, its old months and commits
    included, and a commit written last: until then the folder is no
    snapshot."""
    spark, root = fact.sparkSession, root.rstrip("/")
    if partition_by:
        fact = fact.withColumn(partition_by, F.date_format(date_col, "yyyy-MM"))
    rows, parts = fact, (partition_by,) if partition_by else ()
    if cluster_by:
        rows = clustered(rows, [*parts, *[c for c in cluster_by if c not in parts]])
    elif parts:
        rows = rebalanced(rows, *parts)
    writer = (rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "snappy")
              .option("maxRecordsPerFile", max_records_per_file))
    (writer.partitionBy(*parts) if parts else writer).parquet(root)
    store = Store(spark, root)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fact.schema.fields])
    return _commit(spark, store, root, schema, parts, {"whole": _written(spark, store, root, ".", schema)}, 1)


def unused_runs(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Run folders that none of the newest ``keep`` commits names: former runs
    of replaced batches, and what dead jobs left."""
    root = root.rstrip("/")
    store, used = Store(spark, root), set()
    kept = 0
    for v, path, t in _commits(store, root):
        m = Manifest.parse(store.read(path), v, t)
        if m is not None and kept < keep:
            used |= {b.path for b in m.batches.values()}
            kept += 1
    runs = ["/".join(e.path.rsplit("/", 3)[1:]) for e in store.glob(f"{root}/data/*/*") if e.is_dir]
    return sorted(r for r in runs if r not in used)


def remove_unused(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete them.  Not while a batch is being written: its run is not
    committed yet."""
    runs = unused_runs(spark, root, keep)
    for r in runs:
        Store(spark, root).delete(f"{root.rstrip('/')}/{r}")
    return runs
