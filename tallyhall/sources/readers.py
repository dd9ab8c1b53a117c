"""Generic readers.  Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks import tables
from ..sinks.files import Store

# Declared schemas of the driver's tables (no footer inference per read).
TABLE_SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One parquet table of a data folder, with its declared schema where
    there is one; naive timestamps become zoned UTC."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    df = reader.parquet(f"{root.rstrip('/')}/{name}.parquet")
    return df.select(*[F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType)
                       else F.col(f.name) for f in df.schema.fields])


def latest_snapshot(spark: SparkSession, glob: str, by: str = "name", unit: str = "file", manifest: bool = True) -> DataFrame:
    """Rows of the newest snapshot matching ``glob``.

    A snapshot is one file (``unit="file"``, e.g. ``fact_20260301.parquet``)
    or one folder (``unit="dir"``), partitioned or not: the part of the path
    up to the first component with a wildcard, whatever files the rest of the
    glob matches.  Newest means the greatest path (``by="name"``) or the
    latest time (``by="mtime"``, equal times by path), a folder's time being
    that of its commit.  A folder counts only with a commit of
    :mod:`..sinks.tables`, so one that is being written, or whose job died, is
    passed over; its files are checked against the commit.
    ``manifest=False`` takes plain folders by their files instead.
    """
    store = Store(spark, glob)
    if unit == "file":
        found = [(e.modified, e.path, None) for e in store.glob(glob) if not e.is_dir]
    else:
        found = []
        for e in store.glob(snapshot_root(glob)):
            if e.is_dir and manifest:
                m = tables.manifest(spark, e.path)
                if m is not None:
                    found.append((m.modified, e.path, m))
            elif e.is_dir and store.files(e.path):
                found.append((max(f.modified for f in store.glob(glob) if f.path.startswith(e.path + "/")) if by == "mtime" else 0, e.path, None))
    if not found:
        raise FileNotFoundError(f"no whole snapshot matches {glob}")
    _, path, m = max(found, key=lambda x: x[1] if by == "name" else x[:2])
    return spark.read.parquet(path) if m is None else tables.read_table(spark, path, m.version)


def snapshot_root(glob: str) -> str:
    """The glob up to its first component with a wildcard (the whole path if
    it has none)."""
    parts = glob.rstrip("/").split("/")
    for i, p in enumerate(parts):
        if any(c in p for c in "*?[{"):
            return "/".join(parts[:i + 1])
    return "/".join(parts)


def read_export_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV export: header, quoted cells with doubled quotes, blank lines
    skipped; missing text cells become ''.

    Files are split among tasks at their line ends.  Cells with embedded
    newlines need ``multi_line=True``, and then one task a file; the
    library's own writer makes many files."""
    df = (spark.read.option("header", True).option("multiLine", multi_line)
          .option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
          .schema(schema).csv(path))
    first = schema.fields[0].name
    if first.startswith("\ufeff"):
        df = df.withColumnRenamed(first, first.lstrip("\ufeff"))
    text_cols = [f.name.lstrip("\ufeff") for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return df.fillna("", subset=text_cols)


SITE_LIST_SCHEMA = T.StructType([T.StructField("sites", T.ArrayType(T.ArrayType(T.StringType())))])


def read_site_list_json(spark: SparkSession, path: str) -> DataFrame:
    """``{"sites": [[refid, name, state, ...], ...]}`` -> named columns."""
    raw = spark.read.option("multiLine", True).schema(SITE_LIST_SCHEMA).json(path)
    row = F.explode("sites").alias("s")
    return raw.select(row).select(
        F.col("s").getItem(0).alias("refid"),
        F.col("s").getItem(1).alias("site_name"),
        F.col("s").getItem(2).alias("state"),
    )


def jdbc_options(table_or_query: str, partition_column: str, lower: int, upper: int, num_partitions: int,
                 fetch_size: int = 5000) -> dict[str, str]:
    """Options of a split scan: SELECT text becomes a derived table, since a
    split scan takes a table, not a query."""
    text = table_or_query.strip().rstrip(";")
    table = f"({text}) AS src" if text.lower().startswith(("select", "with")) else text
    return {"dbtable": table, "partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(num_partitions), "fetchsize": str(fetch_size)}


def jdbc_reader(spark: SparkSession, url: str, table_or_query: str, *, partition_column: str, lower: int, upper: int,
                num_partitions: int, user: str | None = None, password: str | None = None,
                fetch_size: int = 5000) -> DataFrame:
    """Parallel JDBC scan of the operational database.

    Credentials come from the caller (never from code); the numeric
    partition column splits the scan into ``num_partitions`` range reads, so
    no task pulls the whole table.  Filters applied afterwards are pushed
    into the remote WHERE clause by Spark.
    """
    r = spark.read.format("jdbc").option("url", url).options(
        **jdbc_options(table_or_query, partition_column, lower, upper, num_partitions, fetch_size))
    for name, value in (("user", user), ("password", password)):
        if value is not None:
            r = r.option(name, value)
    return r.load()
