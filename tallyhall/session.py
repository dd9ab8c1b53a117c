"""Session construction and the cluster's shared folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  Timestamps are naive UTC end to end; AQE does
# the runtime re-planning (partition coalescing, skew-join splitting and the
# size-checked broadcast conversion) so no operator hard-codes a strategy.  A
# skewed join is split even where an aggregate above it reuses its
# partitioning, at the price of one more exchange there.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tallyhall", extra: dict | None = None) -> SparkSession:
    """A session with the library's settings.  The master and the number of
    shuffle partitions are the cluster's unless a caller names them (tests)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
              "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, conf[k])
    return spark


# Shuffled bytes that one task gets, and bytes of the input files for each
# shuffle partition that AQE starts from.  A participant row is some 30 bytes
# in a shuffle and 600 in the hash maps of a distinct count, so Spark's 64 MB
# a task, or a number of partitions that stays while the input grows, are
# gigabytes of memory.
TASK_BYTES = 16 << 20
INPUT_BYTES = 4 << 20
_TASK = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SIZED = "tallyhall.sizedByInput"


def size_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Shuffle partitions in proportion to the input, at least the session's
    number; AQE joins the small ones up to ``TASK_BYTES``.  A size or number
    that the session has of its own stays."""
    ours = set(filter(None, spark.conf.get(_SIZED, "").split(",")))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for key, value in ((_TASK, TASK_BYTES), (_FIRST, max(least, input_bytes // INPUT_BYTES))):
        if key in ours or spark.conf.get(key, None) is None:
            spark.conf.set(key, str(value))
            ours.add(key)
    spark.conf.set(_SIZED, ",".join(sorted(ours)))


def first_partitions(spark: SparkSession) -> int:
    """Shuffle partitions before AQE joins them: for an exchange whose rows
    grow behind it, so that its partitions stay as small."""
    return int(spark.conf.get(_FIRST, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def unsize_tasks(spark: SparkSession) -> None:
    """The session as it was before :func:`size_tasks`."""
    for key in filter(None, spark.conf.get(_SIZED, "").split(",")):
        spark.conf.unset(key)
    spark.conf.unset(_SIZED)


_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from the session's
    ``spark.checkpoint.dir``.  Where it is unset, a session on one machine
    gets a folder of its own; on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="tallyhall-"))
        root = _OWN[0]
    return root.rstrip("/")
