"""Tables that grow by batches, their manifests, and snapshots."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallyhall.sinks import tables, writers
from tallyhall.sources import readers

DAY = dt.date(2026, 1, 5)
SCHEMA = "event_id bigint, event_site_state string, event_startdate date, v int"


def fact(spark, rows):
    return spark.createDataFrame([(i, s, d, i) for i, s, d in rows], SCHEMA)


JAN = [(1, "A", DAY), (2, "B", DAY)]
FEB = [(3, "A", DAY + dt.timedelta(days=31)), (4, None, None)]


def got(spark, root, version=None):
    return sorted(r.event_id for r in tables.read_table(spark, root, version).collect())


def test_batches_append_and_a_batch_twice_equals_once(spark, tmp_path):
    root = str(tmp_path / "t")
    assert tables.manifest(spark, root) is None
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, root)
    assert tables.append_batch(fact(spark, JAN), root, "2026-01").rows == 2
    assert tables.append_batch(fact(spark, FEB), root, "2026-02").rows == 4
    assert tables.append_batch(fact(spark, FEB), root, "2026-02").rows == 4
    assert got(spark, root) == [1, 2, 3, 4] and got(spark, root, 0) == [1, 2]
    m = tables.append_batch(fact(spark, FEB[:1]), root, "2026-02")
    assert got(spark, root) == [1, 2, 3] and m.version == 3 and {k: b.rows for k, b in m.batches.items()} == {"2026-01": 2, "2026-02": 1}
    assert tables.read_table(spark, root).columns == ["event_id", "event_site_state", "event_startdate", "v", "event_year_month"]
    months = {r.event_id: r.event_year_month for r in tables.read_table(spark, root, 2).collect()}
    assert months == {1: "2026-01", 2: "2026-01", 3: "2026-02", 4: None}
    plan = tables.read_table(spark, root).where("event_year_month = '2026-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_year_month" in plan
    for batch_id in ("", "a/b", "_x", "..", "a b"):
        with pytest.raises(ValueError):
            tables.append_batch(fact(spark, JAN), root, batch_id)


def test_the_schema_is_frozen_and_later_batches_are_cast_to_it(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.append_batch(fact(spark, JAN), root, "a")
    tables.append_batch(spark.createDataFrame([("7", "2026-03-01", 9)], "event_id string, event_startdate string, v bigint"), root, "b")
    rows = {r.event_id: r for r in tables.read_table(spark, root).collect()}
    assert rows[7].v == 9 and rows[7].event_site_state is None and rows[7].event_startdate == dt.date(2026, 3, 1)
    assert rows[7].event_year_month == "2026-03"
    with pytest.raises(ValueError, match="extra"):
        tables.append_batch(fact(spark, JAN).withColumn("extra", F.lit(1)), root, "c")


def test_a_dead_job_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.append_batch(fact(spark, JAN), root, "a")
    bad = spark.createDataFrame([("x", "2026-03-01", 9)], "event_id string, event_startdate string, v bigint")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.append_batch(bad, root, "a")
    assert got(spark, root) == [1, 2]
    # A run that was written whole and died before its commit, and a commit cut off while it was written.
    fact(spark, FEB).withColumn("event_year_month", F.lit("x")).write.partitionBy("event_year_month").parquet(f"{root}/data/batch=b/run=0")
    with open(f"{root}/_commits/{1:020d}.json", "w") as fh:
        fh.write('{"schema": {')
    assert got(spark, root) == [1, 2]
    assert "data/batch=b/run=0" in tables.unused_runs(spark, root)
    m = tables.append_batch(fact(spark, FEB), root, "b")
    assert m.version == 2 and got(spark, root) == [1, 2, 3, 4]
    removed = tables.remove_unused(spark, root)
    assert "data/batch=b/run=0" in removed and got(spark, root) == [1, 2, 3, 4] and not tables.unused_runs(spark, root)


def test_writers_that_commit_at_once_both_count(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    tables.append_batch(fact(spark, JAN), root, "a")
    create, lost = tables.Store.create, []

    def slow(self, path, text):
        if not lost:  # another writer takes the number first
            lost.append(path)
            monkeypatch.setattr(tables.Store, "create", create)
            tables.append_batch(fact(spark, FEB[:1]), root, "other")
        return create(self, path, text)
    monkeypatch.setattr(tables.Store, "create", slow)
    m = tables.append_batch(fact(spark, FEB[1:]), root, "mine")
    assert m.version == 2 and got(spark, root) == [1, 2, 3, 4]


def test_missing_or_cut_files_are_an_error(spark, tmp_path):
    root = str(tmp_path / "t")
    m = tables.append_batch(fact(spark, JAN + FEB), root, "a")
    name = m.batches["a"].files[0][0]
    os.remove(f"{root}/{m.batches['a'].path}/{name}")
    with pytest.raises(FileNotFoundError, match="lacks files"):
        tables.read_table(spark, root)


def test_files_beside_a_commit_are_not_read(spark, tmp_path):
    root = str(tmp_path / "t")
    m = tables.append_batch(fact(spark, JAN), root, "a")
    tables.append_batch(fact(spark, FEB), root, "b")
    fact(spark, [(99, "Z", DAY)]).write.mode("append").parquet(f"{root}/{m.batches['a'].path}/event_year_month=2026-09")
    assert got(spark, root) == [1, 2, 3, 4]


def test_an_empty_batch(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.append_batch(fact(spark, JAN).limit(0), root, "a")
    assert got(spark, root) == []
    tables.append_batch(fact(spark, JAN), root, "b")
    assert got(spark, root) == [1, 2]


@pytest.mark.parametrize("by", ["name", "mtime"])
def test_a_partitioned_snapshot_is_read_whole(spark, tmp_path, by):
    old = [(9, "A", DAY)]
    new = [(1, "A", DAY), (2, "A", DAY + dt.timedelta(days=31)), (3, "B", DAY + dt.timedelta(days=62))]
    writers.write_fact_parquet(fact(spark, old), str(tmp_path / "fact_20260101"))
    writers.write_fact_parquet(fact(spark, new), str(tmp_path / "fact_20260301"))
    for glob in ("fact_*", "fact_*/", "fact_*/*/*.parquet"):
        rows = readers.latest_snapshot(spark, str(tmp_path / glob), by=by, unit="dir").collect()
        assert sorted(r.event_id for r in rows) == [1, 2, 3]
    # A newer folder without a commit is passed over; alone it is refused.
    fact(spark, old).write.parquet(str(tmp_path / "fact_20260401"))
    assert readers.latest_snapshot(spark, str(tmp_path / "fact_*"), by=by, unit="dir").count() == 3
    with pytest.raises(FileNotFoundError):
        readers.latest_snapshot(spark, str(tmp_path / "fact_202604*"), by=by, unit="dir")


def test_a_grown_table_is_a_snapshot_and_an_overwrite_drops_old_months(spark, tmp_path):
    root = str(tmp_path / "grown_1")
    tables.append_batch(fact(spark, JAN), root, "a")
    tables.append_batch(fact(spark, FEB), root, "b")
    assert readers.latest_snapshot(spark, str(tmp_path / "grown_*"), unit="dir").count() == 4
    flat = str(tmp_path / "flat")
    writers.write_fact_parquet(fact(spark, JAN + FEB), flat)
    writers.write_fact_parquet(fact(spark, FEB), flat)
    assert got(spark, flat) == [3, 4] and tables.manifest(spark, flat).version == 0


def test_files_follow_the_order_and_a_filter_reads_fewer(spark, tmp_path):
    """SRT-01: global order over the files; a state's rows stand in few of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        i = F.col("id")
        # One state has a third of all rows.
        df = spark.range(9000).select(i.alias("event_id"), F.when(i % 3 == 0, "HOT").when(i % 50 == 1, None).otherwise(
            F.concat(F.lit("S"), (i % 20).cast("string"))).alias("event_site_state"), F.date_add(F.lit(DAY), (i % 300).cast("int")).alias("event_startdate"))
        root = str(tmp_path / "t")
        order = ["event_site_state", "event_startdate", "event_id"]
        m = tables.replace_table(df, root, partition_by=None, cluster_by=order)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    names = [f for f, _ in m.batches["whole"].files]
    assert len(names) > 4
    key = lambda r: (r.event_site_state is None, r.event_site_state or "", r.event_startdate, r.event_id)
    rows = [[key(r) for r in spark.read.parquet(f"{root}/{n}").collect()] for n in names]
    flat = [x for part in rows for x in part]
    assert flat == sorted(flat) and len(flat) == 9000
    assert max(map(len, rows)) < 9000 / 3  # the hot state is split
    state = [sum(any(k[1] == "S7" for k in part) for part in rows), sum(any(k[1] == "HOT" for k in part) for part in rows)]
    assert state[0] <= 2 and 1 < state[1] < len(names)
    import pyarrow.parquet as pq
    hold = 0
    for n in names:
        meta = pq.ParquetFile(f"{root}/{n}").metadata
        stats = [meta.row_group(g).column(1).statistics for g in range(meta.num_row_groups)]
        hold += any(s.has_min_max and s.min <= "S7" <= s.max for s in stats)
    assert hold == state[0] < len(names)
