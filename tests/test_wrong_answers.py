"""Hand-made rows for answers that were once wrong under green queries."""

import datetime as dt
import os
import tempfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import make_fact, make_sites
from tallyhall.config import PillarSpec
from tallyhall.functions.text import is_json_array, json_type, safe_int
from tallyhall.operators import explore, joins, pivots, rollups
from tallyhall.sinks import payload, writers
from tallyhall.sources import readers

PILLARS = [PillarSpec("P", "sub_pillar_name"), PillarSpec("Q", "sub_pillar_name")]


def row(event, day, site="S1", name="n", state="s", group="A", pillar="P", participant=None, **more):
    d = dt.datetime.fromisoformat(day) if day else None
    return {"event_id": event, "participant_id": participant or f"{event}-1", "event_site_refid": site, "event_site_name": name,
            "event_site_state": state, "sub_pillar_name": group, "pillar_name": pillar, "category_name": "NADI4U",
            "event_start": d, "event_startdate": d and d.date(), **more}


def test_null_site_name_is_listed_once_and_has_no_cell(spark):
    f = make_fact(spark, [row(1, "2026-01-02", site="S9", name=None), row(2, "2026-01-02")])
    out = {r.refid: r for r in pivots.pivot_wide_group(f, "sub_pillar_name", ["A"]).collect()}
    assert sorted(out) == ["S1", "S9"]
    assert (out["S9"].A_events, out["S9"].total_events) == (0, 0)
    assert (out["S1"].A_events, out["S1"].total_events) == (1, 1)
    assert {r.refid for r in pivots.pivot_all_grains(f, PILLARS).collect()} == {"S1"}
    dim = make_sites(spark, [("S9", None, "s"), ("S1", "n", "s")])
    wide = make_sites(spark, [("S9", None, "s"), ("S8", "x", None)]).withColumn("n", F.lit(3))
    got = {tuple(r) for r in joins.densify_outer(dim, wide, ["refid", "site_name", "state"], ["n"]).collect()}
    assert got == {("S9", None, "s", 3), ("S1", "n", "s", 0), ("S8", "x", None, 3)}


def test_every_week_of_recent_months_is_a_sheet(spark):
    f = make_fact(spark, [row(1, "2026-03-03"), row(2, "2025-11-05")])
    out = {(r.pillar_name, r.sheet): r.active_sites for r in pivots.active_sites_per_sheet(f, PILLARS).collect()}
    for w in (1, 2, 3, 4):
        assert out["P", f"Mar 2026 W{w}"] == (1 if w == 1 else 0)
        assert out["Q", f"Nov 2025 W{w}"] == 0
    assert out["P", "All"] == 1 and out["Q", "All"] == 0
    empty = pivots.active_sites_per_sheet(f.limit(0), PILLARS).collect()
    assert sorted((r.pillar_name, r.sheet, r.active_sites) for r in empty) == [("P", "All", 0), ("Q", "All", 0)]


def test_multi_grain_totals_count_an_id_once(spark):
    rows = [row(1, "2026-01-02", group=g, participant=p) for g in "AB" for p in ("x", "y")]
    rows += [row(1, "2026-02-02", participant="x"), row(2, None, participant="x")]
    out = {(r.grain, r.sheet, r.grp): (r.events, r.pax) for r in pivots.pivot_all_grains(make_fact(spark, rows), PILLARS).collect()}
    assert out["all", "All", "Total"] == (2, 2) and out["quarter", "Q1 2026", "Total"] == (1, 2)
    assert out["month", "Jan 2026", "A"] == (1, 2) and out["week", "Feb 2026 W1", "Total"] == (1, 1)


def test_sheets_and_months_that_are_gone_do_not_stay(spark):
    d = tempfile.mkdtemp(prefix="tallyhall-test-")
    two = make_fact(spark, [row(1, "2026-02-02"), row(2, "2026-03-02")])
    for f, sheets in ((two, 2), (two.where("event_id = 1"), 1)):
        writers.write_sheets(pivots.pivot_all_grains(f, PILLARS), f"{d}/sheets")
        writers.write_fact_parquet(f, f"{d}/fact")
        back = spark.read.parquet(f"{d}/sheets")
        assert back.where("grain = 'month'").select("sheet").distinct().count() == sheets
        assert spark.read.parquet(f"{d}/fact").count() == sheets


def test_a_payload_run_replaces_only_its_subcategory(spark):
    d = tempfile.mkdtemp(prefix="tallyhall-test-")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        for sub in (1, 2, 2):
            writers.write_payload_json(spark.range(3).withColumn("sub_id", F.lit(sub)), f"{d}/p")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert spark.read.json(f"{d}/p").count() == 6


def test_a_large_month_is_written_by_many_tasks(spark):
    d = tempfile.mkdtemp(prefix="tallyhall-test-")
    f = spark.range(0, 400_000, 1, 40).select(F.col("id").alias("event_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"),
                                    F.when(F.col("id") % 2 == 0, F.lit("2026-01-05")).otherwise(
                                        F.concat(F.lit("2025-0"), (F.col("id") % 9 + 1).cast("string"), F.lit("-01"))).cast("date")
                                    .alias("event_startdate"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        writers.write_fact_parquet(f, f"{d}/fact")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [x for x in os.listdir(f"{d}/fact/event_year_month=2026-01") if x.endswith(".parquet")]
    assert len(files) > 16


@pytest.mark.parametrize(("text", "array", "kind"), [
    ("[1] junk", False, "invalid"), ('{"a":1} x', False, "invalid"), ("[1, 2]", True, "array"), ("[]", True, "array"),
    ('{"a": [1]}', False, "object"), ("null", False, "null"), ("12", False, "scalar"), ("", False, "invalid"), (None, False, None)])
def test_json_with_trailing_text_is_invalid(spark, text, array, kind):
    r = spark.createDataFrame([(text,)], "t string").select(is_json_array("t").alias("a"), json_type("t").alias("k")).first()
    assert (r.a, r.k) == (array, kind)


@pytest.mark.parametrize(("text", "want"), [("9007199254740993", 9007199254740993), ("-3.9", -3), ("1e3", 1000), ("x", 0),
                                            (None, 0), ("9007199254740993.7", 9007199254740993), (" 7 ", 7)])
def test_safe_int_is_exact(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(safe_int("t")).first()[0] == want


def test_groups_with_one_slug_have_two_columns(spark):
    f = make_fact(spark, [row(1, "2026-01-02", group="A-B"), row(2, "2026-01-02", group="A B"), row(3, "2026-01-02", group="A B")])
    r = pivots.pivot_wide_group(f, "sub_pillar_name", ["A-B", "A B", "total"]).first()
    assert (r.A_B_events, r.A_B_2_events, r.total_2_events, r.total_events) == (1, 2, 0, 3)


def test_event_month_is_that_of_the_first_date(spark):
    f = make_fact(spark, [row(1, "2026-04-02", participant="a"), row(1, "2026-08-02", participant="b")])
    assert rollups.event_summary(f).first().month == "Apr 2026"  # 'Aug 2026' comes first as text


def test_month_series_has_the_months_of_the_data_only(spark):
    f = make_fact(spark, [row(1, "2026-01-02"), row(2, "9999-12-01", site="S2"), {**row(3, "2026-02-01"), "participant_id": None}])
    out = {(r.refid, str(r.month_start)): (r.events, r.pax) for r in rollups.site_month_series(
        f, make_sites(spark, [("S1", "n", "s"), ("S2", "n", "s")])).collect()}
    assert len(out) == 6 and out["S1", "2026-01-01"] == (1, 1) and out["S2", "2026-02-01"] == (0, 0) and out["S2", "9999-12-01"] == (1, 1)


def test_monthly_home_pivot_totals_by_sheet(spark):
    rows = [row(1, "2026-01-02", home_refid="S1", program="A"), row(2, "2026-01-09", home_refid="S1", program=None),
            row(3, "2026-02-02", home_refid="S1", program=None), row(4, "2026-02-02", home_refid="S2", program="B")]
    out = {(r.sheet, r.refid): r for r in pivots.monthly_home_pivot(make_fact(spark, rows), make_sites(
        spark, [("S1", "n", "s"), ("S2", "n", "s"), ("S3", "n", "s")]), ["A", "B"]).collect()}
    assert len(out) == 9
    assert (out["Jan 2026", "S1"].A_events, out["Jan 2026", "S1"].total_events) == (1, 2)
    assert out["Feb 2026", "S1"].total_events == 0 and out["All", "S1"].total_events == 3
    assert out["All", "S3"].total_events == 0 and out["Feb 2026", "S2"].B_pax == 1


def test_payload_attributes_and_classifier(spark):
    f = make_fact(spark, [row(1, "2026-01-02", program="cyber x"), row(2, "2026-01-02", program=None)])
    sites = make_sites(spark, [("S1", "n", "s"), ("S2", "m", "s")]).withColumns({"tp": F.lit("T"), "dun": F.lit("D")})
    out = {r.refid: r for r in payload.site_payload(f, sites).collect()}
    assert out["S1"].tp == "T" and out["S1"].dun == "D" and out["S1"].events == 2 and out["S1"].pax.total == 2
    assert {k: v.events for k, v in out["S1"].programs.items()} == {"cyber x": 1} and out["S2"].programs == {}
    from tallyhall.config import Classifier
    labelled = payload.site_payload(f, sites, classifier=Classifier()).where("refid = 'S1'").first()
    assert {k: v.events for k, v in labelled.programs.items()} == {"CYBERSECURITY": 2}


def test_latest_snapshot_reads_one_folder(spark):
    d = tempfile.mkdtemp(prefix="tallyhall-test-")
    spark.createDataFrame([(2,)], "v int").write.parquet(f"{d}/snap_20260301")
    spark.createDataFrame([(1,)], "v int").write.parquet(f"{d}/snap_20260101")  # older name, newer file
    by_name = readers.latest_snapshot(spark, f"{d}/snap_*", unit="dir", manifest=False)
    assert [r.v for r in by_name.collect()] == [2] and all("snap_20260301" in x for x in by_name.inputFiles())
    for x in os.listdir(f"{d}/snap_20260301"):
        os.utime(f"{d}/snap_20260301/{x}", (1, 1))
    by_time = readers.latest_snapshot(spark, f"{d}/snap_*/*.parquet", by="mtime", unit="dir", manifest=False)
    assert [r.v for r in by_time.collect()] == [1] and all("snap_20260101" in x for x in by_time.inputFiles())


def test_new_files_are_seen_in_the_same_session(spark):
    d = tempfile.mkdtemp(prefix="tallyhall-test-")
    spark.range(3).withColumnRenamed("id", "v").write.parquet(f"{d}/t.parquet")
    assert readers.read_table(spark, d, "t").count() == 3
    spark.range(4).withColumnRenamed("id", "v").write.mode("append").parquet(f"{d}/t.parquet")
    assert readers.read_table(spark, d, "t").count() == 7


def test_jdbc_scans_are_always_split():
    o = readers.jdbc_options("SELECT a FROM t;", "a", 0, 10, 4)
    assert o["dbtable"] == "(SELECT a FROM t) AS src" and o["numPartitions"] == "4" and "query" not in o
    with pytest.raises(TypeError):
        readers.jdbc_reader(None, "jdbc:x", "t")


def test_facets_are_ordered_and_cascades_have_no_dates(spark):
    view = spark.createDataFrame([("A", "P", dt.date(2026, 1, 2)), ("B", "", None)], "category_name string, pillar_name string, event_startdate date")
    got = [tuple(r) for r in explore.facet_values(view, ["category_name", "pillar_name"]).collect()]
    assert got == [("category_name", "A"), ("category_name", "B"), ("date_from", "2026-01-02"), ("date_to", "2026-01-02"), ("pillar_name", "P")]
    low = explore.cascaded_facets(view, {"category_name": "A"}, "category_name", ["category_name", "pillar_name"])
    assert [tuple(r) for r in low.collect()] == [("pillar_name", "P")]


def test_session_names_no_master_and_shared_folder_is_required(spark):
    import inspect

    from tallyhall import session
    assert inspect.signature(session.build_session).parameters["master"].default is None
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_dir(unset)


def test_state_report_has_the_fixed_states_in_order(spark):
    from tallyhall.config import REPORT_STATES
    f = make_fact(spark, [row(1, "2026-01-02"), row(2, "2025-01-02"), row(3, "2026-12-30", site="S2")])
    out = pivots.state_report(f, make_sites(spark, [("S1", "n", " johor "), ("S2", "m", "SABAH")])).collect()
    assert [r.state for r in out] == [*REPORT_STATES, "TOTAL"]
    by = {r.state: r for r in out}
    assert (by["JOHOR"].m1, by["JOHOR"].m2, by["JOHOR"].total) == (2, None, 2)
    assert (by["TOTAL"].m1, by["TOTAL"].m12, by["TOTAL"].total) == (2, 1, 3) and by["KEDAH"].total is None


def test_heat_grid_has_idle_months_and_a_footer(spark):
    f = make_fact(spark, [row(i, "2026-01-02") for i in range(7)] + [row(90, "2026-02-02", site="S2")])
    out = {(r.refid, str(r.month_start)): (r.events, r.band) for r in rollups.heat_grid(
        f, make_sites(spark, [("S1", "n", "s"), ("S2", "n", "s")])).collect()}
    assert out == {("S1", "2026-01-01"): (7, "6-20"), ("S1", "2026-02-01"): (0, "0"), ("S2", "2026-01-01"): (0, "0"),
                   ("S2", "2026-02-01"): (1, "1-5"), (None, "2026-01-01"): (7, None), (None, "2026-02-01"): (1, None)}


def test_zero_attendance_filters(spark):
    f = make_fact(spark, [row(1, "2026-01-05", attendance="no", program="A"), row(2, "2026-01-11", attendance="no", program="B"),
                          row(3, "2026-01-12", attendance="no", state="t"), row(4, "2026-01-05", attendance="true")])
    def ids(**kw):
        return sorted(r.event_id for r in rollups.zero_attendance_events(f, **kw).collect())
    assert ids() == [1, 2, 3] and ids(week="2026-01-07") == [1, 2] and ids(state="t") == [3] and ids(program="B") == [2]
    assert ids(site="S2") == [] and ids(week="2026-01-07", program="A") == [1]


def test_periods_come_in_order_and_the_catalogue_has_its_time(spark):
    f = make_fact(spark, [row(i, d) for i, d in enumerate(["2026-02-02", "2025-12-30", "2026-01-15"])])
    assert [r.period for r in rollups.monthly_rollup(f).collect()] == ["2025-12", "2026-01", "2026-02"]
    assert [str(r.week_start) for r in rollups.weekly_rollup(f).collect()] == ["2025-12-29", "2026-01-12", "2026-02-02"]
    subs = spark.createDataFrame([(1, "c", "m", "l")], "subcategory_id int, category_name string, module string, sub_label string")
    at = dt.datetime(2026, 5, 1, 12)
    r = payload.run_catalogue(f.withColumn("subcategory_id", F.lit(1)), subs, at).first()
    assert r.row_count == 3 and r.fetched_at == at


def test_chosen_columns(spark):
    view = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert explore.choose_columns(view, ["c", "a"]).columns == ["c", "a"]
    for bad in (["x"], ["a", "a"]):
        with pytest.raises(ValueError, match="columns"):
            explore.choose_columns(view, bad)
