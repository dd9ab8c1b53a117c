import tempfile
from collections import ChainMap

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tallyhall.config import FilterSpec, PillarSpec
from tallyhall.operators import fact as fb
from tallyhall.operators import pivots
from tallyhall.plans import catalog, flows
from tallyhall.sinks import payload, tables
from tallyhall.sources import fixtures as fx
from tallyhall.sources import logical
from test_fact_builder import ROWS


def test_dashboard_fetch_and_write(spark):
    parts = flows.dashboard_fetch(spark, SMALL, 1, programs=["AUTOMOBILE", "BUILDING"],
                                  remap=lambda df: df.withColumn("program", F.upper("program")))
    nadi = parts["nadi"]
    n_sites = fx.sites(spark, SMALL).count()
    assert nadi.count() == n_sites                      # every site present
    monthly = parts["monthly"].collect()
    assert sum(r.events for r in monthly) == sum(r.events for r in parts["weekly"].collect())
    ev = parts["site_events"]
    assert ev.count() == ev.select("refid", "event_id").distinct().count()
    out = tempfile.mkdtemp(prefix="tallyhall-dash-", dir="/tmp")
    flows.write_dashboard(parts, out, 1)
    assert spark.read.json(f"{out}/nadi").where("sub_id = 1").count() == n_sites


def test_consolidate_then_pivot_matches_direct(spark, tmp_path):
    sheets = flows.consolidate_then_pivot(spark, SMALL, str(tmp_path / "fact"), str(tmp_path / "sheets"), catalog.FIXTURE_PILLARS)
    fact = fx.fact(spark, SMALL, flows.FACT_PIVOT_COLUMNS)
    want = pivots.pivot_all_grains(fact, catalog.FIXTURE_PILLARS)
    cols = want.columns
    some = sheets.where("events > 0 or pax > 0").select(*cols)
    assert sorted(tuple(r) for r in some.collect()) == sorted(tuple(r) for r in want.collect())
    assert sheets.count() == pivots.complete_sheets(fact, catalog.FIXTURE_PILLARS).count() > want.count()
    table = tables.read_table(spark, str(tmp_path / "fact"))
    assert set(table.columns) == {*fx.FACT_COLUMNS, "event_year_month"} and table.count() == fact.count()
    # The batch again, as a rerun of the job: the same table.
    flows.consolidate(fx.Tables(spark, SMALL), str(tmp_path / "fact"), "all", fx.FACT_COLUMNS, fx.FIXTURE_EXCLUDED, fx.GRAPH, fx.UNIQUE)
    assert tables.read_table(spark, str(tmp_path / "fact")).count() == fact.count()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The logical tables as a user's store has them, one column and one
    table's types unlike the declared ones."""
    root = str(tmp_path_factory.mktemp("store"))
    for name, schema in fb.TABLES.items():
        df = spark.createDataFrame(ROWS[name], schema)
        if name == "participants":
            df = df.withColumn("participant_id", F.concat("participant_id", F.lit("\x07"))).withColumn("event_id", F.col("event_id").cast("int"))
        if name == "members":
            df = df.drop("income_range")
        df.write.parquet(f"{root}/{name}.parquet")
    return root


def test_flows_start_from_a_store_of_logical_tables(spark, stored, tmp_path):
    t = logical.from_parquet(spark, stored)
    m = flows.consolidate(t, str(tmp_path / "fact"), "2026-01")
    fact = tables.read_table(spark, str(tmp_path / "fact"))
    assert m.rows == fact.count() == fb.build_fact(t).count() and set(fb._shown(fb.FACT_COLUMNS, False)) | {"event_year_month"} == set(fact.columns)
    assert {r.participant_id for r in fact.collect()} == {"p1", "p2", "p3"}            # control characters are gone
    sheets = flows.publish_sheets(spark, str(tmp_path / "fact"), str(tmp_path / "sheets"), [PillarSpec("Entrepreneur", "sub_pillar_name")])
    top = sheets.where("sheet = 'All' and grp = 'Total'").collect()
    assert {(r.refid, r.events, r.pax) for r in top} == {("S1", 1, 1), ("S2", 0, 0)}
    cells = flows.slice_fact(t, 20, programs=["Biz"], columns=["participant_id", "event_startdate"])
    assert {(r.event_id, r.sub_pillar_name) for r in cells.collect()} == {(1, "Biz")}
    assert flows.slice_fact(t, 20, programs=["Other"]).count() == 0 and flows.slice_fact(t, 20, excluded=["2"]).count() == 0
    assert flows.slice_fact(t, 20, date_to="2026-01-01").count() == 0
    rows = flows.export_rows(t, [21], {"state": "^$", "tp": ""}, known=[20, 21]).collect()
    assert {r.participant_id for r in rows} == {"p2\x07", "p3\x07"}
    with pytest.raises(ValueError, match="unknown subcategory"):
        flows.export_rows(t, [99])
    remapped = flows.slice_fact(t, 20, programs=["BIZ"], remap=lambda df: df.withColumn("sub_pillar_name", F.upper("sub_pillar_name")))
    assert remapped.count() == 4                                                       # the hook comes before the filter


def test_an_event_that_ends_after_the_window_is_outside(spark, stored):
    t = logical.from_parquet(spark, stored)
    late = ChainMap({"events": t["events"].withColumn("event_end", F.expr("event_end + interval 3 days"))}, t)
    for to, n in (("2026-01-02", 0), ("2026-01-04", 0), ("2026-01-05", 1)):
        assert flows.eligible(late, 20, date_from="2026-01-02", date_to=to).count() == n
    assert flows.eligible(late, 20, date_from="2026-01-03").count() == 0


def test_export_by_way_of_csv_gives_the_same_report(spark, tmp_path):
    spec = FilterSpec(facets={"pillar_name": "1-URGENT"}, search="blue")
    direct = flows.export_then_explore(spark, SMALL, spec, [1, 6], {"state": "nation_1"})
    by_csv = flows.export_then_explore(spark, SMALL, spec, [1, 6], {"state": "nation_1"}, path=str(tmp_path / "csv"))
    for part in ("summary", "stats", "facets"):
        assert sorted(map(tuple, direct[part].collect()), key=str) == sorted(map(tuple, by_csv[part].collect()), key=str), part
    blank = lambda rows: [tuple("" if x is None else x for x in r) for r in rows]  # noqa: E731 - CSV has no null text
    assert sorted(blank(direct["preview"].collect()), key=str) == sorted(blank(by_csv["preview"].collect()), key=str)
    view = flows.read_export(spark, str(tmp_path / "csv"), flows.export_rows(
        fx.Tables(spark, SMALL), [1, 6], {"state": "nation_1"}, excluded=fx.FIXTURE_EXCLUDED, graph=fx.GRAPH, unique=fx.UNIQUE))
    rows = [(r.category_name, r.pillar_name, r.site_state, r.site_name, r.event_startdate) for r in view.collect()]
    assert rows == sorted(rows) and len({r[2] for r in rows}) > 1 and all("NATION_1" in r[2] for r in rows)


def test_envelope_names_the_slice(spark):
    parts = flows.dashboard_fetch(spark, SMALL, 1, "1996-01-01", "1997-12-31", ["AUTOMOBILE"])
    e = parts["envelope"].first()
    assert (e.sub_id, str(e.start_date), str(e.end_date), e.programs_filter) == (1, "1996-01-01", "1997-12-31", ["AUTOMOBILE"])
    assert (e.n_nadi, e.n_monthly, e.n_weekly) == tuple(parts[k].count() for k in ("nadi", "monthly", "weekly"))
    open_end = payload.envelope(spark, 3).first()
    assert (open_end.fetched, open_end.start_date, open_end.programs_filter) == (None, None, None)


def test_export_then_explore(spark):
    res = flows.export_then_explore(spark, SMALL, FilterSpec(facets={"pillar_name": "1-URGENT"}))
    stats = res["stats"].first()
    assert stats.filtered_rows <= stats.total_rows
    prev = res["preview"].collect()
    assert len(prev) == min(200, stats.filtered_rows)
    assert all(r.filtered_rows == stats.filtered_rows for r in prev)


def test_sum_of_weekly_equals_monthly_equals_distinct_events(spark):
    f = fx.fact(spark, SMALL, ["event_id", "participant_id", "event_startdate", "gender", "age", "oku_status"])
    from tallyhall.operators import rollups
    w = sum(r.events for r in rollups.weekly_rollup(f).collect())
    m = sum(r.events for r in rollups.monthly_rollup(f).collect())
    assert w == m == f.select("event_id").distinct().count()


def test_state_matrix_row_totals_equal_column_totals(spark):
    q = catalog.QUERIES["state_month_totals"](spark, SMALL).collect()
    rows = sum(r.events or 0 for r in q if r.state != "TOTAL")
    cols = sum(r.events or 0 for r in q if r.state == "TOTAL" and r.month != 0)
    grand = [r.events for r in q if r.state == "TOTAL" and r.month == 0][0]
    assert rows == cols == grand


def test_untouched_plus_active_is_all_sites(spark):
    un = {r.refid for r in catalog.QUERIES["untouched_sites"](spark, SMALL).collect()}
    allsites = {r.refid for r in fx.sites(spark, SMALL).collect()}
    assert un <= allsites and len(un) < len(allsites)
