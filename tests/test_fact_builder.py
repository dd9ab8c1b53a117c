"""The fact over hand-built logical tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tallyhall.sources import fixtures as fx
from tallyhall.operators import fact as fb

T0 = dt.datetime(2026, 1, 2, 9, 0)
ROWS = {
    "events": [(1, 10, 20, 30, "Talk", 40, None, 7, T0, T0 + dt.timedelta(hours=2), T0, 100, "2", "[900]"),
               (2, 10, 21, 31, None, None, "d", 8, T0, T0, T0, 101, "2", "[901]"), (3, *[None] * 13)],
    "categories": [(10, "NADI4U")], "subcategories": [(20, "Entrepreneur", 10), (21, "Wellbeing", 10)],
    "programs": [(30, "Biz", 20), (31, "Fit", 21)], "methods": [(40, "Online")],
    "profiles": [(100, "Ali", "sso_admin"), (101, "Siti", "member")], "officers": [(100, 1), (100, 2), (101, 1)],
    "master": [(1, "Type A"), (2, "Type B")],
    "participants": [("p1", 1, True, True, False, 500, None, 900), ("p2", 2, False, None, None, None, 600, 901),
                     ("p3", 2, None, None, None, None, None, 999), ("p4", 77, True, None, None, 500, None, 900)],
    "members": [(500, "Ahmad", "123", "01", None, None, "20", None, 1, 1, None, None, None, None, None, None, 70)],
    "under12": [(600, "Adik", "02", 2)], "genders": [(1, "Lelaki"), (2, "Perempuan")], "races": [(1, "Melayu")],
    "site_profiles": [(900, "S1", "T1", "One", None, 1, 1, 1, 1, 1, 1, 1, 1, 1.0, 2.0, True, None),
                      (901, "S2", None, "Two", None, 2, None, None, None, None, None, None, None, None, None, None, None)],
    "organizations": [(1, "TP X", "tp", 3), (2, "Not a tp", "other", 3), (3, "DUSP Y", "dusp", None)],
    "states": [(1, "JOHOR")], "parliaments": [(1, "P1")], "duns": [(1, "N1")], "phases": [(1, "Phase 1")], "zones": [(1, "Z")],
    "technologies": [(1, "Fibre")], "bandwidths": [(1, "100M")],
    "addresses": [(900, "1 Road", None, "80000", 1), (900, "2 Road", "Floor 1", "80001", None)], "districts": [(1, "Johor Bahru")],
    "home_sites": [(70, "H1", "C1", 900), (71, None, None, None)],
}


@pytest.fixture(scope="module")
def source(spark):
    return {name: spark.createDataFrame(ROWS[name], schema) for name, schema in fb.TABLES.items()}


def test_fact_rows_fan_out_by_address_and_officer(source):
    rows = fb.build_fact(source).collect()
    p1 = [r for r in rows if r.participant_id == "p1"]
    assert len(p1) == 4                                           # two addresses x two officer types
    assert {r.event_site_address for r in p1} == {"1 Road", "2 Road Floor 1"}
    assert {r.deeper_sub_pillar for r in p1} == {"Type A", "Type B"}
    assert {r.participant_id for r in rows} == {"p1", "p2", "p3"}   # p4's event is unknown, event 3 has nobody
    r = p1[0]
    assert (r.category_name, r.pillar_name, r.sub_pillar_name, r.program_name) == ("NADI4U", "Entrepreneur", "Biz", "Talk")
    assert (r.event_site_tp, r.event_site_dusp, r.event_site_state, r.event_site_parliament) == ("TP X", "DUSP Y", "JOHOR", "P1")
    assert (r.home_refid, r.home_site_name, r.home_tp, r.home_standard_code) == ("H1", "One", "TP X", "C1")
    assert (r.gender, r.race, r.oku_status, r.participant_type) == ("Lelaki", "Melayu", "false", "Member")


def test_roles_defaults_and_typed_organisations(source):
    r = {x.participant_id: x for x in fb.build_fact(source).collect()}
    assert (r["p2"].participant_name, r["p2"].gender, r["p2"].gender_name, r["p2"].under12_gender) == ("Adik", "", "Perempuan", "Perempuan")
    assert r["p2"].event_site_tp == "" and r["p2"].program_name == "Fit" and r["p2"].deeper_sub_pillar is None
    assert r["p2"].participant_type == "Under 12" and r["p3"].participant_type == "Unknown"
    assert r["p3"].event_site_refid == "" and r["p3"].participant_name is None and r["p3"].home_refid == ""


def test_taxonomy_has_one_row_per_event(source):
    rows = {r.event_id: r for r in fb.event_taxonomy(source).collect()}
    assert len(rows) == 3 and rows[3].event_category == "" and rows[3].event_startdate is None
    assert (rows[1].program_module, rows[1].program_method, rows[2].event_description) == ("Entrepreneur", "Online", "d")


def test_home_site_without_profile_gets_a_name(source):
    names = {r.id: r.site_name for r in fb.home_sites(source).collect()}
    assert names == {70: "One", 71: "Site-71"}


def test_left_merge_keeps_participants_of_unknown_events(spark, source):
    twice = source["events"].union(source["events"].withColumn("program_name", F.lit("Zzz")))
    rows = fb.participants_with_events(source["participants"], twice.select("event_id", "program_name")).collect()
    # Event 2 is there twice, as null and as Zzz: nulls come first.
    assert sorted((r.participant_id, r.program_name) for r in rows if r.program_name) == [("p1", "Talk")]
    assert len(rows) == 4 and {r.participant_id for r in rows if r.program_name is None} == {"p2", "p3", "p4"}


def test_sort_and_control_characters(spark):
    df = spark.createDataFrame([("B", "n", "x\x00y\tz", 1), (None, "n", "\x1f", 2), ("A", None, None, 3), ("A", "m", "ok", 4)],
                               "event_site_state string, event_site_name string, participant_name string, event_id int")
    assert [r.event_id for r in fb.sort_fact(df).collect()] == [4, 3, 1, 2]
    clean = {r.event_id: r.participant_name for r in fb.strip_control_everywhere(df).collect()}
    assert clean == {1: "xy\tz", 2: "", 3: None, 4: "ok"}


def test_key_texts_are_made_behind_the_joins(spark):
    """The numbers that participant and site keys are made of cross the
    joins' exchanges, not the texts."""
    plan = fx.fact(spark, SMALL, ["event_id", "participant_id", "event_site_refid", "pillar_name"])._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join", 1)
    assert "concat(" in above and "concat(" not in below
