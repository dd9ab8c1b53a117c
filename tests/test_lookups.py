"""The lookup graph: which joins are planned, and that the rows stay right."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tallyhall.operators import fact as fb
from tallyhall.operators.lookups import Entity, Field, Graph, Link, same
from tallyhall.sources import fixtures as fx
from test_fact_builder import ROWS


@pytest.fixture(scope="module")
def source(spark):
    return {name: spark.createDataFrame(ROWS[name], schema) for name, schema in fb.TABLES.items()}


def joins(df):
    return len(re.findall(r"^[\s:+-]*Join ", df._jdf.queryExecution().optimizedPlan().toString(), re.M))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# Officers and addresses may repeat: three joins (officers, master is not asked, addresses, site) besides the event join.
@pytest.mark.parametrize("columns, unique, n", [
    (["event_id", "participant_id"], fb.UNIQUE, 4),
    (["event_id", "participant_id"], fb.UNIQUE | {"addresses.site_id", "officers.user_id"}, 1),
    (["participant_id", "category_name"], fb.UNIQUE | {"addresses.site_id", "officers.user_id"}, 2),
    (["participant_id", "gender"], fb.UNIQUE | {"addresses.site_id", "officers.user_id"}, 3),
    (["participant_id", "gender_name"], fb.UNIQUE | {"addresses.site_id", "officers.user_id"}, 4),
    (["participant_id", "home_tp"], fb.UNIQUE | {"addresses.site_id", "officers.user_id"}, 5),
    (["participant_id", "event_site_dusp"], fb.UNIQUE | {"addresses.site_id", "officers.user_id"}, 4),
    (["participant_id", "event_site_dusp", "home_dun", "event_site_dun"], fb.UNIQUE | {"addresses.site_id", "officers.user_id"}, 9),
])
def test_joins_by_column_set(source, columns, unique, n):
    assert joins(fb.build_fact(source, columns, unique=unique)) == n


def test_every_column_set_gives_the_columns_of_the_whole_fact(source):
    whole = fb.build_fact(source, personal=True)
    assert whole.columns == fb.FACT_COLUMNS
    for columns in (["participant_id", "event_site_state"], ["event_id", "home_tp", "gender_name"], ["deeper_sub_pillar"], ["event_site_district", "participant_id"]):
        assert rows(fb.build_fact(source, columns)) == rows(whole.select(*columns))


def test_a_lookup_that_may_repeat_keeps_its_rows_and_a_unique_one_is_left_out(source):
    assert fb.build_fact(source, ["participant_id"]).where("participant_id = 'p1'").count() == 4
    once = fb.build_fact(source, ["participant_id"], unique=fb.UNIQUE | {"addresses.site_id"})
    assert once.where("participant_id = 'p1'").count() == 2  # two officer types


def test_personal_data_is_masked_or_left_out_by_default(source):
    shown = fb.build_fact(source)
    assert not set(fb.CONTACT_COLUMNS) & set(shown.columns)
    assert {r.identity_no for r in shown.collect()} == {"00000000****", None}
    assert {r.identity_no for r in fb.build_fact(source, ["identity_no"], personal=True).collect()} == {"123", None}
    assert {r.identity_no for r in fb.participant_details(source, ["identity_no"]).collect()} == {"00000000****", None}


def test_excluded_events_and_taxonomy_by_own_keys(spark, source):
    gone = spark.createDataFrame([(1,)], "event_id bigint")
    assert {r.event_id for r in fb.build_fact(source, ["event_id"], gone).collect()} == {2}
    own = {r.event_id: (r.event_category, r.program_module) for r in fb.event_taxonomy(source, by="event").collect()}
    assert own == {1: ("NADI4U", "Entrepreneur"), 2: ("NADI4U", "Wellbeing"), 3: ("", "")}


def test_conditions_stay_in_the_join_and_inner_links_stay(spark):
    a = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id int, b_id int")
    b = spark.createDataFrame([(10, "x", 5), (11, "y", 6)], "id int, kind string, c_id int")
    c = spark.createDataFrame([(5, "five")], "id int, name string")
    t = {"a": a, "b": b, "c": c}
    g = Graph({"a": Entity("a", {"kind": same("b.kind"), "name": same("c.name"), "both": Field(("b.kind", "c.name"), lambda x, y: F.concat_ws("-", x, y))},
                           {"b": Link("b", "b_id", only=lambda: F.col("kind") == "x"), "c": Link("c", "b.c_id")})})
    unique = {"b.id", "c.id"}
    assert rows(g.plan(t, "a", ["id", "kind"], unique)) == [(1, "x"), (2, None), (3, None)]
    assert rows(g.plan(t, "a", ["id", "both"], unique)) == [(1, "x-five"), (2, ""), (3, "")]
    assert joins(g.plan(t, "a", ["id"], unique)) == 0 and joins(g.plan(t, "a", ["id", "name"], unique)) == 2
    inner = g.extended("a", links={"b": Link("b", "b_id", how="inner")})
    assert rows(inner.plan(t, "a", ["id"], unique)) == [(1,), (2,)]
    round_about = g.extended("a", links={"b": Link("b", "c.id"), "c": Link("c", "b.c_id")})
    with pytest.raises(ValueError, match="circle"):
        round_about.plan(t, "a", ["kind"], unique)


@pytest.mark.parametrize("columns, tables", [
    (["event_id", "participant_id", "gender", "event_site_refid"], {"lineitem", "orders"}),
    (["participant_id", "program"], {"lineitem", "orders", "customer", "supplier"}),  # supplier: the number of sites
    (["participant_id", "event_site_state"], {"lineitem", "orders", "supplier", "nation"}),
    (["participant_id", "program_name", "category_name"], {"lineitem", "orders", "part"}),
])
def test_the_test_tables_fact_reads_only_what_it_needs(spark, columns, tables):
    plan = fx.fact(spark, SMALL, columns)._jdf.queryExecution().optimizedPlan().toString()
    physical = fx.fact(spark, SMALL, columns)._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"/(\w+)\.parquet", physical)) <= tables, plan
