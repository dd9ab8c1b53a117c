"""Eager aggregation: event summaries from the tables below the fact."""

import datetime as dt
import random

import pytest

import __spark_entry__ as E
from conftest import SMALL
from tallyhall.operators import rollups
from test_plans import plan_of


def tables(spark, seed, n, hot=False):
    rng = random.Random(seed)
    parts = [(i, rng.choice(["alpha", "beta", "", None, "g" * 70, "G" * 59 + "xy"])) for i in range(8)]
    events = [(i, rng.choice(["prog", "", None, "q" * 50]), dt.date(2026, 1, 1 + i) if i % 4 else None, rng.choice(["Title", "", None])) for i in range(10)]
    people = [(0 if hot and i % 3 else rng.choice([None, 77, *range(10)]), "S0" if hot and i % 3 else rng.choice(["S1", "S2", "", None]),
               rng.choice(["a", "b", "c", None]), rng.choice([True, False, None]), rng.choice([None, 99, *range(8)])) for i in range(n)]
    return (spark.createDataFrame(people, "event_id bigint, refid string, participant_id string, attendance boolean, part_id bigint"),
            spark.createDataFrame(events, "event_id bigint, program string, event_startdate date, program_name string"),
            spark.createDataFrame(parts, "id bigint, name string"))


def brute(people, events, titles=None):
    ev = {e.event_id: e for e in events}
    groups = {}
    for r in people:
        if r.participant_id is not None and r.refid and r.event_id in ev:
            groups.setdefault((r.refid, r.event_id), []).append(r)
    out = []
    for (site, event), rows in groups.items():
        e = ev[event]
        names = [titles.get(r.part_id) if titles is not None else e.program_name for r in rows]
        out.append((site, event, min((n or e.program or "")[:60] for n in names), e.event_startdate.strftime("%b %Y") if e.event_startdate else "",
                    len({r.participant_id for r in rows}), sum(bool(r.attendance) for r in rows), (e.program or "")[:40]))
    return sorted(out)


@pytest.mark.parametrize("seed, n, hot", [(1, 400, False), (2, 900, True), (3, 0, False)])
def test_summaries_equal_brute_force(spark, seed, n, hot):
    people, events, titles = tables(spark, seed, n, hot)
    p, e, t = people.collect(), events.collect(), {r.id: r.name for r in titles.collect()}
    got = rollups.event_summaries(people, events, titles)
    assert sorted(map(tuple, got.collect())) == brute(p, e, t)
    own = rollups.event_summaries(people, events)
    assert sorted(map(tuple, own.collect())) == brute(p, e)
    # The fact's own summary gives the same rows.
    fact = people.join(events, "event_id").withColumnRenamed("refid", "event_site_refid")
    assert sorted(map(tuple, rollups.event_summary(fact).collect())) == brute(p, e)


def test_zero_attendance_filters(spark):
    people, events, _ = tables(spark, 4, 500)
    rows = [r for r in brute(people.collect(), events.collect()) if r[5] == 0]
    got = rollups.zero_attendance_summaries(people, events)
    assert sorted(map(tuple, got.collect())) == rows
    prog = rollups.zero_attendance_summaries(people, events, program="prog", sites=spark.createDataFrame([("S1",)], "refid string"))
    assert sorted(map(tuple, prog.collect())) == [r for r in rows if r[0] == "S1" and r[6] == "prog"]
    week = rollups.zero_attendance_summaries(people, events, week="2026-01-07")
    monday = dt.date(2026, 1, 5)
    days = {e.event_id: e.event_startdate for e in events.collect()}
    assert {r.event_id for r in week.collect()} == {r[1] for r in rows if days[r[1]] and monday <= days[r[1]] < monday + dt.timedelta(7)}


@pytest.mark.parametrize("name", ["event_summary", "site_events", "zero_attendance_events"])
def test_no_sort_aggregate(spark, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortAggregate" not in plan_of(E.queries()[name](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_events_own_titles_are_joined_after_the_reduction(spark):
    """Participants reach the join with one row for each site and event."""
    people, events, _ = tables(spark, 5, 50)
    plan = rollups.event_summaries(people, events)._jdf.queryExecution().optimizedPlan().toString()
    join = next(i for i, x in enumerate(plan.splitlines()) if "Join Inner" in x)
    below = "\n".join(plan.splitlines()[join:])
    assert "Aggregate" in below and "Aggregate" not in "\n".join(plan.splitlines()[:join])
