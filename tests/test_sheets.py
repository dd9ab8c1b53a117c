"""Complete sheets against a brute-force loop over sheets, sites and groups."""

import datetime as dt
import random
import re

import pytest

import __spark_entry__ as E
from conftest import SMALL, make_fact
from tallyhall.config import Classifier, PillarSpec
from tallyhall.operators import pivots

PILLARS = [PillarSpec("P1", "sub_pillar_name"), PillarSpec("P2", "program_name", Classifier(rules=(("x", "X"),), default="Y"), ("X", "Y")),
           PillarSpec("P3", "sub_pillar_name")]


def brute(rows):
    sites = {(r["event_site_refid"], r.get("event_site_name"), r.get("event_site_state")) for r in rows if r.get("event_site_refid")}
    named = [dict(r, d=r["event_start"].date() if r.get("event_start") else None) for r in rows if "NADI4U" in (r.get("category_name") or "")]
    months = sorted({(r["d"].year, r["d"].month) for r in named if r["d"]})
    label = lambda y, m: dt.date(y, m, 1).strftime("%b %Y")
    sheets = [("month", label(*m), lambda d, m=m: d and (d.year, d.month) == m) for m in months]
    for y, q in sorted({(y, (m + 2) // 3) for y, m in months}):
        sheets.append(("quarter", f"Q{q} {y}", lambda d, y=y, q=q: d and (d.year, (d.month + 2) // 3) == (y, q)))
    for m in months[-3:]:
        for w in (1, 2, 3, 4):
            sheets.append(("week", f"{label(*m)} W{w}", lambda d, m=m, w=w: d and (d.year, d.month) == m and min((d.day - 1) // 7, 3) == w - 1))
    sheets.append(("all", "All", lambda d: True))
    out = []
    for p in PILLARS:
        of = [r for r in named if r.get("pillar_name") == p.name]
        group = lambda r, p=p: ("X" if "x" in (r.get("program_name") or "").lower() else "Y") if p.classifier else r.get("sub_pillar_name")
        groups = list(p.groups) if p.groups else sorted({group(r) for r in of if group(r)})
        for grain, sheet, on in sheets:
            for site in sites:
                here = [r for r in of if on(r["d"]) and (r.get("event_site_refid"), r.get("event_site_name"), r.get("event_site_state")) == site
                        and site[1] is not None and site[2] is not None and group(r) in groups]
                for g in [*groups, "Total"]:
                    cell = [r for r in here if g == "Total" or group(r) == g]
                    out.append((p.name, grain, sheet, *site, g, len({r["event_id"] for r in cell if r.get("event_id") is not None}),
                                len({r["participant_id"] for r in cell if r.get("participant_id") is not None})))
    return sorted(out, key=str)


def some_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = rng.randrange(6)
        rows.append({
            "event_id": rng.choice([None, *range(12)]), "participant_id": rng.choice([None, "a", "b", "c", "d"]),
            "event_site_refid": ["S0", "S1", "S2", None, "", "S1"][s], "event_site_name": ["zero", "one", None, "n", "n", "renamed"][s],
            "event_site_state": ["A", "A", "B", "C", "C", None if i % 2 else "A"][s],
            "category_name": rng.choice(["NADI4U", "x NADI4U", "OTHER", None]), "pillar_name": rng.choice(["P1", "P2", "P9", None]),
            "sub_pillar_name": rng.choice(["g1", "g2", "", None]), "program_name": rng.choice(["ax", "b", None]),
            "event_start": rng.choice([None, dt.datetime(2025, rng.randrange(1, 13), rng.randrange(1, 29), 9), dt.datetime(2026, 1, 31, 23, 59)])})
    return rows


@pytest.mark.parametrize("seed, n", [(1, 300), (2, 40), (3, 1)])
def test_complete_sheets_equal_brute_force(spark, seed, n):
    rows = some_rows(seed, n)
    got = pivots.complete_sheets(make_fact(spark, rows), PILLARS)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_a_site_outside_the_category_is_on_every_sheet_and_an_empty_fact_has_none(spark):
    rows = [{"event_id": 1, "participant_id": "a", "event_site_refid": "S1", "event_site_name": "one", "event_site_state": "A",
             "category_name": "NADI4U", "pillar_name": "P1", "sub_pillar_name": "g", "event_start": dt.datetime(2026, 1, 5)},
            {"event_id": 2, "participant_id": "b", "event_site_refid": "S2", "event_site_name": "two", "event_site_state": "A", "category_name": "OTHER"}]
    got = pivots.complete_sheets(make_fact(spark, rows), PILLARS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert {r.refid for r in got if r.sheet == "Jan 2026"} == {"S1", "S2"} and not any(r.events for r in got if r.refid == "S2")
    assert pivots.complete_sheets(make_fact(spark, []), PILLARS).count() == 0
    no_dates = [{**r, "event_start": None} for r in rows]
    got = pivots.complete_sheets(make_fact(spark, no_dates), PILLARS).collect()
    assert {r.sheet for r in got} == {"All"} and sorted(map(tuple, got), key=str) == brute(no_dates)


def test_every_sheet_lists_every_site(spark):
    rows = some_rows(9, 200)
    got = pivots.complete_sheets(make_fact(spark, rows), PILLARS).select("pillar_name", "grain", "sheet", "refid", "site_name", "state").distinct()
    per = {r["count"] for r in got.groupBy("pillar_name", "grain", "sheet").count().collect()}
    assert len(per) == 1


def test_rows_are_gathered_by_id_before_they_fan_out_to_sheets(spark):
    """An id's row crosses one exchange, and goes to its sheets and totals
    after it; events of many groups, months and quarters count once in each."""
    rows = [{"event_id": 1, "participant_id": p, "event_site_refid": "S", "event_site_name": "n", "event_site_state": "A", "category_name": "NADI4U",
             "pillar_name": "P1", "sub_pillar_name": g, "event_start": dt.datetime(2025, m, d)}
            for p in ("a", "b") for g in ("g1", "g2") for m, d in ((1, 2), (1, 9), (4, 30), (12, 31))]
    out = pivots.pivot_all_grains(make_fact(spark, rows), PILLARS)
    got = {(r.sheet, r.grp): (r.events, r.pax) for r in out.collect()}
    sheets = ["Jan 2025", "Apr 2025", "Dec 2025", "Q1 2025", "Q2 2025", "Q4 2025", "Jan 2025 W1", "Jan 2025 W2", "Apr 2025 W4", "Dec 2025 W4", "All"]
    assert got == {(s, g): (1, 2) for s in sheets for g in ("g1", "g2", "Total")}
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("scalar-subquery")[0]
    below = plan[plan.index("collect_set("):]
    assert "sheet" not in below.split("\n", 1)[1]


def test_counts_go_by_site_once_and_every_sheet_is_made_there(spark):
    """One exchange by site and part of the ids, one by site; none for the
    fan-out to sheets, the sheets of a site and its zeros."""
    def moved(df):
        plan = df._jdf.queryExecution().executedPlan().toString().split("Union")[0]
        return [x.split("Exchange ")[1] for x in plan.splitlines() if re.match(r" *\+- Exchange", x)]
    fact = make_fact(spark, some_rows(4, 50))
    site, part = r"hashpartitioning\(refid\S+ site_name\S+ state", r"hashpartitioning\(part\S+ refid"
    by_site, by_part = moved(pivots.pivot_all_grains(fact, PILLARS))
    assert re.match(site, by_site) and re.match(part, by_part)
    (by_site,) = moved(pivots.complete_sheets(fact, PILLARS))
    assert re.match(site, by_site)


def test_a_site_with_all_ids_is_spread_over_parts(spark):
    rows = [{"event_id": i % 40, "participant_id": f"p{i % 90}", "event_site_refid": "S1", "event_site_name": "one", "event_site_state": "A",
             "category_name": "NADI4U", "pillar_name": "P1", "sub_pillar_name": f"g{i % 3}",
             "event_start": dt.datetime(2026, 1 + i % 5, 1 + i % 28)} for i in range(400)]
    got = pivots.complete_sheets(make_fact(spark, rows), PILLARS)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_lists_of_sheets_do_not_look_up_the_columns_of_fixed_groups(spark):
    plan = E.queries()["complete_sheets"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert sum("part.parquet" in x for x in plan.splitlines() if "FileScan" in x) == 1  # the cells' own
