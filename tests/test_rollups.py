import datetime as dt

from pyspark.sql import functions as F

from conftest import make_fact, make_sites
from tallyhall.operators import joins, pivots, rollups

D1, D2 = dt.date(2026, 1, 5), dt.date(2026, 2, 3)


def fact_rows():
    return [
        # same participant twice at S1, both in the women class
        dict(event_id=1, participant_id="p1", event_site_refid="S1", home_refid="S1", program="A", gender="Perempuan",
             age="20", oku_status="true", attendance="true", event_startdate=D1),
        dict(event_id=1, participant_id="p1", event_site_refid="S1", home_refid="S1", program="A", gender="Perempuan",
             age="11", oku_status="false", attendance="false", event_startdate=D1),
        # empty site: skipped per site, counted in the month total
        dict(event_id=2, participant_id="p2", event_site_refid="", home_refid="S2", program="", gender="Lelaki",
             age="abc", attendance="0", event_startdate=D1),
        # null site
        dict(event_id=3, participant_id="p3", event_site_refid=None, home_refid="S2", program="B", gender="Lelaki",
             age=None, attendance="f", event_startdate=D2),
        # null date
        dict(event_id=4, participant_id="p4", event_site_refid="S2", home_refid="S2", program="B", gender="Lelaki",
             age="30", attendance="1", event_startdate=None),
        # null participant only month
        dict(event_id=5, participant_id=None, event_site_refid="S2", program="B", event_startdate=dt.date(2026, 3, 1)),
        # unknown site
        dict(event_id=6, participant_id="p6", event_site_refid="S9", home_refid="S9", program="B", gender="Lelaki",
             age="16", attendance="yes", event_startdate=D2),
        # site S3: only unprogrammed events (home keyed)
        dict(event_id=7, participant_id="p7", event_site_refid="S3", home_refid="S3", program="", gender="Lelaki",
             age="16", attendance="yes", event_startdate=D2),
    ]


def sites(spark):
    return make_sites(spark, [("S1", "One", "A-State"), ("S2", "Two", "B-State"), ("S3", "Three", None),
                              ("S4", "Four", "A-State")])


def test_site_index_counts_and_densify(spark):
    out = {r["refid"]: r for r in rollups.site_index(make_fact(spark, fact_rows()), sites(spark)).collect()}
    assert set(out) == {"S1", "S2", "S3", "S4"}          # unknown S9 dropped, idle S4 kept
    s1 = out["S1"]
    assert (s1.events, s1.pax_total, s1.women, s1.youth, s1.children, s1.oku) == (1, 1, 2, 1, 1, 1)
    assert out["S4"].events == 0 and out["S4"].pax_total == 0
    assert out["S2"].events == 1      # event 5 has no participant


def test_monthly_rollup_null_participant_month(spark):
    rows = {r["period"]: r for r in rollups.monthly_rollup(make_fact(spark, fact_rows())).collect()}
    assert set(rows) == {"2026-01", "2026-02", "2026-03"}
    assert rows["2026-03"].events == 0 and rows["2026-03"].pax_total == 0
    assert rows["2026-01"].events == 2                      # empty-site event counted in the month


def test_monthly_site_skips_empty_and_null_sites(spark):
    refs = {r["refid"] for r in rollups.monthly_site(make_fact(spark, fact_rows())).collect()}
    assert "" not in refs and None not in refs


def test_pivot_home_total_rule(spark):
    out = {r["refid"]: r for r in pivots.pivot_wide_home(make_fact(spark, fact_rows()), sites(spark),
                                                         ["A", "B"]).collect()}
    assert out["S3"].total_events == 0 and out["S3"].total_pax == 0   # only unprogrammed rows
    assert out["S2"].B_events == 2 and out["S2"].total_events == 3     # total includes the unprogrammed event
    assert "S9" not in out


def test_pivot_group_outer_alignment_keeps_unknown_sites(spark):
    f = make_fact(spark, fact_rows()).withColumn("event_site_name", F.lit("n")).withColumn("event_site_state",
                                                                                           F.lit("s"))
    listed = make_sites(spark, [("S1", "n", "s"), ("S4", "n", "s")])
    out = {r["refid"]: r for r in pivots.pivot_wide_group(f, "program", ["A", "B"], all_sites=listed).collect()}
    assert "S9" in out and out["S9"].B_events == 1                      # kept by outer alignment
    assert out["S4"].total_events == 0                                  # densified to zero
    assert "S3" not in out                                              # only empty-group rows


def test_dedupe_first_is_deterministic(spark):
    df = spark.createDataFrame([("S1", "Zed", "B"), ("S1", "Abe", "A"), ("S2", "X", None)],
                               "refid string, site_name string, state string")
    got = {r.refid: r.site_name for r in joins.dedupe_first(df, ["refid"], ["state", "site_name"]).collect()}
    assert got == {"S1": "Abe", "S2": "X"}


def test_untouched_and_status_partition_sites(spark):
    f = make_fact(spark, fact_rows())
    st = rollups.site_status(f, sites(spark)).collect()
    assert {r.refid for r in st} == {"S1", "S2", "S3", "S4"}
    by = {r.refid: r.status for r in st}
    assert by["S4"] == "untouched" and by["S1"] == "all_complete" and by["S3"] == "all_complete"
    active = f.where(F.col("participant_id").isNotNull()).select(F.col("event_site_refid").alias("refid"))
    untouched = {r.refid for r in joins.untouched(sites(spark), active, "refid").collect()}
    assert untouched == {"S4"}


def test_union_slices_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "sub int, v string")
    b = spark.createDataFrame([("y", 2, 9)], "v string, sub int, extra int")
    got = sorted(tuple(r) for r in joins.union_slices([a, b]).select("sub", "v", "extra").collect())
    assert got == [(1, "x", None), (2, "y", 9)]
