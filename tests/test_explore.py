"""Explorer: summaries, facet tuples, the trigram index and co-partitioned
storage against brute force."""

import datetime as dt
import random
from collections import ChainMap

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from tallyhall.config import FilterSpec
from tallyhall.operators import explore, filters, search
from tallyhall.operators import fact as fb
from tallyhall.sinks import bucketed
from tallyhall.sources import fixtures as fx
from test_plans import plan_of

FACETS = ["category_name", "pillar_name", "sub_pillar_name", "deeper_sub_pillar"]


def view(spark, seed=1, n=400):
    rng = random.Random(seed)
    pick = lambda *x: rng.choice([None, "", *x])
    rows = [(pick("A", "B"), pick("P", "Q"), pick("s1", "s2", "S3"), pick("d"), pick("Ann Lee", "Bob", "Zoë Ünal"), pick("North Hall", "Hall"),
             pick("Yoga", "Code club"), rng.choice([None, dt.date(2026, 1, 1 + i % 28)]), pick("p1", "p2", "p3"), rng.choice([None, 1, 2, 3]),
             pick("X", "Y")) for i in range(n)]
    return spark.createDataFrame(rows, "category_name string, pillar_name string, sub_pillar_name string, deeper_sub_pillar string, "
                                 "participant_name string, site_name string, program_name string, event_startdate date, "
                                 "participant_id string, event_id bigint, site_state string")


def test_facets_and_cascades_of_one_tuple_table(spark):
    v = view(spark)
    rows = v.collect()
    tuples = explore.facet_tuples(v, FACETS)
    assert tuples.count() == len({tuple(r[f] for f in FACETS) for r in rows})
    dates = [r.event_startdate for r in rows if r.event_startdate]
    want = sorted({(f, r[f]) for f in FACETS for r in rows if r[f]} | {("date_from", str(min(dates))), ("date_to", str(max(dates)))})
    assert [tuple(r) for r in explore.facets_of(tuples, FACETS).collect()] == want == [tuple(r) for r in explore.facet_values(v, FACETS).collect()]
    pool = [r for r in rows if r.category_name == "A" and r.pillar_name == "Q"]
    below = sorted({(f, r[f]) for f in FACETS[2:] for r in pool if r[f]})
    picks = {"category_name": "A", "pillar_name": "Q", "sub_pillar_name": "s1"}
    assert [tuple(r) for r in explore.cascade(tuples, picks, "pillar_name").collect()] == below
    assert [tuple(r) for r in explore.cascaded_facets(v, picks, "pillar_name").collect()] == below
    empty = v.limit(0)
    assert explore.facet_values(empty, FACETS).count() == 0


def test_stats_and_summary_equal_brute_force(spark):
    v = view(spark, 2)
    rows = v.collect()
    spec = FilterSpec(facets={"pillar_name": "P"}, date_from="2026-01-05", search="HALL y")
    hay = lambda r: " ".join(r[c] or "" for c in spec.search_fields).lower()
    hit = [r for r in rows if r.pillar_name == "P" and (r.event_startdate is None or r.event_startdate >= dt.date(2026, 1, 5)) and "hall y" in hay(r)]
    n = lambda c, of: len({r[c] for r in of if r[c] not in (None, "")})
    got = tuple(explore.filtered_stats(v, spec).first())
    assert hit and got == (len(rows), len(hit), n("participant_id", hit), n("event_id", hit), n("site_name", hit), n("site_state", hit))
    s = explore.dataset_summary(v, site_col="site_name").first()
    d = lambda c: len({r[c] for r in rows if r[c] is not None})
    dates = [r.event_startdate for r in rows if r.event_startdate]
    assert tuple(s) == (len(rows), d("participant_id"), d("event_id"), d("site_name"), d("category_name"), d("pillar_name"), min(dates), max(dates))
    assert tuple(explore.dataset_summary(v.limit(0), site_col="site_name").first()) == (0, 0, 0, 0, 0, 0, None, None)
    assert tuple(explore.filtered_stats(v.limit(0), spec).first()) == (0,) * 6


@pytest.mark.parametrize("name", ["dataset_summary", "filtered_stats", "facet_values", "cascaded_facets"])
def test_one_hash_aggregate_without_expand(spark, name):
    plan = plan_of(E.queries()[name](spark, SMALL))
    assert "Expand" not in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_the_preview_counts_with_the_filters_columns_alone(spark):
    plan = plan_of(E.queries()["preview_200"](spark, SMALL))
    count = plan.split("Subquery", 2)[-1]
    assert "region.parquet" in plan and "Subquery" in plan and "region.parquet" not in count.split("== Final")[0].split("+- FileScan parquet [l_")[0]


NEEDLES = ["hall", "l yo", " Ann ", "zoë ü", "code club s", "xyz", "ha", "a", "", "  ", "lee n", "hall hall", "e"]


def test_search_by_the_index_equals_the_scan(spark, tmp_path):
    v = view(spark, 3, 600)
    path = str(tmp_path / "i")
    search.build_index(v, path)
    for needle in NEEDLES:
        want = v.where(filters.spec_predicate(FilterSpec(search=needle))).collect()
        assert sorted(map(str, search.search(v, path, needle).collect())) == sorted(map(str, want)), needle
    assert search.candidate_keys(spark, path, "ha") is None and search.candidate_keys(spark, path, "xyz").count() == 0
    assert search.candidate_keys(spark, path, "club s2").count() < v.select(search.text_key()).distinct().count()


def test_postings_are_in_order_so_a_lookup_skips_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        search.build_index(view(spark, 4, 600), str(tmp_path / "i"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    import pyarrow.parquet as pq
    files = sorted((tmp_path / "i" / "postings").glob("*.parquet"))
    grams = [pq.read_table(f).column("gram").to_pylist() for f in files]
    flat = [g for part in grams for g in part]
    assert len(files) > 2 and flat == sorted(flat) and sum("clu" in part for part in grams) <= 2


def test_an_index_of_an_empty_view(spark, tmp_path):
    v = view(spark).limit(0)
    search.build_index(v, str(tmp_path / "i"))
    assert search.search(v, str(tmp_path / "i"), "hall").count() == 0


def test_copartitioned_tables_join_without_an_exchange(spark):
    t = fx.Tables(spark, SMALL, fx.FIXTURE_EXCLUDED)
    names = bucketed.write_copartitioned({k: t[k] for k in ("events", "participants")}, "test_copart", buckets=4)
    stored = ChainMap(bucketed.read_copartitioned(spark, names), t)
    columns = ["event_id", "participant_id", "pillar_name", "attendance"]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = fb.build_fact(stored, columns, graph=fx.GRAPH, unique=fx.UNIQUE)
        plan = plan_of(f)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        per_event = plan_of(f.groupBy("event_id").count())
        assert "Exchange" not in per_event  # the aggregate on the event reuses the buckets
        assert "Exchange" in plan_of(fx.fact(spark, SMALL, columns))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for table in names.values():
            spark.sql(f"DROP TABLE {table}")


def test_copartitioned_fact_has_the_rows_of_the_plain_one(spark):
    t = fx.Tables(spark, SMALL, fx.FIXTURE_EXCLUDED)
    names = bucketed.write_copartitioned({k: t[k] for k in ("events", "participants")}, "test_copart_rows", buckets=3)
    stored = ChainMap(bucketed.read_copartitioned(spark, names), t)
    columns = ["event_id", "participant_id", "event_site_state", "program"]
    got = fb.build_fact(stored, columns, graph=fx.GRAPH, unique=fx.UNIQUE).collect()
    assert sorted(map(str, got)) == sorted(map(str, fx.fact(spark, SMALL, columns).select(*columns).collect()))
    for table in names.values():
        spark.sql(f"DROP TABLE {table}")


def test_the_index_holds_each_field_value_once(spark, tmp_path):
    """Every person at every site: the postings are those of the values, not
    of the joined texts, and a needle over two fields still finds its rows."""
    names = {c: f"v{i}x" for i, c in enumerate(search.SEARCH_FIELDS)}
    first, second = search.SEARCH_FIELDS[:2]
    v = spark.range(30).crossJoin(spark.range(20).toDF("site")).select(
        F.concat(F.lit("person"), F.col("id").cast("string")).alias(first), F.concat(F.lit("place"), F.col("site").cast("string")).alias(second),
        *[F.lit(names[c]).alias(c) for c in search.SEARCH_FIELDS[2:]])
    path = str(tmp_path / "i")
    search.build_index(v, path)
    values = {f"person{i}" for i in range(30)} | {f"place{i}" for i in range(20)} | {names[c] for c in search.SEARCH_FIELDS[2:]}
    grams = sum(len({x[i:i + 3] for i in range(len(x) - 2)}) for x in values)
    assert search.tables.read_table(spark, f"{path}/postings").count() == grams
    assert search.candidate_keys(spark, path, "n7 place1").count() == 11
    assert search.search(v, path, "n7 place1").count() == 11 and search.search(v, path, "7 p").count() == 60
    assert search.search(v, path, "place1 person").count() == 0
