"""Driver query catalog: Spark builders and their DuckDB oracles.

Every query reads the whole driver tables (no id subsets or row caps); the
only limits are the features that are limits (the 200-row preview, the
latest three months).
"""

from __future__ import annotations

import uuid
from collections import ChainMap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CASCADE_ORDER, FACET_COLUMNS, Classifier, FilterSpec, PillarSpec
from ..functions.calendar import (to_utc_timestamp_safe, duration_hours, month_key, month_name, us_date, us_datetime,
                                  year_quarter)
from ..functions.classify import classify
from ..functions.text import is_json_array, json_type, mask_identity, safe_int, strip_control, to_number
from ..operators import explore, filters, joins, pivots, rollups, search
from ..operators import fact as fact_builder
from ..session import shared_dir
from ..sinks import bucketed, payload, tables
from ..sinks.writers import checkpoint_table
from ..sources import fixtures as fx
from ..sources.readers import read_table
from . import oracle_sql as O

FIXTURE_CLASSIFIER = Classifier(rules=(("small", "A"), ("ring|bolt", "B"), ("widget", "C")), default="Z")
FIXTURE_GROUPS = ["A", "B", "C", "Z"]
FIXTURE_PROGRAMS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
FIXTURE_PILLARS = [
    PillarSpec("1-URGENT", "sub_pillar_name"),
    PillarSpec("2-HIGH", "program_name", FIXTURE_CLASSIFIER, tuple(FIXTURE_GROUPS)),
    PillarSpec("3-MEDIUM", "sub_pillar_name"),
    PillarSpec("4-NOT SPECIFIED", "sub_pillar_name"),
    PillarSpec("5-LOW", "sub_pillar_name"),
]
FIXTURE_SPEC = FilterSpec(facets={"pillar_name": "1-URGENT"}, date_from="1996-01-01", date_to="1997-12-31",
                          search="blue")
WINDOW = ("1996-01-01", "1997-12-31")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _fact(spark, root, cols):
    return fx.fact(spark, root, cols)


# ---------------------------------------------------------------------------
# Sources and eligibility
# ---------------------------------------------------------------------------

_ELIGIBLE_SQL = f"""
SELECT DISTINCT o.o_orderkey AS event_id
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey
WHERE CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN true WHEN 'BUILDING' THEN true ELSE false END
  AND CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)
      + CASE o.o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 5 ELSE 8 END = 1
  AND o.o_custkey IS NOT NULL
  AND o.o_orderstatus NOT IN ('P')
  AND CAST(o.o_orderdate AS DATE) >= DATE '{WINDOW[0]}' AND CAST(o.o_orderdate AS DATE) <= DATE '{WINDOW[1]}'
"""


@register("eligible_events", _ELIGIBLE_SQL)
def q_eligible_events(spark, root):
    return filters.eligible_events(fx.events(spark, root), 1, fx.FIXTURE_EXCLUDED, *WINDOW).orderBy("event_id")


@register("events_with_participants", """
SELECT o.o_orderkey AS event_id, o.o_orderpriority AS pillar_name, o.o_orderstatus AS status_id
FROM orders o
WHERE o.o_orderstatus NOT IN ('P') AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def q_events_with_participants(spark, root):
    ev = fx.events(spark, root).select("event_id", "pillar_name", "status_id")
    parts = read_table(spark, root, "lineitem").select(F.col("l_orderkey").alias("event_id"))
    return filters.events_with_participants(ev, parts, fx.FIXTURE_EXCLUDED)


_FACT_OUT = [c for c in fx.FACT_COLUMNS if c not in ("event_start", "event_end")]


_MASKED = "CASE WHEN identity_no IS NOT NULL THEN substr(lpad(identity_no, 12, '0'), 1, 8) || '****' END"


@register("consolidated_fact", O.FACT_CTE + f"SELECT {', '.join(f'{_MASKED} AS {c}' if c == 'identity_no' else c for c in _FACT_OUT)} FROM fact")
def q_consolidated_fact(spark, root):
    return fx.fact(spark, root, _FACT_OUT)


@register("site_dimension", O.FACT_CTE + """
SELECT refid, site_name, state, region, tp, dusp, phase FROM site_dim WHERE refid IS NOT NULL AND refid <> ''
ORDER BY COALESCE(state, ''), site_name
""")
def q_site_dimension(spark, root):
    s = rollups.site_dimension(fx.sites(spark, root))
    return (s.select("refid", "site_name", "state", "region", "tp", "dusp", "phase")
             .orderBy(F.coalesce(F.col("state"), F.lit("")), F.col("site_name").asc_nulls_last()))


@register("fact_sites", O.FACT_CTE + """
SELECT DISTINCT event_site_refid AS refid, event_site_name AS site_name, event_site_state AS state FROM fact
WHERE event_site_refid IS NOT NULL AND event_site_refid <> ''
""")
def q_fact_sites(spark, root):
    return pivots.unique_fact_sites(_fact(spark, root, ["event_site_refid", "event_site_name", "event_site_state"]))


@register("self_hierarchy", """
WITH orgs AS (
  SELECT CAST(n_nationkey AS BIGINT) AS org_id, 'TP ' || n_name AS org_name, 'tp' AS org_type,
         CAST(n_regionkey + 1000 AS BIGINT) AS parent_id FROM nation
  UNION ALL
  SELECT CAST(r_regionkey + 1000 AS BIGINT), 'DUSP ' || r_name, 'dusp', NULL FROM region)
SELECT s.s_suppkey AS site_id, t.org_name AS tp_name, d.org_name AS dusp_name
FROM supplier s
LEFT JOIN orgs t ON t.org_id = CAST(s.s_nationkey AS BIGINT) AND t.org_type = 'tp'
LEFT JOIN orgs d ON d.org_id = t.parent_id AND d.org_type = 'dusp'
""")
def q_self_hierarchy(spark, root):
    sup = read_table(spark, root, "supplier").select(F.col("s_suppkey").alias("site_id"),
                                                     F.col("s_nationkey").cast("bigint").alias("org_key"))
    out = joins.typed_parent(sup, fx.organizations(spark, root), "org_key", "tp", "dusp")
    return out.select("site_id", "tp_name", "dusp_name")


@register("expression_key_join", O.FACT_CTE + """
, g(code, gender_label) AS (VALUES ('A', 'Perempuan'), ('N', 'Lelaki'), ('R', 'Lelaki'), ('F', 'Perempuan'),
                                   ('O', 'Lelaki'))
SELECT l.l_orderkey AS event_id, CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR)
         AS participant_id, g.gender_label
FROM lineitem l
LEFT JOIN g ON g.code = COALESCE(CASE WHEN l.l_linenumber <= 5 THEN l.l_returnflag END,
                                 CASE WHEN l.l_linenumber = 6 THEN l.l_linestatus END)
""")
def q_expression_key_join(spark, root):
    li = read_table(spark, root, "lineitem")
    genders = spark.createDataFrame([("A", "Perempuan"), ("N", "Lelaki"), ("R", "Lelaki"), ("F", "Perempuan"),
                                     ("O", "Lelaki")], "code string, gender_label string")
    member_code = F.when(F.col("l_linenumber") <= 5, F.col("l_returnflag"))
    u12_code = F.when(F.col("l_linenumber") == 6, F.col("l_linestatus"))
    base = li.select(F.col("l_orderkey").alias("event_id"),
                     F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                              F.col("l_linenumber").cast("string")).alias("participant_id"),
                     member_code.alias("mc"), u12_code.alias("uc"))
    out = joins.expression_key_join(base, F.broadcast(genders), F.coalesce("mc", "uc"), "code")
    return out.select("event_id", "participant_id", "gender_label")


@register("subcategory_union", O.FACT_CTE + """
SELECT f.subcategory_id, s.sub_label, count(*) AS row_count, count(DISTINCT f.event_id) AS events
FROM fact f JOIN subcat s ON s.subcategory_id = f.subcategory_id
WHERE f.subcategory_id IN (1, 2, 3, 4, 8)
GROUP BY f.subcategory_id, s.sub_label
""")
def q_subcategory_union(spark, root):
    from ..config import ACTIVE_SUBCATEGORIES, SUBCATEGORIES
    f = _fact(spark, root, ["subcategory_id", "event_id"])
    sl = filters.subcategory_filter(f, list(ACTIVE_SUBCATEGORIES), [s[0] for s in SUBCATEGORIES])
    agg = sl.groupBy("subcategory_id").agg(F.count(F.lit(1)).cast("bigint").alias("row_count"),
                                           F.count_distinct("event_id").cast("bigint").alias("events"))
    dim = F.broadcast(fx.subcategory_dim(spark).select("subcategory_id", "sub_label"))
    return agg.join(dim, "subcategory_id", "inner").select("subcategory_id", "sub_label", "row_count", "events")


@register("run_catalogue", O.FACT_CTE + """
SELECT s.subcategory_id, s.category_name, s.module, s.sub_label,
       COALESCE(a.row_count, 0) AS row_count, COALESCE(a.events, 0) AS events,
       COALESCE(a.row_count, 0) > 0 AS has_data, a.first_date, a.last_date
FROM subcat s LEFT JOIN (
  SELECT subcategory_id, count(*) AS row_count, count(DISTINCT event_id) AS events,
         min(event_startdate) AS first_date, max(event_startdate) AS last_date
  FROM fact GROUP BY subcategory_id) a ON a.subcategory_id = s.subcategory_id
""")
def q_run_catalogue(spark, root):
    f = _fact(spark, root, ["subcategory_id", "event_id", "event_startdate"])
    return payload.run_catalogue(f, fx.subcategory_dim(spark))


# ---------------------------------------------------------------------------
# Projections and scalar functions
# ---------------------------------------------------------------------------

@register("calendar_columns", """
SELECT o_orderkey AS event_id,
       CAST(year(o_orderdate) AS INTEGER) AS event_year,
       CAST(quarter(o_orderdate) AS INTEGER) AS event_quarter,
       CAST(month(o_orderdate) AS INTEGER) AS event_month,
       strftime(o_orderdate, '%B') AS event_month_name,
       strftime(o_orderdate, '%Y-%m') AS event_year_month,
       CAST(year(o_orderdate) AS VARCHAR) || '-Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS event_year_quarter,
       strftime(o_orderdate, '%-m/%-d/%Y %H:%M') AS start_text,
       strftime(o_orderdate, '%-m/%-d/%Y') AS start_date_text
FROM orders
""")
def q_calendar_columns(spark, root):
    o = read_table(spark, root, "orders")
    d = F.col("o_orderdate")
    return o.select(F.col("o_orderkey").alias("event_id"), F.year(d).alias("event_year"),
                    F.quarter(d).alias("event_quarter"), F.month(d).alias("event_month"),
                    month_name(d).alias("event_month_name"), month_key(d).alias("event_year_month"),
                    year_quarter(d).alias("event_year_quarter"), us_datetime(d).alias("start_text"),
                    us_date(d).alias("start_date_text"))


@register("event_duration", f"""
SELECT event_id, {O.DURATION.format(s="date_trunc('day', ts)", e="ts")} AS duration_hours
FROM events
""")
def q_event_duration(spark, root):
    e = fx.event_log(spark, root)
    return e.select("event_id", duration_hours(F.date_trunc("day", "ts"), F.col("ts")).alias("duration_hours"))


@register("participant_type", O.FACT_CTE + """
SELECT event_id, participant_id, member_id, under12_id, participant_type, creator_type, deeper_sub_pillar FROM fact
""")
def q_participant_type(spark, root):
    return _fact(spark, root, ["event_id", "participant_id", "member_id", "under12_id", "participant_type",
                               "creator_type", "deeper_sub_pillar"])


@register("masked_identity", O.FACT_CTE + """
SELECT participant_id, identity_no,
       CASE WHEN identity_no IS NOT NULL THEN substr(lpad(identity_no, 12, '0'), 1, 8) || '****' END AS identity_masked
FROM fact
""")
def q_masked_identity(spark, root):
    f = fx.fact(spark, root, ["participant_id", "identity_no"], personal=True)
    return f.select("participant_id", "identity_no", mask_identity("identity_no").alias("identity_masked"))


@register("clean_strings", r"""
SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g') AS text_clean,
       CAST(length(text) - length(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')) AS BIGINT)
         AS removed_chars
FROM documents
""")
def q_clean_strings(spark, root):
    d = read_table(spark, root, "documents").select("doc_id", "text")
    clean = strip_control("text")
    return d.select("doc_id", clean.alias("text_clean"),
                    (F.length("text") - F.length(clean)).cast("bigint").alias("removed_chars"))


@register("classified_programs", O.FACT_CTE + f"""
SELECT event_site_refid AS refid, {O.FIXTURE_CLASSIFY.format(c='program_name')} AS program,
       count(DISTINCT event_id) AS events, count(DISTINCT participant_id) AS pax
FROM fact WHERE participant_id IS NOT NULL AND event_site_refid IS NOT NULL AND event_site_refid <> ''
GROUP BY 1, 2
""")
def q_classified_programs(spark, root):
    f = _fact(spark, root, ["event_site_refid", "program_name", "event_id", "participant_id"])
    return rollups.site_programs(f, program_col="program_name", classifier=FIXTURE_CLASSIFIER)


@register("attribute_regex_filter", O.FACT_CTE + """
SELECT event_id, participant_id, event_site_state, event_site_dusp FROM fact
WHERE COALESCE(contains(category_name, 'NADI4U'), false)
  AND COALESCE(regexp_matches(event_site_state, 'nation_(1|2)$', 'i'), false)
  AND COALESCE(regexp_matches(event_site_dusp, 'asia|europe', 'i'), false)
""")
def q_attribute_regex_filter(spark, root):
    f = _fact(spark, root, ["event_id", "participant_id", "event_site_state", "event_site_dusp", "category_name"])
    f = f.where(filters.category_contains("category_name", "NADI4U"))
    f = filters.attribute_regex(f, {"event_site_state": "nation_(1|2)$", "event_site_dusp": "asia|europe"})
    return f.select("event_id", "participant_id", "event_site_state", "event_site_dusp")


_JSON_TEXT_SQL = """CASE event_type WHEN 'click' THEN '[' || CAST(user_id AS VARCHAR) || ']'
  WHEN 'view' THEN '[]' WHEN 'purchase' THEN props WHEN 'signup' THEN CAST(user_id AS VARCHAR)
  ELSE 'bad{' || CAST(user_id AS VARCHAR) END"""


def _json_text():
    u = F.col("user_id").cast("string")
    return (F.when(F.col("event_type") == "click", F.concat(F.lit("["), u, F.lit("]")))
             .when(F.col("event_type") == "view", F.lit("[]"))
             .when(F.col("event_type") == "purchase", F.col("props"))
             .when(F.col("event_type") == "signup", u)
             .otherwise(F.concat(F.lit("bad{"), u)))


@register("json_array_events", f"""
WITH j AS (SELECT event_id, {_JSON_TEXT_SQL} AS site_json FROM events)
SELECT event_id,
       CASE WHEN NOT json_valid(site_json) THEN 'invalid'
            WHEN json_type(site_json) = 'ARRAY' THEN 'array'
            WHEN json_type(site_json) = 'OBJECT' THEN 'object'
            WHEN json_type(site_json) = 'NULL' THEN 'null' ELSE 'scalar' END AS json_kind,
       CASE WHEN json_valid(site_json) THEN json_type(site_json) = 'ARRAY' ELSE false END AS is_array
FROM j
""")
def q_json_array_events(spark, root):
    e = fx.event_log(spark, root).select("event_id", _json_text().alias("site_json"))
    return e.select("event_id", json_type("site_json").alias("json_kind"), is_json_array("site_json").alias("is_array"))


@register("bucketed_fact_months", O.FACT_CTE + """
SELECT strftime(event_startdate, '%Y-%m') AS period, category_name, count(*) AS rows, count(DISTINCT event_id) AS events,
       count(DISTINCT participant_id) AS pax
FROM fact GROUP BY 1, 2
""")
def q_bucketed_fact_months(spark, root):
    """The fact over events and participants that are stored in the same
    buckets, so their join needs no exchange."""
    t = fx.Tables(spark, root, fx.FIXTURE_EXCLUDED)
    names = bucketed.write_copartitioned({k: t[k] for k in ("events", "participants")}, f"fact_{uuid.uuid4().hex}")
    stored = ChainMap(bucketed.read_copartitioned(spark, names), t)
    f = fact_builder.build_fact(stored, ["event_id", "participant_id", "event_startdate", "category_name"], graph=fx.GRAPH, unique=fx.UNIQUE)
    return f.groupBy(month_key("event_startdate").alias("period"), "category_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("event_id").alias("events"), F.count_distinct("participant_id").alias("pax"))


# ---------------------------------------------------------------------------
# Rollups
# ---------------------------------------------------------------------------

_PAX = "participant_id IS NOT NULL AND event_site_refid IS NOT NULL AND event_site_refid <> ''"


@register("site_index", O.FACT_CTE + f"""
SELECT s.refid, s.site_name, s.state, COALESCE(a.events, 0) AS events, COALESCE(a.pax_total, 0) AS pax_total,
       COALESCE(a.women, 0) AS women, COALESCE(a.youth, 0) AS youth, COALESCE(a.children, 0) AS children,
       COALESCE(a.oku, 0) AS oku
FROM site_dim s LEFT JOIN (
  SELECT event_site_refid AS refid, count(DISTINCT event_id) AS events, {O.DEMO}
  FROM fact WHERE {_PAX} GROUP BY 1) a ON a.refid = s.refid
WHERE s.refid <> ''
""")
def q_site_index(spark, root):
    f = _fact(spark, root, ["event_site_refid", "event_id", "participant_id", "gender", "age", "oku_status"])
    return rollups.site_index(f, fx.sites(spark, root))


@register("site_programs", O.FACT_CTE + f"""
SELECT event_site_refid AS refid, program, count(DISTINCT event_id) AS events, count(DISTINCT participant_id) AS pax
FROM fact WHERE {_PAX} AND program IS NOT NULL AND program <> '' GROUP BY 1, 2
""")
def q_site_programs(spark, root):
    f = _fact(spark, root, ["event_site_refid", "program", "event_id", "participant_id"])
    return rollups.site_programs(f)


@register("program_coverage", O.FACT_CTE + f"""
SELECT s.refid, s.site_name, s.state, COALESCE(a.n, 0) AS programs_covered
FROM site_dim s LEFT JOIN (
  SELECT event_site_refid AS refid, count(DISTINCT program) AS n
  FROM fact WHERE {_PAX} AND program IS NOT NULL AND program <> '' GROUP BY 1) a ON a.refid = s.refid
""")
def q_program_coverage(spark, root):
    f = _fact(spark, root, ["event_site_refid", "program", "event_id", "participant_id"])
    return rollups.program_coverage(f, fx.sites(spark, root))


_EVSUM_SQL = f"""
SELECT event_site_refid AS refid, event_id,
       min(substr(COALESCE(CASE WHEN program_name <> '' THEN program_name END,
                           CASE WHEN program <> '' THEN program END, ''), 1, 60)) AS name,
       COALESCE(min(strftime(event_startdate, '%b %Y')), '') AS month,
       count(DISTINCT participant_id) AS p,
       count(*) FILTER (WHERE lower(CAST(attendance AS VARCHAR)) IN ('true', '1', 't', 'yes')) AS a,
       min(substr(COALESCE(program, ''), 1, 40)) AS sub_program
FROM fact WHERE {_PAX} GROUP BY 1, 2"""


@register("event_summary", O.FACT_CTE + _EVSUM_SQL)
def q_event_summary(spark, root):
    return rollups.event_summaries(*fx.event_parts(spark, root))


@register("zero_attendance_events", O.FACT_CTE + f"SELECT * FROM ({_EVSUM_SQL}) WHERE a = 0")
def q_zero_attendance(spark, root):
    return rollups.zero_attendance_summaries(*fx.event_parts(spark, root))


@register("site_status", O.FACT_CTE + f"""
, evs AS ({_EVSUM_SQL}),
per AS (SELECT refid, count(*) AS events, count(*) FILTER (WHERE a = 0) AS zero_events FROM evs GROUP BY refid)
SELECT s.refid, s.site_name, s.state, COALESCE(per.events, 0) AS events, COALESCE(per.zero_events, 0) AS zero_events,
       CASE WHEN COALESCE(per.events, 0) = 0 THEN 'untouched' WHEN per.zero_events > 0 THEN 'has_zero'
            ELSE 'all_complete' END AS status
FROM site_dim s LEFT JOIN per ON per.refid = s.refid
""")
def q_site_status(spark, root):
    f = _fact(spark, root, ["event_site_refid", "event_id", "participant_id", "attendance"])
    return rollups.site_status(f, fx.sites(spark, root))


_MONTH = O.MONTH_START.format(d="event_startdate")


@register("monthly_rollup", O.FACT_CTE + f"""
SELECT {_MONTH} AS month_start, strftime({_MONTH}, '%Y-%m') AS period, strftime({_MONTH}, '%b %Y') AS label,
       count(DISTINCT event_id) FILTER (WHERE participant_id IS NOT NULL) AS events, {O.DEMO}
FROM fact WHERE event_startdate IS NOT NULL GROUP BY 1
""")
def q_monthly_rollup(spark, root):
    f = _fact(spark, root, ["event_startdate", "event_id", "participant_id", "gender", "age", "oku_status"])
    return rollups.monthly_rollup(f)


_MONTHLY_SITE_SQL = f"""
SELECT {_MONTH} AS month_start, strftime({_MONTH}, '%Y-%m') AS period, event_site_refid AS refid,
       count(DISTINCT event_id) AS events, count(DISTINCT participant_id) AS pax
FROM fact WHERE event_startdate IS NOT NULL AND {_PAX} GROUP BY 1, 3"""


@register("monthly_site", O.FACT_CTE + _MONTHLY_SITE_SQL)
def q_monthly_site(spark, root):
    f = _fact(spark, root, ["event_startdate", "event_site_refid", "event_id", "participant_id"])
    return rollups.monthly_site(f)


@register("monthly_heat", O.FACT_CTE + f"""
SELECT *, CASE WHEN events >= 100 THEN '100+' WHEN events >= 21 THEN '21-99' WHEN events >= 6 THEN '6-20'
               WHEN events >= 1 THEN '1-5' ELSE '0' END AS band
FROM ({_MONTHLY_SITE_SQL})
""")
def q_monthly_heat(spark, root):
    f = _fact(spark, root, ["event_startdate", "event_site_refid", "event_id", "participant_id"])
    return rollups.monthly_heat(f)


@register("site_month_series", O.FACT_CTE + f"""
, months AS (SELECT DISTINCT {_MONTH} AS month_start FROM fact WHERE event_startdate IS NOT NULL),
cells AS ({_MONTHLY_SITE_SQL})
SELECT s.refid, m.month_start, COALESCE(c.events, 0) AS events, COALESCE(c.pax, 0) AS pax
FROM site_dim s CROSS JOIN months m
LEFT JOIN cells c ON c.refid = s.refid AND c.month_start = m.month_start
""")
def q_site_month_series(spark, root):
    f = _fact(spark, root, ["event_startdate", "event_site_refid", "event_id", "participant_id"])
    return rollups.site_month_series(f, fx.sites(spark, root)).select("refid", "month_start", "events", "pax")


@register("heat_grid", O.FACT_CTE + f"""
, months AS (SELECT DISTINCT {_MONTH} AS month_start FROM fact WHERE event_startdate IS NOT NULL),
cells AS ({_MONTHLY_SITE_SQL}),
grid AS (SELECT s.refid, m.month_start, COALESCE(c.events, 0) AS events, COALESCE(c.pax, 0) AS pax
         FROM site_dim s CROSS JOIN months m
         LEFT JOIN cells c ON c.refid = s.refid AND c.month_start = m.month_start)
SELECT refid, month_start, events, pax, CASE WHEN events >= 100 THEN '100+' WHEN events >= 21 THEN '21-99'
       WHEN events >= 6 THEN '6-20' WHEN events >= 1 THEN '1-5' ELSE '0' END AS band
FROM grid
UNION ALL SELECT NULL, month_start, CAST(sum(events) AS BIGINT), CAST(sum(pax) AS BIGINT), NULL FROM grid GROUP BY month_start
""")
def q_heat_grid(spark, root):
    f = _fact(spark, root, ["event_startdate", "event_site_refid", "event_id", "participant_id"])
    return rollups.heat_grid(f, fx.sites(spark, root))


_WEEK = O.WEEK_START.format(d="event_startdate")


@register("weekly_rollup", O.FACT_CTE + f"""
SELECT {_WEEK} AS week_start, {O.WEEK_KEY.format(w=_WEEK)} AS period, {O.WEEK_LABEL.format(w=_WEEK)} AS label,
       count(DISTINCT event_id) FILTER (WHERE participant_id IS NOT NULL) AS events, {O.DEMO}
FROM fact WHERE event_startdate IS NOT NULL GROUP BY 1
""")
def q_weekly_rollup(spark, root):
    f = _fact(spark, root, ["event_startdate", "event_id", "participant_id", "gender", "age", "oku_status"])
    return rollups.weekly_rollup(f)


@register("weekly_site", O.FACT_CTE + f"""
SELECT {_WEEK} AS week_start, {O.WEEK_KEY.format(w=_WEEK)} AS period, event_site_refid AS refid,
       count(DISTINCT event_id) AS events, count(DISTINCT participant_id) AS pax
FROM fact WHERE event_startdate IS NOT NULL AND {_PAX} GROUP BY 1, 3
""")
def q_weekly_site(spark, root):
    f = _fact(spark, root, ["event_startdate", "event_site_refid", "event_id", "participant_id"])
    return rollups.weekly_site(f)


_DRILL_SQL = f"""
SELECT {_WEEK} AS week_start, event_site_refid AS refid, event_id, count(DISTINCT participant_id) AS p,
       count(*) FILTER (WHERE lower(CAST(attendance AS VARCHAR)) IN ('true', '1', 't', 'yes')) AS a,
       min(requester_id) AS requester_id
FROM fact WHERE event_startdate IS NOT NULL AND {_PAX} GROUP BY 1, 2, 3"""


@register("week_event_drilldown", O.FACT_CTE + _DRILL_SQL)
def q_week_event_drilldown(spark, root):
    f = _fact(spark, root, ["event_startdate", "event_site_refid", "event_id", "participant_id", "attendance",
                            "requester_id"])
    return rollups.week_event_drilldown(f)


@register("weekly_attendance_stack", O.FACT_CTE + f"""
SELECT week_start, count(*) FILTER (WHERE a = 0) AS red, count(*) FILTER (WHERE a > 0 AND a < p) AS amber,
       count(*) FILTER (WHERE a > 0 AND a >= p) AS green
FROM ({_DRILL_SQL}) GROUP BY week_start
""")
def q_weekly_attendance_stack(spark, root):
    f = _fact(spark, root, ["event_startdate", "event_site_refid", "event_id", "participant_id", "attendance",
                            "requester_id"])
    return rollups.weekly_attendance_stack(f)


@register("untouched_sites", O.FACT_CTE + f"""
SELECT s.refid, s.site_name, s.state FROM site_dim s
WHERE s.refid <> '' AND s.refid NOT IN (
  SELECT event_site_refid FROM fact
  WHERE {_PAX} AND pillar_name = '1-URGENT' AND event_startdate BETWEEN DATE '1998-01-05' AND DATE '1998-01-11')
""")
def q_untouched_sites(spark, root):
    f = _fact(spark, root, ["event_site_refid", "participant_id", "pillar_name", "event_startdate"])
    active = (f.where(F.col("participant_id").isNotNull() & (F.col("pillar_name") == "1-URGENT")
                      & F.col("event_startdate").between(F.lit("1998-01-05").cast("date"),
                                                         F.lit("1998-01-11").cast("date")))
               .select(F.col("event_site_refid").alias("refid")))
    dim = rollups.site_dimension(fx.sites(spark, root)).select("refid", "site_name", "state")
    return joins.untouched(dim, active, "refid")


@register("dedupe_first", """
SELECT o_custkey AS requester_id, o_orderkey AS event_id, CAST(o_orderdate AS DATE) AS first_event_date
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1
""")
def q_dedupe_first(spark, root):
    o = read_table(spark, root, "orders")
    d = joins.dedupe_first(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return d.select(F.col("o_custkey").alias("requester_id"), F.col("o_orderkey").alias("event_id"),
                    F.to_date("o_orderdate").alias("first_event_date"))


# ---------------------------------------------------------------------------
# Pivots
# ---------------------------------------------------------------------------

def _wide_sql(groups, gcol="grp"):
    parts = []
    for g in groups:
        s = pivots.slug(g)
        parts.append(f"COALESCE(max(events) FILTER (WHERE {gcol} = '{g}'), 0) AS {s}_events")
        parts.append(f"COALESCE(max(pax) FILTER (WHERE {gcol} = '{g}'), 0) AS {s}_pax")
    return ",\n       ".join(parts)


def _wide_cols(groups):
    return ", ".join(f"COALESCE(w.{c}, 0) AS {c}" for c in pivots.wide_columns(groups))


@register("pivot_wide_home", O.FACT_CTE + f"""
, pax AS (SELECT home_refid AS refid, CASE WHEN program <> '' THEN program END AS program, event_id, participant_id
          FROM fact WHERE participant_id IS NOT NULL AND home_refid IS NOT NULL AND home_refid <> ''),
cells AS (SELECT refid, program AS grp, count(DISTINCT event_id) AS events, count(DISTINCT participant_id) AS pax
          FROM pax WHERE program IS NOT NULL GROUP BY 1, 2),
tot AS (SELECT refid, count(DISTINCT event_id) AS total_events, count(DISTINCT participant_id) AS total_pax
        FROM pax GROUP BY 1),
w AS (SELECT c.refid, {_wide_sql(FIXTURE_PROGRAMS)}, max(t.total_events) AS total_events, max(t.total_pax) AS total_pax
      FROM cells c JOIN tot t ON t.refid = c.refid GROUP BY c.refid)
SELECT s.refid, s.site_name, s.state, {_wide_cols(FIXTURE_PROGRAMS)}
FROM site_dim s LEFT JOIN w ON w.refid = s.refid
""")
def q_pivot_wide_home(spark, root):
    f = _fact(spark, root, ["home_refid", "program", "event_id", "participant_id"])
    return pivots.pivot_wide_home(f, fx.sites(spark, root), FIXTURE_PROGRAMS)


_CLS = O.FIXTURE_CLASSIFY.format(c="program_name")


@register("pivot_wide_group", O.FACT_CTE + f"""
, all_sites AS (SELECT DISTINCT event_site_refid AS refid, event_site_name AS site_name, event_site_state AS state
                FROM fact WHERE event_site_refid IS NOT NULL AND event_site_refid <> ''),
dfx AS (SELECT event_site_refid AS refid, event_site_name AS site_name, event_site_state AS state,
               {_CLS} AS grp, event_id, participant_id
        FROM fact WHERE COALESCE(contains(category_name, 'NADI4U'), false) AND pillar_name = '2-HIGH'),
k AS (SELECT * FROM dfx WHERE refid IS NOT NULL AND refid <> '' AND grp IN ('A', 'B', 'C', 'Z')),
cells AS (SELECT refid, site_name, state, grp, count(DISTINCT event_id) AS events,
                 count(DISTINCT participant_id) AS pax FROM k GROUP BY ALL),
tot AS (SELECT refid, site_name, state, count(DISTINCT event_id) AS total_events,
               count(DISTINCT participant_id) AS total_pax FROM k GROUP BY ALL),
w AS (SELECT c.refid, c.site_name, c.state, {_wide_sql(FIXTURE_GROUPS)},
             max(t.total_events) AS total_events, max(t.total_pax) AS total_pax
      FROM cells c JOIN tot t ON t.refid = c.refid AND t.site_name = c.site_name AND t.state = c.state
      GROUP BY c.refid, c.site_name, c.state)
SELECT COALESCE(a.refid, w.refid) AS refid, COALESCE(a.site_name, w.site_name) AS site_name,
       COALESCE(a.state, w.state) AS state, {_wide_cols(FIXTURE_GROUPS)}
FROM all_sites a FULL JOIN w ON w.refid = a.refid AND w.site_name = a.site_name AND w.state = a.state
""")
def q_pivot_wide_group(spark, root):
    f = _fact(spark, root, ["event_site_refid", "event_site_name", "event_site_state", "category_name",
                            "pillar_name", "program_name", "event_id", "participant_id"])
    f = f.withColumn("grp", classify("program_name", FIXTURE_CLASSIFIER))
    keep = filters.category_contains("category_name", "NADI4U") & (F.col("pillar_name") == "2-HIGH")
    return pivots.pivot_wide_group(f, "grp", FIXTURE_GROUPS, keep)


@register("monthly_home_pivot", O.FACT_CTE + f"""
, pax AS (SELECT home_refid AS refid, CASE WHEN program <> '' THEN program END AS program, event_id, participant_id,
                 event_startdate
          FROM fact WHERE participant_id IS NOT NULL AND home_refid IS NOT NULL AND home_refid <> ''),
t AS (SELECT *, 'month' AS grain, strftime(event_startdate, '%b %Y') AS sheet FROM pax WHERE event_startdate IS NOT NULL
      UNION ALL SELECT *, 'all', 'All' FROM pax),
cells AS (SELECT grain, sheet, refid, program AS grp, count(DISTINCT event_id) AS events,
                 count(DISTINCT participant_id) AS pax FROM t WHERE program IS NOT NULL GROUP BY ALL),
tot AS (SELECT grain, sheet, refid, count(DISTINCT event_id) AS total_events, count(DISTINCT participant_id) AS total_pax
        FROM t GROUP BY ALL),
w AS (SELECT c.grain, c.sheet, c.refid, {_wide_sql(FIXTURE_PROGRAMS)}, max(o.total_events) AS total_events,
             max(o.total_pax) AS total_pax
      FROM cells c JOIN tot o ON o.grain = c.grain AND o.sheet = c.sheet AND o.refid = c.refid
      GROUP BY c.grain, c.sheet, c.refid),
sheets AS (SELECT DISTINCT grain, sheet FROM cells)
SELECT h.grain, h.sheet, s.refid, s.site_name, s.state, {_wide_cols(FIXTURE_PROGRAMS)}
FROM sheets h CROSS JOIN site_dim s
LEFT JOIN w ON w.grain = h.grain AND w.sheet = h.sheet AND w.refid = s.refid
""")
def q_monthly_home_pivot(spark, root):
    f = _fact(spark, root, ["home_refid", "program", "event_id", "participant_id", "event_startdate"])
    return pivots.monthly_home_pivot(f, fx.sites(spark, root), FIXTURE_PROGRAMS)


_SHEETS_SQL = O.FACT_CTE + f"""
, n4u AS (SELECT *, CAST(event_start AS DATE) AS d, CAST(date_trunc('month', CAST(event_start AS DATE)) AS DATE) AS m
          FROM fact WHERE COALESCE(contains(category_name, 'NADI4U'), false)),
latest AS (SELECT DISTINCT m FROM n4u WHERE d IS NOT NULL ORDER BY m DESC LIMIT 3),
tagged AS (
  SELECT n.*, 'month' AS grain, strftime(m, '%b %Y') AS sheet FROM n4u n WHERE d IS NOT NULL
  UNION ALL
  SELECT n.*, 'quarter', 'Q' || CAST(quarter(d) AS VARCHAR) || ' ' || CAST(year(d) AS VARCHAR) FROM n4u n
  WHERE d IS NOT NULL
  UNION ALL
  SELECT n.*, 'week', strftime(m, '%b %Y') || ' ' || {O.WEEK_OF_MONTH.format(d='d')} FROM n4u n
  WHERE m IN (SELECT m FROM latest)
  UNION ALL
  SELECT n.*, 'all', 'All' FROM n4u n),
g AS (SELECT *, CASE WHEN pillar_name = '2-HIGH' THEN {_CLS} ELSE sub_pillar_name END AS grp FROM tagged
      WHERE pillar_name IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')),
k AS (SELECT pillar_name, grain, sheet, event_site_refid AS refid, event_site_name AS site_name,
             event_site_state AS state, grp, event_id, participant_id FROM g
      WHERE event_site_refid IS NOT NULL AND event_site_refid <> '' AND grp IS NOT NULL AND grp <> ''
        AND (pillar_name <> '2-HIGH' OR grp IN ('A', 'B', 'C', 'Z'))),
cells AS (
  SELECT pillar_name, grain, sheet, refid, site_name, state, CASE WHEN GROUPING(grp) = 1 THEN 'Total' ELSE grp END AS grp,
         count(DISTINCT event_id) AS events, count(DISTINCT participant_id) AS pax
  FROM k GROUP BY GROUPING SETS ((pillar_name, grain, sheet, refid, site_name, state, grp),
                                 (pillar_name, grain, sheet, refid, site_name, state)))
"""


@register("pivot_all_grains", _SHEETS_SQL + "SELECT * FROM cells")
def q_pivot_all_grains(spark, root):
    f = _fact(spark, root, ["event_site_refid", "event_site_name", "event_site_state", "category_name",
                            "pillar_name", "program_name", "sub_pillar_name", "event_start", "event_id",
                            "participant_id"])
    return pivots.pivot_all_grains(f, FIXTURE_PILLARS)


@register("complete_sheets", _SHEETS_SQL + """
, sheets AS (SELECT DISTINCT grain, sheet FROM tagged WHERE grain <> 'week'
  UNION SELECT 'week', strftime(m, '%b %Y') || ' W' || CAST(w AS VARCHAR) FROM latest CROSS JOIN range(1, 5) r(w)
  UNION SELECT 'all', 'All'),
all_sites AS (SELECT DISTINCT event_site_refid AS refid, event_site_name AS site_name, event_site_state AS state
              FROM fact WHERE event_site_refid IS NOT NULL AND event_site_refid <> ''),
groups AS (SELECT DISTINCT pillar_name, grp FROM g WHERE pillar_name <> '2-HIGH' AND grp IS NOT NULL AND grp <> ''
  UNION SELECT '2-HIGH', unnest(['A', 'B', 'C', 'Z'])
  UNION SELECT unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']), 'Total')
SELECT p.pillar_name, s.grain, s.sheet, a.refid, a.site_name, a.state, p.grp, COALESCE(c.events, 0) AS events, COALESCE(c.pax, 0) AS pax
FROM groups p CROSS JOIN sheets s CROSS JOIN all_sites a
LEFT JOIN cells c ON c.pillar_name = p.pillar_name AND c.grain = s.grain AND c.sheet = s.sheet AND c.grp = p.grp
  AND c.refid = a.refid AND c.site_name IS NOT DISTINCT FROM a.site_name AND c.state IS NOT DISTINCT FROM a.state
""")
def q_complete_sheets(spark, root):
    f = _fact(spark, root, ["event_site_refid", "event_site_name", "event_site_state", "category_name",
                            "pillar_name", "program_name", "sub_pillar_name", "event_start", "event_id",
                            "participant_id"])
    return pivots.complete_sheets(f, FIXTURE_PILLARS)


@register("active_sites_per_sheet", _SHEETS_SQL + """
, sheets AS (SELECT DISTINCT grain, sheet FROM tagged WHERE grain <> 'week'
  UNION SELECT 'week', strftime(m, '%b %Y') || ' W' || CAST(w AS VARCHAR) FROM latest CROSS JOIN range(1, 5) r(w)),
pil(pillar_name) AS (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')),
act AS (SELECT pillar_name, grain, sheet, count(DISTINCT refid) AS active_sites FROM cells WHERE events > 0
        GROUP BY ALL)
SELECT p.pillar_name, s.grain, s.sheet, COALESCE(a.active_sites, 0) AS active_sites
FROM sheets s CROSS JOIN pil p
LEFT JOIN act a ON a.pillar_name = p.pillar_name AND a.grain = s.grain AND a.sheet = s.sheet
""")
def q_active_sites_per_sheet(spark, root):
    f = _fact(spark, root, ["event_site_refid", "event_site_name", "event_site_state", "category_name",
                            "pillar_name", "program_name", "sub_pillar_name", "event_start", "event_id",
                            "participant_id"])
    return pivots.active_sites_per_sheet(f, FIXTURE_PILLARS)


_STATE_SQL = O.FACT_CTE + f"""
, per_site AS (SELECT event_site_refid AS refid, CAST(month(event_startdate) AS INTEGER) AS month,
                      count(DISTINCT event_id) AS events
               FROM fact WHERE {_PAX} AND event_startdate IS NOT NULL GROUP BY 1, 2),
cells AS (SELECT upper(trim(s.state)) AS state, p.month, CAST(sum(p.events) AS BIGINT) AS events
          FROM per_site p JOIN site_dim s ON s.refid = p.refid GROUP BY 1, 2),
states AS (SELECT DISTINCT upper(trim(state)) AS state FROM site_dim WHERE refid <> ''),
grid AS (SELECT st.state, CAST(m.month AS INTEGER) AS month FROM states st CROSS JOIN range(1, 13) m(month)),
mat AS (SELECT g.state, g.month, c.events FROM grid g LEFT JOIN cells c ON c.state = g.state AND c.month = g.month)
"""


@register("state_month_matrix", _STATE_SQL + """
SELECT state, month, CASE WHEN events > 0 THEN events END AS events FROM mat
""")
def q_state_month_matrix(spark, root):
    f = _fact(spark, root, ["event_site_refid", "participant_id", "event_startdate", "event_id"])
    return pivots.state_month_matrix(f, fx.sites(spark, root), states=None)


REPORT_NATIONS = [f"NATION_{i}" for i in (24, 3, 1, 17, 0)]


@register("state_report", _STATE_SQL + f"""
, listed AS (SELECT c.*, p.place FROM cells c JOIN (VALUES {', '.join(f"('{n}', {i})" for i, n in enumerate(REPORT_NATIONS))})
             p(state, place) ON p.state = c.state),
every AS (SELECT state, month, events FROM listed UNION ALL SELECT 'TOTAL', month, events FROM listed),
names(state, place) AS (VALUES {', '.join(f"('{n}', {i})" for i, n in enumerate([*REPORT_NATIONS, 'TOTAL']))})
SELECT n.state, {', '.join(f"CAST(NULLIF(sum(e.events) FILTER (WHERE e.month = {m}), 0) AS BIGINT) AS m{m}" for m in range(1, 13))},
       CAST(NULLIF(sum(e.events), 0) AS BIGINT) AS total
FROM names n LEFT JOIN every e ON e.state = n.state GROUP BY n.state, n.place ORDER BY n.place
""")
def q_state_report(spark, root):
    f = _fact(spark, root, ["event_site_refid", "participant_id", "event_startdate", "event_id"])
    return pivots.state_report(f, fx.sites(spark, root), REPORT_NATIONS)


@register("state_month_totals", _STATE_SQL + """
, cube_t AS (SELECT state, month, CAST(sum(COALESCE(events, 0)) AS BIGINT) AS events,
                    GROUPING(state) AS gs, GROUPING(month) AS gm
             FROM mat GROUP BY CUBE (state, month))
SELECT CASE WHEN gs = 1 THEN 'TOTAL' ELSE state END AS state, CASE WHEN gm = 1 THEN 0 ELSE month END AS month,
       CASE WHEN events > 0 THEN events END AS events
FROM cube_t WHERE gs = 1 OR gm = 1
""")
def q_state_month_totals(spark, root):
    f = _fact(spark, root, ["event_site_refid", "participant_id", "event_startdate", "event_id"])
    return pivots.state_month_totals(f, fx.sites(spark, root), states=None)


# ---------------------------------------------------------------------------
# Explorer
# ---------------------------------------------------------------------------

_VIEW_SQL = O.FACT_CTE + f"""
, v AS (
  SELECT category_name, pillar_name, sub_pillar_name, deeper_sub_pillar, program_name, participant_name,
         CASE WHEN identity_no IS NOT NULL THEN substr(lpad(identity_no, 12, '0'), 1, 8) || '****' END AS identity_no,
         gender AS gender_name, participant_type, event_site_state AS site_state, event_site_name AS site_name,
         event_site_tp AS site_tp, event_site_dusp AS site_dusp, event_site_phase AS site_phase, event_startdate,
         CAST(year(event_start) AS INTEGER) AS event_year, CAST(quarter(event_start) AS INTEGER) AS event_quarter,
         strftime(event_start, '%B') AS event_month_name,
         {O.DURATION.format(s='event_start', e='event_end')} AS event_duration_hours,
         attendance, event_id, participant_id, event_site_refid AS site_refid
  FROM fact),
hit AS (SELECT *, (COALESCE(pillar_name = '1-URGENT', false)
                   AND (event_startdate IS NULL OR CAST(event_startdate AS VARCHAR) >= '1996-01-01')
                   AND (event_startdate IS NULL OR CAST(event_startdate AS VARCHAR) <= '1997-12-31')
                   AND contains(lower(concat_ws(' ', COALESCE(participant_name, ''), COALESCE(site_name, ''),
                          COALESCE(program_name, ''), COALESCE(sub_pillar_name, ''),
                          COALESCE(deeper_sub_pillar, ''))), 'blue')) AS h
        FROM v)
"""


def _view(spark, root, columns=None):
    """The export view, or some of its columns with the lookups they need."""
    f = _fact(spark, root, explore.EXPORT_FACT_COLUMNS if columns is None else explore.fact_columns(columns))
    return explore.export_view(f, columns=columns)


@register("dataset_summary", O.FACT_CTE + """
SELECT count(*) AS rows, count(DISTINCT participant_id) AS participants, count(DISTINCT event_id) AS events,
       count(DISTINCT event_site_refid) AS sites, count(DISTINCT category_name) AS categories,
       count(DISTINCT pillar_name) AS pillars, min(event_startdate) AS first_date, max(event_startdate) AS last_date
FROM fact
""")
def q_dataset_summary(spark, root):
    f = _fact(spark, root, ["participant_id", "event_id", "event_site_refid", "category_name", "pillar_name",
                            "event_startdate"])
    return explore.dataset_summary(f)


@register("filtered_stats", _VIEW_SQL + """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE h) AS filtered_rows,
       count(DISTINCT participant_id) FILTER (WHERE h AND participant_id <> '') AS participants,
       count(DISTINCT event_id) FILTER (WHERE h AND CAST(event_id AS VARCHAR) <> '') AS events,
       count(DISTINCT site_name) FILTER (WHERE h AND site_name <> '') AS sites,
       count(DISTINCT site_state) FILTER (WHERE h AND site_state <> '') AS states
FROM hit
""")
def q_filtered_stats(spark, root):
    columns = [*explore.filter_columns(FIXTURE_SPEC), "participant_id", "event_id", "site_name", "site_state"]
    return explore.filtered_stats(_view(spark, root, list(dict.fromkeys(columns))), FIXTURE_SPEC)


def _facet_sql(facets, src="v"):
    return " UNION ALL ".join(
        f"SELECT DISTINCT '{f}' AS facet, CAST({f} AS VARCHAR) AS value FROM {src} "
        f"WHERE {f} IS NOT NULL AND CAST({f} AS VARCHAR) <> ''" for f in facets)


@register("facet_values", _VIEW_SQL + f"""
{_facet_sql(FACET_COLUMNS)}
UNION ALL SELECT 'date_from', CAST(min(event_startdate) AS VARCHAR) FROM v HAVING min(event_startdate) IS NOT NULL
UNION ALL SELECT 'date_to', CAST(max(event_startdate) AS VARCHAR) FROM v HAVING max(event_startdate) IS NOT NULL
""")
def q_facet_values(spark, root):
    return explore.facet_values(_view(spark, root, [*FACET_COLUMNS, "event_startdate"]))


@register("cascaded_facets", _VIEW_SQL + f"""
, pool AS (SELECT * FROM v WHERE COALESCE(category_name = 'NADI4U', false))
{_facet_sql(['pillar_name', 'sub_pillar_name', 'deeper_sub_pillar'], 'pool')}
""")
def q_cascaded_facets(spark, root):
    return explore.cascaded_facets(_view(spark, root, CASCADE_ORDER), {"category_name": "NADI4U"}, "category_name")


@register("preview_200", _VIEW_SQL + """
, f AS (SELECT * EXCLUDE (h) FROM hit WHERE h)
SELECT *, (SELECT count(*) FROM f) AS filtered_rows FROM f
ORDER BY category_name NULLS LAST, pillar_name NULLS LAST, site_state NULLS LAST, site_name NULLS LAST,
         event_startdate NULLS LAST, sub_pillar_name NULLS LAST, deeper_sub_pillar NULLS LAST,
         program_name NULLS LAST, participant_name NULLS LAST, identity_no NULLS LAST, gender_name NULLS LAST,
         participant_type NULLS LAST, site_tp NULLS LAST, site_dusp NULLS LAST, site_phase NULLS LAST,
         event_year NULLS LAST, event_quarter NULLS LAST, event_month_name NULLS LAST,
         event_duration_hours NULLS LAST, attendance NULLS LAST, event_id NULLS LAST, participant_id NULLS LAST,
         site_refid NULLS LAST
LIMIT 200
""")
def q_preview_200(spark, root):
    return explore.preview(_view(spark, root), FIXTURE_SPEC, counted=_view(spark, root, explore.filter_columns(FIXTURE_SPEC)))


SEARCH_NEEDLES = ["blue", "1 Blue", "son#12", "a", "zzz"]
_SEARCH_SQL = " UNION ALL ".join(f"""SELECT '{n}' AS needle, participant_id, event_id, participant_name, site_name, program_name FROM v
WHERE contains(lower(concat_ws(' ', COALESCE(participant_name, ''), COALESCE(site_name, ''), COALESCE(program_name, ''),
      COALESCE(sub_pillar_name, ''), COALESCE(deeper_sub_pillar, ''))), '{n.lower()}')""" for n in SEARCH_NEEDLES)


@register("search_index", _VIEW_SQL + f"SELECT needle, count(*) AS rows, count(DISTINCT participant_id) AS participants, "
          f"count(DISTINCT event_id) AS events, min(site_name) AS first_site FROM ({_SEARCH_SQL}) GROUP BY needle")
def q_search_index(spark, root):
    """Searches of one view by its trigram index: needles within a field,
    over two fields, too short for the index, and without a hit."""
    columns = [*explore.filter_columns(FilterSpec(search="x")), "participant_id", "event_id"]
    path = f"{shared_dir(spark)}/tables/search-{uuid.uuid4().hex}"
    tables.replace_table(_view(spark, root, columns), f"{path}/view", partition_by=None)
    view = tables.read_table(spark, f"{path}/view")
    search.build_index(view, path)
    hits = [search.search(view, path, n).select(F.lit(n).alias("needle"), "participant_id", "event_id", "site_name") for n in SEARCH_NEEDLES]
    # One hash aggregate: a hit counts as its site, its participant and its event.
    kind = lambda k, event=None, text=None: F.struct(F.lit(k).alias("kind"), (F.lit(None) if event is None else F.col(event)).cast(
        "bigint").alias("event"), (F.lit(None) if text is None else F.col(text)).cast("string").alias("text"))
    tags = F.array(kind("site", text="site_name"), kind("who", text="participant_id"), kind("event", event="event_id"))
    ids = joins.union_slices(hits).select("needle", F.explode(tags).alias("_t")).groupBy("needle", "_t.kind", "_t.event", "_t.text").agg(
        F.count(F.lit(1)).alias("n"))
    of = lambda k, c: F.when(F.col("kind") == k, F.col(c))
    return ids.groupBy("needle").agg(
        F.sum(of("site", "n")).alias("rows"), F.count(of("who", "text")).alias("participants"), F.count(of("event", "event")).alias("events"),
        F.array_min(F.collect_set(of("site", "text"))).alias("first_site"))


@register("latest_three_months", O.FACT_CTE + f"""
SELECT {_MONTH} AS month_start, count(*) AS rows, count(DISTINCT event_id) AS events,
       strftime({_MONTH}, '%b %Y') AS label
FROM fact WHERE event_startdate IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 3
""")
def q_latest_three_months(spark, root):
    return explore.latest_months(_fact(spark, root, ["event_startdate", "event_id"]))


# ---------------------------------------------------------------------------
# Payload
# ---------------------------------------------------------------------------

@register("site_payload", O.FACT_CTE + f"""
, idx AS (SELECT event_site_refid AS refid, count(DISTINCT event_id) AS events, {O.DEMO}
          FROM fact WHERE {_PAX} GROUP BY 1),
p AS (SELECT event_site_refid AS refid, program, count(DISTINCT event_id) AS program_events,
             count(DISTINCT participant_id) AS program_pax
      FROM fact WHERE {_PAX} AND program IS NOT NULL AND program <> '' GROUP BY 1, 2)
SELECT s.refid, s.site_name AS name, s.state, s.tp, s.dusp, s.region, s.phase, COALESCE(i.events, 0) AS events,
       COALESCE(i.pax_total, 0) AS total, COALESCE(i.women, 0) AS women, COALESCE(i.youth, 0) AS youth,
       COALESCE(i.children, 0) AS children, COALESCE(i.oku, 0) AS oku, p.program, p.program_events, p.program_pax
FROM site_dim s LEFT JOIN idx i ON i.refid = s.refid LEFT JOIN p ON p.refid = s.refid
WHERE s.refid <> ''
""")
def q_site_payload(spark, root):
    f = _fact(spark, root, ["event_site_refid", "event_id", "participant_id", "gender", "age", "oku_status", "program"])
    return payload.flat_payload(payload.site_payload(f, fx.sites(spark, root)))


@register("site_events", O.FACT_CTE + f"""
SELECT refid, event_id, name AS n, month AS m, p, a, sub_program AS sp FROM ({_EVSUM_SQL})
""")
def q_site_events(spark, root):
    return payload.listed_events(rollups.event_summaries(*fx.event_parts(spark, root)))


@register("monthly_site_labels", O.FACT_CTE + f"""
SELECT {_MONTH} AS month_start, strftime({_MONTH}, '%Y-%m') AS period, event_site_refid AS refid,
       {O.FIXTURE_CLASSIFY.format(c='program_name')} AS label, count(DISTINCT event_id) AS events,
       count(DISTINCT participant_id) AS pax
FROM fact WHERE {_PAX} AND event_startdate IS NOT NULL GROUP BY ALL
""")
def q_monthly_site_labels(spark, root):
    f = _fact(spark, root, ["event_site_refid", "event_id", "participant_id", "program_name", "event_startdate"])
    return rollups.monthly_site_labels(f, FIXTURE_CLASSIFIER, program_col="program_name")


@register("payload_envelope", O.FACT_CTE + f"""
, ids AS ({_ELIGIBLE_SQL}),
f AS (SELECT * FROM fact WHERE event_id IN (SELECT event_id FROM ids) AND program IN ('AUTOMOBILE', 'BUILDING'))
SELECT 1 AS sub_id, DATE '{WINDOW[0]}' AS start_date, DATE '{WINDOW[1]}' AS end_date, 'AUTOMOBILE,BUILDING' AS programs_filter,
       (SELECT count(*) FROM site_dim WHERE refid <> '') AS n_nadi,
       (SELECT count(DISTINCT date_trunc('month', event_startdate)) FROM f) AS n_monthly,
       (SELECT count(DISTINCT date_trunc('week', event_startdate)) FROM f) AS n_weekly
""")
def q_payload_envelope(spark, root):
    from .flows import dashboard_fact
    programs = ["AUTOMOBILE", "BUILDING"]
    f = dashboard_fact(spark, root, 1, *WINDOW, programs=programs, columns=[
        "event_site_refid", "event_startdate", "participant_id", "gender", "age", "oku_status"])
    parts = {"nadi": payload.site_payload(f, fx.sites(spark, root)), "monthly": rollups.monthly_rollup(f), "weekly": rollups.weekly_rollup(f)}
    cover = payload.enveloped(parts, payload.envelope(spark, 1, None, *WINDOW, programs))
    return cover.drop("fetched").withColumn("programs_filter", F.concat_ws(",", "programs_filter"))


# ---------------------------------------------------------------------------
# Extracts and end-to-end flow
# ---------------------------------------------------------------------------

@register("fact_table_months", O.FACT_CTE + """
SELECT strftime(event_startdate, '%Y-%m') AS event_year_month, count(*) AS rows, count(DISTINCT event_id) AS events,
       count(DISTINCT event_site_state) AS states, min(event_site_state) AS first_state
FROM fact GROUP BY 1
""")
def q_fact_table_months(spark, root):
    """The fact as a table of two batches, one of them written twice, its
    files in report order; read back by the newest commit."""
    f = _fact(spark, root, ["event_site_state", "event_site_name", "event_startdate", "event_id", "participant_name", "participant_id"])
    f = checkpoint_table(f, "fact-rows")  # joined once for the three batches and the samples of their ranges
    path = f"{shared_dir(spark)}/tables/fact-{uuid.uuid4().hex}"
    late = F.coalesce(F.col("event_startdate") >= F.lit("1998-01-01").cast("date"), F.lit(True))
    for batch, rows in (("early", f.where(~late)), ("late", f), ("late", f.where(late))):
        tables.append_batch(rows, path, batch, cluster_by=fact_builder.FACT_ORDER)
    t = tables.read_table(spark, path)
    # One hash aggregate: a row counts as its event and as its state.
    kind = lambda k, event=None, state=None: F.struct(F.lit(k).alias("kind"), (F.lit(None) if event is None else F.col(event)).cast(
        "bigint").alias("event"), (F.lit(None) if state is None else F.col(state)).cast("string").alias("state"))
    tags = F.array(kind("event", event="event_id"), kind("state", state="event_site_state"))
    ids = t.select("event_year_month", F.explode(tags).alias("_t")).groupBy("event_year_month", "_t.kind", "_t.event", "_t.state").agg(
        F.count(F.lit(1)).alias("n"))
    of = lambda k, c: F.when(F.col("kind") == k, F.col(c))
    return ids.groupBy("event_year_month").agg(
        F.sum(of("state", "n")).alias("rows"), F.count(of("event", "event")).alias("events"), F.count(of("state", "state")).alias("states"),
        F.array_min(F.collect_set(of("state", "state"))).alias("first_state"))



@register("event_taxonomy", O.FACT_CTE + """
SELECT o.o_orderkey AS event_id, COALESCE(s.category_name, '') AS event_category,
       COALESCE(s.module, '') AS program_module, COALESCE(c.c_mktsegment, '') AS program,
       CAST(o.o_orderdate AS DATE) AS event_startdate, CAST(o.o_orderdate AS DATE) AS event_lastdate,
       o.o_custkey AS requester_id
FROM orders o
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN subcat s ON s.subcategory_id = CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)
     + CASE o.o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 5 ELSE 8 END
""")
def q_event_taxonomy(spark, root):
    return fx.event_taxonomy(spark, root, ["event_id", "event_category", "program_module", "program", "event_startdate", "event_lastdate",
                                           "requester_id"])


@register("address_lookup", """
SELECT s.s_suppkey AS site_id, 'S' || CAST(s.s_suppkey AS VARCHAR) AS refid, n.n_name AS district,
       trim(COALESCE(c.c_name, '') || ' ' || COALESCE(c.c_mktsegment, '')) AS address, CAST(c.c_custkey AS VARCHAR) AS postcode
FROM supplier s
LEFT JOIN customer c ON c.c_custkey % (SELECT count(*) FROM supplier) = s.s_suppkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def q_address_lookup(spark, root):
    out = fact_builder.address_lookup(fx.sites(spark, root).select("site_id", "refid"), *fx.addresses(spark, root))
    return out.select("site_id", "refid", "district", F.when(F.col("postcode").isNull(), "").otherwise(F.col("address")).alias("address"),
                      "postcode")


@register("participants_with_events", """
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS participant_id, l.l_orderkey AS event_id,
       o.o_orderpriority AS pillar_name, CAST(o.o_orderdate AS DATE) AS event_startdate
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey AND o.o_orderstatus NOT IN ('P')
""")
def q_participants_with_events(spark, root):
    part = read_table(spark, root, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("participant_id"),
        F.col("l_orderkey").alias("event_id"))
    ev = fx.events(spark, root).where(filters.not_excluded("status_id", fx.FIXTURE_EXCLUDED)).select(
        "event_id", "pillar_name", F.to_date("event_start").alias("event_startdate"))
    return fact_builder.participants_with_events(part, ev)


@register("export_rows", _VIEW_SQL + "SELECT * FROM v")
def q_export_rows(spark, root):
    return _view(spark, root)


@register("export_csv_summary", O.FACT_CTE + """
SELECT category_name, pillar_name, event_site_state AS site_state, count(*) AS rows, count(DISTINCT participant_id) AS participants,
       count(DISTINCT event_id) AS events, min(event_startdate) AS first_date, max(event_startdate) AS last_date,
       count(*) FILTER (WHERE COALESCE(deeper_sub_pillar, '') = '') AS without_deeper
FROM fact WHERE subcategory_id IN (1, 2, 6) AND COALESCE(regexp_matches(event_site_state, 'nation_[12]', 'i'), false) GROUP BY 1, 2, 3
""")
def q_export_csv_summary(spark, root):
    """The export of three subcategories and some states, written as CSV
    files in its order and read back."""
    from . import flows
    path = f"{shared_dir(spark)}/tables/export-{uuid.uuid4().hex}"
    view = flows.export_rows(fx.Tables(spark, root), [1, 2, 6], {"state": "nation_[12]"}, excluded=fx.FIXTURE_EXCLUDED, graph=fx.GRAPH, unique=fx.UNIQUE)
    flows.write_export(view, path)
    back = flows.read_export(spark, path, view)
    return back.groupBy("category_name", "pillar_name", "site_state").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("participant_id").alias("participants"), F.count_distinct("event_id").alias("events"),
        F.min("event_startdate").alias("first_date"), F.max("event_startdate").alias("last_date"),
        F.count_if(F.col("deeper_sub_pillar") == "").alias("without_deeper"))


_LOOSE_SQL = """CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR) WHEN 'view' THEN CAST(user_id AS VARCHAR) || '.75'
  WHEN 'purchase' THEN '-' || CAST(user_id AS VARCHAR) || '.5' WHEN 'signup' THEN 'id ' || CAST(user_id AS VARCHAR) END"""
_WHEN_SQL = """CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 'view' THEN strftime(ts, '%Y-%m-%d')
  WHEN 'purchase' THEN 'on ' || strftime(ts, '%Y-%m-%d') END"""


@register("coerced_values", f"""
WITH t AS (SELECT event_id, {_LOOSE_SQL} AS v, {_WHEN_SQL} AS w FROM events)
SELECT event_id, COALESCE(CAST(trunc(TRY_CAST(v AS DECIMAL(18, 2))) AS BIGINT), 0) AS whole,
       CAST(TRY_CAST(v AS DECIMAL(18, 2)) AS DECIMAL(18, 2)) AS number, strftime(TRY_CAST(w AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS moment
FROM t
""")
def q_coerced_values(spark, root):
    e = fx.event_log(spark, root)
    u, kind, day = F.col("user_id").cast("string"), F.col("event_type"), F.date_format("ts", "yyyy-MM-dd")
    loose = (F.when(kind == "click", u).when(kind == "view", F.concat(u, F.lit(".75"))).when(kind == "purchase", F.concat(F.lit("-"), u, F.lit(".5")))
             .when(kind == "signup", F.concat(F.lit("id "), u)))
    moment = (F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(kind == "view", day)
              .when(kind == "purchase", F.concat(F.lit("on "), day)))
    t = e.select("event_id", loose.alias("v"), moment.alias("w"))
    return t.select("event_id", safe_int("v").alias("whole"), to_number("v").cast("decimal(18,2)").alias("number"),
                    F.date_format(to_utc_timestamp_safe("w"), "yyyy-MM-dd HH:mm:ss").alias("moment"))


@register("dashboard_monthly", O.FACT_CTE + f"""
, ids AS ({_ELIGIBLE_SQL})
SELECT {_MONTH} AS month_start, strftime({_MONTH}, '%Y-%m') AS period, strftime({_MONTH}, '%b %Y') AS label,
       count(DISTINCT event_id) FILTER (WHERE participant_id IS NOT NULL) AS events, {O.DEMO}
FROM fact
WHERE event_id IN (SELECT event_id FROM ids) AND program IN ('AUTOMOBILE') AND event_startdate IS NOT NULL
GROUP BY 1
""")
def q_dashboard_monthly(spark, root):
    from .flows import dashboard_fact
    f = dashboard_fact(spark, root, 1, *WINDOW, programs=["AUTOMOBILE"],
                       columns=["event_startdate", "participant_id", "gender", "age", "oku_status"])
    return rollups.monthly_rollup(f)
