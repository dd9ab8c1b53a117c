"""Independent DuckDB SQL for the logical fact over the driver tables.

This mirrors the mapping of ``sources.fixtures`` in plain SQL, so every
oracle query is ``FACT_CTE`` plus the query's own SELECT.
"""

SUBCAT_VALUES = ", ".join(
    f"({i}, '{cat}', '{mod}', '{label}')" for i, cat, mod, label in __import__(
        "tallyhall.config", fromlist=["SUBCATEGORIES"]).SUBCATEGORIES)

FACT_CTE = f"""
WITH subcat(subcategory_id, category_name, module, sub_label) AS (VALUES {SUBCAT_VALUES}),
site_dim AS (
  SELECT s.s_suppkey AS site_id,
         'S' || CAST(s.s_suppkey AS VARCHAR) AS refid,
         COALESCE(s.s_name, 'Site-' || CAST(s.s_suppkey AS VARCHAR)) AS site_name,
         COALESCE(n.n_name, '') AS state,
         COALESCE(r.r_name, '') AS region,
         COALESCE('TP ' || n.n_name, '') AS tp,
         COALESCE('DUSP ' || r.r_name, '') AS dusp,
         CASE WHEN s.s_acctbal < 0 THEN 'Phase 1' WHEN s.s_acctbal < 5000 THEN 'Phase 2' ELSE 'Phase 3' END AS phase
  FROM supplier s
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
ev AS (
  SELECT o.o_orderkey AS event_id,
         o.o_orderstatus AS status_id,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)
           + CASE o.o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 5 ELSE 8 END AS subcategory_id,
         o.o_orderpriority AS pillar_name,
         o.o_orderdate AS event_start,
         CAST(o.o_orderdate AS DATE) AS event_startdate,
         o.o_orderdate AS event_end,
         o.o_custkey AS requester_id,
         c.c_mktsegment AS program,
         c.c_mktsegment AS sub_pillar_name,
         CASE WHEN c.c_acctbal >= 0 THEN 'sso_admin' ELSE 'member' END AS creator_type,
         CASE WHEN c.c_acctbal >= 0 THEN cn.n_name END AS deeper_sub_pillar,
         'S' || CAST(c.c_custkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS home_refid
  FROM orders o
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation cn ON cn.n_nationkey = c.c_nationkey
  WHERE o.o_orderstatus NOT IN ('P')
),
fact AS (
  SELECT l.l_orderkey AS event_id,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS participant_id,
         CASE WHEN l.l_linenumber <= 5 THEN l.l_partkey END AS member_id,
         CASE WHEN l.l_linenumber = 6 THEN l.l_partkey END AS under12_id,
         CASE WHEN l.l_linenumber <= 5 THEN 'Member' WHEN l.l_linenumber = 6 THEN 'Under 12'
              ELSE 'Unknown' END AS participant_type,
         CASE WHEN l.l_linenumber <= 6 THEN 'Person#' || CAST(l.l_partkey AS VARCHAR) END AS participant_name,
         CASE WHEN l.l_linenumber <= 5 THEN CAST(l.l_partkey AS VARCHAR) END AS identity_no,
         CASE WHEN l.l_returnflag = 'A' THEN 'Perempuan' ELSE 'Lelaki' END AS gender,
         l.l_quantity AS age,
         CASE WHEN l.l_discount = 0 THEN 'true' ELSE 'false' END AS oku_status,
         (l.l_linestatus = 'F') AS attendance,
         p.p_name AS program_name,
         l.l_suppkey AS event_site_id,
         'S' || CAST(l.l_suppkey AS VARCHAR) AS event_site_refid,
         es.site_name AS event_site_name, es.state AS event_site_state, es.region AS event_site_region,
         es.tp AS event_site_tp, es.dusp AS event_site_dusp, es.phase AS event_site_phase,
         ev.status_id, ev.subcategory_id, sc.category_name, ev.pillar_name, ev.event_start,
         ev.event_startdate, ev.event_end, ev.requester_id, ev.program, ev.sub_pillar_name,
         ev.creator_type, ev.deeper_sub_pillar, ev.home_refid,
         hs.site_name AS home_site_name, hs.state AS home_state
  FROM lineitem l
  JOIN ev ON ev.event_id = l.l_orderkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey
  LEFT JOIN site_dim es ON es.site_id = l.l_suppkey
  LEFT JOIN subcat sc ON sc.subcategory_id = ev.subcategory_id
  LEFT JOIN site_dim hs ON hs.refid = ev.home_refid
)
"""

# Demographic block over participant rows (distinct total, row counts).
DEMO = """
  count(DISTINCT participant_id) FILTER (WHERE participant_id IS NOT NULL) AS pax_total,
  count(*) FILTER (WHERE participant_id IS NOT NULL AND gender = 'Perempuan') AS women,
  count(*) FILTER (WHERE participant_id IS NOT NULL
                   AND TRY_CAST(CAST(age AS VARCHAR) AS DOUBLE) BETWEEN 15 AND 24) AS youth,
  count(*) FILTER (WHERE participant_id IS NOT NULL AND TRY_CAST(CAST(age AS VARCHAR) AS DOUBLE) < 12) AS children,
  count(*) FILTER (WHERE participant_id IS NOT NULL AND lower(CAST(oku_status AS VARCHAR)) = 'true') AS oku
"""

# Fixture classifier rules, as SQL.
FIXTURE_CLASSIFY = """CASE
    WHEN regexp_matches(lower(COALESCE({c}, '')), 'small') THEN 'A'
    WHEN regexp_matches(lower(COALESCE({c}, '')), 'ring|bolt') THEN 'B'
    WHEN regexp_matches(lower(COALESCE({c}, '')), 'widget') THEN 'C'
    ELSE 'Z' END"""

WEEK_KEY = ("CAST(year({w}) AS VARCHAR) || '-W' || lpad(CAST(weekofyear({w}) AS VARCHAR), 2, '0')")
WEEK_LABEL = ("strftime({w}, '%-d %b') || ' – ' || strftime(CAST({w} + INTERVAL 6 DAY AS DATE), '%-d %b %Y')")
WEEK_START = "CAST(date_trunc('week', {d}) AS DATE)"
MONTH_START = "CAST(date_trunc('month', {d}) AS DATE)"
WEEK_OF_MONTH = ("CASE WHEN day({d}) <= 7 THEN 'W1' WHEN day({d}) <= 14 THEN 'W2' "
                 "WHEN day({d}) <= 21 THEN 'W3' WHEN day({d}) <= 31 THEN 'W4' END")
DURATION = ("CAST(CAST((CASE WHEN (epoch_us({e}) - epoch_us({s})) < 0 THEN -1 ELSE 1 END)"
            " * ((abs(epoch_us({e}) - epoch_us({s})) + 18000000) // 36000000) AS DECIMAL(18,0))"
            " * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))")
