"""Per-site payload, per-site event list and the run catalogue.

Only bounded things are nested: the per-site ``programs`` map holds one
entry per program (a configuration-sized dimension), built from rows that
are already one per (site, program).  Lists that grow with the data - a
site's events, a period's active sites - are never collected into one row:
they are published as long tables (``site_events``, the monthly / weekly
site cells), partitioned like the payload, so a site holding a third of
all events is still written by many tasks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Classifier, Demographics
from ..functions.classify import classify
from ..functions.text import non_empty
from ..operators import rollups
from ..operators.joins import densify_left


def run_catalogue(fact: DataFrame, subcats: DataFrame, fetched_at: dt.datetime | None = None) -> DataFrame:
    """Every subcategory with its row/event counts, date span and a
    has-data flag (13-row dimension left-joined to one aggregate); with
    ``fetched_at``, the run's time as a column of that name."""
    agg = (fact.groupBy("subcategory_id")
               .agg(F.count(F.lit(1)).cast("bigint").alias("row_count"),
                    F.count_distinct("event_id").cast("bigint").alias("events"),
                    F.min("event_startdate").alias("first_date"),
                    F.max("event_startdate").alias("last_date")))
    out = subcats.join(agg, "subcategory_id", "left").fillna(0, subset=["row_count", "events"])
    out = out.select("subcategory_id", "category_name", "module", "sub_label", "row_count", "events",
                     (F.col("row_count") > 0).alias("has_data"), "first_date", "last_date")
    return out if fetched_at is None else out.withColumn("fetched_at", F.lit(fetched_at))


def envelope(spark: SparkSession, sub_id: int, fetched_at: dt.datetime | None = None, start_date: str | None = None,
             end_date: str | None = None, programs: list[str] | None = None) -> DataFrame:
    """One row that says which slice a published payload is: its
    subcategory, when it was made, the date window and the program filter
    (null where there is none)."""
    row = (sub_id, fetched_at, None if start_date is None else dt.date.fromisoformat(start_date),
           None if end_date is None else dt.date.fromisoformat(end_date), list(programs) if programs else None)
    return spark.createDataFrame([row], "sub_id int, fetched timestamp, start_date date, end_date date, programs_filter array<string>")


def enveloped(parts: dict[str, DataFrame], cover: DataFrame) -> DataFrame:
    """The envelope with the rows of each of the payload's tables as columns
    ``n_<table>``, so a reader can tell a whole payload."""
    out = cover
    for name, df in parts.items():
        out = out.withColumn(f"n_{name}", df.select(F.count(F.lit(1))).scalar())
    return out


SITE_ATTRIBUTES = ["tp", "dusp", "region", "phase", "parliament", "dun", "mukim"]


def site_payload(fact: DataFrame, sites: DataFrame, site_col: str = "event_site_refid",
                 classifier: Classifier | None = None, demo: Demographics = Demographics()) -> DataFrame:
    """One row per site: its attributes (those that the dimension has),
    events, a ``pax`` struct and a ``programs`` map of program -> {events,
    pax}, sorted by program.

    One aggregate over the fact: a participant row counts once for its
    program and once for the site's total."""
    program = F.when(non_empty("program"), F.col("program")) if classifier is None else classify("program", classifier)
    tags = F.array_compact(F.array(F.struct(F.lit(True).alias("all"), F.lit(None).cast("string").alias("program")),
                                   F.when(program.isNotNull(), F.struct(F.lit(False).alias("all"), program.alias("program")))))
    rows = fact.where(F.col(demo.participant).isNotNull() & non_empty(site_col))
    rows = rows.select(F.col(site_col).alias("refid"), "event_id", demo.participant, demo.gender, demo.age, demo.oku,
                       F.explode(tags).alias("_t")).select("*", "_t.all", F.col("_t.program").alias("_program"))
    cells = rows.groupBy("refid", "all", "_program").agg(
        rollups.distinct_events(participant=demo.participant).alias("events"), *rollups.demographic_aggs(demo))
    whole = [F.max(F.when(F.col("all"), F.col(c))).alias(c) for c in ["events", *rollups.DEMO_COLS]]
    listed = F.collect_list(F.when(~F.col("all"), F.struct(F.col("_program").alias("program"), F.struct(
        F.col("events"), F.col("pax_total").alias("pax")).alias("cell"))))
    per_site = cells.groupBy("refid").agg(*whole, F.map_from_entries(F.sort_array(listed)).alias("programs"))
    own = [c for c in SITE_ATTRIBUTES if c in sites.columns]
    dim = rollups.site_dimension(sites).select("refid", "site_name", "state", *own)
    out = densify_left(dim, per_site, ["refid"], ["events", *rollups.DEMO_COLS])
    return out.select("refid", F.col("site_name").alias("name"), "state", *own, "events",
                      F.struct(*[F.col(c).alias(c.replace("pax_total", "total")) for c in rollups.DEMO_COLS]).alias("pax"),
                      F.coalesce("programs", F.create_map().cast("map<string,struct<events:bigint,pax:bigint>>"))
                       .alias("programs"))


def flat_payload(payload: DataFrame) -> DataFrame:
    """The payload with one row per (site, program); a site without a
    program has one row with null program columns."""
    rest = [c for c in payload.columns if c not in ("pax", "programs")]
    rows = payload.select(*rest, "pax.*", F.explode_outer("programs").alias("program", "_c"))
    return rows.select(*rest, "total", "women", "youth", "children", "oku", "program",
                       F.col("_c.events").alias("program_events"), F.col("_c.pax").alias("program_pax"))


def site_events(fact: DataFrame, site_col: str = "event_site_refid",
                classifier: Classifier | None = None) -> DataFrame:
    """The per-site event list as a long table: one row per (site, event)
    with the compact fields n, m, p, a, sp."""
    return listed_events(rollups.event_summary(fact, site_col, classifier))


def listed_events(summaries: DataFrame) -> DataFrame:
    """Event summaries as the compact list."""
    return summaries.select("refid", "event_id", F.col("name").alias("n"), F.col("month").alias("m"), "p", "a", F.col("sub_program").alias("sp"))
