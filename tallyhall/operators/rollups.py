"""Per-site, monthly, weekly and event rollups with the demographic block.

Counting rules: ``pax_total`` is the number of *distinct* participants while
women / youth / children / oku are *row* counts.  Every rollup is one
aggregate (partial + final); the distinct counts are expanded by Catalyst,
so a hot site is pre-aggregated map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import HEAT_BANDS, Classifier, Demographics, EVENT_NAME_CHARS, SUB_PROGRAM_CHARS
from ..functions.calendar import month_key, month_label, month_start, week_key, week_label, week_start
from ..functions.classify import classify
from ..functions.text import is_child, is_true_text, is_youth, non_empty, truthy
from .joins import dedupe_first, densify_left

DEMO_COLS = ["pax_total", "women", "youth", "children", "oku"]


def demographic_aggs(demo: Demographics = Demographics(), only: Column | None = None) -> list[Column]:
    """The demographic block; ``only`` restricts it to matching rows."""
    pax = F.col(demo.participant)
    keep = pax.isNotNull() if only is None else (pax.isNotNull() & only)

    def rows(cond: Column) -> Column:
        return F.count_if(keep & cond).cast("bigint")

    return [
        F.count_distinct(F.when(keep, pax)).cast("bigint").alias("pax_total"),
        rows(F.coalesce(F.col(demo.gender) == F.lit(demo.women_value), F.lit(False))).alias("women"),
        rows(is_youth(demo.age)).alias("youth"),
        rows(is_child(demo.age)).alias("children"),
        rows(is_true_text(demo.oku)).alias("oku"),
    ]


def distinct_events(only: Column | None = None, event: str = "event_id",
                    participant: str = "participant_id") -> Column:
    keep = F.col(participant).isNotNull() if only is None else (F.col(participant).isNotNull() & only)
    return F.count_distinct(F.when(keep, F.col(event))).cast("bigint")


def site_dimension(sites: DataFrame, key: str = "refid") -> DataFrame:
    """Unique, non-empty site keys; a repeated key keeps its first row by
    (state, name), nulls first as in ``COALESCE(state, '')``."""
    s = sites.where(non_empty(key))
    return dedupe_first(s, [key], [F.coalesce(F.col("state"), F.lit("")), F.coalesce(F.col("site_name"), F.lit("")),
                                   F.col("site_name")])


def site_index(fact: DataFrame, sites: DataFrame, site_col: str = "event_site_refid",
               demo: Demographics = Demographics()) -> DataFrame:
    """Every site, all time: distinct events + demographic block; inactive
    sites get zeros, activity at unknown sites is dropped."""
    agg = (fact.where(F.col(demo.participant).isNotNull() & non_empty(site_col))
               .groupBy(F.col(site_col).alias("refid"))
               .agg(distinct_events().alias("events"), *demographic_aggs(demo)))
    dim = site_dimension(sites).select("refid", "site_name", "state")
    return densify_left(dim, agg, ["refid"], ["events"] + DEMO_COLS)


def site_programs(fact: DataFrame, site_col: str = "event_site_refid", program_col: str = "program",
                  classifier: Classifier | None = None) -> DataFrame:
    """Per site x program: distinct events and participants.

    Without a classifier, empty programs are skipped; with one, the label
    comes from the classifier and empty text falls to its default.
    """
    df = fact.where(F.col("participant_id").isNotNull() & non_empty(site_col))
    if classifier is None:
        df = df.where(non_empty(program_col))
        label = F.col(program_col)
    else:
        label = classify(program_col, classifier)
    return (df.groupBy(F.col(site_col).alias("refid"), label.alias("program"))
              .agg(distinct_events().alias("events"),
                   F.count_distinct("participant_id").cast("bigint").alias("pax")))


def program_coverage(fact: DataFrame, sites: DataFrame, site_col: str = "event_site_refid",
                     program_col: str = "program") -> DataFrame:
    """Per site: number of programs with at least one event (all sites)."""
    cov = (site_programs(fact, site_col, program_col).where(F.col("events") > 0)
           .groupBy("refid").agg(F.count(F.lit(1)).cast("bigint").alias("programs_covered")))
    dim = site_dimension(sites).select("refid", "site_name", "state")
    return densify_left(dim, cov, ["refid"], ["programs_covered"])


def _event_name(program_name: str = "program_name", program: str = "program") -> Column:
    first = F.coalesce(F.when(non_empty(program_name), F.col(program_name)),
                       F.when(non_empty(program), F.col(program)), F.lit(""))
    return F.substring(first, 1, EVENT_NAME_CHARS)


def _sub_program(program: Column, classifier: Classifier | None) -> Column:
    return classify(program, classifier) if classifier else F.substring(F.coalesce(program, F.lit("")), 1, SUB_PROGRAM_CHARS)


def event_summary(fact: DataFrame, site_col: str = "event_site_refid", classifier: Classifier | None = None,
                  program_col: str = "program") -> DataFrame:
    """Per site x event: name (60 chars), month label, distinct participants
    ``p``, attended rows ``a`` and the sub-program (40 chars or classified).

    For a fact that is a written table: its numbers are counted in one hash
    aggregate, and its texts, which are constant per event, are reduced to
    their distinct rows before the least of them is taken (so the pick is
    deterministic even where a source varies them by row).  Over unwritten
    tables :func:`event_summaries` reads every row once."""
    rows = fact.where(F.col("participant_id").isNotNull() & non_empty(site_col))
    keys = [F.col(site_col).alias("refid"), F.col("event_id")]
    texts = rows.select(*keys, _event_name().alias("name"), _sub_program(F.col(program_col), classifier).alias("sub_program")).distinct()
    least = texts.groupBy("refid", "event_id").agg(F.min("name").alias("name"), F.min("sub_program").alias("sub_program"))
    counts = rows.groupBy(*keys).agg(F.min("event_startdate").alias("_d"), *_attendance())
    out = counts.join(_named_keys(least), F.col("refid").eqNullSafe(F.col("_refid")) & F.col("event_id").eqNullSafe(F.col("_event")))
    return out.select("refid", "event_id", "name", F.coalesce(month_label("_d"), F.lit("")).alias("month"), "p", "a", "sub_program")


def _named_keys(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"refid": "_refid", "event_id": "_event"})


def _attendance() -> list[Column]:
    return [F.count_distinct("participant_id").cast("bigint").alias("p"), F.count_if(truthy("attendance")).cast("bigint").alias("a")]


def event_summaries(participants: DataFrame, events: DataFrame, titles: DataFrame | None = None, site_col: str = "refid",
                    classifier: Classifier | None = None) -> DataFrame:
    """The rows of :func:`event_summary` from the tables below the fact, with
    eager aggregation: participants (event_id, site, participant_id,
    attendance) are reduced to one row per site and event before they meet
    their events (event_id, program, event_startdate, program_name), so the
    join moves reduced rows and each event's texts are joined once.

    Where titles stand with the participant's part instead (``titles``: id,
    name; participants have ``part_id``), the distinct parts of a site and
    event are looked up."""
    rows = participants.where(F.col("participant_id").isNotNull() & non_empty(site_col) & F.col("event_id").isNotNull())
    keys = [F.col(site_col).alias("refid"), F.col("event_id")]
    program = F.when(non_empty("program"), F.col("program"))
    if titles is None:
        counts = rows.groupBy(*keys).agg(*_attendance())
        name = F.coalesce(F.when(non_empty("program_name"), F.col("program_name")), program, F.lit(""))
        shown = F.substring(name, 1, EVENT_NAME_CHARS)
    else:
        # One pass: a row counts as its participant, and as its part.
        tags = F.array(F.struct(F.lit(True).alias("who"), F.col("participant_id").alias("id"), F.lit(None).cast("bigint").alias("part")),
                       F.struct(F.lit(False).alias("who"), F.lit(None).cast("string").alias("id"), F.col("part_id").cast("bigint").alias("part")))
        tagged = rows.select(*keys, truthy("attendance").alias("_here"), F.explode(tags).alias("_t"))
        ids = tagged.groupBy("refid", "event_id", "_t.who", "_t.id", "_t.part").agg(F.count_if("_here").alias("_a"))
        part = titles.select(F.col("id").alias("_part"), F.col("name").alias("_title"))
        # The distinct parts meet their titles; a participant's row has none and meets nothing.
        ids = ids.join(part, F.col("part") == F.col("_part"), "left")
        title = F.when(~F.col("who") & non_empty("_title"), F.substring("_title", 1, EVENT_NAME_CHARS))
        counts = ids.groupBy("refid", "event_id").agg(
            F.count_if("who").cast("bigint").alias("p"), F.sum(F.when(F.col("who"), F.col("_a")).otherwise(0)).cast("bigint").alias("a"),
            F.array_min(F.collect_set(title)).alias("_least"), F.max(~F.col("who") & ~non_empty("_title")).alias("_untitled"))
        other = F.substring(F.coalesce(program, F.lit("")), 1, EVENT_NAME_CHARS)
        shown = F.least(F.col("_least"), F.when(F.col("_untitled"), other))
    out = counts.join(events, "event_id")
    return out.select("refid", "event_id", shown.alias("name"), F.coalesce(month_label("event_startdate"), F.lit("")).alias("month"), "p", "a",
                      _sub_program(F.col("program"), classifier).alias("sub_program"))


def zero_attendance_events(fact: DataFrame, site_col: str = "event_site_refid", week: str | None = None,
                           state: str | None = None, program: str | None = None, site: str | None = None,
                           state_col: str = "event_site_state", date_col: str = "event_startdate") -> DataFrame:
    """Events that nobody attended, of the rows in a week (any of its days,
    as ISO text), a state, a program or a site if given; the filters reach
    the scan before the rows are grouped."""
    rows = fact if not week else fact.where(_in_week(date_col, week))
    for col, value in ((state_col, state), ("program", program), (site_col, site)):
        if value:
            rows = rows.where(F.col(col) == value)
    return event_summary(rows, site_col).where(F.col("a") == 0)


def _in_week(date_col: str, week: str) -> Column:
    monday = F.date_trunc("week", F.lit(week).cast("date")).cast("date")
    return (F.col(date_col) >= monday) & (F.col(date_col) < F.date_add(monday, 7))


def zero_attendance_summaries(participants: DataFrame, events: DataFrame, titles: DataFrame | None = None, site_col: str = "refid",
                              week: str | None = None, program: str | None = None, sites: DataFrame | None = None) -> DataFrame:
    """The rows of :func:`zero_attendance_events` from the tables below the
    fact; ``sites`` (refid) keeps the sites of a state."""
    if week:
        events = events.where(_in_week("event_startdate", week))
    if program:
        events = events.where(F.col("program") == program)
    if sites is not None:
        participants = participants.join(sites.select(F.col("refid").alias(site_col)), site_col, "left_semi")
    return event_summaries(participants, events, titles, site_col).where(F.col("a") == 0)


def site_status(fact: DataFrame, sites: DataFrame, site_col: str = "event_site_refid") -> DataFrame:
    """untouched (no events) / has_zero (>= 1 event nobody attended) /
    all_complete (events, none at zero), for every site."""
    rows = fact.where(F.col("participant_id").isNotNull() & non_empty(site_col))
    per_event = rows.groupBy(F.col(site_col).alias("refid"), "event_id").agg(F.count_if(truthy("attendance")).alias("a"))
    ev = (per_event.groupBy("refid")
          .agg(F.count(F.lit(1)).cast("bigint").alias("events"),
               F.count_if(F.col("a") == 0).cast("bigint").alias("zero_events")))
    dim = site_dimension(sites).select("refid", "site_name", "state")
    out = densify_left(dim, ev, ["refid"], ["events", "zero_events"])
    return out.withColumn("status", F.when(F.col("events") == 0, "untouched")
                          .when(F.col("zero_events") > 0, "has_zero").otherwise("all_complete"))


def monthly_rollup(fact: DataFrame, demo: Demographics = Demographics(), date_col: str = "event_startdate") -> DataFrame:
    """One row per month present in the data (participant or not), in order;
    counts only over participant rows."""
    d = fact.where(F.col(date_col).isNotNull())
    return (d.groupBy(month_start(date_col).alias("month_start"))
             .agg(distinct_events().alias("events"), *demographic_aggs(demo))
             .select("month_start", month_key("month_start").alias("period"),
                     month_label("month_start").alias("label"), "events", *DEMO_COLS).orderBy("month_start"))


def monthly_site(fact: DataFrame, site_col: str = "event_site_refid", date_col: str = "event_startdate") -> DataFrame:
    d = fact.where(F.col(date_col).isNotNull() & F.col("participant_id").isNotNull() & non_empty(site_col))
    return (d.groupBy(month_start(date_col).alias("month_start"), F.col(site_col).alias("refid"))
             .agg(distinct_events().alias("events"),
                  F.count_distinct("participant_id").cast("bigint").alias("pax"))
             .select("month_start", month_key("month_start").alias("period"), "refid", "events", "pax"))


def monthly_site_labels(fact: DataFrame, classifier: Classifier, site_col: str = "event_site_refid",
                        program_col: str = "program", date_col: str = "event_startdate") -> DataFrame:
    """Month x site x classified label: distinct events and participants."""
    d = fact.where(F.col(date_col).isNotNull() & F.col("participant_id").isNotNull() & non_empty(site_col))
    return (d.groupBy(month_start(date_col).alias("month_start"), F.col(site_col).alias("refid"),
                      classify(program_col, classifier).alias("label"))
             .agg(distinct_events().alias("events"),
                  F.count_distinct("participant_id").cast("bigint").alias("pax"))
             .select("month_start", month_key("month_start").alias("period"), "refid", "label", "events", "pax"))


def heat_band(events: Column) -> Column:
    """0 / 1-5 / 6-20 / 21-99 / 100+."""
    band = None
    for lower, label in reversed(HEAT_BANDS):
        band = F.when(events >= lower, label) if band is None else band.when(events >= lower, label)
    return band


def monthly_heat(fact: DataFrame, site_col: str = "event_site_refid") -> DataFrame:
    """Monthly cells of the sites that were active, with their heat band."""
    return monthly_site(fact, site_col).withColumn("band", heat_band(F.col("events")))


def heat_grid(fact: DataFrame, sites: DataFrame, site_col: str = "event_site_refid") -> DataFrame:
    """Every site in every month of the data with its band; an idle month is
    in band 0.  The footer's rows have a null refid and band: each month's
    events and participants summed over the sites."""
    cells = site_month_series(fact, sites, site_col)
    cells = cells.select("refid", "month_start", "events", "pax", F.explode(F.array(F.lit(False), F.lit(True))).alias("footer"))
    out = cells.groupBy("footer", "month_start", F.when(~F.col("footer"), F.col("refid")).alias("refid")).agg(
        F.sum("events").alias("events"), F.sum("pax").alias("pax"))
    return out.select("refid", "month_start", "events", "pax", F.when(~F.col("footer"), heat_band(F.col("events"))).alias("band"))


def site_month_series(fact: DataFrame, sites: DataFrame, site_col: str = "event_site_refid",
                      date_col: str = "event_startdate") -> DataFrame:
    """Per-site monthly series over every month present in the data, zeros
    where the site was idle (sparkline data)."""
    # Cells of all rows; a null refid stands for rows that only show their month.
    keep = F.col("participant_id").isNotNull() & non_empty(site_col)
    cells = (fact.where(F.col(date_col).isNotNull())
                 .groupBy(month_start(date_col).alias("month_start"), F.when(keep, F.col(site_col)).alias("refid"))
                 .agg(distinct_events().alias("events"),
                      F.count_distinct(F.when(keep, F.col("participant_id"))).cast("bigint").alias("pax")))
    # The months that the cells have, as one array (one entry a calendar month).
    per_site = cells.where("refid is not null").groupBy("refid").agg(
        F.map_from_entries(F.collect_list(F.struct("month_start", F.struct("events", "pax")))).alias("own"))
    every = cells.agg(F.sort_array(F.collect_set("month_start"))).scalar()
    dim = site_dimension(sites).select("refid")
    grid = dim.join(per_site, "refid", "left").select("refid", "own", F.explode(every).alias("month_start"))
    cell = F.try_element_at(F.col("own"), F.col("month_start"))
    return grid.select("month_start", "refid", F.coalesce(cell["events"], F.lit(0)).cast("bigint").alias("events"),
                       F.coalesce(cell["pax"], F.lit(0)).cast("bigint").alias("pax"))


def weekly_rollup(fact: DataFrame, demo: Demographics = Demographics(), date_col: str = "event_startdate") -> DataFrame:
    """One row per Monday-Sunday week, in order; grouped by its Monday (the
    ``period`` label can repeat across years and is only carried)."""
    d = fact.where(F.col(date_col).isNotNull())
    return (d.groupBy(week_start(date_col).alias("week_start"))
             .agg(distinct_events().alias("events"), *demographic_aggs(demo))
             .select("week_start", week_key("week_start").alias("period"), week_label("week_start").alias("label"),
                     "events", *DEMO_COLS).orderBy("week_start"))


def weekly_site(fact: DataFrame, site_col: str = "event_site_refid", date_col: str = "event_startdate") -> DataFrame:
    d = fact.where(F.col(date_col).isNotNull() & F.col("participant_id").isNotNull() & non_empty(site_col))
    return (d.groupBy(week_start(date_col).alias("week_start"), F.col(site_col).alias("refid"))
             .agg(distinct_events().alias("events"),
                  F.count_distinct("participant_id").cast("bigint").alias("pax"))
             .select("week_start", week_key("week_start").alias("period"), "refid", "events", "pax"))


def week_event_drilldown(fact: DataFrame, site_col: str = "event_site_refid",
                         date_col: str = "event_startdate") -> DataFrame:
    """Week -> site -> event with attendance and the requester."""
    d = fact.where(F.col(date_col).isNotNull() & F.col("participant_id").isNotNull() & non_empty(site_col))
    return (d.groupBy(week_start(date_col).alias("week_start"), F.col(site_col).alias("refid"), "event_id")
             .agg(F.count_distinct("participant_id").cast("bigint").alias("p"),
                  F.count_if(truthy("attendance")).cast("bigint").alias("a"),
                  F.min("requester_id").alias("requester_id")))


def weekly_attendance_stack(fact: DataFrame, site_col: str = "event_site_refid",
                            date_col: str = "event_startdate") -> DataFrame:
    """Per week, events by attendance class: red a = 0, amber 0 < a < p,
    green a >= p (amber/green thresholds are an assumption)."""
    ev = week_event_drilldown(fact, site_col, date_col)
    a, p = F.col("a"), F.col("p")
    return (ev.groupBy("week_start")
              .agg(F.count_if(a == 0).cast("bigint").alias("red"),
                   F.count_if((a > 0) & (a < p)).cast("bigint").alias("amber"),
                   F.count_if((a > 0) & (a >= p)).cast("bigint").alias("green")))
