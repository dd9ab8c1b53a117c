"""Explorer over the export view: summary, filtered stats, facets, preview."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CASCADE_ORDER, FACET_COLUMNS, PREVIEW_ROWS, PRIORITY_COLUMNS, FilterSpec
from ..functions.calendar import duration_hours, month_name
from ..functions.text import mask_identity, non_empty
from .filters import spec_predicate


# A view's column and the fact's columns it is made of, where they differ.
_FROM_FACT = {"gender_name": ["gender"], "site_state": ["event_site_state"], "site_name": ["event_site_name"], "site_tp": ["event_site_tp"],
              "site_dusp": ["event_site_dusp"], "site_phase": ["event_site_phase"], "event_year": ["event_start"],
              "event_quarter": ["event_start"], "event_month_name": ["event_start"], "event_duration_hours": ["event_start", "event_end"],
              "site_refid": ["event_site_refid"]}


def fact_columns(columns: list[str]) -> list[str]:
    """The fact's columns that these columns of the view need."""
    return list(dict.fromkeys(f for c in columns for f in _FROM_FACT.get(c, [c])))


def export_view(fact: DataFrame, mask: bool = True, columns: list[str] | None = None) -> DataFrame:
    """Flat export columns in priority order, then the rest (or only those in
    ``columns``).  Identity numbers are masked by default; contact details
    are never exported."""
    named = {
        "category_name": F.col("category_name"),
        "pillar_name": F.col("pillar_name"),
        "sub_pillar_name": F.col("sub_pillar_name"),
        "deeper_sub_pillar": F.col("deeper_sub_pillar"),
        "program_name": F.col("program_name"),
        "participant_name": F.col("participant_name"),
        "identity_no": mask_identity("identity_no") if mask else F.col("identity_no"),
        "gender_name": F.col("gender"),
        "participant_type": F.col("participant_type"),
        "site_state": F.col("event_site_state"),
        "site_name": F.col("event_site_name"),
        "site_tp": F.col("event_site_tp"),
        "site_dusp": F.col("event_site_dusp"),
        "site_phase": F.col("event_site_phase"),
        "event_startdate": F.col("event_startdate"),
        "event_year": F.year("event_start"),
        "event_quarter": F.quarter("event_start"),
        "event_month_name": month_name("event_start"),
        "event_duration_hours": duration_hours("event_start", "event_end"),
        "attendance": F.col("attendance"),
        "event_id": F.col("event_id"),
        "participant_id": F.col("participant_id"),
        "site_refid": F.col("event_site_refid"),
    }
    order = [c for c in PRIORITY_COLUMNS if c in named] + [c for c in named if c not in PRIORITY_COLUMNS]
    return fact.select(*[named[c].alias(c) for c in order if columns is None or c in columns])


EXPORT_FACT_COLUMNS = [
    "category_name", "pillar_name", "sub_pillar_name", "deeper_sub_pillar", "program_name", "participant_name",
    "identity_no", "gender", "participant_type", "event_site_state", "event_site_name", "event_site_tp",
    "event_site_dusp", "event_site_phase", "event_startdate", "event_start", "event_end", "attendance",
    "event_id", "participant_id", "event_site_refid",
]


def choose_columns(view: DataFrame, columns: list[str]) -> DataFrame:
    """The chosen columns, in the chosen order; unknown or repeated names are
    an error."""
    unknown = [c for c in columns if c not in view.columns]
    if unknown or len(set(columns)) < len(columns):
        raise ValueError(f"unknown or repeated columns: {unknown or columns}")
    return view.select(*columns)


def _counted(df: DataFrame, pairs: Column, more: list[Column] = ()) -> DataFrame:
    """(kind, id, n, ...): the distinct (kind, id) pairs of the rows' arrays
    ``pairs`` and their numbers, one hash aggregate.  Distinct counts are
    then counts of its rows, for any number of kinds."""
    kept = [c for c in ("_date",) if c in df.columns]
    rows = df.select(*kept, F.explode(pairs).alias("_p"))
    return rows.groupBy(F.col("_p.kind").alias("kind"), F.col("_p.id").alias("id")).agg(F.count(F.lit(1)).alias("n"), *more)


def _pair(kind: str, value: Column | None = None, when: Column | None = None) -> Column:
    one = F.struct(F.lit(kind).alias("kind"), (F.lit(None) if value is None else value).cast("string").alias("id"))
    return one if when is None else F.when(when, one)


def _distinct(kind: str, name: str) -> Column:
    return F.count_if(F.col("kind") == kind).cast("bigint").alias(name)


def dataset_summary(fact: DataFrame, site_col: str = "event_site_refid", date_col: str = "event_startdate") -> DataFrame:
    """One row: rows, distinct participants / events / sites / categories /
    pillars, first and last date.

    A row is counted once for each of its values; (kind, value) pairs are
    reduced where the rows are, then counted by kind."""
    kinds = {"participants": "participant_id", "events": "event_id", "sites": site_col, "categories": "category_name", "pillars": "pillar_name"}
    pairs = F.array_compact(F.array(_pair("rows"), *[_pair(k, F.col(c), F.col(c).isNotNull()) for k, c in kinds.items()]))
    ends = [F.min("_date").alias("low"), F.max("_date").alias("high")]
    found = _counted(fact.withColumn("_date", F.col(date_col)), pairs, ends)
    return found.agg(F.coalesce(F.sum(F.when(F.col("kind") == "rows", F.col("n"))), F.lit(0)).cast("bigint").alias("rows"),
                     *[_distinct(k, k) for k in kinds], F.min("low").alias("first_date"), F.max("high").alias("last_date"))


def view_summary(view: DataFrame) -> DataFrame:
    """The summary of an export view."""
    return dataset_summary(view, site_col="site_refid")


def filtered_stats(view: DataFrame, spec: FilterSpec) -> DataFrame:
    """Total rows, filtered rows and distinct non-empty participants,
    events, sites and states of the filtered rows, in one pass.  A row that
    fails the filter is counted and nothing else."""
    kinds = {"participants": "participant_id", "events": "event_id", "sites": "site_name", "states": "site_state"}
    hit = F.coalesce(spec_predicate(spec), F.lit(False))
    pairs = F.when(hit, F.array_compact(F.array(_pair("hit"), *[_pair(k, F.col(c), non_empty(c)) for k, c in kinds.items()]))).otherwise(
        F.array(_pair("miss")))
    found = _counted(view, pairs)

    def rows(*which: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind").isin(*which), F.col("n"))), F.lit(0)).cast("bigint")

    return found.agg(rows("hit", "miss").alias("total_rows"), rows("hit").alias("filtered_rows"), *[_distinct(k, k) for k in kinds])


def facet_tuples(view: DataFrame, facets: list[str] = FACET_COLUMNS, date_col: str | None = "event_startdate") -> DataFrame:
    """The distinct tuples of the facets with their rows and first and last
    date: a small table, made once, that serves every facet list and cascade.
    One hash aggregate by the facets."""
    ends = [F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date")] if date_col else []
    return view.groupBy(*[F.col(f).cast("string").alias(f) for f in facets]).agg(F.count(F.lit(1)).alias("rows"), *ends)


def facets_of(tuples: DataFrame, facets: list[str] = FACET_COLUMNS) -> DataFrame:
    """(facet, value) of a tuple table: distinct non-empty values of each
    facet by facet and value, and, if the tuples have dates, the first and
    last of them as facets ``date_from`` / ``date_to``."""
    dated = "first_date" in tuples.columns
    day = F.lit(None).cast("date")

    def one(facet: str, value: Column, low: Column = day, high: Column = day) -> Column:
        return F.struct(F.lit(facet).alias("facet"), value.alias("value"), low.alias("low"), high.alias("high"))

    pairs = [F.when(non_empty(f), one(f, F.col(f))) for f in facets]
    if dated:
        pairs.append(one("_date", F.lit(None).cast("string"), F.col("first_date").cast("date"), F.col("last_date").cast("date")))
    rows = tuples.select(F.explode(F.array_compact(F.array(*pairs))).alias("p")).select("p.*")
    ends = rows.groupBy("facet", "value").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    both = F.array(*[F.struct(F.lit(f).alias("facet"), F.col(c).cast("string").alias("value")) for f, c in (("date_from", "low"), ("date_to", "high"))])
    out = ends.select(F.explode(F.when(F.col("facet") == "_date", both).otherwise(F.array(F.struct("facet", "value")))).alias("p"))
    return out.select("p.facet", "p.value").where("value is not null").orderBy("facet", "value")


def facet_values(view: DataFrame, facets: list[str] = FACET_COLUMNS, date_col: str | None = "event_startdate") -> DataFrame:
    """The facet lists of a view (see :func:`facets_of`)."""
    return facets_of(facet_tuples(view, facets, date_col), facets)


def cascade(tuples: DataFrame, picks: dict[str, str], level: str, order: list[str] = CASCADE_ORDER) -> DataFrame:
    """Downstream facet values of a tuple table once the upstream picks up to
    ``level`` are applied (category -> pillar -> sub-pillar -> deeper)."""
    idx = order.index(level)
    for col in order[: idx + 1]:
        if picks.get(col):
            tuples = tuples.where(F.col(col) == F.lit(picks[col]))
    return facets_of(tuples.drop("first_date", "last_date"), order[idx + 1:])


def cascaded_facets(view: DataFrame, picks: dict[str, str], level: str,
                    order: list[str] = CASCADE_ORDER) -> DataFrame:
    """:func:`cascade` over a view."""
    return cascade(facet_tuples(view, order, None), picks, level, order)


PREVIEW_ORDER = ["category_name", "pillar_name", "site_state", "site_name", "event_startdate"]


def preview(view: DataFrame, spec: FilterSpec, n: int = PREVIEW_ROWS, order: list[str] = PREVIEW_ORDER,
            counted: DataFrame | None = None) -> DataFrame:
    """First ``n`` filtered rows in export order (nulls last, every column
    as a tie-break so the cut is deterministic) plus the filtered count.

    The rows are a bounded top-n, merged from each task's own.  The count
    needs the filter's columns alone: give ``counted``, the same rows with
    those columns (:func:`filter_columns`), and it pays for no other lookup."""
    f = view.where(spec_predicate(spec))
    keys = order + [c for c in view.columns if c not in order]
    total = (view if counted is None else counted).where(spec_predicate(spec)).select(F.count(F.lit(1)).cast("bigint")).scalar()
    return f.orderBy(*[F.col(c).asc_nulls_last() for c in keys]).limit(n).withColumn("filtered_rows", total)


def filter_columns(spec: FilterSpec) -> list[str]:
    """The view's columns that the filter reads."""
    own = [c for c, v in spec.facets.items() if v]
    dates = [spec.date_col] if spec.date_from or spec.date_to else []
    search = list(spec.search_fields) if spec.search and spec.search.strip() else []
    return list(dict.fromkeys([*own, *dates, *search]))


def latest_months(fact: DataFrame, n: int = 3, date_col: str = "event_startdate") -> DataFrame:
    """The ``n`` most recent months present, with their row and event counts."""
    from ..functions.calendar import month_label, month_start
    m = (fact.where(F.col(date_col).isNotNull())
             .groupBy(month_start(date_col).alias("month_start"))
             .agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                  F.count_distinct("event_id").cast("bigint").alias("events")))
    return m.orderBy(F.col("month_start").desc()).limit(n).withColumn("label", month_label("month_start"))
