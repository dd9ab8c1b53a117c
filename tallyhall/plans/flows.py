"""The three end-to-end flows, composed from the operators.

A. Dashboard fetch: eligible events of one subcategory (semi-join, never
   collected) -> fact -> optional remap hook and program filter -> site
   payload, site event list, monthly and weekly totals and site cells, with
   an envelope that names the slice, written per subcategory.
B. Consolidate then pivot: the whole fact, its control characters stripped,
   appended as a batch of a table in report order; its newest commit read
   back with column pruning, every pillar's complete sheets in one aggregate.
C. Export then explore: the flat export view of some subcategories, filtered
   by attributes, sorted and written as CSV; then stats, facets and preview
   of the CSV for a filter spec.

Each starts from logical tables (``t``, see :mod:`..sources.logical`), with a
lookup graph for sources that hold something elsewhere.  The functions that
take ``(spark, root)`` run them over the test tables.
"""

from __future__ import annotations

import datetime as dt
from collections import ChainMap
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CLASSIFIED_SUBCATEGORY, EXCLUDED_STATUSES, PILLARS, SUBCATEGORIES, Classifier, FilterSpec, PillarSpec
from ..operators import explore, filters, pivots, rollups
from ..operators import fact as builder
from ..operators.lookups import Graph
from ..sinks import payload, tables, writers
from ..sources import fixtures as fx
from ..sources.readers import read_export_csv

_ELIGIBLE = ["event_id", "site_json", "subcategory_id", "program_id", "status_id", "event_start", "event_end"]


def eligible(t: builder.Source, sub_id: int, excluded: Iterable = EXCLUDED_STATUSES, date_from: str | None = None,
             date_to: str | None = None, graph: Graph = builder.GRAPH, unique: Iterable[str] = builder.UNIQUE) -> DataFrame:
    """Ids of a subcategory's eligible events."""
    return filters.eligible_events(graph.plan(t, "event", _ELIGIBLE, unique), sub_id, list(excluded), date_from, date_to)


def slice_fact(t: builder.Source, sub_id: int, excluded: Iterable = EXCLUDED_STATUSES, date_from: str | None = None,
               date_to: str | None = None, programs: list[str] | None = None, remap: Callable[[DataFrame], DataFrame] | None = None,
               columns: list[str] | None = None, program_col: str = "sub_pillar_name", graph: Graph = builder.GRAPH,
               unique: Iterable[str] = builder.UNIQUE) -> DataFrame:
    """Fact rows of one subcategory's eligible events: the id set stays a
    distributed DataFrame and restricts the fact by a semi-join.  The remap
    hook comes before the program filter."""
    ids = eligible(t, sub_id, excluded, date_from, date_to, graph, unique)
    cols = None if columns is None else sorted({*columns, "event_id", program_col})
    fact = filters.restrict_to(builder.build_fact(t, cols, graph=graph, unique=unique), ids)
    if remap is not None:
        fact = fact.transform(remap)
    return filters.program_include(fact, programs, program_col)


def dashboard_fact(spark: SparkSession, root: str, sub_id: int, date_from: str | None = None,
                   date_to: str | None = None, programs: list[str] | None = None,
                   remap: Callable[[DataFrame], DataFrame] | None = None,
                   columns: list[str] | None = None) -> DataFrame:
    """Flow A's fact over the test tables."""
    return slice_fact(fx.Tables(spark, root), sub_id, fx.FIXTURE_EXCLUDED, date_from, date_to, programs, remap, columns or fx.FACT_COLUMNS,
                      "program", fx.GRAPH, fx.UNIQUE)


def dashboard_fetch(spark: SparkSession, root: str, sub_id: int, date_from: str | None = None,
                    date_to: str | None = None, programs: list[str] | None = None,
                    remap: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Flow A: the payloads of one subcategory.  The restricted fact is
    written once in the shared folder and read back for each of them; the
    classified subcategory's programs are labelled."""
    fact = dashboard_fact(spark, root, sub_id, date_from, date_to, programs, remap)
    cover = payload.envelope(spark, sub_id, dt.datetime.now(dt.UTC), date_from, date_to, programs)
    return dashboard_parts(fact, fx.sites(spark, root), sub_id, cover)


def dashboard_parts(fact: DataFrame, sites: DataFrame, sub_id: int, cover: DataFrame | None = None) -> dict[str, DataFrame]:
    """Flow A for any restricted fact and site dimension."""
    fact = writers.checkpoint_table(fact, f"dashboard-{sub_id}")
    classifier = Classifier() if sub_id == CLASSIFIED_SUBCATEGORY else None
    out = {
        "nadi": payload.site_payload(fact, sites, classifier=classifier),
        "site_events": payload.site_events(fact, classifier=classifier),
        "monthly": rollups.monthly_rollup(fact),
        "monthly_sites": rollups.monthly_site(fact),
        "weekly": rollups.weekly_rollup(fact),
        "weekly_sites": rollups.weekly_site(fact),
    }
    if classifier:
        out["monthly_labels"] = rollups.monthly_site_labels(fact, classifier)
    if cover is not None:
        out["envelope"] = payload.enveloped({k: out[k] for k in ("nadi", "monthly", "weekly")}, cover)
    return out


def write_dashboard(parts: dict[str, DataFrame], out_root: str, sub_id: int) -> None:
    """Publish the payloads, the envelope last; re-running a subcategory
    replaces only it."""
    for name, df in sorted(parts.items(), key=lambda x: x[0] == "envelope"):
        writers.write_payload_json(df.withColumn("sub_id", F.lit(sub_id)), f"{out_root.rstrip('/')}/{name}")


FACT_PIVOT_COLUMNS = ["event_site_refid", "event_site_name", "event_site_state", "category_name", "pillar_name",
                      "sub_pillar_name", "program_name", "event_id", "participant_id", "event_start",
                      "event_startdate"]


def consolidate(t: builder.Source, fact_path: str, batch_id: str, columns: list[str] | None = None, excluded: Iterable = EXCLUDED_STATUSES,
                graph: Graph = builder.GRAPH, unique: Iterable[str] = builder.UNIQUE) -> tables.Manifest:
    """Flow B's first half: the events of ``t`` that have participants and
    no excluded status, as a batch of the fact table.  All columns unless
    some are named; text without control characters; rows in report order."""
    events = t["events"].where(filters.not_excluded("status_id", list(excluded)))
    fact = builder.build_fact(ChainMap({"events": events}, t), columns, graph=graph, unique=unique)
    fact = builder.strip_control_everywhere(fact)
    return tables.append_batch(fact, fact_path, batch_id, cluster_by=[c for c in builder.FACT_ORDER if c in fact.columns])


def publish_sheets(spark: SparkSession, fact_path: str, sheets_path: str, pillars: list[PillarSpec] = list(PILLARS)) -> DataFrame:
    """Flow B's second half: the complete sheets of the fact table's newest
    commit."""
    fact = tables.read_table(spark, fact_path).select(*FACT_PIVOT_COLUMNS)
    writers.write_sheets(pivots.complete_sheets(fact, pillars), sheets_path)
    return spark.read.parquet(sheets_path)


def consolidate_then_pivot(spark: SparkSession, root: str, fact_path: str, sheets_path: str,
                           pillars: list[PillarSpec] = list(PILLARS)) -> DataFrame:
    """Flow B over the test tables."""
    consolidate(fx.Tables(spark, root), fact_path, "all", fx.FACT_COLUMNS, fx.FIXTURE_EXCLUDED, fx.GRAPH, fx.UNIQUE)
    return publish_sheets(spark, fact_path, sheets_path, pillars)


def pivot_fact(fact: DataFrame, fact_path: str, sheets_path: str, pillars: list[PillarSpec] = list(PILLARS)) -> DataFrame:
    """Flow B for any fact, which takes the place of the folder."""
    writers.write_fact_parquet(fact.select(*FACT_PIVOT_COLUMNS), fact_path)
    return publish_sheets(fact.sparkSession, fact_path, sheets_path, pillars)


EXPORT_ATTRIBUTES = {"tp": "site_tp", "dusp": "site_dusp", "phase": "site_phase", "state": "site_state"}


def export_rows(t: builder.Source, subcategories: list[int] | None = None, attributes: dict[str, str] | None = None, literal: bool = False,
                date_from: str | None = None, date_to: str | None = None, excluded: Iterable = EXCLUDED_STATUSES,
                graph: Graph = builder.GRAPH, unique: Iterable[str] = builder.UNIQUE,
                known: Iterable[int] = tuple(s[0] for s in SUBCATEGORIES)) -> DataFrame:
    """Flow C's rows: the export view of the listed subcategories (all, if
    none are), inside the window, whose tp, dusp, phase and state match the
    patterns.  The predicates stand on the plan, so Catalyst pushes them
    below the lookups."""
    cond = filters.not_excluded("status_id", list(excluded)) & filters.date_window("event_start", "event_end", date_from, date_to)
    events = t["events"].where(cond)
    if subcategories is not None:
        events = filters.subcategory_filter(events, subcategories, list(known))
    view = explore.export_view(builder.build_fact(ChainMap({"events": events}, t), explore.EXPORT_FACT_COLUMNS, graph=graph, unique=unique))
    return filters.attribute_regex(view, {EXPORT_ATTRIBUTES[k]: v for k, v in (attributes or {}).items()}, literal)


def write_export(view: DataFrame, path: str) -> None:
    """The export in its order, as CSV files that follow each other."""
    writers.write_csv(writers.clustered(view, [*explore.PREVIEW_ORDER, "event_id", "participant_id"]), path)


def read_export(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """An export read back, its columns typed as those of ``like``."""
    return read_export_csv(spark, path, T.StructType([T.StructField(f.name, f.dataType, True) for f in like.schema.fields]))


def export_then_explore(spark: SparkSession, root: str, spec: FilterSpec, subcategories: list[int] | None = None,
                        attributes: dict[str, str] | None = None, path: str | None = None) -> dict[str, DataFrame]:
    """Flow C over the test tables; with ``path``, by way of a CSV there."""
    view = export_rows(fx.Tables(spark, root), subcategories, attributes, excluded=fx.FIXTURE_EXCLUDED, graph=fx.GRAPH, unique=fx.UNIQUE)
    if path is None:
        return explore_view(writers.checkpoint_table(view, "explore"), spec)
    write_export(view, path)
    return explore_view(read_export(spark, path, view), spec)


def explore_fact(fact: DataFrame, spec: FilterSpec) -> dict[str, DataFrame]:
    """Flow C for any fact; the view is written once and read back."""
    return explore_view(writers.checkpoint_table(explore.export_view(fact), "explore"), spec)


def explore_view(view: DataFrame, spec: FilterSpec) -> dict[str, DataFrame]:
    return {"summary": explore.view_summary(view), "stats": explore.filtered_stats(view, spec), "facets": explore.facet_values(view),
            "preview": explore.preview(view, spec)}
