"""Predicates: event eligibility, date windows, attribute and facet filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FilterSpec
from ..functions.text import contains_or_false, is_json_array, regex_or_false, search_haystack


def date_window(start_col: str, end_col: str, date_from: str | None = None,
                date_to: str | None = None) -> Column:
    """start date >= from and *end* date <= to; either side optional."""
    cond = F.lit(True)
    if date_from:
        cond = cond & (F.to_date(F.col(start_col)) >= F.lit(date_from).cast("date"))
    if date_to:
        cond = cond & (F.to_date(F.col(end_col)) <= F.lit(date_to).cast("date"))
    return cond


def not_excluded(status_col: str, excluded) -> Column:
    """``NOT IN``: a null status is dropped, as in SQL."""
    return ~F.col(status_col).isin(*excluded)


def eligible_events(events: DataFrame, subcategory_id: int, excluded, date_from=None, date_to=None,
                    site_json_col="site_json", start_col="event_start", end_col="event_end") -> DataFrame:
    """Distinct ids of events held at a JSON array of sites, in one
    subcategory, with a program, not excluded, inside the window."""
    cond = (F.col(site_json_col).isNotNull() & is_json_array(site_json_col)
            & (F.col("subcategory_id") == subcategory_id)
            & F.col("program_id").isNotNull()
            & not_excluded("status_id", excluded)
            & date_window(start_col, end_col, date_from, date_to))
    return events.where(cond).select("event_id").distinct()


def events_with_participants(events: DataFrame, participants: DataFrame, excluded,
                             key: str = "event_id") -> DataFrame:
    """Events having at least one participant row (semi-join, no fan-out)."""
    return events.where(not_excluded("status_id", excluded)).join(participants.select(key), key, "left_semi")


def restrict_to(df: DataFrame, ids: DataFrame, key: str = "event_id") -> DataFrame:
    """Key-list membership as a semi-join against a distributed id set."""
    return df.join(ids.select(key), key, "left_semi")


def category_contains(col: str, needle: str) -> Column:
    return contains_or_false(F.col(col), needle)


def attribute_regex(df: DataFrame, patterns: dict[str, str], literal: bool = False) -> DataFrame:
    """AND of case-insensitive regex tests per attribute (null is false)."""
    cond = F.lit(True)
    for col, pat in patterns.items():
        if pat:
            cond = cond & regex_or_false(F.col(col), pat, literal)
    return df.where(cond)


def program_include(df: DataFrame, programs: list[str] | None, col: str = "program") -> DataFrame:
    return df if not programs else df.where(F.col(col).isin(*programs))


def subcategory_filter(df: DataFrame, sub_ids: list[int], known: list[int], col: str = "subcategory_id") -> DataFrame:
    bad = sorted(set(sub_ids) - set(known))
    if bad:
        raise ValueError(f"unknown subcategory ids: {bad}")
    return df.where(F.col(col).isin(*sub_ids))


def spec_predicate(spec: FilterSpec, text_dates: bool = False) -> Column:
    """Explorer filter as one predicate, for ``where``; what is not known to
    hold (a null facet) is left out.

    Facets: exact equality (empty value = no filter).  Dates: inclusive
    range of the date column, rows with a blank date pass; ``text_dates``
    for a column of ISO date text.  Plain comparisons reach the scan.
    Search: lower-cased substring of the search fields joined by spaces.
    """
    cond = F.lit(True)
    for col, value in spec.facets.items():
        if value:
            cond = cond & (F.col(col) == F.lit(value))
    d = F.col(spec.date_col)
    blank = d.isNull() | (d == "") if text_dates else d.isNull()

    def day(text: str) -> Column:
        return F.lit(text) if text_dates else F.lit(text).cast("date")

    if spec.date_from:
        cond = cond & (blank | (d >= day(spec.date_from)))
    if spec.date_to:
        cond = cond & (blank | (d <= day(spec.date_to)))
    if spec.search and spec.search.strip():
        needle = spec.search.lower().strip()
        cond = cond & search_haystack(*spec.search_fields).contains(needle)
    return cond
