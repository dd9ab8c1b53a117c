"""Calendar keys and labels: month, quarter, ISO week, week of month."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import WEEK_OF_MONTH_EDGES

__all__ = [
    "to_utc_timestamp_safe", "month_start", "quarter_start", "week_start",
    "month_key", "month_label", "month_name", "year_quarter", "quarter_sheet",
    "week_key", "week_label", "week_of_month", "duration_hours", "us_datetime",
    "us_date",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_utc_timestamp_safe(c) -> Column:
    """Coercing parse to a zoned timestamp; bad text becomes null."""
    c = _c(c)
    return F.coalesce(F.try_to_timestamp(c.cast("string")), F.lit(None).cast("timestamp"))


def month_start(d) -> Column:
    return F.trunc(_c(d), "month")


def quarter_start(d) -> Column:
    return F.trunc(_c(d), "quarter")


def week_start(d) -> Column:
    """Monday of the (Mon-Sun) week holding ``d``, as a date."""
    return F.to_date(F.date_trunc("week", _c(d).cast("timestamp")))


def month_key(d) -> Column:
    """``yyyy-MM``."""
    return F.date_format(_c(d), "yyyy-MM")


def month_label(d) -> Column:
    """``MMM yyyy`` e.g. ``Jan 2026``."""
    return F.date_format(_c(d), "MMM yyyy")


def month_name(d) -> Column:
    return F.date_format(_c(d), "MMMM")


def year_quarter(d, sep: str = "-") -> Column:
    """``2026-Q1`` (separator is a parameter; null stays null)."""
    d = _c(d)
    return F.concat(F.year(d).cast("string"), F.lit(sep + "Q"), F.quarter(d).cast("string"))


def quarter_sheet(d) -> Column:
    """``Q1 2026``."""
    d = _c(d)
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.year(d).cast("string"))


def week_key(d) -> Column:
    """``{calendar year of Monday}-W{ISO week, 2 digits}``.

    Two different weeks can share a key (e.g. 1996-01-01 and 1996-12-30), so
    group by :func:`week_start` and carry this only as a label.
    """
    w = week_start(d)
    return F.concat(F.year(w).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(w).cast("string"), 2, "0"))


def week_label(d) -> Column:
    """``12 Jan – 18 Jan 2026`` (en dash, no leading zero)."""
    w = week_start(d)
    return F.concat(F.date_format(w, "d MMM"), F.lit(" – "), F.date_format(F.date_add(w, 6), "d MMM yyyy"))


def week_of_month(d) -> Column:
    """W1..W4 bins of the day of month; null date stays null."""
    day = F.dayofmonth(_c(d))
    expr = None
    for upper, label in WEEK_OF_MONTH_EDGES:
        cond = day <= upper
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def duration_hours(start, end, scale: int = 2) -> Column:
    """(end - start) in hours, decimal, rounded half-up to ``scale`` places."""
    # exact integer arithmetic: round half away from zero at ``scale`` places
    micros = F.unix_micros(_c(end)) - F.unix_micros(_c(start))
    unit = 3600000000 // (10 ** scale)
    q = F.call_function("div", F.abs(micros) + F.lit(unit // 2), F.lit(unit))
    signed = F.when(micros < 0, -q).otherwise(q)
    return (signed.cast("decimal(18,0)") / F.lit(10 ** scale).cast("decimal(18,0)")).cast(f"decimal(18,{scale})")


def us_datetime(ts, seconds: bool = False) -> Column:
    return F.date_format(_c(ts), "M/d/yyyy HH:mm:ss" if seconds else "M/d/yyyy HH:mm")


def us_date(ts) -> Column:
    return F.date_format(_c(ts), "M/d/yyyy")
