"""Text, truthiness, masking, JSON and numeric coercion helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (CHILD_MAX, CONTROL_CHARS, MASK_KEEP, MASK_SUFFIX, MASK_WIDTH,
                      TRUTHY_VALUES, YOUTH_MAX, YOUTH_MIN)

__all__ = [
    "truthy", "is_true_text", "mask_identity", "strip_control", "non_empty",
    "is_json", "is_json_array", "json_type", "safe_int", "to_number", "is_youth", "is_child",
    "search_haystack", "site_name_fallback", "address_line", "contains_or_false",
    "regex_or_false",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truthy(c) -> Column:
    """lower(text) in {true, 1, t, yes}; null is false."""
    return F.coalesce(F.lower(_c(c).cast("string")).isin(*TRUTHY_VALUES), F.lit(False))


def is_true_text(c) -> Column:
    """lower(text) == 'true'; null is false."""
    return F.coalesce(F.lower(_c(c).cast("string")) == F.lit("true"), F.lit(False))


def mask_identity(c) -> Column:
    """Left-pad to 12 with '0' (longer input is cut), keep 8, append '****'."""
    c = _c(c).cast("string")
    return F.when(c.isNotNull(), F.concat(F.substring(F.lpad(c, MASK_WIDTH, "0"), 1, MASK_KEEP), F.lit(MASK_SUFFIX)))


def strip_control(c) -> Column:
    return F.regexp_replace(_c(c), CONTROL_CHARS, "")


def non_empty(c) -> Column:
    c = _c(c)
    return c.isNotNull() & (c.cast("string") != F.lit(""))


def is_json(c) -> Column:
    """True when the whole text is one JSON value.  The parsers stop after
    the first value, so the text is put into an array before a mark: the
    mark is the second element only if nothing else follows the value."""
    framed = F.concat(F.lit("["), _c(c), F.lit(',"#end#"]'))
    return F.coalesce(F.get_json_object(framed, "$[1]") == "#end#", F.lit(False))


def is_json_array(c) -> Column:
    """True when the whole text is a JSON array (``[]`` included)."""
    c = _c(c)
    return F.json_array_length(c).isNotNull() & is_json(c)


def json_type(c) -> Column:
    """Coarse JSON type name: array, object, null, scalar or invalid."""
    c = _c(c)
    t = F.trim(c)
    return (F.when(c.isNull(), F.lit(None))
            .when(~is_json(c), "invalid")
            .when(F.json_array_length(c).isNotNull(), "array")
            .when(F.json_object_keys(c).isNotNull(), "object")
            .when(F.lower(t) == "null", "null")
            .otherwise("scalar"))


def to_number(c) -> Column:
    """Coercing numeric parse (bad text -> null)."""
    return _c(c).cast("string").try_cast("double")


def safe_int(c) -> Column:
    """Whole part of a number's text, 0 if it is none; exact for every
    bigint and every decimal of 38 digits."""
    t = _c(c).cast("string")
    return F.coalesce(t.try_cast("bigint"), t.try_cast("decimal(38,18)").try_cast("bigint"),
                      t.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def is_youth(age) -> Column:
    a = to_number(age)
    return F.coalesce(a.between(YOUTH_MIN, YOUTH_MAX), F.lit(False))


def is_child(age) -> Column:
    a = to_number(age)
    return F.coalesce(a < CHILD_MAX, F.lit(False))


def search_haystack(*cols) -> Column:
    """Lower-cased fields joined by single spaces, nulls as ''."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]))


def site_name_fallback(name, site_id) -> Column:
    return F.coalesce(_c(name), F.concat(F.lit("Site-"), _c(site_id).cast("string")))


def address_line(a1, a2, trim: bool = True) -> Column:
    s = F.concat(F.coalesce(_c(a1), F.lit("")), F.lit(" "), F.coalesce(_c(a2), F.lit("")))
    return F.trim(s) if trim else s


def contains_or_false(c, needle: str) -> Column:
    return F.coalesce(_c(c).contains(needle), F.lit(False))


def regex_or_false(c, pattern: str, literal: bool = False) -> Column:
    """Case-insensitive regular-expression test; null is false."""
    import re
    pat = re.escape(pattern) if literal else pattern
    return F.coalesce(_c(c).rlike("(?i)" + pat), F.lit(False))
