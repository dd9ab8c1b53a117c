"""Ordered keyword classifier as a single CASE expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Classifier


def classify(c, classifier: Classifier | None = None) -> Column:
    """First matching rule wins; null or unmatched text gets the default."""
    classifier = classifier or Classifier()
    text = F.lower(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")))
    expr = None
    for pattern, label in classifier.rules:
        cond = text.rlike(pattern)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    if expr is None:
        return F.lit(classifier.default)
    return expr.otherwise(classifier.default)
