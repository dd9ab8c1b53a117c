"""Free-text search by a trigram index.

The explorer's search is a substring test over five fields joined by spaces.
The index has the distinct values of a view's fields (a site's or a program's
name stands there once, however many rows have it), and for each trigram the
values that have it, ordered by trigram, so a lookup reads a few row groups.
The join is by a space, so a word of the needle (a run without a space) lies
within one field.  A search takes the word with the rarest trigram, reads the
postings of that word's rarest trigrams, and puts the rows with such a value
to the exact test.  A value's key is a 64-bit hash: values that share one are
candidates together, so no hit is lost, and the test is exact whatever the
index gives.

A needle without a word of three characters has no trigram, and one whose
rarest trigram most values have, or more than a join broadcasts, is not worth
a lookup: those scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SEARCH_FIELDS
from ..functions.text import search_haystack
from ..sinks import tables
from ..sinks.writers import checkpoint_table

GRAM = 3
RAREST = 4  # postings read for a needle
SCAN_SHARE = 0.3
MOST_KEYS = 100_000  # broadcast to the rows' scan


def text_key(fields: list[str] = SEARCH_FIELDS) -> Column:
    return F.xxhash64(search_haystack(*fields))


def field_values(fields: list[str] = SEARCH_FIELDS) -> list[Column]:
    """The fields as they stand in the joined text."""
    return [search_haystack(c) for c in fields]


def grams(text: Column) -> Column:
    """The distinct trigrams of a text, whichever order."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - (GRAM - 1), F.lit(1)))
    return F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(GRAM))))).otherwise(
        F.array().cast("array<string>"))


def word_grams(needle: str) -> list[list[str]]:
    """The trigrams of each word of the needle that has any."""
    words = [w for w in needle.lower().strip().split(" ") if len(w) >= GRAM]
    return [list(dict.fromkeys(w[i:i + GRAM] for i in range(len(w) - GRAM + 1))) for w in words]


def build_index(view: DataFrame, path: str, fields: list[str] = SEARCH_FIELDS) -> None:
    """Write the view's index: ``<path>/postings`` (gram, key) in order of
    gram, and ``<path>/grams`` (gram, texts) with the number of field values
    that have it; the empty gram has the number of all values."""
    spark = view.sparkSession
    raw = view.select(F.explode(F.array(*[F.col(c).cast("string") for c in fields])).alias("text")).distinct()
    texts = checkpoint_table(raw.select(search_haystack("text").alias("text")).distinct(), "search-values")
    postings = texts.select(F.explode(grams(F.col("text"))).alias("gram"), F.xxhash64("text").alias("key"))
    tables.replace_table(postings, f"{path}/postings", partition_by=None, cluster_by=["gram", "key"])
    whole = texts.agg(F.count(F.lit(1)).alias("texts")).select(F.lit("").alias("gram"), "texts")
    written = tables.read_table(spark, f"{path}/postings")
    tables.replace_table(written.groupBy("gram").agg(F.count(F.lit(1)).alias("texts")).unionByName(whole), f"{path}/grams",
                         partition_by=None, cluster_by=["gram"])


def candidate_keys(spark: SparkSession, path: str, needle: str) -> DataFrame | None:
    """Keys of the field values that have the rarest trigrams of one of the
    needle's words (one column, ``key``); None where a scan is the better
    way."""
    words = word_grams(needle)
    if not words:
        return None
    asked = sorted({g for w in words for g in w})
    known = {r.gram: r.texts for r in tables.read_table(spark, f"{path}/grams").where(F.col("gram").isin("", *asked)).collect()}
    by_rarity = [sorted(w, key=lambda g: (known.get(g, 0), g))[:RAREST] for w in words]
    rare = min(by_rarity, key=lambda w: (known.get(w[0], 0), w))
    most = known.get(rare[0], 0)
    if most > MOST_KEYS or most > SCAN_SHARE * known.get("", 0):
        return None
    hits = tables.read_table(spark, f"{path}/postings").where(F.col("gram").isin(*rare) if most else F.lit(False))
    return hits.groupBy("key").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(rare)).select("key")


def search(view: DataFrame, path: str, needle: str, fields: list[str] = SEARCH_FIELDS) -> DataFrame:
    """The rows whose joined fields contain the needle (case apart; blanks
    around it do not count, and a blank needle is in every row): those of
    ``filters.spec_predicate``, by way of the index at ``path``."""
    n = needle.lower().strip()
    if not n:
        return view
    exact = search_haystack(*fields).contains(n)
    keys = candidate_keys(view.sparkSession, path, needle)
    if keys is None:
        return view.where(exact)
    rows, found = view, F.lit(False)
    for i, value in enumerate(field_values(fields)):
        rows = rows.join(F.broadcast(keys.select(F.col("key").alias(f"_k{i}"))), F.xxhash64(value) == F.col(f"_k{i}"), "left")
        found = found | F.col(f"_k{i}").isNotNull()
    return rows.where(found & exact).select(*view.columns)
