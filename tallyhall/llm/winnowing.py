"""Benchmark decontamination by winnowing.

Of every run of ``span`` consecutive k-gram hashes a text keeps the smallest
one.  Two texts that share ``span + k - 1`` consecutive words share such a
run and so keep the same hash there: joining the kept hashes misses no shared
window.  Documents with a joined hash are then extended: all their windows
are compared with the items' windows by 128 bits of hash, and the union of
the equal ones is what is hit.

Only DataFrame functions run here.  The items' tables are written first, so
Spark knows their sizes: below its broadcast threshold they are broadcast,
above it the joins are sort-merge joins that it may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import UPPER, lower_az, saved, table

WINDOW = 10
K = 6
WORD_GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words; null and empty texts have none."""
    return F.coalesce(F.array_remove(F.split(lower_az(text.cast("string")), WORD_GAP, -1), ""),
                      F.array().cast("array<string>"))


def _rolled(source: str, span: int, make) -> Column:
    """``make`` of each run of ``span`` elements of an array column."""
    run = F.transform(F.sequence(F.lit(0), F.size(source) - span),
                      lambda i: make([F.get(source, i + j) for j in range(span)]))
    return F.when(F.size(source) >= span, run).otherwise(F.array().cast("array<bigint>"))


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def _fingerprints(df: DataFrame, n: int, k: int) -> DataFrame:
    """Column ``kept``: the smallest k-gram hash of each n-word window."""
    k = min(k, n)
    grams = df.withColumn("grams", _rolled("hashes", k, lambda x: F.xxhash64(F.lit(n), *x)))
    if n == k:
        return grams.withColumnRenamed("grams", "kept")
    return grams.withColumn("kept", _rolled("grams", n - k + 1, lambda x: F.least(*x))).drop("grams")


def _windows(df: DataFrame, n: int, keep: list[str]) -> DataFrame:
    """A row for each n-word window: its place and 128 bits of hash."""
    two = (df.withColumn("one", _rolled("hashes", n, lambda x: F.xxhash64(F.lit(-n), *x)))
           .withColumn("two", _rolled("hashes", n, lambda x: F.xxhash64(F.lit(1000 + n), *reversed(x)))))
    return two.select(*keep, F.posexplode(F.arrays_zip("one", "two")).alias("at", "w")).select(
        *keep, F.lit(n).alias("n"), "at", "w.one", "w.two")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(F.col(id_col), F.col(text_col).cast("string")).alias("doc_key"))


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K, id_col: str = "doc_id",
         text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(places, found): ``places`` has doc_key, start and stop (word numbers,
    stop exclusive) of each window that occurs; ``found`` the distinct
    doc_key and item_id.

    An item of fewer words than ``window`` is one window; an item without
    words, and an item with a null id in ``found``, is nothing.  Repeated
    items each count by their id; repeated rows of a document share a
    doc_key.  Empty tables give no rows."""
    item_words = _hashed(items.select(F.col(item_col).alias("item_id"), words(F.col(item_text)).alias("words"))
                         .where(F.size("words") > 0)).withColumn("n", F.least(F.size("words"), F.lit(window)))
    item_words = saved(item_words, "items")
    lengths = sorted(r.n for r in item_words.select("n").distinct().collect())  # at most ``window`` values
    keyed = _keyed(docs, id_col, text_col)
    none = keyed.select("doc_key", F.lit(0).alias("n"), F.lit(0).alias("at"), F.lit(0).cast("bigint").alias("one"),
                        F.lit(0).cast("bigint").alias("two")).limit(0)
    item_windows = items.select(F.col(item_col).alias("item_id"), F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("one"),
                                F.lit(0).cast("bigint").alias("two")).limit(0)
    if not lengths:
        return none.select("doc_key", F.col("at").alias("start"), F.col("n").alias("stop")), \
            none.select("doc_key", F.lit(None).cast(item_words.schema["item_id"].dataType).alias("item_id"))

    prints = [_fingerprints(item_words.where(F.col("n") == n), n, k).select(F.explode("kept").alias("kept")) for n in lengths]
    of_items = prints[0]
    for p in prints[1:]:
        of_items = of_items.union(p)
    of_items = saved(of_items.distinct(), "item-prints")
    hashed = _hashed(keyed.select("doc_key", words(F.col("text")).alias("words")))
    candidates = None
    for n in lengths:
        kept = _fingerprints(hashed, n, k).select("doc_key", F.explode(F.array_distinct("kept")).alias("kept"))
        met = kept.join(of_items, "kept", "left_semi").select("doc_key")
        candidates = met if candidates is None else candidates.union(met)
    candidates = saved(candidates.distinct(), "candidates")

    for n in lengths:
        item_windows = item_windows.union(
            _windows(item_words.where(F.col("n") == n), n, ["item_id"]).select("item_id", "n", "one", "two"))
    item_windows = saved(item_windows.distinct(), "item-windows")
    own = _hashed(keyed.join(candidates, "doc_key", "left_semi").select("doc_key", words(F.col("text")).alias("words")))
    placed = none
    for n in lengths:
        placed = placed.union(_windows(own, n, ["doc_key"]))
    met = placed.join(item_windows.select("n", "one", "two").distinct(), ["n", "one", "two"], "left_semi")
    met = saved(met, "hits")
    places = met.select("doc_key", F.col("at").alias("start"), (F.col("at") + F.col("n")).alias("stop"))
    found = (met.select("doc_key", "n", "one", "two").distinct().join(item_windows, ["n", "one", "two"])
             .where(F.col("item_id").isNotNull()).select("doc_key", "item_id").distinct())
    return places, found


def covered(spans: Column) -> Column:
    """Length of the union of an array of (start, stop)."""
    return F.aggregate(
        F.array_sort(spans), F.struct(F.lit(0).alias("total"), F.lit(0).alias("upto")),
        lambda a, x: F.struct((a["total"] + F.greatest(x["stop"] - F.greatest(x["start"], a["upto"]), F.lit(0))).alias("total"),
                              F.greatest(a["upto"], x["stop"]).alias("upto")),
        lambda a: a["total"])


def report(docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """Per document: n_words, n_hit, the sorted item ids that occur, and
    contaminated.  A null or empty text has no words; repeated rows are
    returned each; empty tables give no hits.  A document's lists are bounded by its own words and by the
    items that it holds."""
    places, found = hits(docs, items, **kw)
    hit = places.groupBy("doc_key").agg(covered(F.collect_set(F.struct("start", "stop"))).alias("n_hit"))
    of_doc = found.groupBy("doc_key").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    keyed = _keyed(docs, kw.get("id_col", "doc_id"), kw.get("text_col", "text"))
    sizes = keyed.select("doc_id", "doc_key", F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    out = sizes.join(hit.join(of_doc, "doc_key", "left"), "doc_key", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, all columns kept."""
    places, _ = hits(docs, items, id_col=id_col, text_col=text_col, **kw)
    bad = saved(places.select(F.col("doc_key").alias("__key")).distinct(), "contaminated")
    key = F.xxhash64(F.col(id_col), F.col(text_col).cast("string"))
    return docs.withColumn("__key", key).join(bad, "__key", "left_anti").drop("__key")


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS_SQL = f"coalesce(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), " \
             "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"

OP3_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), {WINDOW}) AS n FROM (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
             FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
m AS (SELECT doc_id, i, n, item_id FROM dw JOIN iw USING (n, win)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
      FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""
