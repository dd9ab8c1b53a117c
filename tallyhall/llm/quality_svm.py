"""Document quality by a support vector machine with Naive Bayes features.

Indicators of n-grams are scaled by the log ratio of their counts in the two
classes, and a linear L2-loss support vector machine is fitted to the scaled
indicators by dual coordinate descent.  The n-grams are words, pairs of
words, word endings, and runs of one to three word shapes (letter cases,
digits, marks) that also tell whether neighbouring words are equal.

Fitting takes a bounded sample of labelled rows (``sample``) in one task;
every document is scored whole.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bucket, id_type, saved, table, texts
from .features import Words, all_pairs, hashed, numbered
from .tokens import slices

SAMPLE = 8_000


def _mixed(x: np.ndarray, y) -> np.ndarray:
    """One 64-bit number of two."""
    with np.errstate(over="ignore"):
        z = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(y) if np.isscalar(y) else \
            (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + y
        return (z ^ (z >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _parts(column: pa.Array) -> list:
    w = Words(column)
    shapes = w.words
    for pattern, put in ((r"[\p{Lu}]+", "A"), (r"[\p{Ll}]+", "a"), (r"[\p{Lo}\p{Lt}\p{Lm}\p{M}]+", "o"), (r"\p{N}+", "0")):
        shapes = pc.replace_substring_regex(shapes, pattern, put)
    named = shapes.dictionary_encode()
    shape_of, shape_hash = named.indices.to_numpy(), hashed(named.dictionary, "shape")
    word_hash = hashed(pc.utf8_lower(w.words), "word")
    parts = [(w.row, w.code, word_hash),
             (w.row, w.code, hashed(pc.utf8_slice_codeunits(w.words, -3), "end")),
             (w.row, shape_of[w.code] if len(w.code) else w.code, shape_hash)]
    two, three = w.runs(2), w.runs(3)
    if len(two):
        pair = _mixed(word_hash[w.code[two]], word_hash[w.code[two + 1]])
        parts.append((w.row[two], np.arange(len(two)), pair))
    s, same = shape_hash[shape_of[w.code]] if len(w.code) else np.zeros(0, np.uint64), np.zeros(len(w.code), np.uint64)
    same[:-1] = w.code[1:] == w.code[:-1]
    for at, n in ((two, 2), (three, 3)):
        if len(at):
            f = s[at]
            for j in range(1, n):
                f = _mixed(f, s[at + j] + same[at + j - 1])
            known, code = np.unique(f, return_inverse=True)
            parts.append((w.row[at], code, known))
    return parts


def log_count_ratios(row: np.ndarray, col: np.ndarray, y: np.ndarray, n_features: int, smooth: float = 1.0) -> np.ndarray:
    pos = smooth + np.bincount(col, weights=(y[row] > 0).astype(float), minlength=n_features)
    neg = smooth + np.bincount(col, weights=(y[row] < 0).astype(float), minlength=n_features)
    return np.log(pos / pos.sum()) - np.log(neg / neg.sum())


def dual_coordinate_descent(starts: np.ndarray, col: np.ndarray, value: np.ndarray, y: np.ndarray, n_features: int,
                            cost: float = 1.0, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Weights (the intercept last) of the L2-loss linear machine over rows
    ``starts`` of (col, value)."""
    w, alpha, rng = np.zeros(n_features + 1), np.zeros(len(y)), np.random.default_rng(seed)
    rows = [(col[a:b], value[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    diagonal = 1 / (2 * cost)
    q = np.array([v @ v + 1.0 for _, v in rows]) + diagonal
    for _ in range(rounds):
        for i in rng.permutation(len(y)):
            c, v = rows[i]
            g = y[i] * (w[c] @ v + w[-1]) - 1 + diagonal * alpha[i]
            new = max(alpha[i] - g / q[i], 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[c] += step * v
                w[-1] += step
                alpha[i] = new
    return w


def _unit(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    norm = np.sqrt(np.bincount(row, weights=value * value, minlength=n))
    return value / np.maximum(norm, 1e-12)[row]


def fit_machine(column: pa.Array, label: np.ndarray, least_rows: int = 2) -> dict:
    """``label`` is 1 or 0.  All features of at least ``least_rows`` rows are
    used: one that a single row has says nothing of any other."""
    row, feature = all_pairs(column, _parts)
    known, n = np.unique(feature, return_counts=True)
    known = known[n >= least_rows]
    y = np.where(label > 0, 1.0, -1.0)
    at = np.minimum(np.searchsorted(known, feature), max(0, len(known) - 1))
    hit = known[at] == feature if len(known) else np.zeros(len(feature), bool)
    row, col = row[hit], at[hit]
    ratio = log_count_ratios(row, col, y, len(known))
    starts = np.searchsorted(row, np.arange(len(y) + 1))
    w = dual_coordinate_descent(starts, col, _unit(row, ratio[col], len(y)), y, len(known))
    return {"known": known, "ratio": ratio.astype(np.float32), "weight": (w[:-1] * ratio).astype(np.float32), "intercept": float(w[-1])}


def machine_scores(model: dict, column: pa.Array, slope: float = 2.0) -> np.ndarray:
    """Scores 0 to 1: the logistic of ``slope`` times the margin."""
    row, col = numbered(_parts(column), model["known"])
    n = len(column)
    norm = np.sqrt(np.bincount(row, weights=np.square(model["ratio"][col], dtype=np.float64), minlength=n))
    margin = np.bincount(row, weights=model["weight"][col], minlength=n) / np.maximum(norm, 1e-12) + model["intercept"]
    return 1 / (1 + np.exp(-np.clip(slope * margin, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text") -> dict:
    """The machine, from at most ``sample`` labelled rows: those whose hashed
    ids are smallest.  Rows with a null id or label are left out.  Without
    labelled rows every score is one half."""
    ok = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    one = ok.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    few = saved(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "labelled")
    src = texts(docs, id_col, text_col).join(F.broadcast(few), "doc_id")  # at most ``sample`` rows of integers

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        whole = pa.Table.from_batches(batches).combine_chunks()
        whole = whole.take(pc.sort_indices(whole, sort_keys=[("text_hash", "ascending"), ("y", "ascending")]))
        model = fit_machine(whole.column("text").combine_chunks(), whole.column("y").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    # The scan and the join run in parallel; the one fitting task reads the sample that they wrote.
    texts_of = saved(src.withColumn("text_hash", F.xxhash64("text")).drop("doc_id"), "labelled-texts")
    found = texts_of.repartition(1).mapInArrow(run, "model binary").collect()
    if found:
        return pickle.loads(found[0].model)
    none = np.zeros(0, np.float32)
    return {"known": np.zeros(0, np.uint64), "ratio": none, "weight": none, "intercept": 0.0}


def scored(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, score) of every document, null and empty texts too: they
    have the intercept's score.  Repeated rows are scored each; an empty
    table gives no rows."""
    src = texts(docs, id_col, text_col)
    schema = T.StructType([T.StructField("doc_id", id_type(src)), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in (x for whole in batches for x in slices(whole, "text")):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(machine_scores(model, batch.column("text")))], schema.names)

    return src.mapInArrow(run, schema)


def op6_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(bucket("doc_id", 3) != 1))
    out = scored(docs, model)
    return out.select("doc_id", (bucket("doc_id", 3) == 1).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
