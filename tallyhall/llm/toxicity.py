"""Toxicity categories by a chain of linear classifiers.

Each category has a logistic regression over the words and word beginnings
that tell it from the rest.  The categories are predicted one after another,
and a later model is given the earlier categories' log-odds; it is trained
with out-of-fold predictions of them, so it learns how far to trust a
prediction rather than a label.

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

from .common import id_type, saved, table, texts
from .features import MARKS, Words, all_pairs, hashed, numbered
from .tokens import slices

SAMPLE = 10_000
CATEGORIES = ("low_quality", "toxic")
FOLDS = 3


def _parts(column: pa.Array) -> list:
    """Features: the lower-cased word without marks around it, and the first
    five letters of a longer one."""
    w = Words(column)
    bare = pc.utf8_trim(pc.utf8_lower(w.words), MARKS)
    long = pc.greater(pc.utf8_length(bare), 5).to_numpy(zero_copy_only=False)
    begins = pc.if_else(pa.array(long), pc.utf8_slice_codeunits(bare, 0, 5), "")
    keep = long[w.code] if len(w.code) else np.zeros(0, bool)
    return [(w.row, w.code, hashed(bare, "word")), (w.row[keep], w.code[keep], hashed(begins, "begin"))]


def _chosen(row: np.ndarray, feature: np.ndarray, label: np.ndarray, least_rows: int = 3, z: float = 4.0) -> np.ndarray:
    """Sorted features whose share of positive rows is ``z`` standard errors
    above the label's share."""
    known, number = np.unique(feature, return_inverse=True)
    n = np.bincount(number)
    pos = np.bincount(number, weights=label[row])
    share = label.mean()
    score = (pos - n * share) / np.sqrt(np.maximum(n * share * (1 - share), 1e-9))
    return known[(score >= z) & (n >= least_rows)]


def _logistic(row, col, dense, y, n_features: int, steps: int = 300, rate: float = 0.5, l2: float = 1e-4):
    """Weights of indicator features (row, col), of dense columns, and the
    intercept, by Adagrad on the mean log loss."""
    w, v, b = np.zeros(n_features), np.zeros(dense.shape[1]), 0.0
    seen = [np.full(n_features, 1e-8), np.full(dense.shape[1], 1e-8), 1e-8]
    for _ in range(steps):
        z = np.bincount(row, weights=w[col], minlength=len(y)) + dense @ v + b
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / max(1, len(y))
        grads = [np.bincount(col, weights=e[row], minlength=n_features) + l2 * w, dense.T @ e + l2 * v, e.sum()]
        for i, g in enumerate(grads):
            seen[i] = seen[i] + g * g
        w = w - rate * grads[0] / np.sqrt(seen[0])
        v = v - rate * grads[1] / np.sqrt(seen[1])
        b = b - rate * grads[2] / np.sqrt(seen[2])
    return w, v, b


def _log_odds(row, col, dense, model, n):
    w, v, b = model
    return np.clip(np.bincount(row, weights=w[col], minlength=n) + dense @ v + b, -30, 30)


def fit_chain(column: pa.Array, labels: np.ndarray, folds: np.ndarray) -> dict:
    """``labels`` has a column for each category, in chain order."""
    row, feature = all_pairs(column, _parts)
    n, k = labels.shape
    known = np.unique(np.concatenate([_chosen(row, feature, labels[:, j]) for j in range(k)])) if n else np.zeros(0, np.uint64)
    at = np.searchsorted(known, feature)
    hit = (at < len(known)) & (known[np.minimum(at, max(0, len(known) - 1))] == feature) if len(known) else np.zeros(len(feature), bool)
    row, col = row[hit], at[hit]
    earlier, models = np.zeros((n, 0)), []
    for j in range(k):
        out = np.zeros(n)
        for f in range(FOLDS):
            train = folds != f
            number = np.cumsum(train) - 1
            sel = train[row]
            model = _logistic(number[row[sel]], col[sel], earlier[train], labels[train, j], len(known))
            out[~train] = _log_odds(row, col, earlier, model, n)[~train]
        models.append(_logistic(row, col, earlier, labels[:, j], len(known)))
        earlier = np.column_stack([earlier, out])
    return {"known": known, "models": models}


def chain_probabilities(model: dict, column: pa.Array) -> np.ndarray:
    """A column of probabilities for each category."""
    row, col = numbered(_parts(column), model["known"])
    earlier = np.zeros((len(column), 0))
    for one in model["models"]:
        earlier = np.column_stack([earlier, _log_odds(row, col, earlier, one, len(column))])
    return 1 / (1 + np.exp(-earlier))


def fit(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, sample: int = SAMPLE,
        id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The chain, from at most ``sample`` labelled rows: those whose hashed
    ids are smallest.  Rows with a null id or label are left out; several
    labels of a document count as one, the largest.  Without labelled rows
    every probability is one half."""
    ok = labels.where(F.col(id_col).isNotNull())
    for c in categories:
        ok = ok.where(F.col(c).isNotNull())
    one = ok.groupBy(F.col(id_col).alias("doc_id")).agg(*[F.max(F.col(c).cast("int")).alias(f"y{j}") for j, c in enumerate(categories)])
    few = saved(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "labelled")
    src = texts(docs, id_col, text_col).join(F.broadcast(few), "doc_id")  # at most ``sample`` rows of integers
    k = len(categories)

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        whole = pa.Table.from_batches(batches).combine_chunks()
        order = pc.sort_indices(whole, sort_keys=[("fold_hash", "ascending"), ("text_hash", "ascending")])
        whole = whole.take(order)
        column = whole.column("text").combine_chunks()
        y = np.column_stack([whole.column(f"y{j}").to_numpy() for j in range(k)]).astype(float)
        model = fit_chain(column, y, whole.column("fold_hash").to_numpy().astype(np.uint64) % FOLDS)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    # The scan and the join run in parallel; the one fitting task reads the sample that they wrote.
    texts_of = saved(src.withColumn("fold_hash", F.xxhash64("doc_id", F.lit(1))).withColumn("text_hash", F.xxhash64("text"))
                     .drop("doc_id"), "labelled-texts")
    found = texts_of.repartition(1).mapInArrow(run, "model binary").collect()
    if found:
        return pickle.loads(found[0].model)
    return {"known": np.zeros(0, np.uint64), "models": [(np.zeros(0), np.zeros(j), 0.0) for j in range(k)]}


def scored(docs: DataFrame, model: dict, categories: tuple[str, ...] = CATEGORIES, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Rows (doc_id, p_<category>...) of every document; a null or empty text
    has no features and the intercepts' probabilities.  Repeated rows are
    scored each; an empty table gives no rows."""
    src = texts(docs, id_col, text_col)
    names = [f"p_{c}" for c in categories]
    schema = T.StructType([T.StructField("doc_id", id_type(src)), *[T.StructField(n, T.DoubleType()) for n in names]])

    def run(batches):
        for batch in (x for whole in batches for x in slices(whole, "text")):
            p = chain_probabilities(model, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(p[:, j]) for j in range(len(names))]], schema.names)

    return src.mapInArrow(run, schema)


def _labels(labels: DataFrame) -> DataFrame:
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose probability of the last category is below
    ``threshold``, all columns kept.  The text is scored in place, so rows
    are never joined back."""
    model = fit(docs, _labels(labels))

    def run(batches):
        for batch in (x for whole in batches for x in slices(whole, "__text")):
            p = chain_probabilities(model, pc.fill_null(batch.column("__text"), ""))[:, -1]
            yield batch.filter(pa.array(p < threshold)).drop_columns(["__text"])

    return docs.withColumn("__text", F.col("text").cast("string")).mapInArrow(run, docs.schema)


def op10_chain_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = scored(docs, fit(docs, _labels(table(spark, sf_dir, "labels"))))
    return out.withColumn("toxic", F.col("p_toxic") >= 0.5)
