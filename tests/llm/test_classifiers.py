import zlib

import numpy as np
import pyarrow as pa
import pytest
from edge import ROWS, edge_docs, empty_docs, write_tables
from pyspark.sql import functions as F

from tallyhall.llm import quality_svm, toxicity
from tallyhall.llm.features import Words, all_pairs, hashed, numbered

MID = "/root/testdata/sf0.01"
LABELS = "doc_id bigint, quality int, toxic int"


def test_words_and_features_against_python():
    texts = ["The cat, the CAT", None, "", "  \n", "a b  a", "é É x"]
    w = Words(pa.array(texts))
    names = w.words.to_pylist()
    assert [(r, names[c]) for r, c in zip(w.row.tolist(), w.code.tolist(), strict=True)] == \
        [(i, x) for i, t in enumerate(texts) for x in (t or "").split()]
    parts = [(w.row, w.code, hashed(w.words, "word"))]
    row, feature = all_pairs(pa.array(texts), lambda col: [(v := Words(col)) and (v.row, v.code, hashed(v.words, "word"))], 2)
    assert len(row) == sum(len(set((t or "").split())) for t in texts)
    known = np.unique(feature[row == 4])
    assert list(zip(*[x.tolist() for x in numbered(parts, known)], strict=True)) == [(4, 0), (4, 1)]
    assert len(numbered(parts, np.zeros(0, np.uint64))[0]) == 0


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 4))
    y = np.where(x @ [1, -2, .5, 0] + .3 + rng.normal(size=60) * .4 > 0, 1.0, -1.0)
    starts, col = np.arange(61) * 4, np.tile(np.arange(4), 60)
    w = quality_svm.dual_coordinate_descent(starts, col, x.ravel(), y, 4, rounds=400)

    def loss(w):
        return w @ w / 2 + (np.maximum(0, 1 - y * (x @ w[:-1] + w[-1])) ** 2).sum()
    best = loss(w)
    assert all(loss(w + rng.normal(size=5) * s) >= best - 1e-6 for s in (1e-3, 1e-2, .1) for _ in range(200))


def test_op6_held_out_accuracy(spark):
    out = quality_svm.op6_nbsvm_quality(spark, MID).collect()
    docs = {r.doc_id for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in out) == sorted(docs)
    want = {r.doc_id: r.quality for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= .5)
    held = [r for r in out if r.held_out and r.doc_id in want]
    good = [r.predicted for r in held if want[r.doc_id] == 1]
    bad = [r.predicted for r in held if want[r.doc_id] == 0]
    assert np.mean(good) > .97 and np.mean(bad) < .5


def test_op6_does_not_learn_from_held_out_rows(spark, tmp_path):
    docs, labels = spark.read.parquet(f"{MID}/documents.parquet"), spark.read.parquet(f"{MID}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    d = write_tables(tmp_path, docs, labels=flipped)
    one, two = (quality_svm.op6_nbsvm_quality(spark, x).orderBy("doc_id").collect() for x in (MID, d))
    assert one == two


def test_op10_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{MID}/documents.parquet"), spark.read.parquet(f"{MID}/labels.parquet")
    named = toxicity._labels(labels)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 1
    out = toxicity.scored(docs, toxicity.fit(docs, named.where(~held))).join(named.where(held), "doc_id").collect()
    clean, toxic = ([r.p_toxic >= .5 for r in out if r.toxic == v] for v in (0, 1))
    assert np.mean(clean) < .02 and np.mean(toxic) > .5


def test_op10_chain_uses_earlier_categories():
    rng = np.random.default_rng(0)
    first = rng.random(900) < .4
    second = first & (rng.random(900) < .9)
    texts = pa.array([f"{'rude' if f else 'kind'} word{i % 7}" for i, f in enumerate(first)])
    model = toxicity.fit_chain(texts, np.column_stack([first, second]).astype(float), np.arange(900) % 3)
    assert [m[1].shape for m in model["models"]] == [(0,), (1,)]
    assert model["models"][1][1][0] > 0
    p = toxicity.chain_probabilities(model, pa.array(["a rude one", "a kind one"]))
    assert p[0, 0] > .8 and p[0, 1] > .7 and p[1, 0] < .2 and p[1, 1] < .2


LABEL_ROWS = [(1, 1, 0), (6, 0, 1), (7, None, 0), (None, 0, 1), (8, 0, None), (9, 1, 0), (9, 0, 0), (404, 1, 1)]


@pytest.mark.parametrize("rows", [LABEL_ROWS, []])
def test_edges(spark, tmp_path, rows):
    labels = spark.createDataFrame(rows, LABELS).withColumn("text", F.lit("clash"))
    d = write_tables(tmp_path, edge_docs(spark), labels=labels)
    six, ten = quality_svm.op6_nbsvm_quality(spark, d).collect(), toxicity.op10_chain_toxicity(spark, d).collect()
    for out in (six, ten):
        assert sorted((r.doc_id for r in out), key=str) == sorted((r[0] for r in ROWS), key=str)
    assert all(0 <= r.score <= 1 for r in six)
    assert all(0 <= p <= 1 for r in ten for p in (r.p_low_quality, r.p_toxic))
    kept = toxicity.without_toxic(edge_docs(spark), labels, 1.1)
    assert kept.schema == edge_docs(spark).schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, edge_docs(spark).collect()))
    assert toxicity.without_toxic(empty_docs(spark), labels).count() == 0
    e = write_tables(tmp_path / "e", empty_docs(spark), labels=labels)
    assert quality_svm.op6_nbsvm_quality(spark, e).count() == 0
    assert toxicity.op10_chain_toxicity(spark, e).count() == 0


def _shape(word):
    import regex
    for pattern, put in ((r"\p{Lu}+", "A"), (r"\p{Ll}+", "a"), (r"[\p{Lo}\p{Lt}\p{Lm}\p{M}]+", "o"), (r"\p{N}+", "0")):
        word = regex.sub(pattern, put, word)
    return word


def _svm_features(text):
    w = (text or "").split()
    s = [_shape(x) for x in w]
    out = {("word", x.lower()) for x in w} | {("end", x[-3:]) for x in w} | {("shape", x) for x in s}
    out |= {("pair", a.lower(), b.lower()) for a, b in zip(w, w[1:])}
    out |= {("two", s[i], s[i + 1], w[i] == w[i + 1]) for i in range(len(w) - 1)}
    return out | {("three", *s[i:i + 3], w[i] == w[i + 1], w[i + 1] == w[i + 2]) for i in range(len(w) - 2)}


def _sample(n, seed):
    rng = np.random.default_rng(seed)
    good, bad = "the quick Brown fox jumps over 12 lazy dogs".split(), "BUY now now now !!! cheap PILLS 99 $$$".split()
    label = rng.integers(0, 2, n)
    return [" ".join(rng.choice(good if y else bad, 12)) + " é" * int(rng.integers(0, 2)) for y in label], label


def test_op6_scores_equal_a_plain_version():
    texts, label = _sample(60, 5)
    model = quality_svm.fit_machine(pa.array(texts), label)
    sets = [_svm_features(t) for t in texts]
    known = sorted({f for s in sets for f in s if sum(f in o for o in sets) >= 2}, key=str)
    assert len(model["known"]) == len(known)
    x = np.array([[f in s for f in known] for s in sets], float)
    y = np.where(label > 0, 1.0, -1.0)
    pos, neg = 1 + x[y > 0].sum(0), 1 + x[y < 0].sum(0)
    ratio = np.log(pos / pos.sum()) - np.log(neg / neg.sum())
    scaled = lambda m: m * ratio / np.maximum(np.sqrt(((m * ratio) ** 2).sum(1)), 1e-12)[:, None]
    xs, w, b, alpha, rng = scaled(x), np.zeros(len(known)), 0.0, np.zeros(60), np.random.default_rng(7)
    for _ in range(8):
        for i in rng.permutation(60):
            g = y[i] * (xs[i] @ w + b) - 1 + alpha[i] / 2
            new = max(alpha[i] - g / (xs[i] @ xs[i] + 1.5), 0)
            w, b, alpha[i] = w + (new - alpha[i]) * y[i] * xs[i], b + (new - alpha[i]) * y[i], new
    asked = ["the fox BUY now", "", "unknown words only", texts[3], None]
    m = np.array([[f in _svm_features(t) for f in known] for t in asked], float)
    want = 1 / (1 + np.exp(-2 * (scaled(m) @ w + b)))
    assert np.abs(quality_svm.machine_scores(model, pa.array(asked)) - want).max() < 1e-4


def test_op10_probabilities_equal_a_plain_version():
    texts, label = _sample(90, 6)
    rng = np.random.default_rng(2)
    both = np.column_stack([label, label & rng.integers(0, 2, 90)]).astype(float)
    texts = [t + (" hateful" if y else "") for t, y in zip(texts, both[:, 1])]
    folds = np.arange(90) % 3
    model = toxicity.fit_chain(pa.array(texts), both, folds)

    def features(t):
        bare = [w.lower().strip(toxicity.MARKS) for w in (t or "").split()]
        return {("word", w) for w in bare} | {("begin", w[:5]) for w in bare if len(w) > 5}
    sets = [features(t) for t in texts]
    every = sorted({f for s in sets for f in s})
    x = np.array([[f in s for f in every] for s in sets], float)
    n = x.sum(0)
    picked = np.zeros(len(every), bool)
    for j in range(2):
        share = both[:, j].mean()
        picked |= ((x.T @ both[:, j] - n * share) / np.sqrt(n * share * (1 - share)) >= 4) & (n >= 3)
    assert picked.sum() == len(model["known"]) > 0

    def fit(z, y):
        w, seen = np.zeros(z.shape[1]), np.full(z.shape[1], 1e-8)
        l2 = np.r_[np.full(z.shape[1] - 1, 1e-4), 0]
        for _ in range(300):
            e = (1 / (1 + np.exp(-np.clip(z @ w, -30, 30))) - y) / len(y)
            g = z.T @ e + l2 * w
            seen += g * g
            w = w - 0.5 * g / np.sqrt(seen)
        return w
    odds = lambda z, w: np.clip(z @ w, -30, 30)
    wide = lambda m, extra: np.column_stack([m, *extra, np.ones(len(m))])
    asked = ["hateful now now", "the fox", "", None, "PILLS! hateful."]
    m = np.array([[f in features(t) for f in every] for t in asked], float)[:, picked]
    xp, earlier, of_asked, want = x[:, picked], [], [], []
    for j in range(2):
        out = np.zeros(90)
        for f in range(3):
            w = fit(wide(xp, earlier)[folds != f], both[folds != f, j])
            out[folds == f] = odds(wide(xp, earlier), w)[folds == f]
        w = fit(wide(xp, earlier), both[:, j])
        z = odds(wide(m, of_asked), w)
        want.append(1 / (1 + np.exp(-z)))
        earlier, of_asked = [*earlier, out], [*of_asked, z]
    assert np.abs(toxicity.chain_probabilities(model, pa.array(asked)) - np.column_stack(want)).max() < 1e-6
