import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from edge import ROWS, edge_docs, empty_docs, write_tables

from tallyhall.llm import pitman_yor as py

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)), py.END]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def base(docs):
    c = Counter(t for d, x in docs if not held(d) for t in tokens(x))
    n, v = sum(c.values()), len(c)
    return sorted(((d, held(d), len(tokens(x)), sum(c[t] > 0 for t in tokens(x)), n,
                    sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens(x))) for d, x in docs), key=str)


def check(docs, out):
    for want, got in zip(base(docs), sorted((tuple(r) for r in out), key=str), strict=True):
        assert want[:5] == got[:5]
        assert got[5] == pytest.approx(want[5], rel=1e-9)
        assert got[6] < 0 or want[4] == 0


def test_op1_base_columns_and_held_out_gain(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{MID}/documents.parquet").collect()]
    out = py.op1_pitman_yor(spark, MID).collect()
    check(docs, out)
    rest = [r for r in out if r.held_out]
    assert sum(r.score for r in rest) > sum(r.base_score for r in rest)


def test_op1_edges(spark, tmp_path):
    check(ROWS, py.op1_pitman_yor(spark, write_tables(tmp_path, edge_docs(spark))).collect())
    assert py.op1_pitman_yor(spark, write_tables(tmp_path / "e", empty_docs(spark))).count() == 0
    only_held = [(d, "some text here") for d in range(200) if held(d)]
    out = py.op1_pitman_yor(spark, write_tables(tmp_path / "h", edge_docs(spark, only_held))).collect()
    check(only_held, out)
    assert all(r.score == pytest.approx(0) for r in out)


class Naive:
    """The predictive rule in plain Python, from the sampled tables."""

    def __init__(self, model):
        self.m, self.leaf, self.kind, self.root = model, {}, {}, {}
        for r in model.states.collect():
            arrays = py._unzip(r.body)
            res, flat = py._load(r.body), [x.astype(int).tolist() for x in arrays[4:]]
            for s in range(py.SAMPLES):
                leaf, kind, root = flat[3 * s:3 * s + 3]
                for o, u, c, t in zip(res.of.tolist(), res.context.tolist(), res.count.tolist(), leaf, strict=True):
                    self.leaf[s, int(res.words[o]), u] = (c, t)
                for o, k, t in zip(res.kind_of.tolist(), res.kind_class.tolist(), kind, strict=True):
                    self.kind[s, int(res.words[o]), k] = t
                for w, t in zip(res.words.tolist(), root, strict=True):
                    self.root[s, w] = t
        self.sums = []
        for s in range(py.SAMPLES):
            own = {k: v for k, v in self.leaf.items() if k[0] == s}
            self.sums.append({
                "cu": Counter(), "tu": Counter(), "ck": Counter(), "tk": Counter(), "ckw": Counter(), "c0w": Counter()})
            x = self.sums[-1]
            for (_, w, u), (c, t) in own.items():
                assert 1 <= t <= c
                x["cu"][u] += c
                x["tu"][u] += t
                x["ck"][u // py.CHILDREN] += t
                x["ckw"][w, u // py.CHILDREN] += t
            for (i, w, k), t in self.kind.items():
                if i == s:
                    assert 1 <= t <= x["ckw"][w, k]
                    x["tk"][k] += t
                    x["c0w"][w] += t
            x["c0"], x["t0"] = sum(x["tk"].values()), sum(t for (i, _), t in self.root.items() if i == s)

    def p(self, w, u):
        total, (d2, d1, d0), k = 0, self.m.prior.discount, u // py.CHILDREN
        for s, x in enumerate(self.sums):
            q = 1 / (self.m.prior.words + 1)
            q = (x["c0w"][w] - d0 * self.root.get((s, w), 0) + (1 + d0 * x["t0"]) * q) / (1 + x["c0"])
            q = (x["ckw"][w, k] - d1 * self.kind.get((s, w, k), 0) + (1 + d1 * x["tk"][k]) * q) / (1 + x["ck"][k])
            c, t = self.leaf.get((s, w, u), (0, 0))
            total += (c - d2 * t + (1 + d2 * x["tu"][u]) * q) / (1 + x["cu"][u])
        return total / len(self.sums)


def test_scores_against_the_plain_rule_and_sums_to_one(spark):
    docs = py.split(spark.read.parquet(f"{SMALL}/documents.parquet"))
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        model = py.train(docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert model.hot and len(model.hot) < 2 * model.n_buckets
    naive = Naive(model)
    words = [w for _, w in naive.root if _ == 0]
    for u in [0, 5, *sorted(naive.sums[0]["cu"])[:6]]:
        assert sum(naive.p(w, u) for w in words) + naive.p(1, u) == pytest.approx(1)
    got = {r.doc_id: r.score for r in py.score(docs, model).collect()}
    for r in docs.limit(40).collect():
        names, contexts = py._named(pa.array(tokens(r.text)))
        want = sum(math.log10(naive.p(int(w), int(u))) for w, u in zip(names, [contexts[-1], *contexts[:-1]], strict=True))
        assert got[r.doc_id] == pytest.approx(want, rel=1e-9)


def test_the_model_learns_pairs_of_words(spark):
    rows = [(i, "red apple green pear " * 6) for i in range(60)]
    docs = py.split(spark.createDataFrame(rows, "doc_id bigint, text string"))
    probe = spark.createDataFrame([(1000, "red apple green pear"), (1001, "red green apple pear")], "doc_id bigint, text string")
    out = {r.doc_id: r.score for r in py.score(py.split(probe), py.train(docs)).collect()}
    assert out[1000] > out[1001] + 1


def test_tables_of_few_customers_follow_the_exact_posterior():
    d, others, parent = .6, 7, .05
    def seatings(c):
        """Weight of each number of tables by summing all seatings in turn."""
        state = {((1,), 1): (1 + d * others) * parent}
        for _ in range(c - 1):
            new = Counter()
            for (sizes, _), w in state.items():
                new[tuple(sorted((*sizes, 1))), 0] += w * (1 + d * (others + len(sizes))) * parent
                for i in range(len(sizes)):
                    more = list(sizes)
                    more[i] += 1
                    new[tuple(sorted(more)), 0] += w * (sizes[i] - d)
            state = new
        out = Counter()
        for (sizes, _), w in state.items():
            out[len(sizes)] += w
        return {t: w / sum(out.values()) for t, w in out.items()}
    for c in (2, 3, 6):
        n = 40_000
        got = Counter(py.draw_tables(np.random.default_rng(c), np.full(n, c), np.full(n, others), np.full(n, parent), d).tolist())
        for t, p in seatings(c).items():
            assert got[t] / n == pytest.approx(p, abs=4 * math.sqrt(p / n) + 1e-4)
    many = py.draw_tables(np.random.default_rng(0), np.array([9, 1000, 10**6]), np.full(3, others), np.full(3, parent), d)
    assert (many >= 1).all() and many[2] < 200


def test_each_context_has_its_own_restaurant():
    """More contexts than 64 x 1024, all with the same last letter."""
    words = pa.array([f"{i}e" for i in range(100_000)])
    assert len(np.unique(py._named(words)[1])) == len(words)


def test_contexts_of_one_ending_keep_their_own_words(spark):
    """Each of 4,000 contexts ending in e is always followed by the same one
    of two words, and only their own counts tell which."""
    rows = [(i, f"{i % 4000}e {'even' if i % 2 == 0 else 'odd'}") for i in range(16_000)]
    train = spark.createDataFrame([(*r, False) for r in rows], "doc_id bigint, text string, held_out boolean")
    probe = spark.createDataFrame([(2 * i + (i % 2 != j), f"{i}e {w}", True) for i in range(400) for j, w in enumerate(("even", "odd"))],
                                  "doc_id bigint, text string, held_out boolean")  # an even id: the right word
    model = py.train(train)
    assert sum(len(py._unzip(r.body)[0]) for r in model.contexts.where("bucket = -1").collect()) == 4003
    out = {r.doc_id: r.score for r in py.score(probe, model).collect()}
    assert all(out[2 * i] > out[2 * i + 1] + 0.5 for i in range(400))


def test_later_sweeps_take_off_the_tables_that_were_counted(monkeypatch):
    rng = np.random.default_rng(4)
    word, context, count = py.pair_counts(rng.integers(0, 30, 900).astype(np.uint64), rng.integers(0, 40, 900).astype(np.uint64),
                                          rng.integers(1, 30, 900))
    starts = py._runs(word)
    r = py.Restaurants(word[starts], py._sizes(starts, len(word)), *py._coded(context), count)
    away, seen, draw = 5, [], py.draw_tables  # tables of each context in other buckets

    def spy(rng, customers, others, parent, d):
        if len(customers) == len(word):
            seen.append((others, r.by_context(r.tables[0])[r.at] - r.tables[0] + away))
        return draw(rng, customers, others, parent, d)

    monkeypatch.setattr(py, "draw_tables", spy)
    prior = py.Prior((0.6, 0.6, 0.6), int(count.sum()), len(r.words))
    for _ in py.sweeps(r, prior, r.by_context(r.tables[0]) + away, r.totals(), [np.random.default_rng(i) for i in range(4)]):
        pass
    assert len(seen) == 4 and all((got == want).all() for got, want in seen)
