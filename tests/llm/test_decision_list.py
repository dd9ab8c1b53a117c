import math
import re

import numpy as np
import pytest
from edge import ROWS, edge_docs, empty_docs, write_tables
from pyspark.sql import functions as F

from tallyhall.llm import decision_list as dl

MID = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, covered = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(p + k for p in places for k in range(3))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


HARD = [*ROWS, (20, "a b c " * 40), (21, "a a a a"), (22, "x y z x y"), (23, "l1 a\n l1 a\nl1 a\n\n\nl1 a\n l1 a \n"),
        (24, "é# <b>|日本* " * 60), (25, " ".join(f"w{i}" for i in range(60)) + " w1 w2 w3 w4")]


@pytest.mark.parametrize("rows", [None, HARD])
def test_op7_base_columns(spark, tmp_path, rows):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (20, None, 1), (9, 0, 0), (9, 1, 0)], "doc_id bigint, quality int, toxic int")
    d = MID if rows is None else write_tables(tmp_path, edge_docs(spark, rows), labels=labels)
    if rows is None:
        rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{MID}/documents.parquet").collect()]
    out = dl.op7_decision_list(spark, d).collect()
    assert sorted((tuple(r)[:7] for r in out), key=str) == sorted(((i, *base(t)) for i, t in rows), key=str)
    assert not any(r.kept and r.base_failed for r in out)


def test_op7_empty(spark, tmp_path):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert dl.op7_decision_list(spark, write_tables(tmp_path, empty_docs(spark), labels=labels)).count() == 0


def test_op7_verdicts_against_labels(spark):
    out = {r.doc_id: r for r in dl.op7_decision_list(spark, MID).collect()}
    labels = [(out[r.doc_id], r.quality) for r in spark.read.parquet(f"{MID}/labels.parquet").collect() if not out[r.doc_id].base_failed]
    assert np.mean([r.kept for r, q in labels if q == 1]) > .97
    assert np.mean([r.kept for r, q in labels if q == 0]) < .3


def test_rules_learned_without_the_prune_rows_hold_on_them(spark):
    stats = dl.statistics(spark.read.parquet(f"{MID}/documents.parquet"))
    labels = spark.read.parquet(f"{MID}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3)) == 0
    rules = dl.learn_from(stats, labels.where(~held))
    rows = stats.withColumn("rule", dl.verdict(rules)).join(labels.where(held), "doc_id").collect()
    assert np.mean([r.rule == 0 for r in rows if r.quality == 1]) > .95
    assert np.mean([r.rule > 0 for r in rows if r.quality == 0]) > .6


def holds(rule, x):
    return all((x[c.feature] >= c.threshold) == c.at_least for c in rule)


def brute_best(rows, marks):
    p0, n0 = sum(r["bad"] for r in rows), sum(not r["bad"] for r in rows)
    found = []
    for f, m in marks.items():
        for t in m:
            for ge in (True, False):
                kept = [r for r in rows if (r[f] >= t) == ge]
                p = sum(r["bad"] for r in kept)
                if p:
                    found.append(p * (math.log2(p / len(kept)) - math.log2(p0 / (p0 + n0))))
    return max(found)


def test_grow_step_and_list_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [{"a": float(rng.integers(0, 10)), "b": float(rng.integers(0, 4)), "prune": bool(i % 3 == 0)} for i in range(600)]
    for r in rows:
        r["bad"] = bool((r["a"] >= 7 and r["b"] < 2) or r["a"] < 1)
    df = spark.createDataFrame([(r["a"], r["b"], r["prune"], r["bad"]) for r in rows], "a double, b double, prune boolean, bad boolean")
    marks = dl._thresholds(df, ("a", "b"), 12)
    best, p, n = dl._best_condition(df, (), marks)
    kept = [r for r in rows if holds((best,), r)]
    assert (p, n) == (sum(r["bad"] for r in kept), sum(not r["bad"] for r in kept))
    p0 = sum(r["bad"] for r in rows)
    assert dl.foil_gain(p, n, p0, len(rows) - p0) == pytest.approx(brute_best(rows, marks))
    rules = dl.learn(df, ("a", "b"), bins=12)
    first = [next((i for i, rule in enumerate(rules, 1) if holds(rule, r)), 0) for r in rows]
    assert [f > 0 for f in first] == [r["bad"] for r in rows]
    got = df.select(dl.verdict(rules).alias("v")).collect()
    assert [r.v for r in got] == first


def test_no_rule_without_bad_rows(spark):
    df = spark.createDataFrame([(1.0, False, False), (2.0, True, False)], "a double, prune boolean, bad boolean")
    assert dl.learn(df, ("a",)) == []
    assert dl.learn(df.limit(0), ("a",)) == []


def test_no_python_in_the_plan(spark):
    assert not re.search("Python|Pandas|MapInArrow", dl.statistics(spark.read.parquet(f"{MID}/documents.parquet"))._jdf.queryExecution().toString())


@pytest.mark.parametrize("bits", [26, 60, 5])
def test_repeats_are_exact_when_high_bits_clash_or_places_run_out(spark, monkeypatch, bits):
    """With 60 bits for places only 4 of a hash are left, so unlike windows
    share them; with 5 a text of over 31 windows has more than places."""
    monkeypatch.setattr(dl, "PLACE_BITS", bits)
    rng = np.random.default_rng(bits)
    rows = [(i, " ".join(rng.choice(list("abcdefgh"), int(rng.integers(0, 300))))) for i in range(60)] + HARD
    got = dl.statistics(edge_docs(spark, rows)).collect()
    want = sorted(((i, base(t)[4]) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_repeat_words) for r in got), key=str) == want
