from itertools import combinations

import numpy as np
import pytest
import xxhash
from edge import ROWS, edge_docs, empty_docs, write_tables

from tallyhall.llm import simhash
from tallyhall.llm.components import components

SMALL = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(nodes, linked):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(docs):
    prints = {}
    for d, t in docs:
        if d is not None:
            prints.setdefault(d, set()).add(fingerprint(t))
    flat = [(d, f) for d, fs in prints.items() for f in fs]
    to = roots(prints, [(a, b) for (a, x), (b, y) in combinations(flat, 2) if (x ^ y).bit_count() <= 4])
    return sorted(((d, f"{fingerprint(t):016x}", to.get(d)) for d, t in docs), key=str)


def test_op9_on_the_small_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in simhash.op9_simhash_near_dedup(spark, SMALL).collect()), key=str)
    assert got == brute(docs)


def test_op9_edges(spark, tmp_path):
    got = simhash.op9_simhash_near_dedup(spark, write_tables(tmp_path, edge_docs(spark))).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(ROWS)
    assert simhash.op9_simhash_near_dedup(spark, write_tables(tmp_path / "e", empty_docs(spark))).count() == 0
    kept = simhash.one_of_each(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    want = {d for d, _, c in brute(ROWS) if d == c and d is not None}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == sorted(want)
    assert [r.text for r in kept.where("doc_id is null").collect()] == ["no id here"]


def test_any_four_positions_hold_a_triple():
    keys = [set(t) for t in simhash.triples()]
    assert len(keys) == 20
    assert all(any(k <= set(four) for k in keys) for four in combinations(range(8), 4))


@pytest.mark.parametrize(("max_bits", "block"), [(4, 2048), (4, 16), (2, 8), (6, 64), (0, 2048)])
def test_links_against_all_pairs(spark, max_bits, block):
    rng = np.random.default_rng(max_bits)
    base = rng.integers(0, 2**63, 25, dtype=np.uint64)
    prints = {int(b) for b in base}
    for b in base.tolist() + [int(base[0])] * 10:  # one dense group
        for _ in range(12):
            x = int(b)
            for bit in rng.integers(0, 64, int(rng.integers(1, 9))):
                x ^= 1 << int(bit)
            prints.add(x)
    rows = [(int(np.uint64(p).view(np.int64)), i) for i, p in enumerate(sorted(prints))]
    of = {i: p for i, p in enumerate(sorted(prints))}
    got = simhash.links(spark.createDataFrame(rows, "print bigint, node bigint"), max_bits, block).collect()
    assert all((of[r.a] ^ of[r.b]).bit_count() <= max_bits for r in got)
    want = roots(of, [(a, b) for a, b in combinations(of, 2) if (of[a] ^ of[b]).bit_count() <= max_bits])
    assert roots(of, [(r.a, r.b) for r in got]) == want


def test_components_of_chains_stars_and_nothing(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(300, 200), (250, 300), (250, 250)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {k: v for k, v in roots({x for p in pairs for x in p}, pairs).items()}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_unlike_texts_of_one_id_are_each_kept(spark):
    rows = [(5, "one two three four five six"), (5, "nine eight seven six five four three"), (6, "one two three four five six"),
            (4, "Nine eight seven six five four three"), (5, "one two three four five six"), (7, None), (8, "")]
    kept = simhash.one_of_each(edge_docs(spark, rows))
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id < 7) == [
        (4, "Nine eight seven six five four three"), (5, "one two three four five six")]
    apart = simhash.one_of_each(edge_docs(spark, [(5, "alpha beta gamma delta"), (5, "words of quite another kind here")]))
    assert sorted(r.text for r in apart.collect()) == ["alpha beta gamma delta", "words of quite another kind here"]


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "x y z w"), ("a", "X y z w"), ("c", "something else entirely now")], "doc_id string, text string")
    assert {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()} == {("a", "a"), ("b", "a"), ("c", "c")}
    assert {r.doc_id for r in simhash.one_of_each(docs).collect()} == {"a", "c"}
