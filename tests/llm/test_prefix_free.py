import hashlib
import random

import numpy as np
import pytest
from edge import ROWS, edge_docs, empty_docs, write_tables

from tallyhall.llm import prefix_free
from tallyhall.llm.parsing import Hashes, Parse, sliding_minimum

SMALL = "/root/testdata/sf0.001"


def gone_bytes(texts, length):
    seen = {}
    for i, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            seen.setdefault(t[s:s + length], []).append((i, s))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                gone[i][s:s + length] = True
    return gone


def brute(docs, length=200):
    texts = [(t or "").encode() for _, t in docs]
    out = []
    for (doc, _), t, g in zip(docs, texts, gone_bytes(texts, length), strict=True):
        runs = int((np.diff(np.concatenate([[0], g.astype(int)])) > 0).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~g])
        out.append((doc, len(t), int(g.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, path):
    return sorted((tuple(r) for r in prefix_free.op5_prefix_free_dedup(spark, path).collect()), key=str)


def test_op5_on_the_small_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = brute(docs)
    assert run(spark, SMALL) == want
    assert any(x[2] for x in want) and any(0 < x[2] < x[1] for x in want)


def copies(seed):
    """Texts of few letters with long copies, runs of one letter, and copies
    that end at the texts' ends."""
    rng = random.Random(seed)
    texts = ["".join(rng.choice("ab é"[:2 + seed % 3]) for _ in range(rng.randrange(0, 900))) for _ in range(12)]
    for _ in range(25):
        a = rng.choice(texts)
        if len(a) > 60:
            x = rng.randrange(len(a) - 50)
            part = a[x:x + rng.choice([150, 199, 200, 201, 260, 500])]
            b = rng.randrange(len(texts))
            y = rng.choice([0, len(texts[b]), rng.randrange(len(texts[b]) + 1)])
            texts[b] = texts[b][:y] + part + texts[b][y:]
    return [*texts, "a" * 500, "ab" * 150, "a" * 199, "a" * 200, texts[0]]


@pytest.mark.parametrize("seed", range(4))
def test_op5_against_brute_force(spark, tmp_path, seed):
    rows = [(i, t) for i, t in enumerate(copies(seed))]
    assert run(spark, write_tables(tmp_path, edge_docs(spark, rows).repartition(3))) == brute(rows)


def test_op5_edges(spark, tmp_path):
    assert run(spark, write_tables(tmp_path, edge_docs(spark))) == brute(ROWS)
    assert run(spark, write_tables(tmp_path / "e", empty_docs(spark))) == []


@pytest.mark.parametrize("length", [40, 200])
def test_equal_windows_have_equal_phrases(length):
    rng = np.random.default_rng(length)
    part = rng.integers(0, 4, length + 80, dtype=np.uint8)
    found = []
    for pad in (0, 1, 57, 300):
        data = np.concatenate([rng.integers(0, 4, pad, dtype=np.uint8), part, rng.integers(0, 4, 33, dtype=np.uint8)])
        p = Parse(data, length)
        assert p.first[0] == 0 and p.last[-1] == len(data) - length and (p.first[1:] == p.last[:-1] + 1).all()
        owner = np.repeat(p.phrase, p.last - p.first + 1)
        found.append(owner[pad:pad + 81].tolist())
    assert all(x == found[0] for x in found)


def test_hashes_and_minimum():
    data = np.frombuffer(b"abcabcxabc", np.uint8)
    h = Hashes(data).of(np.array([0, 3, 7, 1]), np.array([3, 6, 10, 4]))
    assert h[0] == h[1] == h[2] != h[3]
    x = np.random.default_rng(0).integers(0, 50, 300)
    for width in (1, 2, 7, 64, 300, 301):
        assert sliding_minimum(x, width).tolist() == [min(x[i:i + width]) for i in range(300 - width + 1)]
