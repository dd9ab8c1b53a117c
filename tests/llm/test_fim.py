import hashlib
import re

import pytest
import zstandard
from edge import ROWS, edge_docs, empty_docs, write_tables

from tallyhall.llm import fim

AWKWARD = ROWS + [
    (20, "a <P> inside"), (21, "<S>"), (22, "x<M"), (23, "abc" * 4000), (24, "é" * 3000), (25, "a😀b" * 2000), (26, "<" * 500),
    (27, "A"), (28, " "), (29, "<P" + "x" * 61 + "<S>"), (30, "one two\n\nthree\tfour 5"), (31, "\u0000nul and ﻿bom"),
] + [(100 + i, f"text number {i}: some words, ünd mehr; <P {i}> " * (i % 7)) for i in range(60)]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, digest = len(units), sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    return n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


@pytest.mark.parametrize("size", [5, 64, fim.FRAME])
def test_digests_texts_and_frames_equal_brute_force(spark, tmp_path, size):
    fim.write_frames(edge_docs(spark, AWKWARD), str(tmp_path / "f"), size=size)
    store = fim.read_frames(spark, str(tmp_path / "f"))
    want = {(k, t): brute(k, t) for k, t in AWKWARD}
    got = sorted((tuple(r) for r in fim.transformed(store, "digest", size).collect()), key=str)
    assert got == sorted(((k, *want[k, t][:4], sha(want[k, t][4]), sha(t or "")) for k, t in AWKWARD), key=str)
    texts = sorted((tuple(r) for r in fim.transformed(store, "text").collect()), key=str)
    assert texts == sorted(((k, *want[k, t]) for k, t in AWKWARD), key=str)
    forms = {r[2] for r in got}
    assert forms == {"plain", "psm", "spm"}
    for r in fim.transformed(store, "frames", size).collect():
        parts = [zstandard.ZstdDecompressor().decompress(b) for b in r.frames]
        assert [sum(map(len, parts[:i + 1])) for i in range(len(parts))] == r.ends and all(len(p) <= size for p in parts)
        assert (r.doc_id, b"".join(parts).decode()) in {(k, w[4]) for (k, _), w in want.items()}


def test_only_the_cut_frame_is_opened():
    text = ("word " * 30_000).encode()
    ends = fim.frame_ends(text, 4096)
    blobs = [zstandard.ZstdCompressor().compress(text[a:b]) for a, b in zip([0, *ends], ends)]
    units = [len(re.findall(rb"[A-Za-z]+|[^A-Za-z]", text[:e])) for e in ends]
    f = fim.Frames(blobs, units, ends)
    opened = []
    frame, f.frame = f.frame, lambda i: opened.append(i) or frame(i)
    k = 33_333
    at = f.byte_of(k)
    assert len(re.findall(rb"[A-Za-z]+|[^A-Za-z]", text[:at])) == k and len(set(opened)) == 1


def test_a_run_over_frames_counts_once_and_where_it_starts():
    text = ("ab1" + "x" * 100 + "2" + "y" * 50).encode()
    units = re.findall(rb"[A-Za-z]+|[^A-Za-z]", text)
    for size in (4, 7, 16, 1000):
        ends = fim.frame_ends(text, size)
        starts = fim.unit_starts(__import__("numpy").frombuffer(text, "u1"))
        f = fim.Frames([zstandard.ZstdCompressor().compress(text[a:b]) for a, b in zip([0, *ends], ends)],
                       [int(starts[:e].sum()) for e in ends], ends)
        assert f.n == len(units) and [f.byte_of(k) for k in range(len(units) + 1)] == [len(b"".join(units[:k])) for k in range(len(units) + 1)]


def test_a_marker_over_a_frame_border_is_seen():
    text = b"abcde<P>fgh"
    for size in range(4, 11):
        ends = fim.frame_ends(text, size)
        f = fim.Frames([zstandard.ZstdCompressor().compress(text[a:b]) for a, b in zip([0, *ends], ends)], [1] * len(ends), ends)
        assert fim.holds_marker(f)


def test_query_over_tables_and_an_empty_one(spark, tmp_path):
    rows = fim.op12_seekable_fim(spark, write_tables(tmp_path / "a", edge_docs(spark)))
    assert rows.count() == len(ROWS)
    assert rows.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert fim.op12_seekable_fim(spark, write_tables(tmp_path / "b", empty_docs(spark))).count() == 0
