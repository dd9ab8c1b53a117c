import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from edge import ROWS, edge_docs, empty_docs, write_tables
from tokenizers import Tokenizer

from tallyhall.llm import packing, token_orc
from tallyhall.llm.common import scratch
from tallyhall.llm.tokens import Encoder

SMALL = "/root/testdata/sf0.001"


def plain(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_ids_equal_the_library(name, spark):
    enc, want = Encoder(public_tokenizers.path(name), limit=50), plain(name)
    assert enc.kind
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    odd = ["a  b", " a", "a ", "a\n b", "a \nb", "it's we'll", "ΑΣ ΑΣ", "İ I", "e\u0301 é", "\u0301 x", "x\u00a0 y", "",
           " ", "\x1c a", "a\x1c b", "日本 語", "ª º ²", "1234 5 6", "--- ...", "a\u2028 b", "a\x01 b", "a\n\nb\nc.\nd", "x...\ny?!", "é.è,ß;×.÷,", "\n", "a\n", "\na.",
           "a.\u0338b", "a.b.c's", "N.A.S.A. e.g.,", "\u00ad soft \u00adhyphen"]
    every = [*texts, *odd, *[t or "" for _, t in ROWS]]
    ids, ends = enc.batch(pa.array(["cut off", *every]).slice(1), 2)
    assert len(ends) == len(every) + 1
    for t, a, b in zip(every, ends[:-1], ends[1:], strict=True):
        assert np.frombuffer(enc.ids(t), "<u4").tolist() == want(t), t[:80]
        assert ids[a:b].tolist() == [*want(t), 2], t[:80]


def expected_op2(rows):
    ids, at, out = plain("word_bpe_49k.json"), 0, []
    for doc, text in rows:
        x = [*ids(text), 2]
        out.append((doc, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        at += len(x)
    return out


def test_op2_against_plain_encoding(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = [tuple(r) for r in token_orc.op2_token_orc(spark, SMALL).orderBy("doc_id").collect()]
    assert got == expected_op2(sorted(rows))


def test_op2_edges(spark, tmp_path):
    d = write_tables(tmp_path, edge_docs(spark))
    got = sorted((tuple(r) for r in token_orc.op2_token_orc(spark, d).collect()), key=lambda r: r[1])
    assert got == expected_op2(sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)))
    assert token_orc.op2_token_orc(spark, write_tables(tmp_path / "e", empty_docs(spark))).count() == 0


def test_orc_reads_by_id(spark):
    path = scratch(spark, "orc-test")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    token_orc.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    one = token_orc.read_tokens(spark, path).where("doc_id = 17")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,17)]" in one._jdf.queryExecution().toString()
    text = docs.where("doc_id = 17").first().text
    assert one.first().ids == [*plain("word_bpe_49k.json")(text), 2]


def check_packing(rows, packed):
    ids, by_doc, by_seq = plain("byte_bpe_50k.json"), {}, {}
    for r in packed:
        assert 1 <= r.length <= 1024
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by_seq) == list(range(len(by_seq)))
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    total = 0
    for doc, text in dict(rows).items():
        x = [*ids(text), 2]
        copies = sum(1 for d, _ in rows if d == doc)
        got = sorted(by_doc[doc], key=lambda r: r.piece)
        assert sum(r.length for r in got) == len(x) * copies
        assert len(got) == -(-len(x) // 1024) * copies
        for r in got:
            assert zlib.crc32(np.array(x[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32
        total += len(x) * copies
    return len(by_seq), total


def test_op4_against_plain_encoding(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    n, total = check_packing(rows, packing.op4_best_fit_packing(spark, SMALL).collect())
    assert n <= -(-total // 1024) + 2


def test_op4_edges(spark, tmp_path):
    check_packing(ROWS, packing.op4_best_fit_packing(spark, write_tables(tmp_path, edge_docs(spark))).collect())
    empty = write_tables(tmp_path / "e", empty_docs(spark))
    assert packing.op4_best_fit_packing(spark, empty).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_plan_uses_every_piece_once_and_few_sequences(seed):
    rng = np.random.default_rng(seed)
    top = [60, 400, 1024][seed % 3]
    sizes = rng.integers(1, top + 1, int(rng.integers(1, 4000)))
    counts = dict(zip(*[x.tolist() for x in np.unique(sizes, return_counts=True)], strict=True))
    fill, seen = {}, {}
    for length, rank, n, first, each, offset in packing.plan_packing(counts):
        for k in range(n):
            seen.setdefault(length, []).append(rank + k)
            fill.setdefault(first + k // each, []).append((offset + k % each * length, length))
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(v)) for k, v in counts.items()}
    for spans in fill.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    bound = max(-(-int(sizes.sum()) // 1024), int((sizes > 512).sum()))
    assert len(fill) <= 1.1 * bound + 1


def test_row_index_and_bloom_filter_skip_row_groups(spark, tmp_path):
    """A read of one id scans its row group by the row index; an id that lies
    between others but is not there, none at all, by the Bloom filter."""
    docs = spark.range(8000).selectExpr("id * 2 doc_id", "concat('text ', id) text")
    path = str(tmp_path / "t")
    token_orc.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"), n_files=1, row_stride=1000)

    def scanned(condition):
        df = token_orc.read_tokens(spark, path).where(condition)
        df.collect()
        return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()

    assert scanned("doc_id >= 0") == 8000
    assert scanned("doc_id = 7776") == 1000
    assert scanned("doc_id = 7777") == 0
