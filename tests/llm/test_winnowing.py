import hashlib
import re

import pytest
from edge import edge_docs, empty_docs, write_tables

from tallyhall.llm import winnowing

SMALL = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (ids := windows.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= ids
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, path):
    return sorted((tuple(r) for r in winnowing.op3_winnowing(spark, path).collect()), key=str)


def test_op3_on_the_small_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = brute(docs, items)
    assert run(spark, SMALL) == want
    assert any(x[-1] for x in want) and not all(x[-1] for x in want)


PASSAGE = "One two, three FOUR five six seven eight nine ten eleven twelve"
ITEMS = [(1, PASSAGE), (2, "short item"), (3, None), (4, ""), (5, PASSAGE), (None, "nobody owns this window"), (6, "naïve"),
         (7, "a b c d e f g"), (10, "short item"), (1, PASSAGE)]
DOCS = [(1, f"before {PASSAGE.lower()} after"), (2, None), (3, ""), (4, "a short item here, short ITEM"), (5, "café naïve-café"),
        (6, "nobody owns this window"), (7, "a b c d e f g h"), (8, "one two three four five six seven eight nine"),
        (9, "x " * 30000 + PASSAGE + " y" * 10), (9, PASSAGE), (9, PASSAGE), (None, PASSAGE), (11, "9 naïve9 SHORT_ITEM")]


def test_op3_edges(spark, tmp_path):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").selectExpr("*", "1 as n", "'x' as words", "0 as doc_id")
    d = write_tables(tmp_path, edge_docs(spark, DOCS), items)
    assert run(spark, d) == brute(DOCS, ITEMS)
    kept = winnowing.without_contaminated(edge_docs(spark, DOCS), items)
    assert kept.columns == edge_docs(spark).columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [x for x in sorted(DOCS[:9]) if x[0] in (2, 3, 8)]


@pytest.mark.parametrize("no_docs", [True, False])
def test_op3_empty_tables(spark, tmp_path, no_docs):
    items = spark.createDataFrame([] if not no_docs else ITEMS, "item_id bigint, text string")
    docs = empty_docs(spark) if no_docs else edge_docs(spark)
    got = winnowing.op3_winnowing(spark, write_tables(tmp_path, docs, items)).collect()
    assert len(got) == docs.count() and not any(r.contaminated for r in got)


def test_no_python_in_the_plan(spark):
    text = winnowing.op3_winnowing(spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", text)


def test_op3_equals_its_sql(spark, duck):
    got = {tuple(sorted(r.asDict().items())) for r in winnowing.op3_winnowing(spark, SMALL).collect()}
    rel = duck.execute(winnowing.OP3_SQL)
    names = [c[0] for c in rel.description]
    assert got == {tuple(sorted(zip(names, r, strict=True))) for r in rel.fetchall()}
