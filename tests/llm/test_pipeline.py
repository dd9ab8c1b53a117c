import pyarrow as pa
import test_secrets
import test_simhash
import test_tokens
import test_winnowing
from edge import edge_docs, empty_docs, write_tables

import corpus_pipeline
from tallyhall.llm import toxicity

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    model = toxicity.fit(docs, toxicity._labels(spark.read.parquet(f"{SMALL}/labels.parquet")))
    now, df = sorted(rows(docs)), docs
    for (name, stage), columns in zip(corpus_pipeline.STAGES, [docs.columns] * 4 + [None], strict=True):
        df = corpus_pipeline.saved(stage(spark, df, SMALL), name)
        before = now
        if name == "toxicity":
            now = [(d, t) for d, t in now if toxicity.chain_probabilities(model, pa.array([t]))[0, -1] < .5]
            assert len(now) < len(before)
        elif name == "simhash_near_dedup":
            now = [(d, t) for (d, _, c), t in zip(sorted(test_simhash.brute(now), key=lambda x: x[0]), [t for _, t in now], strict=True) if c == d]
            assert len(now) < len(before)
        elif name == "benchmark_decontamination":
            hit = {x[0] for x in test_winnowing.brute(now, items) if x[-1]}
            now = [(d, t) for d, t in now if d not in hit]
            assert len(now) < len(before)
        elif name == "secret_scan":
            out = []
            for (doc, text), r in zip(now, sorted(test_secrets.brute(now), key=lambda x: x[0]), strict=True):
                new, upto = "", 0
                for _, a, b in (s.split(":") for s in r[-1].split(",") if s):
                    if int(b) > upto:
                        new += text[upto:int(a)] + "[SECRET]" if int(a) >= upto else ""
                        upto = int(b)
                out.append((doc, new + text[upto:]))
            now = out
        if columns:
            assert df.columns == columns and df.schema == docs.schema
            assert sorted(rows(df)) == now, name
    n, total = test_tokens.check_packing(now, df.collect())
    assert n <= -(-total // 1024) + 2
    whole = corpus_pipeline.run(spark, SMALL).drop("sequence_id", "offset")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, df.drop("sequence_id", "offset").collect()))


def test_edges(spark, tmp_path):
    """Copies share the smallest id; texts without words link to each other;
    the text with a benchmark word goes; a row without an id stays."""
    items = spark.createDataFrame(test_winnowing.ITEMS, "item_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    for i, docs in enumerate([edge_docs(spark), empty_docs(spark)]):
        d = write_tables(tmp_path / str(i), docs, items, labels)
        kept = {r.doc_id for r in corpus_pipeline.run(spark, d).collect()}
        assert kept == (set() if i else {1, 2, 6, 8, 9, None})
