"""Small tables with awkward rows, shared by the operators' tests."""

from pyspark.sql import functions as F

LONG = "alpha beta gamma delta " * 5000

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog, don't it? 3.14!"),
    (2, None),
    (3, ""),
    (4, " \n\t  "),
    (5, "naïve café — ΑΣ İstanbul e\u0301 日本語 😀  two  spaces\n\n new\u00a0line \x1c x "),
    (6, LONG),
    (7, "The quick brown fox jumps over the lazy dog, don't it? 3.14!"),
    (None, "no id here"),
    (8, "<|endoftext|> is text & AKIA-like #things"),
    (9, "same row"),
    (9, "same row"),
]


def edge_docs(spark, rows=ROWS):
    """Documents with nulls, empty and very long texts, ties, repeated rows
    and extra columns whose names clash with those of the operators."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return df.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("x").alias("source"), F.lit(0).alias("n"),
                     F.lit("k").alias("key"), F.lit(1).alias("part"), F.lit(1).alias("score"), F.lit(2).alias("length"),
                     F.lit(7).alias("h"), F.lit("w").alias("words"), F.lit(None).cast("string").alias("start"))


def empty_docs(spark):
    return edge_docs(spark, []) 


def write_tables(path, docs, benchmark=None, labels=None):
    """A folder of tables as the queries read them."""
    docs.write.parquet(f"{path}/documents.parquet")
    if benchmark is not None:
        benchmark.write.parquet(f"{path}/benchmark.parquet")
    if labels is not None:
        labels.write.parquet(f"{path}/labels.parquet")
    return str(path)
