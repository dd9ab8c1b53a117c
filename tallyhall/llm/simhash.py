"""Near-duplicates by SimHash with a byte-position index.

Two 64-bit fingerprints that differ in at most ``max_bits`` bits share at
least ``8 - max_bits`` of their 8 bytes in place.  A list per (position,
byte) would hold one 256th of all fingerprints, and tallying its pairs is
quadratic; so the index is kept on position triples instead, chosen so that
any four shared positions include one of them (Turan's 20 triples of 8).  In
each list the shared positional bytes of a pair are tallied, pairs below the
guaranteed minimum go, and the bits of the rest are compared.

A list longer than ``block`` is cut into blocks and each pair of blocks is a
task of its own.  A task emits only links that join something new.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import partitions, saved, table
from .components import components

SHINGLE = 4
MAX_BITS = 4
BLOCK = 2048


def triples() -> list[tuple[int, ...]]:
    """20 triples of 8 positions, one within any 4 positions: of three groups,
    a triple takes three of one, or two of one and one of the next."""
    groups = [(0, 1, 2), (3, 4, 5), (6, 7)]
    out = []
    for g, nxt in zip(groups, [*groups[1:], groups[0]], strict=True):
        out += combinations(g, 3)
        out += [(*two, one) for two in combinations(g, 2) for one in nxt]
    return out


def positions_for(max_bits: int) -> list[tuple[int, ...]]:
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits must be 0 to 7: beyond that no shared byte is guaranteed")
    return triples() if max_bits <= 4 else [(i,) for i in range(8)]


def _text_prints(texts: list[bytes | None], shingle: int) -> np.ndarray:
    """Fingerprints of whole texts as int64."""
    import xxhash

    digest, out = xxhash.xxh64_intdigest, np.zeros(len(texts), np.uint64)
    for at, text in enumerate(texts):
        words = text.lower().split() if text else []
        if not words:
            continue
        joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes + 1) - sizes - 1
        last = np.minimum(np.arange(n) + shingle - 1, len(words) - 1)
        first, stop = starts[:n].tolist(), (starts[last] + sizes[last]).tolist()
        count = np.zeros(64, np.int64)
        for low in range(0, n, 1 << 16):
            high = min(n, low + (1 << 16))
            h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(first[low:high], stop[low:high], strict=True)),
                            "<u8", high - low)
            count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[at] = np.packbits(2 * count > n, bitorder="little").view("<u8")[0]
    return out.view(np.int64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, text_hash, print): a bit is set if more than half of the
    text's shingles have it in their XXH64 (seed 42).  Fewer words than a
    shingle: all of them; no words or null: zero.  Ids keep their type."""
    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    schema = T.StructType([src.schema["doc_id"], T.StructField("text_hash", T.LongType()), T.StructField("print", T.LongType())])

    def run(batches):
        for batch in batches:
            prints = _text_prints(batch.column("text").to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(prints)], schema.names)

    return src.mapInArrow(run, schema)


class _Joined:
    """Union-find over small integers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


def _list_links(group: np.ndarray, prints: np.ndarray, nodes: np.ndarray, max_bits: int) -> tuple[list, list]:
    """Links within equal neighbours of the sorted ``group``; each joins two
    nodes that the batch's earlier links had not."""
    left, right, off = [], [], 1
    live = np.arange(max(0, len(group) - 1))
    joined = None
    while len(live := live[live + off < len(group)]):
        live = live[group[live] == group[live + off]]
        x = prints[live] ^ prints[live + off]
        tally = (np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        near = live[(tally >= 8 - max_bits) & (_bits(x) <= max_bits)]
        if len(near):
            if joined is None:
                ids, place = np.unique(nodes, return_inverse=True)
                joined, place = _Joined(len(ids)), place.tolist()
            for a in near.tolist():
                if joined.join(place[a], place[a + off]):
                    left.append(nodes[a])
                    right.append(nodes[a + off])
        off += 1
    return left, right


def links(prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between nodes of ``prints`` (columns print and node, one
    row per print), enough to connect whatever differs in at most
    ``max_bits`` bits."""
    keys = positions_for(max_bits)

    def byte(i: int):
        return F.shiftrightunsigned("print", 8 * i).bitwiseAND(F.lit(255))

    key = F.array(*[sum((byte(i) * (1 << 8 * j) for j, i in enumerate(t)), F.lit(k << 24).cast("bigint")) for k, t in enumerate(keys)])
    posted = prints.select("print", "node", F.explode(key).alias("list"))
    lengths = posted.groupBy("list").agg(F.count("*").alias("n")).where("n > 1")
    sizes = saved(lengths.select("list", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "lists")
    dealt = posted.join(sizes, "list")
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    other = dealt.select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = other.select("list", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "print", "node")
    by = ["list", "lo", "hi"]
    rows = rows.repartition(partitions(prints.sparkSession), *by).sortWithinPartitions(*by)

    def run(batches):
        held = None
        for batch in batches:
            now = [batch.column(c).to_numpy() for c in (*by, "print", "node")]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            new = np.concatenate([[True], (now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1]) | (now[2][1:] != now[2][:-1])])
            cut = int(np.flatnonzero(new)[-1])  # the last list may go on in the next batch
            held = [x[cut:] for x in now]
            yield from emit(np.cumsum(new)[:cut], now[3][:cut], now[4][:cut])
        if held is not None:
            yield from emit(np.zeros(len(held[0]), np.int64), held[3], held[4])

    def emit(group, fp, node):
        a, b = _list_links(group, fp, node, max_bits)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, block: int = BLOCK,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, print, component_id) of every document; component_id is
    the smallest doc_id reachable by links, its own included.

    Documents without words share fingerprint zero and link like others.  A
    row with a null id has a fingerprint, links nothing and has no component.
    Repeated rows are returned each; an empty table gives no rows."""
    return _resolved(docs, shingle, max_bits, block, id_col, text_col).select("doc_id", "print", "component_id")


def _resolved(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, block: int = BLOCK, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """:func:`near_duplicates` with text_hash and the component's root, its
    smallest fingerprint.  Components are of fingerprints, not of ids, so
    texts that share an id and nothing else stay apart."""
    prints = saved(fingerprints(docs, shingle, id_col, text_col), "prints")
    nodes = saved(prints.where("doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("low")), "print-nodes")
    roots = components(links(nodes.select("print", F.col("print").alias("node")), max_bits, block))
    named = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").select("print", "low", F.coalesce("root", "print").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    out = prints.join(named.select("print", "root").join(lowest, "root"), "print", "left")
    known = F.col("doc_id").isNotNull()
    return out.select("doc_id", "text_hash", "print", F.when(known, F.col("root")).alias("root"), F.when(known, F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row of each component: that with the smallest id, of several texts
    with that id in the component the one whose hash is smallest.  Repeated
    rows (equal id and text) count as one; unlike texts that share an id are
    each kept; rows with a null id stay.  All columns are kept."""
    found = _resolved(docs, id_col=id_col, text_col=text_col, **kw).where("doc_id = component_id")
    best = saved(found.groupBy("root", "doc_id").agg(F.min("text_hash").alias("__hash")).select(F.col("doc_id").alias("__keep"), "__hash"), "kept")
    known = docs.where(F.col(id_col).isNotNull()).withColumn("__text_hash", F.xxhash64(F.col(text_col).cast("string")))
    kept = known.join(best, (F.col(id_col) == F.col("__keep")) & (F.col("__text_hash") == F.col("__hash")), "left_semi")
    return kept.dropDuplicates([id_col, "__text_hash"]).select(*docs.columns).union(docs.where(F.col(id_col).isNull()))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
