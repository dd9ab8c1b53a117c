"""Centroid clustering of integer vectors, with geometrically tightened bounds.

Lloyd's rounds, exact: every vector keeps an upper bound of the distance to
its own centroid and a lower bound of the distance to any other.  When the
centroids move, the lower bounds of a cluster need not be loosened by the
longest move.  All vectors of a cluster lie in the sphere around its centroid
whose radius is its largest upper bound.  For that sphere and one moved
centroid the whole question lies in a plane, that of the sphere's centre and
the line of the move: the distance to the moved centroid shrinks by more than
t only within one branch of a hyperbola, which lies inside its asymptotes, a
cone around the move's midpoint.  So no vector of the sphere comes nearer by
more than the length of the move times the cosine of the smallest angle
between the move and the sphere seen from that midpoint.  The largest such
number over the other centroids is taken off the cluster's lower bounds.

A vector whose bounds still part keeps its cluster; the others are ambiguous
and are measured exactly against all centroids.  Ties go to the smaller
number, so equal bounds count as ambiguous.

Each round is one pass without a shuffle of vectors: a task reads its
vectors with their bounds and writes them with the new ones, and with them
one row for each cluster it saw (count, sums, radius).  Those rows alone are
added up, k x dimensions numbers, and go to the driver.  The written table
cuts the lineage, so a lost executor costs no earlier round; the table of the
round before is removed.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_type, removed, scratch, table

K, DIMS, ROUNDS, SCALE, SALT = 40, 64, 5, 256, "2:"
REACH = 1 << 27  # components beyond saturate, so that squared distances fit 64 bits
EXACT = 1 << 20  # up to here products of floating-point matrices are exact
SLACK = 1e-9
LARGEST = (1 << 63) - 1


@dataclass
class Step:
    """What a pass needs of the centroids: where they are, and by how much
    the bounds of each cluster change."""

    centroids: np.ndarray
    drift: np.ndarray | None = None
    loosen: np.ndarray | None = None
    half: np.ndarray = field(default_factory=lambda: np.zeros(0))


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows, one column a centroid."""
    if max(np.abs(v).max(initial=0), np.abs(c).max(initial=0)) <= EXACT:
        a, b = v.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([np.square(v - one).sum(1) for one in c], axis=1)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster, how much nearer any other moved centroid can have
    come to a vector within ``radius`` of the cluster's old centroid."""
    old, new = old.astype(np.float64), new.astype(np.float64)
    move, middle = new - old, (new + old) / 2
    length = np.sqrt(np.square(move).sum(1))
    out = np.zeros(len(old))
    for i in range(len(old)):
        away = old[i] - middle
        far = np.sqrt(np.square(away).sum(1))
        scale = np.maximum(far * length, 1e-300)
        angle = np.arccos(np.clip((away * move).sum(1) / scale, -1, 1))
        seen = np.arcsin(np.minimum(radius[i] / np.maximum(far, 1e-300), 1))  # half the angle the sphere fills
        near = length * np.where(far <= radius[i], 1.0, np.maximum(np.cos(np.maximum(angle - seen, 0)), 0))
        near[i] = 0
        out[i] = near.max()
    return out


def step_to(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> Step:
    s = first_step(new)
    s.drift = np.sqrt(np.square((new - old).astype(np.float64)).sum(1))
    s.loosen = loosening(old, new, radius)
    return s


def first_step(centroids: np.ndarray) -> Step:
    between = np.sqrt(squared(centroids, centroids).astype(np.float64))
    np.fill_diagonal(between, np.inf)
    return Step(centroids, half=between.min(1) / 2)


def assign(v: np.ndarray, step: Step, cluster=None, upper=None, lower=None):
    """(cluster, upper, lower, number of vectors measured against all
    centroids) of the rows of ``v``; without bounds all are measured."""
    n, c = len(v), step.centroids
    if cluster is None:
        cluster, upper, lower, ask = np.zeros(n, np.int32), np.zeros(n), np.zeros(n), np.arange(n)
    else:
        cluster = cluster.astype(np.int32)
        upper = (upper + step.drift[cluster]) * (1 + SLACK)
        lower = lower - step.loosen[cluster] * (1 + SLACK) - SLACK
        apart = np.maximum(lower, step.half[cluster] * (1 - SLACK))
        ask = np.flatnonzero(~(upper < apart))
        # The own centroid alone first: it often settles the question.
        upper[ask] = np.sqrt(np.square(v[ask] - c[cluster[ask]]).sum(1)) * (1 + SLACK)
        ask = ask[~(upper[ask] < apart[ask])]
    for low in range(0, len(ask), 1 << 14):
        at = ask[low:low + (1 << 14)]
        d = squared(v[at], c)
        best = d.argmin(1)
        own = d[np.arange(len(at)), best]
        d[np.arange(len(at)), best] = LARGEST
        cluster[at], upper[at] = best, np.sqrt(own) * (1 + SLACK)
        lower[at] = np.sqrt(d.min(1)) * (1 - SLACK) if len(c) > 1 else np.inf
    return cluster, upper, lower, len(ask)


def integer_vectors(df: DataFrame, dims: int = DIMS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, v) of the vectors with exactly ``dims`` components, none
    null or not finite; each component is floor(scale * x), saturated at
    +-2^27.  Other rows, null vectors among them, are no vectors."""
    x = F.col(vector_col).cast("array<double>")
    end = REACH / scale
    whole = F.transform(x, lambda e: F.floor(F.least(F.greatest(e, F.lit(-end)), F.lit(end)) * scale).cast("int"))
    fine = (F.size(vector_col) == dims) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return df.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).alias("vec_id"), whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int = K, salt: str = SALT) -> np.ndarray:
    """The ``k`` vectors whose salted ids hash smallest, in that order (a null
    id last; equal ids by their components); fewer if there are fewer."""
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(key.asc_nulls_last(), "v").limit(k).collect()  # k rows
    return np.array([r.v for r in rows], np.int64).reshape(len(rows), len(rows[0].v) if rows else 0)


def _stat_type(dims: int) -> T.StructType:
    return T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("n", T.LongType()),
                         T.StructField("radius", T.DoubleType()), T.StructField("inertia", T.DecimalType(38, 0)),
                         T.StructField("asked", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType()))])


def _pass(rows: DataFrame, step: Step, last: bool) -> DataFrame:
    """One assignment: rows of vectors with their bounds (of the last pass:
    their distances) and, with null ``v`` and a ``stat``, a row a cluster."""
    dims = step.centroids.shape[1]
    first = "cluster" not in rows.columns
    stat = _stat_type(dims)
    schema = T.StructType([
        T.StructField("vec_id", id_type(rows, "vec_id")), T.StructField("v", T.ArrayType(T.IntegerType())),
        T.StructField("cluster", T.IntegerType()), T.StructField("upper", T.DoubleType()), T.StructField("lower", T.DoubleType()),
        T.StructField("distance", T.LongType()), T.StructField("stat", stat)])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        to = to_arrow_schema(schema)
        k = len(step.centroids)
        n, radius, inertia, asked = np.zeros(k, np.int64), np.zeros(k), [0] * k, 0
        sums = np.zeros((k, dims), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("v")
            v = lists.flatten().to_numpy().reshape(-1, dims).astype(np.int64)
            state = () if first else tuple(batch.column(c).to_numpy() for c in ("cluster", "upper", "lower"))
            cluster, upper, lower, more = assign(v, step, *state)
            asked += more
            n += np.bincount(cluster, minlength=k)
            np.maximum.at(radius, cluster, upper)
            order = np.argsort(cluster, kind="stable")
            seen, at = np.unique(cluster[order], return_index=True)
            distance = np.square(v - step.centroids[cluster]).sum(1) if last else None
            if last:
                halves = [np.add.reduceat((distance >> s & 0xFFFFFFFF)[order], at) for s in (0, 32)]
                for c, a, b in zip(seen.tolist(), *[h.tolist() for h in halves], strict=True):
                    inertia[c] += a + (b << 32)
            else:
                sums[seen] += np.add.reduceat(v[order], at)
            rows_out = len(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.nulls(rows_out, lists.type) if last else lists, pa.array(cluster), pa.array(upper),
                 pa.array(lower), pa.array(distance) if last else pa.nulls(rows_out, pa.int64()), pa.nulls(rows_out, to.field("stat").type)],
                schema=to)
        seen = np.flatnonzero(n).tolist()
        if seen:
            stats = [{"cluster": c, "n": int(n[c]), "radius": float(radius[c]), "inertia": inertia[c], "asked": asked if c == seen[0] else 0,
                      "sums": sums[c].tolist()} for c in seen]
            yield pa.RecordBatch.from_pylist([{"stat": _decimal(s)} for s in stats], schema=to)

    return rows.mapInArrow(run, schema)


def _decimal(stat: dict) -> dict:
    from decimal import Decimal

    return stat | {"inertia": Decimal(stat["inertia"])}


@dataclass
class Clustering:
    rows: DataFrame  # vec_id, cluster, distance
    centroids: np.ndarray
    n: list[int]
    inertia: list[int]
    asked: list[int]  # vectors measured against all centroids, by pass


def cluster(vectors: DataFrame, centroids: np.ndarray, rounds: int = ROUNDS) -> Clustering:
    """``rounds`` times every vector goes to its nearest centroid and every
    non-empty centroid to its vectors' componentwise floor of the mean, then
    every vector is assigned once more.  Repeated rows count each."""
    spark = vectors.sparkSession
    step, rows, before, asked = first_step(centroids), vectors, None, []
    for turn in range(rounds + 1):
        last = turn == rounds
        path = scratch(spark, f"kmeans-{turn}")
        done = _pass(rows, step, last)
        done.write.option("compression", "zstd").parquet(path)
        if before:
            removed(spark, before)
        before = path
        written = spark.read.schema(done.schema).parquet(path)
        stat = written.where("stat is not null").select("stat.*")
        # One row for each cluster and component: k x dimensions at most.
        found = (stat.select("*", F.posexplode("sums").alias("place", "x")).groupBy("cluster", "place")
                 .agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), F.sum("inertia").alias("inertia"),
                      F.sum("asked").alias("asked"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect())
        heads = [r for r in found if r.place == 0]
        asked.append(sum(r.asked for r in heads))
        if last:
            n, inertia = [0] * len(centroids), [0] * len(centroids)
            for r in heads:
                n[r.cluster], inertia[r.cluster] = r.n, int(r.inertia)
            return Clustering(written.where("stat is null").select("vec_id", "cluster", "distance"), step.centroids, n, inertia, asked)
        new, radius = step.centroids.copy(), np.zeros(len(centroids))
        for r in found:
            new[r.cluster, r.place] = int(r.x) // r.n
            radius[r.cluster] = r.radius
        step = step_to(step.centroids, new, radius)
        rows = written.where("stat is null").select("vec_id", "v", "cluster", "upper", "lower")
    raise AssertionError("unreachable")


def clustered(df: DataFrame, k: int = K, dims: int = DIMS, rounds: int = ROUNDS, id_col: str = "vec_id",
              vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256) of every vector that ``integer_vectors`` keeps.

    Rows with a null vector, another length, or a component that is null or
    not finite are left out; a null id is kept; repeated rows count each; a
    table without vectors gives no rows; with fewer than ``k`` vectors there
    are that many centroids.  Sums beyond 64 bits are given as the largest."""
    spark = df.sparkSession
    vectors = integer_vectors(df, dims, SCALE, id_col, vector_col)
    centroids = first_centroids(vectors, k)
    if not len(centroids):
        kind = id_type(vectors, "vec_id").simpleString()
        return vectors.limit(0).selectExpr(f"cast(vec_id as {kind}) vec_id", "0 cluster", "0L distance", "0L cluster_inertia", "0L inertia", "'' centroid_sha256")
    done = cluster(vectors, centroids, rounds)
    texts = [",".join(map(str, c)) for c in done.centroids.tolist()]
    facts = [(i, min(done.inertia[i], LARGEST), hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(texts)]
    small = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, centroid_sha256 string")
    whole = min(sum(done.inertia), LARGEST)
    return (done.rows.join(F.broadcast(small), "cluster")  # k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(whole).cast("bigint").alias("inertia"), "centroid_sha256"))


def op13_drift_tightened_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    parts = [f"""src AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v
  FROM (SELECT sha256('{SALT}' || vec_id) AS h, v FROM src ORDER BY h NULLS LAST, v LIMIT {K}))"""]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, min(d * 64 + k) % 64 AS k, min(d * 64 + k) // 64 AS d
  FROM (SELECT s.rid, c.k, CAST(list_sum(list_transform(list_zip(s.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
        FROM src s, c{r} c) GROUP BY rid)""")
        if r < ROUNDS:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS v FROM (
      SELECT k, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT a.k, unnest(s.v) AS x, generate_subscripts(s.v, 1) AS pos FROM a{r} a JOIN src s USING (rid)) GROUP BY k, pos)
    GROUP BY k) m ON c.k = m.k)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT s.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN src s USING (rid) JOIN c{ROUNDS} c ON a.k = c.k"""


OP13_SQL = _sql()
