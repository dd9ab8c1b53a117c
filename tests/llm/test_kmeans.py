import hashlib
import math
import random

import numpy as np
import pytest

from tallyhall.llm import kmeans


def brute(rows, k, dims, rounds):
    """Lloyd's rounds in plain Python over (id, components) rows."""
    kept = []
    for key, x in rows:
        if x is not None and len(x) == dims and all(e is not None and math.isfinite(e) for e in x):
            kept.append((key, [math.floor(256 * e) for e in x]))
    h = lambda key: "~" if key is None else hashlib.sha256(f"2:{key}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (h(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for i in range(len(centroids)):
            own = [v for (_, v), c in zip(kept, at) if c == i]
            if own:
                centroids[i] = [sum(col) // len(own) for col in zip(*own)]
    done = [(key, *nearest(v)) for key, v in kept]
    return sorted(((key, c, d, sum(x[1] for x in done if x[2] == c), sum(x[1] for x in done),
                    hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for key, d, c in done), key=str)


def vectors(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    return df.selectExpr("*", "1 cluster", "'x' stat", "2 upper", "3 v", "0 label") if extra else df


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_brute_force_with_awkward_rows(spark):
    rng = random.Random(5)
    rows = [(i, [float(np.float32(rng.gauss(i % 5, 0.6))) for _ in range(4)]) for i in range(300)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (1000, rows[3][1]), (None, [0.5, 0.5, 0.5, 0.5]), (2000, None), (2001, []),
             (2002, [1.0, 2.0, 3.0]), (2003, [1.0, None, 3.0, 4.0]), (2004, [float("nan"), 0.0, 0.0, 0.0]),
             (2005, [float("inf"), 0.0, 0.0, 0.0]), (2006, [0.0] * 4), (2007, [0.0] * 4)]
    got = result(kmeans.clustered(vectors(spark, rows), k=12, dims=4, rounds=4))
    assert got == brute(rows, 12, 4, 4)


def test_ties_go_to_the_smaller_number(spark):
    """Points of a line in steps of one: midpoints between centroids abound."""
    rows = [(i, [(i % 21) / 256, 0.0]) for i in range(210)]
    assert result(kmeans.clustered(vectors(spark, rows), k=8, dims=2, rounds=5)) == brute(rows, 8, 2, 5)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_fewer_vectors_than_centroids(spark, n):
    rows = [(i, [float(i), 1.0]) for i in range(n)] + [(9, None)]
    assert result(kmeans.clustered(vectors(spark, rows), k=40, dims=2)) == brute(rows, 40, 2, 5)


def test_large_components_saturate_and_stay_exact(spark):
    rows = [(0, [3e38, 1.0]), (1, [-3e38, 1.0]), (2, [4e5, 2.0]), (3, [4e5, 2.0])]
    got = result(kmeans.clustered(vectors(spark, rows), k=2, dims=2, rounds=2))
    cut = [(k, [max(-524288.0, min(524288.0, x)) for x in v]) for k, v in rows]
    assert got == brute(cut, 2, 2, 2)


def test_loosening_covers_every_vector_of_the_sphere_and_is_less_than_the_drift():
    rng = np.random.default_rng(3)
    tighter = 0
    for _ in range(300):
        d = int(rng.integers(2, 6))
        old = rng.normal(size=(6, d)) * 10
        new = old + rng.normal(size=(6, d)) * rng.choice([0.01, 1, 5])
        radius = np.abs(rng.normal(size=6)) * rng.choice([0.1, 2, 10])
        bound = kmeans.loosening(old, new, radius)
        drift = np.sqrt(np.square(new - old).sum(1))
        for i in range(6):
            x = rng.normal(size=(400, d))
            x = old[i] + x / np.linalg.norm(x, axis=1, keepdims=True) * radius[i] * rng.random((400, 1)) ** 0.2
            nearer = [(np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)).max() for j in range(6) if j != i]
            most = max(drift[j] for j in range(6) if j != i)
            assert max(nearer) <= bound[i] + 1e-9 and bound[i] <= most + 1e-9
            tighter += bound[i] < 0.9 * most
    assert tighter > 300


def test_the_bounds_settle_most_vectors_of_parted_clusters(spark):
    rng = random.Random(1)
    rows = [(i, [float(np.float32(10 * (i % 6 == j) + rng.gauss(0, 0.2))) for j in range(6)]) for i in range(1200)]
    v = kmeans.integer_vectors(vectors(spark, rows), 6)
    done = kmeans.cluster(v, kmeans.first_centroids(v, 6), 5)
    assert done.asked[0] == 1200 and len(done.asked) == 6 and sum(done.asked[2:]) < 1200
    assert sum(done.n) == 1200


def test_a_cluster_with_a_third_of_all_rows(spark):
    rng = random.Random(2)
    rows = [(i, [0.25, 0.5, 0.75]) for i in range(200)] + [(200 + i, [rng.random() * 4 for _ in range(3)]) for i in range(400)]
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in rows]
    assert result(kmeans.clustered(vectors(spark, rows), k=7, dims=3, rounds=3)) == brute(rows, 7, 3, 3)
