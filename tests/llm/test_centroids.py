"""Integer k-means against a plain loop."""

import hashlib
import random

import pytest

from terrace.llm import centroids

DIM = 5


def brute(rows, k, rounds):
    kept = [(i, [int(1024 * x // 1) for x in v]) for i, v in rows
            if v is not None and len(v) == DIM and all(x is not None and abs(x) < float("inf") for x in v)]
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)
    cs = [list(q) for _, q in order[:k]]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(cs))

    for _ in range(rounds):
        groups = {}
        for _, q in kept:
            groups.setdefault(near(q)[1], []).append(q)
        for n, g in groups.items():
            cs[n] = [sum(col) // len(g) for col in zip(*g)]
    out = [(i, near(q)) for i, q in kept]
    per = {}
    for _, (d, n) in out:
        per[n] = per.get(n, 0) + d
    return [(i, n, d, per[n], sum(per.values()), hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest())
            for i, (d, n) in out]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                                 "vec_id long, embedding array<double>, q string, cluster int").repartition(3)


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


@pytest.mark.parametrize("seed", [1, 2])
def test_against_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(DIM)]) for i in range(60)]
    rows += [(100, [0.25] * DIM)] * 30  # a third of the rows are one vector
    rows += [(None, [0.5] * DIM), (7, [rng.gauss(0, 1) for _ in range(DIM)])]
    rows += [(200, None), (201, [0.1] * 4), (202, [0.1, None, 0.1, 0.1, 0.1]), (203, [float("nan")] * DIM),
             (204, [float("inf")] * DIM), (205, [])]
    got, cs = centroids.cluster(frame(spark, rows), k=4, rounds=3, dim=DIM)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows, 4, 3), key=key)
    assert len(cs) == 4 and got.columns == ["vec_id", *centroids.OUT]


def test_fewer_rows_than_centroids_and_ties(spark):
    rows = [(1, [0.0] * DIM), (2, [0.0] * DIM), (3, [1.0] * DIM)]  # two equal seeds: the second stays empty
    got, cs = centroids.cluster(frame(spark, rows), k=8, rounds=2, dim=DIM)
    assert len(cs) == 3 and sorted(map(tuple, got.collect())) == sorted(brute(rows, 8, 2))


def test_empty(spark):
    got, cs = centroids.cluster(frame(spark, []), dim=DIM)
    assert got.count() == 0 and cs == [] and got.columns == ["vec_id", *centroids.OUT]
    assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]


def test_native_and_no_shuffle_of_vectors(spark):
    q = centroids.quantize(frame(spark, [(1, [0.0] * DIM)]), dim=DIM)
    plan = centroids.assign(q, [[0] * DIM, [5] * DIM])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "hashpartitioning" not in plan
    assert "array_min" in plan and "zip_with" in plan
