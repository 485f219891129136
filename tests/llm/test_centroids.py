import hashlib
import math

import numpy as np
import pytest

from mensula.llm import centroids
from mensula.llm.centroids import Config

SCHEMA = "vec_id long, embedding array<double>, cluster string, planes int"


def plain(rows, c):
    """(id, cluster, distance, cluster inertia, inertia, digest) of (id, vector) rows, by whole numbers of Python."""
    kept = [(i, [math.floor(c.scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == c.components and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()))[:c.clusters]
    middle = [list(v) for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), i) for i, m in enumerate(middle))

    for _ in range(c.rounds):
        near = [nearest(v)[1] for _, v in kept]
        for i in range(len(middle)):
            own = [v for (_, v), n in zip(kept, near) if n == i]
            if own:
                middle[i] = [sum(x) // len(own) for x in zip(*own)]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = sum(p[2] for p in placed)
    return [(i, n, d, sum(p[2] for p in placed if p[1] == n), total,
             hashlib.sha256(",".join(map(str, middle[n])).encode()).hexdigest()) for i, n, d in placed]


def same(spark, rows, c, **cut):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in centroids.cluster(df, c).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=order) == sorted(plain(rows, c), key=order)
    return got


def test_planes_give_exact_dot_products_and_numbers():
    rng = np.random.default_rng(1)
    for low, high, size in ((-1, 1, 64), (0, 1, 64), (-300, 5, 64), (-(2**26), 2**26, 64), (-9, 9, 5), (-9, 9, 130)):
        a, b = rng.integers(low, high + 1, (7, size)), rng.integers(low // 2 - 1, 2, (4, size))
        p, q = centroids.planes(a), centroids.planes(b)
        assert (centroids.numbers(p, size) == a).all()
        assert (centroids.dots(p, q) == a @ b.T).all()
        assert (centroids.squares(p) == (a * a).sum(1)).all()
        best, far = centroids.assign(p, b)
        whole = ((a[:, None] - b[None]) ** 2).sum(-1)
        assert (best == whole.argmin(1)).all() and (far == whole.min(1)).all()


@pytest.mark.parametrize("components", [64, 3, 70])
def test_against_brute_force(spark, components):
    rng = np.random.default_rng(components)
    rows = [(i, v) for i, v in enumerate(rng.normal(0, 2, (300, components)).tolist())]
    assert len(same(spark, rows, Config(clusters=7, components=components))) == 300


def test_rows_that_take_no_part_ties_repeats_and_null_keys(spark):
    nan, inf = float("nan"), float("inf")
    c = Config(clusters=4, components=3)
    rows = [(1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, None, 2.0]), (5, [1.0, nan, 2.0]), (6, [inf, 0.0, 0.0]),
            (7, [1.0, 2.0, 3.0, 4.0]), (8, [0.0] * 3), (9, [0.0] * 3), (10, [1.0] * 3), (10, [1.0] * 3), (None, [-5.0] * 3),
            (12, [1e5, -1e5, 0.01]), (13, [-0.001, 0.001, 0.5])]
    assert len(same(spark, rows, c)) == 7
    assert len(same(spark, [(1, [0.5, 0.25, 0.0]), (2, [4.0] * 3)], c)) == 2
    assert same(spark, rows[:7], c) == [] and same(spark, [], c) == []
    one = [(i, [0.5, -0.5, 0.25]) for i in range(50)]  # copies of one vector: all but the first centroid stay empty
    assert {r[1] for r in same(spark, one, c)} == {0}


def test_a_component_too_large_for_the_result_raises(spark):
    df = spark.createDataFrame([(1, [1e12, 0.0, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="would not fit"):
        centroids.cluster(df, Config(components=3)).collect()


def test_plan_moves_no_vectors(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert "Exchange" not in centroids.packed(df)._jdf.queryExecution().toString()
