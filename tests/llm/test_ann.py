import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mensula.llm import ann
from mensula.llm.common import table


def brute(rows, queries, k=10):
    """{query: [(score, id)]} over (id, vector) rows; a repeated id counts once."""
    out = {}
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    for q in queries:
        best = {}
        for own in x[ids == q]:
            for i, d in zip(ids.tolist(), np.sqrt(((x - own) ** 2).sum(1)).tolist()):
                if i != q:
                    best[i] = min(d, best.get(i, math.inf))
        out[q] = sorted((d, i) for i, d in best.items())[:k]
    return out


def lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("config", [ann.Config(), ann.Config(part_rows=100, sample=2_000, block=50)])
def test_recall_over_all_rows(spark, config):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, want = lists(ann.search(df, F.col("vec_id") % 100 == 0, config)), brute(rows, [i for i, _ in rows if i % 100 == 0])
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = [i in {j for _, j in got[q]} for q in want for _, i in want[q]]
    assert np.mean(hits) >= 0.9
    vectors = dict(rows)
    for q, found in got.items():
        for score, i in found:
            assert score == pytest.approx(math.dist(vectors[q], vectors[i]), rel=1e-12)


def clustered(rows=6_000, clusters=60, dim=24, seed=7):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(clusters, dim))[rng.integers(0, clusters, rows)] * 5 + rng.normal(size=(rows, dim))


def recall(spark, x, config):
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got, want = lists(ann.search(df, F.col("vec_id") % 100 == 0, config)), brute(rows, range(0, len(rows), 100))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    return np.mean([i in {j for _, j in got[q]} for q in want for _, i in want[q]])


def test_clustered_vectors_need_a_quarter_of_the_parts_at_most(spark):
    x, config = clustered(), ann.Config(part_rows=150)
    router = ann.learn(x, len(x), config)
    assert router.parts >= 32 and router.probes <= router.parts / 4
    assert recall(spark, x, config) >= 0.9


def test_two_levels_of_routers(spark):
    x = clustered(8_000, 80)
    config = ann.Config(part_rows=120, most_parts=8, split_rows=500, sample=3_000, block=64)
    order = np.random.default_rng(1).permutation(len(x))[:3_000]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "id long, v array<double>")
    levels = ann._levels(df, x[order], len(x), 24, config)
    home = levels.home(x)
    assert len(levels.below) >= 6 and len(np.unique(home)) >= 40 and np.bincount(home).max() < 500
    visits = levels.visits(x[:200])
    assert np.mean([len(v) for v in visits]) <= len(np.unique(home)) / 4 and all(len(set(v)) == len(v) for v in visits)
    assert recall(spark, x, config) >= 0.9


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (100, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [0.0, 2.0]), (3, [5.0, 5.0]),
        (200, [0.0, 0.0]), (300, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (8, []),
        *((1_000 + i, [7.0, 7.0]) for i in range(1, 40)), (500, [7.0, 7.0]),
    ]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, part int, query int")
    fine = [(i, v) for i, v in rows if i is not None and v and len(v) == 2 and None not in v and all(map(math.isfinite, v)) and any(v)]
    for block in (8, 4_096):
        got = lists(ann.search(df, F.col("vec_id") % 100 == 0, ann.Config(block=block)))
        assert got == brute(fine, [0, 100, 500])
    assert [i for _, i in got[500]] == list(range(1_001, 1_011))
    assert ann.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert ann.search(df, F.lit(None).cast("boolean")).count() == 0
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert lists(ann.search(few, F.col("vec_id") % 100 == 0)) == {0: [(1.0, 1)]}


def test_parts_are_balanced_and_keep_neighbours():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(8, 16))[rng.integers(0, 8, 1_600)] * 4 + rng.normal(size=(1_600, 16))
    graph = ann.nearest(x, x, 10, skip_self=True)
    part = ann.balanced_parts(x, graph, 16, seed=1)
    size = np.bincount(part, minlength=16)
    assert size.max() <= math.ceil(100 * 1.1) and size.min() >= 89
    assert (part[graph] == part[:, None]).mean() > 0.5
