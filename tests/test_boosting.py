"""Fits that stop on gain, fits at the same time, and prefixes of trees."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from mensula import Panel
from mensula.operators import boosting as B
from mensula.operators import models as M
from mensula.operators.gain import best_gain
from mensula.operators.parallel import at_once
from mensula.operators.ranks import Ranking

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def cube(spark):
    """Three flags; the label needs all of them, so that three stumps rank perfectly and two do not."""
    bit = lambda i: F.when(F.col("id") % 53 != 0, F.floor(F.col("id") / 2**i) % 2)
    rows = spark.range(1_600).select("id", bit(0).alias("a"), bit(1).alias("b"), bit(2).alias("c"))
    return rows.withColumn("y", F.coalesce((F.col("a") + F.col("b") + F.col("c") == 3).cast("int"), F.lit(0)))


def test_fit_ends_when_the_gain_stops_growing(cube):
    train, held = cube.where("id % 3 <> 0"), cube.where("id % 3 = 0")
    params = M.TreeParams(trees=50, learning_rate=0.5, max_depth=1, balanced=False)
    model = B.fit_on_gain(train, held, FEATURES, params, 4, ["id"], "y", "y", patience=4, gain=40, cost=2)
    ones = held.where("y = 1").count()
    assert [h[0] for h in model.history] == list(range(1, 8)) and len(model.steps) == 3
    assert model.history[2] == (3, 40 * ones, ones)
    assert model.history[0][1] < model.history[1][1] < model.history[2][1] == max(h[1] for h in model.history)
    scored = model.score(held, FEATURES, ["id", "y"])
    assert best_gain(scored, Ranking("proba", ("id",)), "y", 40, 2).first()["gain"] == 40 * ones
    assert 0 < scored.agg(F.min("proba")).first()[0] < scored.agg(F.max("proba")).first()[0] < 1


def test_default_patience_follows_the_learning_rate():
    assert B.patience_for(M.TreeParams(learning_rate=0.01)) == 55 and B.patience_for(M.TreeParams(learning_rate=1.0)) == 50


def test_fit_without_validation_rows_or_with_one_class(cube):
    params = M.TreeParams(trees=3, max_depth=1, row_share=0.8, feature_share=0.5)
    model = B.fit_on_gain(cube, cube.where("false"), FEATURES, params, 1, ["id"], "y", "y", patience=1)
    assert len(model.steps) == 1 and model.history == ((1, 0, 0), (2, 0, 0))
    alone = B.fit_on_gain(cube.where("y = 0"), cube, FEATURES, params, 1, ["id"], "y", "y", patience=5, gain=40, cost=2)
    assert len(alone.history) == 3


def test_pieces_run_together_and_in_the_callers_job_group(spark):
    spark.sparkContext.setJobGroup("mine", "mine")
    running, most, lock = [0], [0], threading.Lock()

    def piece(n):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(0.2)
        out = spark.range(n).count()
        with lock:
            running[0] -= 1
        return out, spark.sparkContext.getLocalProperty("spark.jobGroup.id")

    got = at_once(spark, {n: lambda n=n: piece(n) for n in range(1, 8)}, most=3)
    assert got == {n: (n, "mine") for n in range(1, 8)} and most[0] == 3
    assert at_once(spark, {}) == {}


def test_a_failure_cancels_the_rest(spark):
    ended = []

    def slow():
        try:
            spark.range(8).where(F.expr("java_method('java.lang.Thread', 'sleep', 20000L) is null")).collect()
        finally:
            ended.append("slow")

    def fail():
        time.sleep(1)
        raise KeyError("broken")

    start = time.time()
    with pytest.raises(KeyError, match="broken"):
        at_once(spark, {"slow": slow, "fail": fail, "late": lambda: ended.append("late")}, most=2)
    assert time.time() - start < 15 and ended == ["slow"]


def test_finished_seeds_stay_when_a_fit_fails(spark, cube, tmp_path, monkeypatch):
    original, base = M.fit_prepared, str(tmp_path / "models")

    def broken(training, params, seed, *more):
        if seed == 3:
            end = time.time() + 60
            while not M._finished(spark, f"{base}/s/seed=*-finished") and time.time() < end:
                time.sleep(0.5)
            raise RuntimeError("seed 3")
        return original(training, params, seed, *more)

    monkeypatch.setattr(M, "fit_prepared", broken)
    params = M.TreeParams(trees=1, max_depth=1)
    with pytest.raises(RuntimeError, match="seed 3"):
        M.fit_seeds(cube, FEATURES, "y", params, [1, 3], base, "s", most=2)
    done = M._finished(spark, f"{base}/s/seed=*-finished")
    assert set(done) == {1}
    monkeypatch.setattr(M, "fit_prepared", original)
    assert set(M.fit_seeds(cube, FEATURES, "y", params, [1, 3], base, "s")) == {1, 3}
    assert set(M._finished(spark, f"{base}/s/seed=*-finished")) == {1, 3}


def test_best_prefix_is_that_of_all_prefixes(cube):
    keyed = cube.withColumn("z", F.lit(0))
    model = M.fit_seed(keyed, FEATURES, "y", M.TreeParams(trees=9, max_depth=1), 2)
    whole = M.staged_gain(model, keyed, FEATURES, ["id"], "y", 40, 2).orderBy(F.desc("gain"), "trees").first()
    for ladder in (2, 3, 12):
        best = M.best_staged(model, keyed, FEATURES, ["id"], "y", 40, 2, ladder=ladder)
        assert best["gain"] == whole["gain"] or ladder < 12
    assert best["trees"] == whole["trees"]
    some = M.staged_gain(model, keyed, FEATURES, ["id"], "y", 40, 2, prefixes=[2, 7]).collect()
    every = {r["trees"]: tuple(r) for r in M.staged_gain(model, keyed, FEATURES, ["id"], "y", 40, 2).collect()}
    assert {r["trees"]: tuple(r) for r in some} == {n: every[n] for n in (2, 7)}


def test_rows_are_prepared_once_per_fold_and_weighting(spark, monkeypatch):
    df = spark.range(400).select(
        (F.col("id") % 40).alias("c"), F.floor(F.col("id") / 40).cast("int").alias("m"), (F.col("id") % 2).cast("int").alias("fold"),
        (F.col("id") % 10).alias("x"), *[(F.col("id") % 10 > 6).cast("int").alias(t) for t in ("target_binario", "target_ternario")])
    calls, original = [], M.prepare
    monkeypatch.setattr(M, "prepare", lambda *a, **k: calls.append(a[3]) or original(*a, **k))
    options = [M.TreeParams(trees=t, max_depth=1, balanced=b) for t, b in ((1, True), (2, True), (1, False))]
    out = M.search(df, Panel("c", "m"), ["x"], options, 5, gain=10, cost=1)
    assert sorted(calls) == [False, False, True, True] and out.count() == 6
