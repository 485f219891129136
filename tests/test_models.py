"""Fitting and scoring on a small separable table."""

from statistics import fmean

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from mensula import Panel
from mensula.operators import models as M
from mensula.operators.gain import best_gain
from mensula.operators.ranks import Ranking


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(600).select(
        "id", (F.col("id") % 10 > 6).cast("int").alias("y"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 10).alias("x"), F.lit(None).cast("double").alias("empty"))


def test_scores_separate_classes_despite_nulls(spark, table):
    model = M.fit_seed(table, ["x", "empty"], "y", M.TreeParams(trees=3, max_depth=3), seed=1)
    scored = M.score(model, table.withColumn("empty", F.lit(5.0)), ["x", "empty"], ["id", "x", "y"])
    means = {r["y"]: r["m"] for r in scored.where("x is not null").groupBy("y").agg(F.avg("proba").alias("m")).collect()}
    assert scored.count() == 600 and means[1] > 0.7 > 0.3 > means[0]
    top = M.importances(model, spark).orderBy(F.desc("importance")).first()
    assert top["feature"] == "x__filled"


def test_same_seed_same_scores(table):
    params = M.TreeParams(trees=2, max_depth=2, row_share=0.7)
    first, again = (M.score(M.fit_seed(table, ["x"], "y", params, 3), table, ["x"], ["id"]) for _ in range(2))
    assert first.exceptAll(again).isEmpty()


def test_last_fit_uses_mean_tree_count():
    assert M.with_trees(M.TreeParams(trees=50), 12.8).trees == 12
    assert M.with_trees(M.TreeParams(), 0.2).trees == 1


def folded(spark):
    return spark.range(400).select(
        (F.col("id") % 40).alias("c"), F.floor(F.col("id") / 40).cast("int").alias("m"), (F.col("id") % 2).cast("int").alias("fold"),
        (F.col("id") % 10).alias("x"), (F.col("id") % 10 > 6).cast("int").alias("target_binario"), (F.col("id") % 10 > 6).cast("int").alias("target_ternario"))


def test_ledger_is_written_per_trial_and_resumed(spark, tmp_path, monkeypatch):
    df, ledger = folded(spark), str(tmp_path / "ledger")
    options = [M.TreeParams(trees=1, max_depth=1), M.TreeParams(trees=2, max_depth=1)]
    first = M.search(df, Panel("c", "m"), ["x"], options[:1], 5, gain=10, cost=1, ledger=ledger)
    record = spark.read.json(ledger, schema=M.LEDGER).first()
    assert record["value"] == fmean(r["gain"] for r in first.collect()) and record["top_features"][0] == "x__filled"
    assert [f["n_class_1"] for f in record["folds"]] == [40, 80]
    fitted = []
    original = M.fit_prepared
    monkeypatch.setattr(M, "fit_prepared", lambda *a, **k: fitted.append(1) or original(*a, **k))
    both = M.search(df, Panel("c", "m"), ["x"], options, 5, gain=10, cost=1, ledger=ledger).collect()
    assert len(fitted) == 2 and len(both) == 4
    assert M.best_params(spark, ledger) == options[0]  # equal values: the first trial, one tree on average


def test_training_rows_are_thinned_and_validation_is_not(spark):
    seen = []

    def thin(train, number):
        seen.append(number)
        return train.where((F.col("target_binario") == 1) | (F.col("c") % 3 == 0))

    out = M.search(folded(spark), Panel("c", "m"), ["x"], [M.TreeParams(trees=1, max_depth=1)], 5, gain=10, cost=1, thin=thin)
    assert sorted(seen) == [5, 6] and [r["n_rows"] for r in out.orderBy("fold").collect()] == [200, 200]


def test_prefix_of_trees_by_gain(spark, table):
    keyed = table.withColumn("z", F.lit(0))
    model = M.fit_seed(keyed, ["x"], "y", M.TreeParams(trees=4, max_depth=2), 2)
    staged = {r["trees"]: r["gain"] for r in M.staged_gain(model, keyed, ["x"], ["id"], "y", 10, 1).collect()}
    assert sorted(staged) == [1, 2, 3, 4]
    whole = M.score(model, keyed, ["x"], ["id", "y"])
    assert staged[4] == best_gain(whole, Ranking("proba", ("id",)), "y", 10, 1).first()["gain"]


def test_all_models_score_in_one_scan(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    training = M.prepare(stored, ["x"], "y")
    models = {s: M.fit_prepared(training, M.TreeParams(trees=2, max_depth=2, row_share=0.6), s) for s in range(1, 7)}
    scored = M.score_study(models, stored, ["x"], ["id"], "s")
    text = scored._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1
    assert scored.where("seed = 3").select("id", "proba").exceptAll(M.score(models[3], stored, ["x"], ["id"])).isEmpty()


def test_changed_settings_are_fitted_anew(spark, table, tmp_path):
    base = str(tmp_path / "models")
    used = lambda path: M.used_trees(PipelineModel.load(path))
    paths = M.fit_seeds(table, ["x"], "y", M.TreeParams(trees=1, max_depth=1), [1], base, "s")
    assert used(paths[1]) == 1
    paths = M.fit_seeds(table, ["x"], "y", M.TreeParams(trees=2, max_depth=1), [1], base, "s")
    assert used(paths[1]) == 2
