"""Training sets: counts, repeatability, temporal order."""

import pytest
from pyspark.sql import functions as F

from mensula import Panel
from mensula.operators import samples as K

P = Panel("e", "t")


@pytest.fixture(scope="module")
def panel(spark):
    return spark.range(4000).select(
        F.col("id").alias("e"), (F.col("id") % 4 + 202101).cast("int").alias("t"),
        (F.col("id") % 10 == 0).cast("int").alias("target_binario")).cache()


def test_undersample_keeps_all_positives_and_repeats(panel):
    s = K.Sampling(0.2, periods=(202101, 202102, 202103, 202104))
    first = K.training_rows(panel, P, s, seed=5)
    again = K.training_rows(panel.repartition(7), P, s, seed=5)
    assert first.where("target_binario = 1").count() == 400
    assert 500 < first.where("target_binario = 0").count() < 940
    assert first.exceptAll(again).isEmpty() and again.exceptAll(first).isEmpty()
    assert not first.exceptAll(K.training_rows(panel, P, s, seed=6)).isEmpty()


def test_strategy_needs_its_lists(panel):
    with pytest.raises(ValueError, match="periods"):
        K.training_rows(panel, P, K.Sampling(0.5, positive_periods=(202101,)), seed=1)


def test_exact_undersample_counts(panel):
    s = K.Sampling(0.3, periods=("202101", 202103))
    out = K.exact_undersample(panel, P, s, rows_per_bucket=100)
    positives = panel.where("t in (202101, 202103) and target_binario = 1").count()
    assert out.where("target_binario = 1").count() == positives
    assert out.where("target_binario = 0").count() == int(positives / 0.3)
    assert out.dropDuplicates(["e"]).count() == out.count()
    with pytest.raises(ValueError, match="negatives"):
        K.exact_undersample(panel, P, K.Sampling(0.001, periods=(202101, 202103)))


def test_folds_cover_rows_and_are_even(panel):
    sizes = [r["count"] for r in K.with_fold(panel, P, 5, 1).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and sum(sizes) == 4000 and min(sizes) > 650


def test_empty_period_list_selects_nothing(panel):
    train, validation = K.period_split(panel, P, [], [202104])
    assert train.isEmpty() and validation.count() == 1000


def test_feature_columns(panel):
    df = panel.withColumn("x", F.lit(1))
    assert K.feature_columns(df, P) == ["x"]
    assert K.feature_columns(df, P, keep_entity=True) == ["e", "x"]


@pytest.mark.parametrize("limit", [7, 1_000_000])
def test_even_folds_differ_by_one_row_at_most(spark, limit):
    df = spark.range(103).select((F.col("id") % 9).alias("e"), F.floor(F.col("id") / 9).alias("t"), F.lit(1).alias("rank"))
    out = K.with_fold(df, P, 5, 3, even=True, rows_per_bucket=limit)
    sizes = sorted(r["count"] for r in out.groupBy("fold").count().collect())
    assert sizes == [20, 20, 21, 21, 21] and out.columns == ["e", "t", "rank", "fold"]
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, K.with_fold(df.repartition(3), P, 5, 3, even=True).collect()))
    with pytest.raises(ValueError):
        K.with_fold(df, P, 5, 3, by_entity=True, even=True)


def plan_of(spark, n, folds, **sizes):
    """[(train places, validation places)] of an axis of `n` periods."""
    axis = spark.range(n).select(F.lit(1).alias("c"), F.col("id").cast("int").alias("m"))
    out = {}
    for r in K.temporal_folds(axis, Panel("c", "m"), folds, **sizes).orderBy("fold", "m").collect():
        out.setdefault(r["fold"], {"train": [], "validation": []})[r["role"]].append(r["m"])
    assert sorted(out) == list(range(1, len(out) + 1))
    return [(out[f]["train"], out[f]["validation"]) for f in sorted(out)]


def test_temporal_folds_by_hand(spark):
    three = {"min_train_size": 2, "val_size": 1, "gap": 1}
    assert plan_of(spark, 8, 3, **three) == [([0, 1], [3]), ([0, 1, 2, 3], [5]), ([0, 1, 2, 3, 4, 5], [7])]
    assert plan_of(spark, 8, 3, strategy="rolling", **three)[1] == ([2, 3], [5])
    assert plan_of(spark, 8, 1, min_train_size=3) == [([0, 1, 2], [3])]
    assert plan_of(spark, 3, 5) == [([0, 1], [2])]
    assert plan_of(spark, 2, 2) == []
    with pytest.raises(ValueError):
        plan_of(spark, 8, 2, strategy="sideways")


@pytest.mark.parametrize("n,folds,strategy,train,validation,gap", [
    (30, 8, "expanding", 5, 3, 3), (30, 8, "rolling", 5, 3, 3), (7, 3, "expanding", 1, 1, 0), (12, 4, "rolling", 2, 2, 1), (9, 9, "rolling", 1, 1, 2)])
def test_training_precedes_validation(spark, n, folds, strategy, train, validation, gap):
    splits = plan_of(spark, n, folds, strategy=strategy, min_train_size=train, val_size=validation, gap=gap)
    assert 0 < len(splits) <= folds
    for before, after in splits:
        assert max(before) + gap + 1 == min(after) and len(after) == validation and len(before) >= train
