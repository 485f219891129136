"""Drift against pandas and numpy on small samples."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mensula.operators import drift as D


def frame(spark, expected, actual):
    rows = [("e", v) for v in expected] + [("a", v) for v in actual]
    return spark.createDataFrame(rows, "s string, v double")


def edges_of(values, q):
    bins = pd.qcut(pd.Series(values, dtype=float), q=q, duplicates="drop").cat.categories
    return sorted({b.left for b in bins} | {b.right for b in bins})


def numpy_psi(expected, actual, edges):
    e, a = (np.histogram(x, bins=edges)[0] / len(x) for x in (expected, actual))
    return float(((a - e) * np.log(a / e)).sum())


RNG = np.random.default_rng(4)
SAMPLES = {
    "spread": RNG.normal(5, 2, 700), "counts": RNG.poisson(1.2, 700).astype(float),
    "tiny": RNG.random(500) / 900, "negative": -RNG.random(500) * 40, "close": 1000 + RNG.random(400) / 50,
}


@pytest.mark.parametrize("name", sorted(SAMPLES))
def test_label_edges_equal_interval_labels(spark, name):
    values = [float(v) for v in SAMPLES[name]]
    df = D.long_form(frame(spark, values, []), ["v"], ["s"])
    got = D.quantile_edges(df, 10, labelled=True, rows_per_bucket=50).first()["edges"]
    assert np.allclose(got, edges_of(values, 10), rtol=0, atol=1e-9)


def test_labelled_psi(spark):
    expected, actual = SAMPLES["spread"], SAMPLES["spread"] * 1.1 + 0.2
    df = frame(spark, [float(v) for v in expected], [float(v) for v in actual])
    got = D.psi(df, "s", "e", "a", ["v"], labelled=True, rows_per_bucket=60).first()["psi"]
    assert got == pytest.approx(numpy_psi(expected, actual, edges_of(expected, 10)), abs=1e-9)


def test_psi_of_equal_samples_is_zero(spark):
    values = [float(v) for v in SAMPLES["spread"]] + [None] * 20
    assert D.psi(frame(spark, values, values), "s", "e", "a", ["v"]).first()["psi"] == 0.0


def test_null_term_needs_nulls_on_both_sides(spark):
    values = [1.0, 2.0, 3.0, 4.0] * 10
    one = D.psi(frame(spark, [*values, None], values), "s", "e", "a", ["v"], buckets=2).first()["psi"]
    both = D.psi(frame(spark, [*values, None], [*values, None, None]), "s", "e", "a", ["v"], buckets=2).first()["psi"]
    e, a = 1 / 41, 2 / 42
    assert one == 0.0 and both == pytest.approx((a - e) * math.log(a / e))


def test_empty_bins(spark):
    expected, actual = [float(v) for v in range(100)], [float(v) for v in range(50)]
    df = frame(spark, expected, actual)
    assert D.psi(df, "s", "e", "a", ["v"]).first()["psi"] == math.inf
    assert 0 < D.psi(df, "s", "e", "a", ["v"], empty="epsilon").first()["psi"] < math.inf
    with pytest.raises(ValueError):
        D.psi(df, "s", "e", "a", ["v"], empty="skip")


def test_bins_close_only_the_last_edge(spark):
    df = frame(spark, [0.0, 1.0, 2.0], [-1.0, 0.0, 0.5, 1.0, 2.0, 3.0, None])
    rows = D.bin_counts(df, "s", "e", "a", ["v"], buckets=2, labelled=False).orderBy("bin").collect()
    assert [(r["left_edge"], r["right_edge"], r["n_expected"], r["n_actual"]) for r in rows] == [
        (0.0, 1.0, 1, 2), (1.0, 2.0, 2, 2)]


def test_constant_column_has_no_bins(spark):
    df = frame(spark, [3.0] * 5, [3.0] * 4)
    assert D.psi(df, "s", "e", "a", ["v"]).first()["psi"] == 0.0


def test_nan_counts_as_null(spark):
    df = frame(spark, [1.0, float("nan")], [1.0, 0.0, 0.0, 2.0])
    assert D.null_shares(df, "s", "e", "a").first()["expected_pct"] == 50.0
    zero = D.zero_shares(df.withColumn("t", F.lit("0")), "s", "e", "a").collect()
    assert [(r["feature"], r["actual_pct"]) for r in zero] == [("v", 50.0), ("t", 0.0)]


def test_histogram_of_many_edges(spark):
    values = spark.range(1000).select(F.lit("v").alias("feature"), F.col("id").cast("double").alias("value"))
    edges = spark.createDataFrame([("v", [float(x) for x in range(0, 1001, 20)])], "feature string, edges array<double>")
    rows = D.histogram(values, edges).collect()
    assert sorted((r["bin"], r["n"]) for r in rows) == [(i, 20) for i in range(50)]
    assert D.histogram(values, edges.limit(0)).count() == 0
