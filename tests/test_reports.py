"""Grouped reports keep every group: NULL groups, groups without any score, and labels that are NULL."""

import pytest
from pyspark.sql import functions as F

from mensula import sizing
from mensula.operators import gain, profile, scores
from mensula.operators.ranks import Ranking

ROWS = [
    *[(1, i, i / 10, i % 2) for i in range(10)],
    *[(2, i, None, i % 2) for i in range(4)],
    *[(None, i, i / 8, 1 - i % 2) for i in range(6)],
    (3, 0, 0.5, None),
]


@pytest.fixture(params=["broadcast", "shuffled"])
def df(request, spark, monkeypatch):
    if request.param == "shuffled":
        monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    return spark.createDataFrame(ROWS, "period int, e int, p double, y int")


def by_period(frame):
    return {r["period"]: r for r in frame.collect()}


@pytest.mark.parametrize("limit", [3, 1_000_000])
def test_distribution(df, limit):
    got = by_period(scores.distribution(df, "p", rows_per_bucket=limit))
    assert {p: r["n_rows"] for p, r in got.items()} == {1: 10, 2: 4, None: 6, 3: 1}
    assert got[1]["median"] == pytest.approx(0.45) and got[None]["median"] == pytest.approx(2.5 / 8)
    assert got[2]["mean"] is None and got[2]["median"] is None and got[2]["q99"] is None
    assert got[3]["std"] == 0 and got[3]["q01"] == 0.5


def test_class_distribution(df):
    got = by_period(scores.class_distribution(df, "p", "y"))
    assert {p: (r["n_churners"], r["n_no_churners"]) for p, r in got.items()} == {1: (5, 5), 2: (2, 2), None: (3, 3), 3: (0, 0)}
    assert got[None]["median_churners"] == pytest.approx(0.25) and got[2]["mean_churners"] is None
    assert got[3]["churn_rate"] == 0 and got[1]["churn_rate"] == 0.5


@pytest.mark.parametrize("limit", [3, 1_000_000])
def test_month_report(df, limit):
    ranking = Ranking("p", ("e",), ("period",), rows_per_bucket=limit)
    got = by_period(gain.month_report(df, ranking, "y", cuts=[0.2, 0.6], sizes=[2, 4], fixed_size=5, gain=10, cost=1))
    assert {p: (r["n_rows"], r["n_positive"]) for p, r in got.items()} == {1: (10, 5), 2: (4, 2), None: (6, 3), 3: (1, None)}
    assert got[None]["best_size"]["n_contacts"] == 4 and got[None]["fixed_size"]["TP"] == 2
    assert got[2]["best_threshold"]["n_contacts"] == 0 and got[2]["best_size"]["TP"] == 2
    assert got[3]["best_size"] is None and got[3]["churn_rate"] is None


def test_month_report_of_a_whole_table(df):
    got = gain.month_report(df, Ranking("p", ("e", "period")), "y", cuts=[0.2], sizes=[3], fixed_size=3, gain=10, cost=1).collect()
    assert [(r["n_rows"], r["best_size"]["n_contacts"], r["fixed_size"]["n_contacts"]) for r in got] == [(21, 3, 3)]


def test_top_scores(df):
    got = {(r["period"], r["size"]) for r in scores.top_scores(df, Ranking("p", ("e",), ("period",)), "y", [1, 5]).collect()}
    assert got == {(1, 1), (1, 5), (2, 1), (None, 1), (None, 5), (3, 1)}


def test_label_counts(df):
    rows = profile.label_counts(df, "y", ["period"]).collect()
    assert {(r["period"], r["y"]): (r["n_rows"], r["share"]) for r in rows} == {
        (1, 0): (5, 0.5), (1, 1): (5, 0.5), (2, 0): (2, 0.5), (2, 1): (2, 0.5), (None, 0): (3, 0.5), (None, 1): (3, 0.5), (3, None): (1, 1.0)}


def test_model_results_and_ensembles(spark):
    rows = [(e, s, seed, split, (e * 7 % 11) / 11, e % 2) for e in range(11) for s in ("a", None) for seed in (1, None) for split in ("test", None)]
    df = spark.createDataFrame(rows, "entity int, study string, seed int, split string, proba double, y int")
    got = {(r["study"], r["seed"]): (r["n_rows"], r["n_contacts_test"] is not None) for r in gain.model_results(df, ["test"]).collect()}
    assert got == {(s, seed): (22, True) for s in ("a", None) for seed in (1, None)}
    report = gain.ensemble_report(df.where("study = 'a'"), split=["split"]).collect()
    assert {(r["split"], r["strategy"]) for r in report} == {(p, s) for p in ("test", None) for s in ("simple", "two_stage", "study_a")}
    assert all(r["difference"] is not None for r in report)


def test_cardinality_just_below_a_large_bound(spark):
    df = spark.range(200_000).select(
        "id", (F.col("id") % 199_999).alias("below"), F.when(F.col("id") > 0, F.col("id").cast("string")).alias("text"))
    found = {r["variable"]: r["n_distinct"] for r in profile.cardinality(df, 200_000).collect()}
    assert found == {"below": 199_999, "text": 199_999}
    assert profile.low_cardinality_columns(df, 200_001) == ["id", "below", "text"]


def test_entry_without_a_package_still_offers_the_rest(tmp_path):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import sys; sys.modules['ahocorasick'] = None; sys.modules['mensula.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), [q for q in e.queries() if q.startswith('op')])"
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and out.stdout.strip().endswith("[]") and "no training-data queries" in out.stderr
