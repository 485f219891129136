"""Reports looked up in a stored rank index equal those from the table, with few jobs and from few folders."""

import re

import pytest
from pyspark.sql import functions as F

from mensula import sizing
from mensula.operators import gain, rank_index, scores
from mensula.operators.ranks import Ranking

RANKING = Ranking("p", ("e",), ("g",), rows_per_bucket=120)


@pytest.fixture(scope="module")
def table(spark):
    third = F.when(F.col("id") % 3 == 0, 0.5).when(F.col("id") % 41 == 1, None).otherwise((F.col("id") * 7919 % 1009) / 1009)
    return spark.range(6_000).select(
        F.when(F.col("id") % 4 == 3, None).otherwise(F.col("id") % 4).alias("g"), F.col("id").alias("e"), third.alias("p"),
        (F.col("id") * 31 % 7 == 0).cast("int").alias("y")).unionByName(spark.createDataFrame([(9, 1, None, 1), (9, 2, None, 0)], "g long, e long, p double, y int"))


@pytest.fixture(scope="module")
def index(table, tmp_path_factory):
    return rank_index.build(table, RANKING, str(tmp_path_factory.mktemp("index") / "i"), ["y"])


def rows(frame):
    return sorted(map(repr, (tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in frame.collect())))


def test_every_report_equals_that_of_the_table(spark, table, index, tmp_path, monkeypatch):
    loaded = rank_index.build(table, RANKING, str(tmp_path / "i"), ["y"])
    monkeypatch.setattr(rank_index, "LISTED", 1)
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    for i in (index, rank_index.load(spark, RANKING, str(tmp_path / "i"), ["y"]), loaded):
        sizes = [1, 2, 100, 700, 1_500, 9_999]
        assert rows(gain.top_n_sweep(i, RANKING, "y", sizes)) == rows(gain.top_n_sweep(table, RANKING, "y", sizes))
        assert rows(scores.top_scores(i, RANKING, "y", sizes)) == rows(scores.top_scores(table, RANKING, "y", sizes))
        columns = scores.distribution(table, "p", "g").columns
        assert rows(scores.distribution(i, "p", "g").select(columns)) == rows(scores.distribution(table, "p", "g"))
        report = dict(cuts=[0.2, 0.5], sizes=[50, 900], fixed_size=300, gain=10, cost=1)
        wanted = gain.month_report(table, RANKING, "y", **report)
        assert rows(gain.month_report(i, RANKING, "y", **report).select(wanted.columns)) == rows(wanted)


def test_buckets_follow_the_order(index):
    buckets = index.buckets.orderBy("g", "_bucket").collect()
    assert len(buckets) > 40 and max(b["n"] for b in buckets) < 500
    for a, b in zip(buckets, buckets[1:]):
        if a["g"] == b["g"]:
            assert a["last_key"] < b["first_key"] and b["first_rank"] == a["first_rank"] + a["n"] and b["before_y"] == a["before_y"] + a["sum_y"]


def test_a_lookup_reads_few_folders_in_few_jobs(spark, index):
    sc = spark.sparkContext
    for name, report in (("sizes", lambda: gain.top_n_sweep(index, RANKING, "y", [10, 200])), ("tops", lambda: scores.top_scores(index, RANKING, "y", [10])),
                         ("spread", lambda: scores.distribution(index, "p", "g"))):
        sc.setJobGroup(name, name)
        frame = report()
        frame.collect()
        assert len(sc.statusTracker().getJobIdsForGroup(name)) <= 6, name
    sc.setJobGroup("rest", "rest")
    text = gain.top_n_sweep(index, RANKING, "y", [10])._jdf.queryExecution().executedPlan().toString()
    listed = re.search(r"PartitionFilters: \[([^\]]*)\]", text)[1]
    assert "_bucket_id" in listed and 0 < len(re.findall(r"-?\d{5,}", listed)) <= 5


def test_an_empty_table_and_no_group(spark, table, tmp_path):
    empty = rank_index.build(table.where("false"), RANKING, str(tmp_path / "e"), ["y"])
    assert gain.top_n_sweep(empty, RANKING, "y", [1]).count() == 0
    whole = Ranking("p", ("e",), rows_per_bucket=500)
    one = rank_index.build(table, whole, str(tmp_path / "o"), ["y"])
    assert rows(gain.top_n_sweep(one, whole, "y", [3, 5_000])) == rows(gain.top_n_sweep(table, whole, "y", [3, 5_000]))
