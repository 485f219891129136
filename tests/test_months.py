"""Months added to a stored table, and features of a new month from state alone."""

import os
import re

import pytest
from pyspark.sql import functions as F

from mensula import Panel, sizing
from mensula.operators import combine, history, targets
from mensula.operators.history import History
from mensula.sources import months

P = Panel("c", "m")
H = History(columns=("x", "n"), trends=("x",), momenta=("x", "z"), peaks=("n",), counted={"busy": "n > 3"}, events={"quiet": "n <= 1", "never": "n < 0"})


@pytest.fixture(scope="module")
def table(spark):
    """Entities with gaps, late starters and leavers over ten months; measures with NULLs."""
    cell = spark.range(60).select(F.col("id").alias("c"), F.explode(F.sequence(F.lit(202001), F.lit(202010))).alias("m"))
    there = (F.pmod(F.xxhash64("c", "m"), F.lit(10)) < 7) & (F.col("m") - 202000 >= F.col("c") % 7) & ((F.col("c") % 5 != 2) | (F.col("m") < 202007))
    value = lambda k: F.pmod(F.xxhash64("c", "m", F.lit(k)), F.lit(11))
    return cell.where(there).select(
        "c", F.col("m").cast("int").alias("m"), F.when(value(1) > 1, value(2) / 4.0).alias("x"), value(3).cast("int").alias("n"),
        F.when(value(4) > 6, value(5)).alias("z"))


def rows(df, *columns):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*columns).fillna(-99).collect())


@pytest.mark.parametrize("cut", [202001, 202006])
def test_months_from_state_equal_the_full_build(table, cut):
    whole, labelled = history.by_windows(table, P, H), targets.churn_targets(table, P)
    state = sizing.settle(history.state_of(table.where(F.col("m") <= cut), P, H))
    last = 202010 if cut == 202006 else 202004
    for month in range(cut + 1, last + 1):
        features, labels, state = history.advance(state, table.where(F.col("m") == month), P, H)
        state = sizing.settle(state)
        assert set(features.columns) == set(whole.columns)
        assert rows(features, *whole.columns) == rows(whole.where(F.col("m") == month), *whole.columns)
        known = targets.churn_targets(table.where(F.col("m") <= month), P).where(F.col("m") >= month - 2)
        names = ("c", "m", "target_binario", "target_ternario")
        assert rows(labels, *names) == rows(known, *names)
        assert {(r["m"], r["settled"]) for r in labels.select("m", "settled").distinct().collect()} <= {(month, 0), (month - 1, 0), (month - 2, 1)}
    again = history.state_of(table.where(F.col("m") <= last), P, H)
    names = [c for c in again.columns if c != "pending"]
    assert sorted(map(repr, state.select(*names).collect())) == sorted(map(repr, again.select(*names).collect()))
    waiting = lambda s: sorted((r["c"], sorted(map(tuple, r["pending"]), key=repr)) for r in s.select("c", "pending").collect())
    assert waiting(state) == waiting(again)
    assert rows(labels.where("settled = 1"), "c", "target_binario") == rows(labelled.where(F.col("m") == last - 2), "c", "target_binario") or last < 202010


def test_wrong_months_raise(table):
    state = sizing.settle(history.state_of(table.where("m <= 202003"), P, H))
    for wrong, message in ((table.where("m = 202003"), "not later"), (table.where("m = 202004").unionByName(table.where("m = 202004")), "not unique"),
                           (table.where("m = 202004").withColumn("c", F.lit(None).cast("long")), "NULL in key")):
        with pytest.raises(Exception, match=message):
            history.advance(state, wrong, P, H)[0].collect()
    with pytest.raises(Exception, match="not unique"):
        history.state_of(table.unionByName(table), P, H).collect()


def test_a_new_month_reads_itself_and_the_state_only(spark, table, tmp_path):
    history.state_of(table.where("m <= 202009"), P, H).write.parquet(f"{tmp_path}/state")
    table.where("m = 202010").write.parquet(f"{tmp_path}/month")
    features, labels, state = history.advance(spark.read.parquet(f"{tmp_path}/state"), spark.read.parquet(f"{tmp_path}/month"), P, H)
    for df in (features, labels, state):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert set(re.findall(r"FileScan parquet .*?\[file:[^\]]*/(\w+)\]", text)) == {"state", "month"}
        assert len(re.findall(r"Exchange hashpartitioning\(", text)) <= 2


WIDE = "k long, m int, a string, b double"


def test_append_is_idempotent_and_leaves_other_months_alone(spark, tmp_path):
    path, log = f"{tmp_path}/t", f"{tmp_path}/log"
    first = spark.createDataFrame([(i, 202001 + i % 3, f"a{i}", i / 2) for i in range(30)] + [(99, None, "no month", None)], WIDE)
    assert months.append_month(first, path, "m", log)
    times = lambda: {p: [(f, os.stat(f"{path}/{p}/{f}").st_mtime_ns) for f in sorted(os.listdir(f"{path}/{p}"))] for p in os.listdir(path) if p.startswith("m=")}
    stored = lambda: sorted(map(repr, months.read_months(spark, path, first).collect()))
    before = times()
    new = spark.createDataFrame([(1, 202002, "a1", 0.5), (1, 202002, "revised", 0.5), (50, 202004, "new", 1.0), (50, 202004, "new", 1.0)], WIDE)
    assert months.append_month(new, path, "m", log)
    after, rows_ = times(), stored()
    assert len(rows_) == 31 + 2 and set(after) - set(before) == {"m=202004"}
    assert all(after[p] == before[p] for p in before if p != "m=202002") and after["m=202002"] != before["m=202002"]
    assert not months.append_month(new.repartition(3), path, "m", log) and times() == after  # the same rows in another order
    # A run that ended before its record: the same rows once more.
    assert months.append_month(new, path, "m", f"{tmp_path}/other-log") and stored() == rows_
    assert [r["n_rows"] for r in spark.read.json(log).orderBy("at").collect()] == [31, 4]


def test_a_failed_append_leaves_the_old_month(spark, tmp_path):
    path, log = f"{tmp_path}/t", f"{tmp_path}/log"
    first = spark.createDataFrame([(i, 202001, f"a{i}", 0.0) for i in range(10)], WIDE)
    months.append_month(first, path, "m", log)
    broken = spark.range(20).select(
        "id", F.lit(202001).alias("m"), F.lit("x").alias("a"),
        F.when(F.col("id") < 15, 1.0).otherwise(F.raise_error(F.lit("lost")).cast("double")).alias("b")).toDF("k", "m", "a", "b")
    with pytest.raises(Exception, match="lost"):
        months.append_month(broken, path, "m", log)
    assert sorted(map(repr, months.read_months(spark, path, first).collect())) == sorted(map(repr, first.collect()))
    assert spark.read.json(log).count() == 1
    with pytest.raises(ValueError, match="differ"):
        months.append_month(first.withColumn("b", F.col("b").cast("float")).withColumnRenamed("a", "c"), path, "m", log)


@pytest.mark.parametrize("clash", [False, True])
def test_distinct_append_by_digest(spark, clash, monkeypatch):
    if clash:  # two digests for all rows of the table
        monkeypatch.setattr(combine, "digest", lambda row, n: F.pmod(F.xxhash64(row), F.lit(2)))
    nan = float("nan")
    base = spark.createDataFrame([(i, 1, f"a{i}", i / 3) for i in range(40)] + [(None, 1, None, nan), (77, 1, "zero", 0.0)], WIDE)
    new = spark.createDataFrame([(i, 1, f"a{i}", i / 3) for i in range(30, 50)] * 2 + [(None, 1, None, nan), (77, 1, "zero", -0.0), (30, 1, "a30", 9.0)], WIDE)
    got = combine.append_distinct(base, new)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, base.unionByName(new).distinct().collect())) and got.count() == 53


def test_rows_that_share_nothing_are_not_exchanged(spark, tmp_path):
    base = spark.range(500).select(F.col("id").alias("k"), *[F.concat(F.lit(f"{i}-"), F.col("id")).alias(f"w{i}") for i in range(30)])
    base.write.parquet(f"{tmp_path}/a")
    base.withColumn("k", F.col("k") + 1_000).write.parquet(f"{tmp_path}/b")
    out = combine.append_distinct(spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b"))
    out.collect()
    text = out._jdf.queryExecution().executedPlan().toString()
    final = text[text.index("Final Plan"):text.index("Initial Plan")] if "Initial Plan" in text else text
    assert "w29" not in "".join(re.findall(r"Exchange hashpartitioning\([^)]*\)", final)) and "FileScan" in final
    assert out.count() == 1_000
