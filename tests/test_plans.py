"""Shape of the physical plans: shuffles, windows, pruning, pushed filters."""

import re

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from mensula.operators import gain, ranks, targets, windows
from mensula.operators.combine import append_period
from mensula.operators.ranks import Ranking, keys_at_ranks, top_rows, with_rank
from mensula.operators.samples import class_period_rows
from mensula.operators.scores import distribution
from mensula.panel import attach, with_columns
from mensula.plans.recipes import BANK_PANEL, BANK_RECIPE, build_features, history_features
from mensula.sources.writers import save_by_entity

P = fx.PANEL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hash_shuffles(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


@pytest.fixture(scope="module")
def panel(spark, tmp_path_factory):
    """The user-day panel as a plain table, so plans show only the operators' own shuffles."""
    path = str(tmp_path_factory.mktemp("panel"))
    fx.user_days(spark, "/root/testdata/sf0.001").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scores"))
    fx.scores(spark, "/root/testdata/sf0.001").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_history_and_targets_share_one_shuffle_and_sort(panel):
    df = targets.churn_targets(panel, P)
    df = windows.expand(df, P, ["n_all", "mview", "cview"])
    df = with_columns(df, windows.counted(P, {"k": "mview_lag_1 > 0"}), windows.time_since(P, {"s": "cview > 0"}),
                      windows.against_max(P, ["mview"]), windows.volatility(P, ["n_all"]))
    text = plan(df)
    shuffles = hash_shuffles(text)
    assert len(shuffles) == 1 and shuffles[0].startswith("c#")
    assert len(re.findall(r"Sort \[", text)) == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_recipe_history_has_one_shuffle(spark):
    df = fx.bank_months(spark, "/root/testdata/sf0.001", BANK_RECIPE)
    small = targets.churn_targets(df.select(*BANK_PANEL.keys, "mrentabilidad", "cproductos", "mcuentas_saldo"), BANK_PANEL)
    recipe = type(BANK_RECIPE)(trends=("mrentabilidad",), momenta=("cproductos",), behaviour={
        "f": ("falling", "mcuentas_saldo")}, streaks={"s": "f = 1"}, times_since={"t": "f = 1"})
    text = plan(history_features(small, BANK_PANEL, recipe, BANK_PANEL.keys))
    own = [s for s in hash_shuffles(text) if s.startswith("numero_de_cliente#")]
    assert len(own) == 1


@pytest.mark.parametrize("build", [
    lambda df: gain.best_gain(df, Ranking("proba", ("entity", "study", "seed"), rows_per_bucket=500), "y"),
    lambda df: with_rank(df, Ranking("proba", ("entity",), ("study", "seed"), rows_per_bucket=500)),
    lambda df: top_rows(df, Ranking("proba", ("entity", "study", "seed"), rows_per_bucket=500), 700),
    lambda df: keys_at_ranks(df, Ranking("proba", ("entity",), ("study",), rows_per_bucket=500), F.array(F.lit(5))),
    lambda df: distribution(df, "proba", rows_per_bucket=500),
], ids=["best_gain", "with_rank", "top_rows", "keys_at_ranks", "distribution"])
def test_ranked_rows_are_never_in_one_window(scored, build):
    text = plan(build(scored))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    for match in re.finditer(r"Window \[row_number\(\) windowspecdefinition\(([^,]*),", text):
        assert "_bucket" in match.group(0) or "study" in match.group(1)
    # Keys at ranks are found before the plan is made, from few rows (next test), and stand in it as values.
    assert "_bucket" in text or "subquery" in text.lower() or "LocalTableScan" in text


def test_windows_over_brackets_see_few_rows(scored, monkeypatch):
    seen, original = [], ranks._found_in_brackets
    monkeypatch.setattr(ranks, "_found_in_brackets", lambda counted, *a: seen.append(counted.count()) or original(counted, *a))
    total = scored.count()
    for ranking in (Ranking("proba", ("entity", "study", "seed")), Ranking("proba", ("entity",), ("study",))):
        keys_at_ranks(scored, ranking, F.array(F.lit(5), F.lit(700)))
    assert len(seen) == 2 and max(seen) < total / 20, (seen, total)


def test_sweep_does_not_shuffle_rows(scored):
    text = plan(gain.threshold_sweep(scored, "proba", "y"))
    shuffles = re.findall(r"Exchange [^\n]*\n[^\n]*", text)
    assert all("HashAggregate" in s for s in shuffles)


def test_period_filter_reaches_the_scan(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 4 + 1).cast("int").alias("m"), (F.col("id") % 2).alias("y"), F.lit(1).alias("c"))
    df.write.partitionBy("m").parquet(str(tmp_path / "p"))
    text = plan(class_period_rows(spark.read.parquet(str(tmp_path / "p")), P, "y", [1, 2], [3]).select("id"))
    assert "PartitionFilters: [m#" in text or "PartitionFilters: [((m#" in text or "m#" in re.search(r"PartitionFilters: \[([^\]]*)\]", text).group(1)
    assert "ReadSchema: struct<id:bigint,y:bigint>" in text


def test_columns_are_pruned(panel):
    df = with_columns(panel, windows.lags(P, ["n_all"])).select("c", "m", "n_all_lag_1")
    assert re.search(r"ReadSchema: struct<c:bigint,m:int,n_all:bigint>", plan(df))


def test_append_leaves_old_periods_unshuffled(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("m"))
    df.write.partitionBy("m").parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    out = append_period(base, df.where("m = 3"), "m", base_is_distinct=True)
    assert out.count() == 100
    text = plan(out)
    # Old periods once; the new file's period for rows that stand alone and for those compared whole, which alone are shuffled.
    assert text.count("FileScan") == 3 and len(hash_shuffles(text)) == 1 and text.count("Filter isnull(_new") == 1


def test_tables_stored_by_entity_need_no_shuffle(spark, tmp_path):
    """The recipe, its labels and an attached table from bucketed storage: no exchange by entity."""
    df = fx.bank_months(spark, "/root/testdata/sf0.001", BANK_RECIPE)
    stored = save_by_entity(df, BANK_PANEL, "bank_by_entity", 3, str(tmp_path / "bank"))
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(build_features(stored, BANK_PANEL, BANK_RECIPE))
        assert "Exchange hashpartitioning(numero_de_cliente" not in text and "Bucketed: true" in text
        more = save_by_entity(df.select(*BANK_PANEL.keys, df.mrentabilidad.alias("again")), BANK_PANEL, "more_by_entity", 3, str(tmp_path / "more"))
        joined = attach(stored, more, BANK_PANEL.keys)
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert joined.count() == df.count()
    finally:
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bank_by_entity", "more_by_entity"):
            spark.sql(f"drop table if exists {name}")
