"""Reports over tuning trials, fitted models and feature importances."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensula.sources.writers import append_records

TESTS = (
    "study string, model string, n_rows long, gain long, n_contacts long, pct_contacted double, trees int, params string, "
    "train_periods array<string>, test_periods array<string>, ratio double, at timestamp"
)


def mean_by_study(results: DataFrame, gains: Sequence[str], study: str = "study") -> DataFrame:
    """Fitted models and mean gain per test for each study."""
    return results.groupBy(study).agg(
        F.count("*").alias("n_models"), *[F.avg(g).alias(f"{g}_mean") for g in gains]
    )


def fold_summary(
    folds: DataFrame, by: Sequence[str], gain: str = "gain", iteration: str = "best_iteration"
) -> DataFrame:
    """Mean and population deviation of the folds' gain, and the mean iteration cut to whole."""
    return folds.groupBy(*by).agg(
        F.avg(gain).alias("gain_mean"),
        F.stddev_pop(gain).alias("gain_std"),
        F.floor(F.avg(iteration)).cast("int").alias("best_iteration"),
    )


def completed(trials: DataFrame, value: str = "value") -> DataFrame:
    return trials.where(F.col(value).isNotNull())


def top_trials(trials: DataFrame, n: int = 5, value: str = "value", trial: str = "trial_number") -> DataFrame:
    """Best completed trials; equal values by trial number."""
    return completed(trials, value).orderBy(F.desc(value), trial).limit(n)


def best_trial(trials: DataFrame, value: str = "value", trial: str = "trial_number") -> DataFrame:
    """The completed trial with the largest value, the first one of equals."""
    rows = F.struct(*trials.columns)
    best = completed(trials, value).agg(
        F.max_by(rows, F.struct(F.col(value), -F.col(trial))).alias("best")
    )
    return best.where(F.col("best").isNotNull()).select("best.*")


def trial_statistics(trials: DataFrame, value: str = "value") -> DataFrame:
    return completed(trials, value).agg(
        F.count("*").alias("total_trials"),
        F.max(value).alias("best_gain"),
        F.min(value).alias("worst_gain"),
        F.avg(value).alias("mean_gain"),
    )


def top_features(importances: DataFrame, n: int = 10) -> DataFrame:
    """(feature, importance) rows with the largest importance; equals by name."""
    return importances.orderBy(F.desc("importance"), "feature").limit(n)


def record_tests(
    report: DataFrame, ledger: str, study: str, params: Mapping, trees: int | None = None, train_periods: Iterable = (),
    test_periods: Iterable = (), ratio: float | None = None,
) -> None:
    """Adds a test's report (`gain.seed_report`: a row per seed and their mean) to a ledger of JSON lines.

    Each row carries what it was fitted with: parameters (as JSON), trees, periods of training and test, and the share of negatives
    drawn. Earlier records stay.
    """
    texts = lambda periods: F.array(*[F.lit(str(p)) for p in periods]).cast("array<string>")
    append_records(report.select(
        F.lit(study).alias("study"), "model", "n_rows", "gain", "n_contacts", "pct_contacted", F.lit(trees).cast("int").alias("trees"),
        F.lit(json.dumps(dict(params), sort_keys=True)).alias("params"), texts(train_periods).alias("train_periods"),
        texts(test_periods).alias("test_periods"), F.lit(ratio).cast("double").alias("ratio"), F.current_timestamp().alias("at"),
    ).coalesce(1), ledger)


def read_tests(spark: SparkSession, ledger: str) -> DataFrame:
    """All recorded tests, one row per test and model."""
    return spark.read.json(ledger, schema=TESTS)
