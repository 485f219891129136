"""Distribution of scores by period, and how it moves between periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mensula.operators.gain import hits_within
from mensula.operators.rank_index import RankIndex
from mensula.operators.ranks import Ranking, named_quantiles, value_of

# Reported percentiles and top sizes.
PERCENTILES = {"q01": 0.01, "q05": 0.05, "q10": 0.10, "q25": 0.25, "median": 0.50,
               "q75": 0.75, "q90": 0.90, "q95": 0.95, "q99": 0.99}
CLASS_PERCENTILES = {"q25": 0.25, "median": 0.50, "q75": 0.75}
STATISTIC_SIZES = (1000, 5000, 11000, 15000, 20000)


def distribution(
    df: DataFrame | RankIndex, score: str, period: str = "period", rows_per_bucket: int = 1_000_000
) -> DataFrame:
    """Per period: count, mean, population deviation, extremes and exact percentiles.

    A NULL period is a period; one without any score has NULL statistics. An index of the scores by period, best first, is looked up.
    """
    if isinstance(df, RankIndex):
        return _distribution_of(df, period)
    basic = {"mean": F.avg(score), "std": F.stddev_pop(score), "min": F.min(score), "max": F.max(score)}
    return named_quantiles(df, score, PERCENTILES, [period], rows_per_bucket, basic)


def _distribution_of(index: RankIndex, period: str) -> DataFrame:
    """The same from an index: the k-th smallest of n known scores has rank n - k + 1 from the best."""
    spot = {name: F.lit(share) * (F.col("n_known") - 1) for name, share in PERCENTILES.items()}
    rank = lambda place: F.col("n_known") - place
    wanted = F.filter(F.array(*[rank(end(s)) for s in spot.values() for end in (F.floor, F.ceil)]), lambda r: r <= F.col("n_known"))
    found = index.at_ranks(wanted).withColumn("_at", F.map_from_entries(F.transform("found", lambda f: F.struct(
        f["rank"], value_of(f["key"], index.ranking.descending)))))
    low = lambda s: F.try_element_at("_at", rank(F.floor(s)))
    high = lambda s: F.try_element_at("_at", rank(F.ceil(s)))
    return found.select(period, "n_rows", "mean", "std", "min", "max", *[
        (low(s) + (high(s) - low(s)) * (s - F.floor(s))).alias(name) for name, s in spot.items()])


def top_scores(
    df: DataFrame | RankIndex, ranking: Ranking, y: str, sizes: Sequence[int] = STATISTIC_SIZES
) -> DataFrame:
    """Per group and size: score at that rank, recall and precision of the rows up to it."""
    return hits_within(df, ranking, y, sizes).select(
        *ranking.group, F.col("n_contacts").alias("size"), "threshold",
        F.coalesce(F.try_divide(F.col("TP").cast("double"), F.col("n_positive")), F.lit(0.0)).alias("recall"),
        (F.col("TP").cast("double") / F.col("n_contacts")).alias("precision"),
    )


def class_distribution(
    df: DataFrame, score: str, y: str, period: str = "period", rows_per_bucket: int = 1_000_000
) -> DataFrame:
    """Per period: counts, churn rate and score statistics of each class, and their ratios."""
    sides = {"churners": 1, "no_churners": 0}
    basic = {"mean": F.avg(score), "std": F.stddev_pop(score)}
    per_class = named_quantiles(df, score, CLASS_PERCENTILES, [period, y], rows_per_bucket, basic).withColumnRenamed("n_rows", "n")
    # A row per period and class by now.
    wide = per_class.groupBy(period).agg(F.sum("n").alias("_n"), *[
        F.max(F.when(F.col(y) == label, F.col(c))).alias(f"{c}_{name}")
        for name, label in sides.items() for c in ("n", "mean", "std", *CLASS_PERCENTILES)
    ]).fillna(0, [f"n_{name}" for name in sides])
    has_base = F.col("mean_no_churners") > 0
    return wide.select(
        "*", (F.col("n_churners") / F.col("_n")).alias("churn_rate"),
        F.when(has_base, F.try_divide("mean_churners", "mean_no_churners")).alias("mean_ratio"),
        F.when(has_base, F.try_divide("median_churners", "median_no_churners")).alias("median_ratio"),
    ).drop("_n")


def distribution_shifts(statistics: DataFrame, period: str = "period") -> DataFrame:
    """Changes between consecutive periods; the input has one row per period."""
    order = Window.orderBy(period)
    names = ("mean", "median", "std", "mean_churners", "churn_rate")
    known = [c for c in names if c in statistics.columns]
    before = statistics.select(
        period, *known, F.lag(period).over(order).alias("previous"),
        *[F.lag(c).over(order).alias(f"_{c}") for c in known],
    ).where(F.col("previous").isNotNull())
    out = [period, "previous"] + [
        (F.col(c) - F.col(f"_{c}")).alias(f"delta_{c}") for c in ("mean", "median", "std")
    ]
    out.append(F.when(F.col("_mean") > 0, (F.col("mean") - F.col("_mean")) / F.col("_mean") * 100)
               .otherwise(0.0).alias("pct_change_mean"))
    if "mean_churners" in known:
        both = (F.col("mean_churners") != 0) & (F.col("_mean_churners") != 0)
        out += [F.when(both, F.col(c) - F.col(f"_{c}")).alias(f"delta_{c}")
                for c in ("mean_churners", "churn_rate")]
    return before.select(*out)


def comparison_table(
    statistics: DataFrame, metrics: Sequence[str], periods: Sequence, period: str = "period"
) -> DataFrame:
    """Metrics as rows, one column per named period."""
    values = statistics.select(period, *[F.col(c).cast("double").alias(c) for c in metrics])
    return (
        values.unpivot([period], list(metrics), "metric", "value")
        .groupBy("metric").pivot(period, list(periods)).agg(F.max("value"))
    )
