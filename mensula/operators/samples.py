"""Training sets: splits by period, class balance, folds.

Rows are drawn by a hash of their key and a seed, so a rerun or a recomputed task picks the
same rows, and no draw needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensula.functions.columns import in_periods
from mensula.operators.ranks import Ranking, keys_at_ranks, with_rank
from mensula.panel import Panel, period_axis
from mensula.sizing import settle, small_side

DRAWS = 1_000_000

# Seed of the exact undersample, and the columns that are never features.
EXACT_SAMPLE_SEED = 600011
TARGETS = ("target_binario", "target_ternario")


def draw(keys: Sequence[str], seed: int) -> Column:
    """A repeatable number in [0, 1) for each row."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(DRAWS)) / F.lit(float(DRAWS))


def period_split(
    df: DataFrame, panel: Panel, train: Iterable, validation: Iterable
) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows by their period lists."""
    return (
        df.where(in_periods(df, panel.period, train)),
        df.where(in_periods(df, panel.period, validation)),
    )


def final_fit_rows(df: DataFrame, panel: Panel, train: Iterable, validation: Iterable) -> DataFrame:
    """Rows of both lists, for the last fit."""
    return df.where(in_periods(df, panel.period, [*train, *validation]))


def class_period_rows(
    df: DataFrame, panel: Panel, y: str, positive_periods: Iterable, negative_periods: Iterable
) -> DataFrame:
    """Positives of one period list and negatives of another, in one scan."""
    positive = in_periods(df, panel.period, positive_periods) & (F.col(y) == 1)
    negative = in_periods(df, panel.period, negative_periods) & (F.col(y) == 0)
    return df.where(positive | negative)


def undersample(df: DataFrame, y: str, ratio: float, chance: Column) -> DataFrame:
    """All positives, and each negative with probability `ratio` (`chance` below it)."""
    return df.where((F.col(y) == 1) | ((F.col(y) == 0) & (chance < ratio)))


@dataclass(frozen=True)
class Sampling:
    """Which rows train a model: one period list, or one list per class."""

    ratio: float
    periods: tuple = ()
    positive_periods: tuple = ()
    negative_periods: tuple = ()
    y: str = "target_binario"

    def lists(self) -> tuple[tuple, tuple]:
        if self.periods:
            return self.periods, self.periods
        if self.positive_periods and self.negative_periods:
            return self.positive_periods, self.negative_periods
        raise ValueError("give `periods`, or both `positive_periods` and `negative_periods`")


def training_rows(
    df: DataFrame, panel: Panel, sampling: Sampling, seed: int, chance: Column | None = None
) -> DataFrame:
    """Rows of the strategy, negatives drawn with the seed."""
    positive, negative = sampling.lists()
    chosen = class_period_rows(df, panel, sampling.y, positive, negative)
    return undersample(chosen, sampling.y, sampling.ratio, draw(panel.keys, seed) if chance is None else chance)


def exact_undersample(
    df: DataFrame,
    panel: Panel,
    sampling: Sampling,
    chance: Column | None = None,
    rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """All positives and exactly int(positives / ratio) negatives, without replacement.

    With class lists, both classes come from the positive list. The negatives with the
    smallest draw are kept: the key that bounds them is found on written narrow rows, and
    the wide rows are only filtered.
    """
    periods, _ = sampling.lists()
    y = F.col(sampling.y)
    score = F.xxhash64(*panel.keys, F.lit(EXACT_SAMPLE_SEED)) if chance is None else chance
    rows = df.where(in_periods(df, panel.period, periods) & y.isin(0, 1)).withColumn("_draw", score)
    narrow = settle(rows.select(*panel.keys, sampling.y, "_draw"))
    counts = narrow.agg(F.count(F.when(y == 1, 1)).alias("n1"), F.count(F.when(y == 0, 1)).alias("n0")).first()
    wanted = int(counts["n1"] / sampling.ratio)
    if wanted > counts["n0"]:
        raise ValueError(f"{wanted} negatives asked for, {counts['n0']} in the table")
    if not wanted:
        return rows.where(y == 1).drop("_draw")
    ranking = Ranking("_draw", tuple(panel.keys), descending=False, rows_per_bucket=rows_per_bucket)
    edge = keys_at_ranks(narrow.where(y == 0), ranking, F.array(F.lit(wanted).cast("long"))).select("key")
    return rows.where((y == 1) | (ranking.key() <= edge.scalar())).drop("_draw")


def fold_of(keys: Sequence[str], n_folds: int, seed: int) -> Column:
    """Fold number from 0. Give only the entity to keep its rows in one fold."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(n_folds)).cast("int")


def with_fold(
    df: DataFrame, panel: Panel, n_folds: int, seed: int, by_entity: bool = False, number: Column | None = None,
    even: bool = False, rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """Add `fold`: by a hash of the key, or of a whole `number` per row that is given instead.

    Folds are of equal size on average. With `even` rows are counted off in the order of that hash, so that sizes differ by one row at
    most; rows are then ranked, which shuffles them once.
    """
    if even and by_entity:
        raise ValueError("folds that keep an entity together cannot be even")
    if even:
        score = F.xxhash64(*panel.keys, F.lit(seed)) if number is None else number
        ties = [f"_key_{i}" for i in range(len(panel.keys))]
        # The row in one column, so that its names clash with none of the ranking.
        drawn = df.select(F.struct(*df.columns).alias("_row"), score.alias("_draw"), *[F.col(k).alias(t) for k, t in zip(panel.keys, ties)])
        ranked = with_rank(drawn, Ranking("_draw", tuple(ties), descending=False, rows_per_bucket=rows_per_bucket))
        return ranked.select("_row.*", ((F.col("rank") - 1) % n_folds).cast("int").alias("fold"))
    keys = [panel.entity] if by_entity else panel.keys
    fold = fold_of(keys, n_folds, seed) if number is None else F.pmod(number, F.lit(n_folds)).cast("int")
    return df.withColumn("fold", fold)


def temporal_folds(
    df: DataFrame, panel: Panel, n_splits: int, strategy: str = "expanding",
    min_train_size: int = 2, val_size: int = 1, gap: int = 0,
) -> DataFrame:
    """(period, `fold` from 1, `role`) over the periods of the table itself.

    Roles are conditions on a period's place in the axis: fold f trains up to the place
    `min_train_size + (f - 1) * step` and validates `val_size` places behind the gap. Steps are
    equal and as long as the axis allows. `expanding` trains from the first period,
    `rolling` on the last `min_train_size`. Fewer folds come back when the periods do not suffice.
    """
    if strategy not in ("expanding", "rolling"):
        raise ValueError(f"strategy {strategy!r}: use 'expanding' or 'rolling'")
    axis = period_axis(df, panel).withColumn("_free", F.col("last_idx") + 1 - (min_train_size + gap + val_size))
    folds = F.least(F.lit(n_splits), F.col("_free") + 1)
    step = F.when(folds > 1, F.greatest(F.lit(1), F.expr("_free div greatest(1, least(%d, _free + 1) - 1)" % n_splits))).otherwise(1)
    per_fold = axis.where(F.col("_free") >= 0).select(
        panel.period, "period_idx", "_free", (step * 1).alias("_step"), F.explode(F.sequence(F.lit(1), folds.cast("int"))).alias("fold"))
    ahead = F.col("period_idx") - (min_train_size + (F.col("fold") - 1) * F.col("_step"))
    trains = (ahead < 0) if strategy == "expanding" else (ahead < 0) & (ahead >= -min_train_size)
    role = F.when(trains, "train").when((ahead >= gap) & (ahead < gap + val_size), "validation")
    fits = (F.col("fold") - 1) * F.col("_step") <= F.col("_free")
    return per_fold.where(fits).select(panel.period, "fold", role.alias("role")).where("role is not null")


def with_temporal_folds(df: DataFrame, panel: Panel, n_splits: int, **sizes) -> DataFrame:
    """Rows repeated for every temporal fold they take part in, with `fold` (from 1) and `role`."""
    table = small_side(temporal_folds(df, panel, n_splits, **sizes))
    return df.join(table, panel.period).select(*df.columns, "fold", "role")


def feature_columns(
    df: DataFrame, panel: Panel, targets: Iterable[str] = TARGETS, keep_entity: bool = False
) -> list[str]:
    """Columns a model may see: neither targets nor period, and by default not the entity."""
    left_out = {*targets, panel.period} | (set() if keep_entity else {panel.entity})
    return [c for c in df.columns if c not in left_out]
