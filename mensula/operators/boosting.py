"""Boosted trees that stop on money gain.

Every round fits a regression tree to what the margins so far leave unexplained, sets its leaves by a Newton step of the
log-loss, adds it to the margins of training and validation rows, and takes the best gain of the validation rows, on a
target of its own. Fitting ends when the gain has not grown for `patience` rounds, so no tree is fitted that a later cut would
drop. Margins are written after each round; with `spark.cleaner.referenceTracking.cleanCheckpoints` Spark removes those of
earlier rounds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.regression import DecisionTreeRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensula.operators.gain import CONTACT_COST, GAIN_PER_HIT, best_gain
from mensula.operators.models import BINS, TreeParams, Training, prepare, prepared_rows
from mensula.operators.ranks import Ranking
from mensula.sizing import settle

# Rounds without growth before the fit ends, for a learning rate.
PATIENCE, PATIENCE_PER_RATE = 50, 0.05


def patience_for(params: TreeParams) -> int:
    return int(PATIENCE + PATIENCE_PER_RATE / params.learning_rate)


@dataclass(frozen=True)
class Step:
    """A tree and what it adds to the margin in each leaf."""

    tree: DecisionTreeRegressionModel
    leaves: dict[float, float]

    def added(self, rows: DataFrame, margin: str) -> DataFrame:
        """Rows with the tree's part added to the margin."""
        scored = self.tree.transform(rows)
        return scored.withColumn(margin, F.col(margin) + self._part()).drop("_leaf", "_fitted")

    def _part(self) -> Column:
        known = F.create_map(*[F.lit(x) for pair in self.leaves.items() for x in pair])
        return F.coalesce(F.try_element_at(known, F.col("_leaf")), F.lit(0.0))


@dataclass(frozen=True)
class GainBoosted:
    """The rounds up to the best one, and `history`: (round, gain, n_contacts) of every round that was fitted."""

    training: Training
    start: float
    steps: tuple[Step, ...]
    history: tuple[tuple[int, int, int], ...]

    def score(self, df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
        """`keep` columns and the probability of class 1 as `proba`."""
        rows = prepared_rows(self.training, df, features, keep).withColumn("_margin", F.lit(self.start))
        for step in self.steps:
            rows = step.added(rows, "_margin")
        return rows.select(*keep, _share(F.col("_margin")).alias("proba"))


def _share(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def fit_on_gain(
    train: DataFrame, validation: DataFrame, features: Sequence[str], params: TreeParams, seed: int, keys: Sequence[str],
    fit_y: str = "target_binario", eval_y: str = "target_ternario", patience: int | None = None,
    gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST, rows_per_bucket: int = 1_000_000, smoothing: float = 1.0,
) -> GainBoosted:
    """Model whose number of trees is that of the best gain on the validation rows, the first of equal ones.

    `params.trees` bounds the rounds, `patience` those without growth (50 and a share by learning rate by default). Rows are sampled
    per round by `row_share` and features by `feature_share`. `smoothing` is added to the second derivatives of a leaf. Without
    validation rows, or with one class only, the first round is the best.
    """
    training = prepare(train, features, fit_y, params.balanced)
    sums = training.rows.agg(F.sum("_weight").alias("w"), F.sum(F.col("_weight") * F.col(fit_y)).alias("p")).first()
    share = min(max((sums["p"] or 0.0) / (sums["w"] or 1.0), 1e-6), 1 - 1e-6)
    start = math.log(share / (1 - share))
    rows = training.rows.withColumn("_margin", F.lit(start))
    judged = prepared_rows(training, validation, features, [*keys, eval_y]).withColumn("_margin", F.lit(start))
    ranking = Ranking("_margin", tuple(keys), rows_per_bucket=rows_per_bucket)
    steps, history, best = [], [], 0
    for number in range(1, params.trees + 1):
        step = _round(rows, fit_y, params, seed + number, smoothing)
        steps.append(step)
        rows, judged = settle(step.added(rows, "_margin")), settle(step.added(judged, "_margin"))
        found = best_gain(judged, ranking, eval_y, gain, cost).first()
        history.append((number, int(found["gain"]), int(found["n_contacts"])) if found and found["n_rows"] else (number, 0, 0))
        if history[-1][1] > history[best][1]:
            best = number - 1
        if number - 1 - best >= (patience_for(params) if patience is None else patience):
            break
    return GainBoosted(training, start, tuple(steps[: best + 1]), tuple(history))


def _round(rows: DataFrame, y: str, params: TreeParams, seed: int, smoothing: float) -> Step:
    share = _share(F.col("_margin"))
    left = rows.withColumns({"_left": F.col(y) - share, "_bend": share * (1.0 - share)})
    drawn = left if params.row_share >= 1.0 else left.sample(params.row_share, seed)
    # A forest of one tree, because a single tree cannot be told to look at a share of the features.
    share_of = "all" if params.feature_share >= 1.0 else str(params.feature_share)
    forest = RandomForestRegressor(
        numTrees=1, bootstrap=False, featureSubsetStrategy=share_of, labelCol="_left", featuresCol="_features", weightCol="_weight",
        maxBins=BINS, seed=seed, maxDepth=params.max_depth, minInstancesPerNode=params.min_rows_in_leaf).fit(drawn)
    tree = forest.trees[0].copy().setFeaturesCol("_features").setLeafCol("_leaf").setPredictionCol("_fitted")
    # A row per leaf, 2 to the depth at most.
    leaves = tree.transform(left).groupBy("_leaf").agg(
        F.sum(F.col("_weight") * F.col("_left")).alias("g"), F.sum(F.col("_weight") * F.col("_bend")).alias("h")).collect()
    return Step(tree, {r["_leaf"]: params.learning_rate * r["g"] / (r["h"] + smoothing) for r in leaves})
