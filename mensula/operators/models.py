"""Boosted-tree models with Spark ML: fit per seed, score, search, inspect.

Fitting, scoring and evaluation are Spark jobs; the driver sees models, metrics and the
parameter list only. Independent fits run several at a time.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from datetime import datetime
from functools import partial
from statistics import fmean, pstdev

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensula.operators.gain import CONTACT_COST, GAIN_PER_HIT, best_gain
from mensula.operators.parallel import AT_ONCE, at_once
from mensula.operators.ranks import Ranking
from mensula.panel import Panel
from mensula.sizing import settle
from mensula.sources.writers import append_records

# Fixed value: bins per feature.
BINS = 31


@dataclass(frozen=True)
class TreeParams:
    """Settings of one fit. `trees` bounds the number of boosting rounds."""

    trees: int = 20
    learning_rate: float = 0.1
    max_depth: int = 5
    min_rows_in_leaf: int = 1
    feature_share: float = 1.0
    row_share: float = 1.0
    balanced: bool = True


def _prepared(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Doubles, and a 0/1 column per feature that tells whether it was NULL."""
    columns = {f: F.col(f).cast("double") for f in features}
    missing = {f"{f}__missing": F.col(f).isNull().cast("double") for f in features}
    return df.withColumns({**columns, **missing}), [*missing]


def _class_weight(df: DataFrame, y: str, balanced: bool) -> DataFrame:
    """`_weight`: positives weigh as much as all negatives together."""
    if not balanced:
        return df.withColumn("_weight", F.lit(1.0))
    n = df.agg(F.count(F.when(F.col(y) == 1, 1)).alias("p"), F.count(F.when(F.col(y) == 0, 1)).alias("q")).first()
    weight = n["q"] / n["p"] if n["p"] else 1.0
    return df.withColumn("_weight", F.when(F.col(y) == 1, weight).otherwise(1.0))


@dataclass(frozen=True)
class Training:
    """Rows ready for any number of fits: `_features`, the target, `_weight` and the columns kept, written once."""

    rows: DataFrame
    steps: tuple
    y: str


def prepare(
    train: DataFrame, features: Sequence[str], y: str, balanced: bool = True, keep: Sequence[str] = ()
) -> Training:
    """Class weights, medians and vectors of a training set; none of them depends on a seed.

    NULLs become the median plus an indicator; a feature without any value is 0.
    """
    rows, missing = _prepared(_class_weight(train, y, balanced), features)
    rows = rows.withColumn(y, F.col(y).cast("double"))
    known = rows.agg(*[F.count(F.nanvl(f, F.lit(None).cast("double"))).alias(f) for f in features]).first()
    rows = rows.withColumns({f: F.lit(0.0) for f in features if known[f] == 0})
    filled = [f"{f}__filled" for f in features]
    medians = Imputer(strategy="median", inputCols=list(features), outputCols=filled).fit(rows)
    vectors = VectorAssembler(inputCols=[*filled, *missing], outputCol="_features")
    ready = vectors.transform(medians.transform(rows)).select("_features", y, "_weight", *keep)
    return Training(settle(ready), (medians, vectors), y)


def fit_prepared(
    training: Training, params: TreeParams, seed: int, stop_on: str | None = None, tolerance: float = 0.01
) -> PipelineModel:
    """One model of prepared rows.

    With `stop_on`, a boolean column kept in the rows, its true rows only decide when more
    trees stop helping (by log-loss).
    """
    share = params.feature_share
    trees = GBTClassifier(
        labelCol=training.y, featuresCol="_features", weightCol="_weight", maxBins=BINS, seed=seed,
        maxIter=params.trees, stepSize=params.learning_rate, maxDepth=params.max_depth,
        minInstancesPerNode=params.min_rows_in_leaf, subsamplingRate=params.row_share,
        featureSubsetStrategy="all" if share >= 1.0 else str(share),
    )
    if stop_on is not None:
        trees = trees.setParams(validationIndicatorCol=stop_on, validationTol=tolerance)
    return PipelineModel([*training.steps, trees.fit(training.rows)])


def fit_seed(
    train: DataFrame, features: Sequence[str], y: str, params: TreeParams, seed: int,
    stop_on: str | None = None, tolerance: float = 0.01,
) -> PipelineModel:
    """`prepare` and `fit_prepared` for one model."""
    keep = () if stop_on is None else (stop_on,)
    return fit_prepared(prepare(train, features, y, params.balanced, keep), params, seed, stop_on, tolerance)


def fit_seeds(
    train: DataFrame, features: Sequence[str], y: str, params: TreeParams, seeds: Sequence[int], base: str,
    study: str, most: int = AT_ONCE,
) -> dict[int, str]:
    """Fit and save one model per seed under `base/study/seed=<n>`, `most` at a time; the rows are prepared once.

    A record beside the model, written after it, marks a finished one and holds its settings. It is skipped when the
    settings are the same, and fitted anew when they are not. When a fit fails, the others are cancelled; finished models stay.
    """
    spark = train.sparkSession
    settings = json.dumps({"params": asdict(params), "features": list(features), "y": y}, sort_keys=True)
    paths = {seed: f"{base.rstrip('/')}/{study}/seed={seed}" for seed in seeds}
    done = _finished(spark, f"{base.rstrip('/')}/{study}/seed=*-finished")
    todo = [seed for seed in paths if done.get(seed) != settings]
    if not todo:
        return paths
    training = prepare(train, features, y, params.balanced)

    def fit(seed: int) -> None:
        model = fit_prepared(training, params, seed)
        model.write().overwrite().save(paths[seed])
        record = spark.createDataFrame(
            [(study, seed, used_trees(model), settings)], "study string, seed int, trees int, settings string")
        record.coalesce(1).write.mode("overwrite").json(f"{paths[seed]}-finished")

    at_once(spark, {seed: partial(fit, seed) for seed in todo}, most)
    return paths


def _finished(spark: SparkSession, paths: str) -> dict[int, str]:
    """Settings of every finished seed; a record each."""
    if not _exists(spark, paths):
        return {}
    return {r["seed"]: r["settings"] for r in spark.read.json(paths, schema="seed int, settings string").collect()}


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a record was written at the path, on whatever storage Spark reads."""
    try:
        return not spark.read.text(path).isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def prepared_rows(training: Training, df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """`keep` columns and `_features` of other rows, filled as the training rows were."""
    rows, _ = _prepared(df.select(*keep, *[F.col(f).alias(f) for f in features if f not in keep]), features)
    medians, vectors = training.steps
    return vectors.transform(medians.transform(rows)).select(*keep, "_features")


def score(model: PipelineModel, df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """`keep` columns and the probability of class 1 as `proba`."""
    rows, _ = _prepared(df.select(*keep, *[F.col(f).alias(f) for f in features if f not in keep]), features)
    scored = model.transform(rows)
    return scored.select(*keep, vector_to_array("probability")[1].alias("proba"))


def score_study(
    models: Mapping[int, PipelineModel | str], df: DataFrame, features: Sequence[str], keep: Sequence[str],
    study: str,
) -> DataFrame:
    """Long scores of every model of a study, with `study` and `seed`; the rows are read once for all models."""
    rows, _ = _prepared(df.select(*keep, *[F.col(f).alias(f) for f in features if f not in keep]), features)
    base, done = rows.columns, []
    for i, model in enumerate(models.values()):
        medians, vectors, trees = (PipelineModel.load(model) if isinstance(model, str) else model).stages
        named = trees.copy().setProbabilityCol(f"_p{i}").setRawPredictionCol(f"_raw{i}").setPredictionCol(f"_y{i}")
        scored = named.transform(vectors.transform(medians.transform(rows)))
        rows = scored.select(*base, *done, vector_to_array(f"_p{i}")[1].alias(f"_p{i}"))
        done.append(f"_p{i}")
    each = F.explode(F.array(*[
        F.struct(F.lit(seed).alias("seed"), F.col(p).alias("proba")) for seed, p in zip(models, done)]))
    return rows.select(*keep, F.lit(study).alias("study"), each.alias("_s")).select(*keep, "study", "_s.seed", "_s.proba")


def staged_gain(
    model: PipelineModel, df: DataFrame, features: Sequence[str], keys: Sequence[str], y: str,
    gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST, rows_per_bucket: int = 1_000_000,
    prefixes: Sequence[int] | None = None,
) -> DataFrame:
    """Best gain of prefixes of the model's trees, of all by default: (trees, n_rows, gain, n_contacts). One fit stands for
    all tree counts. A row is written per validation row and prefix; `best_staged` needs few prefixes."""
    wanted = sorted(set(prefixes)) if prefixes is not None else list(range(1, used_trees(model) + 1))
    rows, _ = _prepared(df.select(*keys, y, *[F.col(f).alias(f) for f in features if f not in (*keys, y)]), features)
    medians, vectors, boosted = model.stages
    rows = vectors.transform(medians.transform(rows)).select(*keys, y, "_features")
    for i, tree in enumerate(boosted.trees):
        rows = tree.copy().setFeaturesCol("_features").setPredictionCol(f"_t{i}").transform(rows)
    # One array of what each tree adds, summed up from one prefix to the next: as many terms as trees, not their square.
    parts = F.array(*[F.lit(float(weight)) * F.col(f"_t{i}") for i, weight in enumerate(boosted.treeWeights)])
    steps = F.array(*[F.struct(F.lit(a + 1).alias("first"), F.lit(b - a).alias("n"), F.lit(b).alias("trees")) for a, b in zip([0, *wanted], wanted)])
    empty = F.array().cast("array<struct<trees: int, margin: double>>")
    running = F.aggregate(steps, empty, lambda done, s: F.concat(done, F.array(F.struct(
        s["trees"].alias("trees"),
        F.aggregate(F.slice("_parts", s["first"], s["n"]), F.coalesce(F.get(done, F.size(done) - 1)["margin"], F.lit(0.0)), lambda t, p: t + p).alias("margin")))))
    staged = rows.select(*keys, y, parts.alias("_parts")).select(*keys, y, F.explode(running).alias("_s"))
    scored = staged.select(*keys, y, "_s.trees", "_s.margin")
    ranking = Ranking("margin", tuple(keys), ("trees",), rows_per_bucket=rows_per_bucket)
    return best_gain(settle(scored), ranking, y, gain, cost)


LADDER = 12


def best_staged(
    model: PipelineModel, df: DataFrame, features: Sequence[str], keys: Sequence[str], y: str,
    gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST, rows_per_bucket: int = 1_000_000, ladder: int = LADDER,
):
    """The prefix of the trees with the largest gain, the shortest of equal ones, as a row of `staged_gain`.

    Evenly spaced prefixes are judged first, `ladder` of them, then as many between the neighbours of the best one, until there
    is none left between: the gain of the result is the largest of all that were judged.
    """
    low, high = 1, used_trees(model)
    judged: dict[int, object] = {}
    while True:
        open_ = [n for n in range(low, high + 1) if n not in judged]
        count = min(ladder, len(open_))
        steps = {open_[(len(open_) - 1) * i // max(count - 1, 1)] for i in range(count)}
        for row in staged_gain(model, df, features, keys, y, gain, cost, rows_per_bucket, sorted(steps)).collect():
            judged[row["trees"]] = row
        best = max(judged.values(), key=lambda r: (r["gain"], -r["trees"]))
        known = sorted(judged)
        at = known.index(best["trees"])
        low, high = known[max(at - 1, 0)], known[min(at + 1, len(known) - 1)]
        if all(n in judged for n in range(low, high + 1)):
            return best


def trees_of(model: PipelineModel) -> GBTClassificationModel:
    return model.stages[-1]


def used_trees(model: PipelineModel) -> int:
    return trees_of(model).getNumTrees


def importances(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """(feature, importance) of every model input."""
    names = model.stages[-2].getInputCols()
    values = [float(v) for v in trees_of(model).featureImportances.toArray()]
    return spark.createDataFrame(list(zip(names, values)), "feature string, importance double")


def split_points(spark: SparkSession, path: str, feature: str | None = None) -> DataFrame:
    """(feature, tree, node, threshold) of a saved model's splits, in threshold order."""
    model = PipelineModel.load(path)
    names = model.stages[-2].getInputCols()
    # The folder of the last stage, as the saved pipeline itself names its stages.
    order = json.loads(spark.read.text(f"{path}/metadata").first()[0])["paramMap"]["stageUids"]
    width = len(str(len(order)))
    nodes = spark.read.parquet(f"{path}/stages/{str(len(order) - 1).zfill(width)}_{order[-1]}/data")
    labels = F.array(*[F.lit(n) for n in names])
    splits = nodes.where(F.col("nodeData.leftChild") >= 0).select(
        F.get(labels, F.col("nodeData.split.featureIndex")).alias("feature"),
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"),
        F.get(F.col("nodeData.split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"),
    )
    wanted = splits if feature is None else splits.where(F.col("feature").isin(feature, f"{feature}__filled"))
    return wanted.orderBy("feature", "threshold", "tree", "node")


LEDGER = (
    "trial_number int, params string, value double, gain_std double, best_iteration int, folds array<struct<fold: int, "
    "n_rows: long, n_class_0: long, n_class_1: long, gain: long, n_contacts: long, best_iteration: int>>, "
    "top_features array<string>, state string, datetime timestamp"
)


def search(
    df: DataFrame, panel: Panel, features: Sequence[str], candidates: Sequence[TreeParams], seed: int,
    fit_y: str = "target_binario", eval_y: str = "target_ternario",
    gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST, rows_per_bucket: int = 1_000_000,
    stop_early: bool = False, thin: Callable[[DataFrame, int], DataFrame] | None = None, ledger: str | None = None,
    most: int = AT_ONCE,
) -> DataFrame:
    """Cross-validated gain of every candidate: one row per trial and fold.

    `df` holds `fold` and either `role` ('train'/'validation', temporal folds, rows
    repeated) or none (shuffled folds: each fold validates once, the others train). Models
    fit on one target and are judged by the best gain on the other. `stop_early` judges prefixes of the trees
    by gain and reports the length of the best (`best_staged`). `thin(train, seed + fold)` draws the rows to fit
    on; validation rows stay whole. A fold's rows are prepared once for all candidates of one class weighting, and the folds
    of a candidate are fitted `most` at a time. With `ledger`, a folder of JSON lines, each trial is recorded as soon as it is finished, and recorded
    trials with the same parameters are not fitted again.
    """
    spark = df.sparkSession
    temporal = "role" in df.columns
    done = _recorded(spark, ledger)
    data = folds = None
    rows, ready, sizes = [], {}, {}

    def parts(fold: int) -> tuple[DataFrame, DataFrame]:
        here = F.col("fold") == fold
        return (data.where(here & (F.col("role") == "train") if temporal else ~here),
                data.where(here & (F.col("role") == "validation") if temporal else here))

    def prepared(fold: int, balanced: bool) -> Training:
        if (fold, balanced) not in ready:
            train = parts(fold)[0]
            ready[fold, balanced] = prepare(thin(train, seed + fold) if thin else train, features, fit_y, balanced)
        return ready[fold, balanced]

    def judge(fold: int, params: TreeParams) -> tuple[tuple, dict[str, float]]:
        judged = parts(fold)[1]
        model = fit_prepared(prepared(fold, params.balanced), params, seed)
        if stop_early:
            best = best_staged(model, judged, features, panel.keys, eval_y, gain, cost, rows_per_bucket)
            trees = best["trees"]
        else:
            scored = settle(score(model, judged, features, [*panel.keys, eval_y]))
            best = best_gain(scored, Ranking("proba", tuple(panel.keys), rows_per_bucket=rows_per_bucket), eval_y, gain, cost).first()
            trees = used_trees(model)
        if fold not in sizes:
            sizes[fold] = judged.where(F.col(eval_y) == 1).count()
        ones, n = sizes[fold], best["n_rows"]
        weights = dict(zip(model.stages[-2].getInputCols(), trees_of(model).featureImportances.toArray().tolist()))
        return (fold, n, n - ones, ones, int(best["gain"]), best["n_contacts"], trees), weights

    for trial, params in enumerate(candidates):
        settings = json.dumps(asdict(params), sort_keys=True)
        if (trial, settings) in done:
            rows += [(trial, *fold) for fold in done[trial, settings]]
            continue
        if data is None:
            data = settle(df)
            folds = sorted(r[0] for r in data.select("fold").distinct().collect())
        results = at_once(spark, {fold: partial(judge, fold, params) for fold in folds}, most)
        found, weights = [results[fold][0] for fold in folds], Counter()
        for fold in folds:
            weights.update(results[fold][1])
        rows += [(trial, *fold) for fold in found]
        if ledger is not None:
            gains = [f[4] for f in found]
            top = sorted(weights, key=lambda n: (-weights[n], n))[:10]
            record = (trial, settings, fmean(gains), pstdev(gains), math.floor(fmean(f[6] for f in found)), found, top, "COMPLETE", datetime.now())
            append_records(spark.createDataFrame([record], LEDGER), ledger)
    kinds = "trial_number int, fold int, n_rows long, n_class_0 long, n_class_1 long, gain long, n_contacts long, best_iteration int"
    return spark.createDataFrame(rows, kinds)


def _recorded(spark: SparkSession, ledger: str | None) -> dict[tuple[int, str], list]:
    """Fold results of the finished trials in the ledger; one record per trial, so they are few."""
    if ledger is None or not _exists(spark, ledger):
        return {}
    found = spark.read.json(ledger, schema=LEDGER).where("state = 'COMPLETE'").collect()
    return {(r["trial_number"], r["params"]): [tuple(f) for f in r["folds"]] for r in found}


def best_params(spark: SparkSession, ledger: str) -> TreeParams:
    """Settings of the ledger's best trial, with its mean tree count, for the last fit."""
    best = spark.read.json(ledger, schema=LEDGER).where("state = 'COMPLETE'").orderBy(F.desc("value"), "trial_number").first()
    if best is None:
        raise ValueError(f"no finished trial in {ledger}")
    return with_trees(TreeParams(**json.loads(best["params"])), best["best_iteration"])


def ledger_rows(folds: DataFrame, candidates: Sequence[TreeParams], settings: Mapping[str, str]) -> DataFrame:
    """One trial record per candidate: mean and deviation of gain, trees, parameters, settings."""
    names = list(TreeParams.__dataclass_fields__)
    rows = [(i, *[getattr(p, n) for n in names]) for i, p in enumerate(candidates)]
    kinds = {"trees": "int", "max_depth": "int", "min_rows_in_leaf": "int", "balanced": "boolean"}
    schema = "trial_number int, " + ", ".join(f"{n} {kinds.get(n, 'double')}" for n in names)
    table = folds.sparkSession.createDataFrame(rows, schema)
    params = table.select("trial_number", F.struct(*names).alias("params"))
    summary = folds.groupBy("trial_number").agg(
        F.avg("gain").alias("value"), F.stddev_pop("gain").alias("gain_std"),
        F.floor(F.avg("best_iteration")).cast("int").alias("best_iteration"),
    )
    entries = [F.lit(x) for pair in settings.items() for x in pair]
    setting = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
    return summary.join(F.broadcast(params), "trial_number").select(
        "trial_number", "params", "value", "gain_std", "best_iteration",
        F.lit("COMPLETE").alias("state"), F.current_timestamp().alias("datetime"),
        setting.alias("configuration"),
    )


def with_trees(params: TreeParams, iterations: float) -> TreeParams:
    """The same settings with the mean tree count of the folds, for the last fit."""
    return replace(params, trees=max(1, math.floor(iterations)))
