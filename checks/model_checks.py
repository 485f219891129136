"""Boosted-tree jobs (M1-M7) on labels whose best trees are known.

Without sampling, a label `x > t` makes one split of depth 1, scores of one tree on either side, and all
importance on `x`; SQL can state each of these.
"""

import math

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.views import sql
from mensula.operators import models as M
from mensula.operators.boosting import fit_on_gain
from mensula.operators import samples as K
from mensula.operators import trials as A
from mensula.sizing import scratch_path

P = fx.PANEL
FEATURES = ["n_all", "mclick", "mview", "mpurchase", "cview"]
STUMP = M.TreeParams(trees=1, max_depth=1, balanced=False)
LABEL = "cview > 1"
GAIN, COST = 40_000, 2_000


def rows(spark, sf):
    """All users by day; both targets are the known label."""
    y = F.expr(LABEL).cast("int")
    return fx.user_days(spark, sf).withColumns({"target_binario": y, "target_ternario": y})


def one_model(spark, sf):
    df = rows(spark, sf)
    model = M.fit_seed(df, FEATURES, "target_binario", STUMP, 7)
    return M.score(model, df, FEATURES, ["c", "m", "target_ternario"]).withColumn("proba", F.round("proba", 9))


def skipped(spark, sf):
    """The second call finds one seed fitted and fits the other."""
    df, base = rows(spark, sf), scratch_path(spark, "models")
    M.fit_seeds(df, FEATURES, "target_binario", STUMP, [1], base, "small")
    paths = M.fit_seeds(df, FEATURES, "target_binario", STUMP, [1, 2], base, "small")
    return M.score_study(paths, df, FEATURES, ["c", "m"], "small").groupBy("study", "seed").agg(F.count("*").alias("n"))


def study_scores(spark, sf):
    df, base = rows(spark, sf), scratch_path(spark, "models")
    paths = M.fit_seeds(df, FEATURES, "target_binario", STUMP, [1, 2], base, "small")
    return M.score_study(paths, df, FEATURES, ["c", "m"], "small").withColumn("proba", F.round("proba", 9))


def searched(spark, sf):
    df = K.with_fold(rows(spark, sf), P, 2, 3, number=F.col("c") * 31 + F.col("m"))
    options = [STUMP, M.TreeParams(trees=3, max_depth=1, balanced=False)]
    return M.search(df, P, FEATURES, options, 7, gain=GAIN, cost=COST, stop_early=True)


def searched_in_time(spark, sf):
    df = K.with_temporal_folds(rows(spark, sf), P, 2, min_train_size=6, val_size=2)
    ledger = scratch_path(spark, "ledger")
    M.search(df, P, FEATURES, [STUMP], 7, gain=GAIN, cost=COST, ledger=ledger)
    again = M.search(df.where("false"), P, FEATURES, [STUMP], 7, gain=GAIN, cost=COST, ledger=ledger)  # from the ledger alone
    return again.select("trial_number", "fold", "n_rows", "gain", "n_contacts")


def searched_undersampled(spark, sf):
    """Temporal folds whose training rows keep exactly as many negatives as positives; validation rows stay whole."""
    df = K.with_temporal_folds(rows(spark, sf), P, 2, min_train_size=6, val_size=2)

    def thin(train, number):
        days = [r[0] for r in train.select("m").distinct().collect()]
        return K.exact_undersample(train, P, K.Sampling(ratio=1.0, periods=tuple(days)), chance=F.xxhash64("c", "m", F.lit(number)))

    out = M.search(df, P, FEATURES, [STUMP], 7, gain=GAIN, cost=COST, thin=thin)
    return out.select("trial_number", "fold", "n_rows", "gain", "n_contacts")


def stopped_on_gain(spark, sf):
    """A label that needs three flags, as bits of the order number: three stumps rank perfectly and two do not."""
    bit = lambda i: F.floor(F.col("o_orderkey") / 2**i) % 2
    df = fx.table(spark, sf, "orders").select("o_orderkey", bit(0).alias("a"), bit(1).alias("b"), bit(2).alias("c"))
    df = df.withColumn("y", (F.col("a") + F.col("b") + F.col("c") == 3).cast("int"))
    held = F.floor(F.col("o_orderkey") / 8) % 3 == 0
    params = M.TreeParams(trees=50, learning_rate=0.5, max_depth=1, balanced=False)
    model = fit_on_gain(df.where(~held), df.where(held), ["a", "b", "c"], params, 4, ["o_orderkey"], "y", "y", 4, GAIN, COST)
    best = model.history[len(model.steps) - 1]
    return spark.createDataFrame([(len(model.steps), len(model.history), best[1], best[2])], "best_round int, rounds int, gain long, n_contacts long")


def filled_and_weighted(spark, sf):
    """A label by a column with NULLs, which count as the median; positives weigh as all negatives together."""
    df = rows(spark, sf).withColumn("target_binario", (F.coalesce("mpurchase", F.lit(-1)) > 0).cast("int"))
    model = M.fit_seed(df, ["mpurchase"], "target_binario", M.TreeParams(trees=1, max_depth=1), 7)
    return M.score(model, df, ["mpurchase"], ["c", "m"]).withColumn("proba", F.round("proba", 9))


def search_sizes(spark, sf):
    return searched_in_time(spark, sf).select("trial_number", "fold", "n_rows")


def stopped(spark, sf):
    """Held-out rows whose label has nothing to do with the features: the first tree is the last."""
    df = rows(spark, sf).withColumn("held_out", F.pmod("c", F.lit(4)) == 0)
    noise = F.pmod(F.col("c") * 7 + F.col("m"), F.lit(2)).cast("int")
    df = df.withColumn("target_binario", F.when(F.col("held_out"), noise).otherwise(F.col("target_binario")))
    model = M.fit_seed(df, FEATURES, "target_binario", M.TreeParams(trees=12, max_depth=1, balanced=False), 7, stop_on="held_out")
    return M.score(model, df, FEATURES, ["c", "m"]).agg(F.count("*").alias("n"), F.lit(M.used_trees(model)).alias("trees"))


def important(spark, sf):
    model = M.fit_seed(rows(spark, sf), FEATURES, "target_binario", STUMP, 7)
    return A.top_features(M.importances(model, spark), 1)


def thresholds(spark, sf):
    base = scratch_path(spark, "models")
    paths = M.fit_seeds(rows(spark, sf), FEATURES, "target_binario", STUMP, [1], base, "small")
    return M.split_points(spark, paths[1])


HIGH, LOW = (round(1 / (1 + math.exp(s * 2)), 9) for s in (-1, 1))
SCORED = f"case when {LABEL} then {HIGH}::double else {LOW}::double end as proba"
# Perfect scores: the best prefix is all positives.
PERFECT = (f"count(*) as n_rows, cast(count(*) filter ({LABEL}) * {GAIN} as bigint) as gain, count(*) filter ({LABEL}) as n_contacts")
LAST = ("(select *, dense_rank() over (order by m) - 1 as i from p_ud) join (select count(distinct m) as days from p_ud) on true "
        "join (select cast(unnest([1, 2]) as integer) as fold) on i >= 6 + (fold - 1) * (days - 8) and i < 8 + (fold - 1) * (days - 8)")

CHECKS = {
    "M1_fit_and_score": (one_model, sql("p_ud", f"select c, m, cast({LABEL} as integer) as target_ternario, {SCORED} from p_ud")),
    "M2_skip_fitted": (skipped, sql("p_ud", """select 'small' as study, cast(unnest([1, 2]) as integer) as seed, n
        from (select count(*) as n from p_ud)""")),
    "M3_study_scores": (study_scores, sql("p_ud", f"""select c, m, 'small' as study, seed, {SCORED}
        from p_ud, (select cast(unnest([1, 2]) as integer) as seed)""")),
    "M4_search": (searched, sql("p_ud", f"""select trial_number, cast((c * 31 + m) % 2 as integer) as fold, {PERFECT},
        count(*) filter (not ({LABEL})) as n_class_0, count(*) filter ({LABEL}) as n_class_1, cast(1 as integer) as best_iteration
        from p_ud, (select cast(unnest([0, 1]) as integer) as trial_number) group by 1, 2""")),
    "M4_search_in_time": (searched_in_time, sql("p_ud", f"select cast(0 as integer) as trial_number, fold, {PERFECT} from {LAST} group by fold")),
    "M4_search_undersampled": (searched_undersampled, sql("p_ud", f"select cast(0 as integer) as trial_number, fold, {PERFECT} from {LAST} group by fold")),
    "M1_fit_nulls_and_weights": (filled_and_weighted, sql("p_ud", f"""select c, m, case when mpurchase > 0 then {HIGH}::double else {LOW}::double end as proba
        from p_ud""")),
    "M5_stop_on_gain": (stopped_on_gain, f"""select cast(3 as integer) as best_round, cast(7 as integer) as rounds,
        cast(count(*) * {GAIN} as bigint) as gain, count(*) as n_contacts from orders where o_orderkey % 8 = 7 and o_orderkey // 8 % 3 = 0"""),
    "M4_fold_sizes": (search_sizes, sql("p_ud", f"select cast(0 as integer) as trial_number, fold, count(*) as n_rows from {LAST} group by fold")),
    "M5_early_stop": (stopped, sql("p_ud", "select count(*) as n, cast(1 as integer) as trees from p_ud")),
    "M6_importance": (important, sql("p_ud", "select 'cview__filled' as feature, 1.0::double as importance")),
    "M7_split_points": (thresholds, sql("p_ud", """select 'cview__filled' as feature, cast(0 as integer) as tree, cast(0 as integer) as node,
        (max(cview) filter (cview <= 1) + min(cview) filter (cview > 1)) / 2.0::double as threshold from p_ud""")),
}
