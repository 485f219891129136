"""Money gain of contacting scored rows: curves, sweeps, selection, ensembles.

Two rules occur. In the gain curve a hit earns the gain and a miss costs the contact. In
the sweeps and in the expected gain every contact costs, hits too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensula.functions.columns import PROBABILITY_CUT
from mensula.operators.combine import studies_of
from mensula.operators.rank_index import RankIndex
from mensula.operators.ranks import Ranking, best_prefix, find, match, top_rows, value_of, with_rank
from mensula.sizing import settle, small_side

# Gain per hit, cost per contact, contacts to select, and the sweeps.
GAIN_PER_HIT = 780_000
CONTACT_COST = 20_000
CONTACTS = 11_000
THRESHOLD_FIRST, THRESHOLD_LAST, THRESHOLD_COUNT = 0.001, 0.1, 100
TOP_SIZES = (5000, 7000, 9000, 11000, 13000, 15000, 17000, 19000, 21000)


def thresholds(
    first: float = THRESHOLD_FIRST, last: float = THRESHOLD_LAST, count: int = THRESHOLD_COUNT
) -> list[float]:
    """Evenly spaced cuts from first to last."""
    step = (last - first) / (count - 1)
    return [i * step + first for i in range(count - 1)] + [last]


def row_gain(y: str, gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST) -> Column:
    return F.when(F.col(y) == 1, F.lit(gain)).otherwise(F.lit(-cost)).cast("long")


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient, 0 when the divisor is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))


def gain_curve(
    df: DataFrame, ranking: Ranking, y: str, gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST
) -> DataFrame:
    """Every row with its `rank` and the `gain` of contacting all rows up to it."""
    valued = df.withColumn("_gain", row_gain(y, gain, cost))
    return (
        with_rank(valued, ranking, running=["_gain"])
        .withColumnRenamed("running__gain", "gain").drop("_gain", "n_rows")
    )


def best_gain(
    df: DataFrame, ranking: Ranking, y: str, gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST
) -> DataFrame:
    """Per group: `n_rows`, maximum `gain` of the curve, and `n_contacts` that first reach it."""
    valued = df.withColumn("_gain", row_gain(y, gain, cost))
    return best_prefix(valued, ranking, "_gain").withColumnsRenamed(
        {"best": "gain", "at_rank": "n_contacts"}
    )


def gain_at_labels(
    df: DataFrame, y: str, predicted: str | Column, by: Sequence[str] = (),
    gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST,
) -> DataFrame:
    """Gain of fixed 0/1 predictions: hits earn, misses cost, the rest is free."""
    chosen = (F.col(predicted) if isinstance(predicted, str) else predicted) == 1
    earned = F.when(chosen & (F.col(y) == 1), gain).when(chosen & (F.col(y) == 0), -cost).otherwise(0)
    return df.groupBy(*by).agg(F.coalesce(F.sum(earned.cast("long")), F.lit(0)).alias("gain"))


def gain_at_cut(
    df: DataFrame, score: str, y: str, cut: float = PROBABILITY_CUT, by: Sequence[str] = (),
    gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST,
) -> DataFrame:
    """Gain of contacting every row scored above the cut."""
    return gain_at_labels(df, y, (F.col(score) > cut).cast("int"), by, gain, cost)


def bin_index(value: Column, cuts: Sequence[float]) -> Column:
    """How many of the ascending cuts are at or below the value, by halving; NULL gives 0."""
    def part(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= cuts[middle], part(middle + 1, high)).otherwise(part(low, middle))

    return part(0, len(cuts))


def threshold_sweep(
    df: DataFrame, score: str, y: str, cuts: Sequence[float] | None = None, by: Sequence[str] = (),
    gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST,
) -> DataFrame:
    """One row per cut (`score >= cut`): confusion counts, gain, precision, recall, F1.

    Each row is placed once between two cuts; the cuts then add up a few bins per group.
    """
    by = list(by)
    levels = sorted(cuts if cuts is not None else thresholds())
    value = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    bins = df.groupBy(*by, bin_index(value, levels).alias("_bin")).agg(
        F.count(F.when(F.col(y) == 1, 1)).alias("p"), F.count(F.when(F.col(y) == 0, 1)).alias("n")
    )
    group = bins.groupBy(*by).agg(
        F.collect_list(F.struct("_bin", "p", "n")).alias("_bins"),
        F.sum("p").alias("_p"), F.sum("n").alias("_n"),
    )
    cut_rows = F.posexplode(F.array(*[F.lit(float(c)) for c in levels])).alias("_at", "threshold")
    rows = group.select("*", cut_rows)

    def above(field: str) -> Column:
        return F.aggregate(
            F.filter("_bins", lambda b: b["_bin"] > F.col("_at")), F.lit(0).cast("long"),
            lambda total, b: total + b[field])

    counted = rows.select(*by, "threshold", above("p").alias("TP"), above("n").alias("FP"), "_p", "_n")
    tp, fp, fn = F.col("TP"), F.col("FP"), F.col("_p") - F.col("TP")
    money = tp * gain - (tp + fp) * cost
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return counted.select(
        *by, "threshold", (tp + fp).alias("n_contacts"), "TP", "FP",
        (F.col("_n") - fp).alias("TN"), fn.alias("FN"),
        money.alias("gain"), _ratio(money, tp + fp).alias("gain_per_contact"),
        precision.alias("precision"), recall.alias("recall"),
        _ratio(2 * precision * recall, precision + recall).alias("f1"),
    )


def hits_within(df: DataFrame | RankIndex, ranking: Ranking, y: str, sizes: Sequence[int]) -> DataFrame:
    """Per group and size n (of those not above the group's rows): `TP` among the first n rows,
    the score at rank n as `threshold`, and the group's `n_rows` and `n_positive`.

    Only the rows near the wanted ranks are sorted; the rest are counted between them, with their hits. An index of the scores, with `y`
    (0, 1) as a value, is looked up instead.
    """
    return _opened(_at_sizes(df, ranking, y, sizes), ranking)


def _at_sizes(
    df: DataFrame | RankIndex, ranking: Ranking, y: str, sizes: Sequence[int], extra: dict[str, Column] | None = None
) -> DataFrame:
    wanted = F.array(*[F.lit(int(n)).cast("long") for n in sorted(set(sizes))])
    if isinstance(df, RankIndex):
        found = df.at_ranks(wanted).withColumnRenamed(f"total_{y}", "total_hits")
        return found.withColumn("found", F.transform("found", lambda f: F.struct(
            f["rank"].alias("rank"), f["key"].alias("key"), f[f"upto_{y}"].alias("upto_hits"))))
    return find(df, ranking, wanted, {"hits": (F.col(y) == 1).cast("long")}, extra)


def _opened(found: DataFrame, ranking: Ranking) -> DataFrame:
    by = list(ranking.group)
    opened = found.select(*by, F.explode("found").alias("_edge"), "n_rows", F.col("total_hits").alias("n_positive"))
    return opened.select(
        *by, F.col("_edge.rank").alias("n_contacts"),
        value_of(F.col("_edge.key"), ranking.descending).alias("threshold"),
        F.col("_edge.upto_hits").alias("TP"), "n_rows", "n_positive",
    )


def top_n_sweep(
    df: DataFrame | RankIndex, ranking: Ranking, y: str, sizes: Sequence[int] = TOP_SIZES,
    gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST,
) -> DataFrame:
    """One row per contact count: hits, misses, cut score, gain, precision."""
    return _sized_gain(hits_within(df, ranking, y, sizes), ranking, gain, cost)


def _sized_gain(hits: DataFrame, ranking: Ranking, gain: int, cost: int) -> DataFrame:
    n, tp = F.col("n_contacts"), F.col("TP")
    money = tp * gain - n * cost
    return hits.select(
        *ranking.group, "n_contacts", "threshold", "TP", (n - tp).alias("FP"), money.alias("gain"),
        (money.cast("double") / n).alias("gain_per_contact"), (tp.cast("double") / n).alias("precision"),
    )


def month_report(
    df: DataFrame | RankIndex, ranking: Ranking, y: str, cuts: Sequence[float] | None = None,
    sizes: Sequence[int] = TOP_SIZES, fixed_size: int = CONTACTS,
    gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST,
) -> DataFrame:
    """Per group (period): size, churn, best threshold, best contact count and the fixed count."""
    by = list(ranking.group)
    indexed = isinstance(df, RankIndex)
    by_cut = threshold_sweep(df.rows if indexed else df, ranking.score, y, cuts, by, gain, cost).groupBy(*by).agg(
        F.max_by(F.struct("threshold", "gain", "n_contacts", "TP", "FP"),
                 F.struct("gain", -F.col("threshold"))).alias("best_threshold"))
    about = {"n_positive": F.sum(y).cast("long"), "churn_rate": F.avg(y)}
    found = _at_sizes(df, ranking, y, sorted({*sizes, fixed_size}), about)
    if indexed:
        found = found.withColumns({"n_positive": F.col("total_hits"), "churn_rate": F.try_divide(F.col("total_hits").cast("double"), F.col("n_rows"))})
    sweep = _sized_gain(_opened(found, ranking), ranking, gain, cost)
    row = F.struct("n_contacts", "gain", "TP", "threshold", "precision")
    listed = F.col("n_contacts").isin(*[int(s) for s in sizes])
    by_size = sweep.groupBy(*by).agg(
        F.max_by(F.when(listed, row), F.when(listed, F.struct("gain", -F.col("n_contacts")))).alias("best_size"),
        F.max(F.when(F.col("n_contacts") == fixed_size, row)).alias("fixed_size"),
    )
    return match(match(found.select(*by, "n_rows", *about), by_cut, by, "left"), by_size, by, "left")


# Selecting whom to contact.

def select_top(df: DataFrame, ranking: Ranking, n: int = CONTACTS) -> DataFrame:
    """The n best rows (all of a smaller table)."""
    return top_rows(df, ranking, n)


def cut_score(selected: DataFrame, score: str) -> DataFrame:
    """Rows and the lowest score of a selection."""
    return selected.agg(F.count("*").alias("n_contacts"), F.min(score).alias("threshold"))


def select_break_even(
    df: DataFrame, score: str, gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST
) -> DataFrame:
    """Rows whose expected earnings exceed the contact cost."""
    return df.where(F.col(score) > cost / gain)


def expected_gain(
    selected: DataFrame, score: str, gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST
) -> DataFrame:
    """Expected gain of a selection, from its scores alone."""
    expected = F.coalesce(F.sum(F.col(score) * gain - cost), F.lit(0.0))
    n = F.count("*")
    return selected.agg(
        expected.alias("expected_gain"), n.alias("n_contacts"),
        F.coalesce(F.sum(score), F.lit(0.0)).alias("expected_positives"),
        _ratio(expected, n).alias("gain_per_contact"),
        F.coalesce(F.avg(score), F.lit(0.0)).alias("mean_score"),
    )


def compare_strategies(
    df: DataFrame, ranking: Ranking, n: int = CONTACTS,
    gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST,
) -> DataFrame:
    """Expected gain of the top-n and the break-even selection; `recommended` marks the better.

    Of equal ones the break-even selection is recommended.
    """
    top = expected_gain(select_top(df, ranking, n), ranking.score, gain, cost)
    even = expected_gain(select_break_even(df, ranking.score, gain, cost), ranking.score, gain, cost)
    both = top.withColumn("strategy", F.lit("top_n")).unionByName(
        even.withColumn("strategy", F.lit("break_even")))
    paired = both.agg(F.collect_list(F.struct(*both.columns)).alias("rows"),
                      F.max_by("strategy", F.struct("expected_gain", F.col("strategy") == "break_even"))
                      .alias("chosen"))
    return paired.select(F.explode("rows").alias("r"), "chosen").select(
        "r.*", (F.col("r.strategy") == F.col("chosen")).cast("int").alias("recommended"))


# Ensembles.

def seed_average(
    scores: DataFrame, keys: Sequence[str], proba: str = "proba", keep: Sequence[str] = ()
) -> DataFrame:
    """Mean score over whatever `keys` leave out."""
    return scores.groupBy(*keys).agg(F.avg(proba).alias(proba), *[F.max(c).alias(c) for c in keep])


def _study_means(
    scores: DataFrame, entity: str, study: str, proba: str, y: str, split: Sequence[str], names: Sequence
) -> DataFrame:
    """One row per entity: label, mean over all models, and each study's mean."""
    means = [F.avg(F.when(F.col(study) == s, F.col(proba))) for s in names]
    return scores.groupBy(*split, entity).agg(
        F.max(y).alias(y), F.avg(proba).alias("_simple"),
        *[m.alias(f"_study_{i}") for i, m in enumerate(means)],
    )


def _strategies(
    wide: DataFrame, entity: str, proba: str, y: str, split: Sequence[str], names: Sequence
) -> DataFrame:
    per_study = F.array_compact(F.array(*[F.col(f"_study_{i}") for i in range(len(names))]))
    two_stage = F.aggregate(
        per_study, F.lit(0.0), lambda total, v: total + v, lambda total: total / F.size(per_study))
    options = [("simple", F.col("_simple")), ("two_stage", two_stage)]
    options += [(f"study_{s}", F.col(f"_study_{i}")) for i, s in enumerate(names)]
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("strategy"), c.alias("proba")) for n, c in options]))
    return (
        wide.select(*split, entity, y, rows.alias("r"))
        .select(*split, entity, y, "r.strategy", F.col("r.proba").alias(proba))
        .where(F.col(proba).isNotNull())
    )


def ensemble_scores(
    scores: DataFrame, entity: str = "entity", study: str = "study", proba: str = "proba", y: str = "y",
    split: Sequence[str] = (), studies: Sequence | None = None,
) -> DataFrame:
    """Long scores per `strategy`: mean over all models, mean of study means, each study's mean.

    One aggregation by entity; a strategy's row appears where the entity has its scores.
    """
    names = list(studies) if studies is not None else studies_of(scores, study)
    wide = _study_means(scores, entity, study, proba, y, split, names)
    return _strategies(wide, entity, proba, y, split, names)


def ensemble_report(
    scores: DataFrame, entity: str = "entity", study: str = "study", proba: str = "proba", y: str = "y",
    split: Sequence[str] = (), studies: Sequence | None = None,
    gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST, rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """Gain and contacts of every strategy, and its difference from the plain mean.

    The means are written once; ranking reads them several times.
    """
    names = list(studies) if studies is not None else studies_of(scores, study)
    wide = settle(_study_means(scores, entity, study, proba, y, split, names))
    long = _strategies(wide, entity, proba, y, split, names)
    ranking = Ranking(proba, (entity,), (*split, "strategy"), rows_per_bucket=rows_per_bucket)
    best = small_side(best_gain(long, ranking, y, gain, cost))
    plain = best.where(F.col("strategy") == "simple").select(*split, F.col("gain").alias("_plain"))
    if split:
        joined = match(best, plain, list(split), "left")
    else:
        joined = best.withColumn("_plain", plain.select("_plain").scalar())
    return joined.select(
        *split, "strategy", "gain", "n_contacts", (F.col("gain") - F.col("_plain")).alias("difference"))


def seed_report(
    scores: DataFrame, entity: str = "entity", seed: str = "seed", proba: str = "proba", y: str = "y",
    gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST, rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """Test result of each seed and of the seeds' mean: gain, contacts, share contacted."""
    single = scores.select(entity, y, proba, F.col(seed).cast("string").alias("model"))
    mean = settle(seed_average(scores, [entity], proba, keep=[y])).withColumn("model", F.lit("mean"))
    ranking = Ranking(proba, (entity,), ("model",), rows_per_bucket=rows_per_bucket)
    best = best_gain(single.unionByName(mean), ranking, y, gain, cost)
    return best.select(
        "model", "n_rows", "gain", "n_contacts", (F.col("n_contacts") / F.col("n_rows") * 100).alias("pct_contacted"))


def model_results(
    scores: DataFrame, splits: Sequence[str], entity: str = "entity", study: str = "study",
    seed: str = "seed", split: str = "split", proba: str = "proba", y: str = "y",
    gain: int = GAIN_PER_HIT, cost: int = CONTACT_COST, rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """One row per study and seed: rows, classes, and gain and contacts on each named split."""
    ranking = Ranking(proba, (entity,), (study, seed, split), rows_per_bucket=rows_per_bucket)
    best = best_gain(scores, ranking, y, gain, cost)
    per_split = best.groupBy(study, seed).agg(*[
        F.max(F.when(F.col(split) == s, F.col(c))).alias(f"{c}_{s}")
        for s in splits for c in ("gain", "n_contacts")
    ])
    counts = scores.groupBy(study, seed).agg(
        F.count("*").alias("n_rows"),
        F.count(F.when(F.col(y) == 0, 1)).alias("n_class_0"),
        F.count(F.when(F.col(y) == 1, 1)).alias("n_class_1"),
    )
    return match(counts, per_split, [study, seed], "left")
