"""Putting tables together: unions, score alignment, membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensula.panel import distinct_values
from mensula.sizing import small_side


def check_same_schema(base: DataFrame, new: DataFrame) -> None:
    ours, theirs = dict(base.dtypes), dict(new.dtypes)
    wrong = sorted(c for c in ours.keys() | theirs.keys() if ours.get(c) != theirs.get(c))
    if wrong:
        raise ValueError(f"columns that differ: {[(c, ours.get(c), theirs.get(c)) for c in wrong]}")


def stack(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of every table, matched by column name."""
    out = first
    for other in others:
        out = out.unionByName(other)
    return out


def append_distinct(base: DataFrame, new: DataFrame) -> DataFrame:
    """Distinct rows of both tables, where `base` has no row twice.

    Only digests of the rows, 128 bits each, are grouped. Rows whose digest stands once go through as they are;
    the others, which are alike or happen to share a digest, are compared whole. So wide rows are exchanged only
    as far as both tables share them.
    """
    check_same_schema(base, new)
    both = _digested(base).unionByName(_digested(new))
    again = both.groupBy("_a", "_b").agg(F.count("*").alias("_n")).where("_n > 1").select(F.col("_a").alias("_x"), F.col("_b").alias("_y"))
    shared = small_side(again)
    same = (F.col("_a") == F.col("_x")) & (F.col("_b") == F.col("_y"))
    alone = both.join(shared, same, "left_anti")
    alike = both.join(shared, same, "left_semi")
    return alone.select(*base.columns).unionByName(alike.select(*base.columns).distinct())


def _digested(df: DataFrame) -> DataFrame:
    row = F.struct(*sorted(df.columns))
    return df.select("*", digest(row, 0).alias("_a"), digest(row, 1).alias("_b"))


def digest(row: Column, number: int) -> Column:
    """One of two independent hashes of a row."""
    return F.xxhash64(F.lit(number), row)


def append_period(
    base: DataFrame, new: DataFrame, period: str | None = None, base_is_distinct: bool = False
) -> DataFrame:
    """Distinct rows of both tables. A revised row does not replace the old one.

    With `period` given and a base known to be free of duplicates, only the base's rows of
    the new file's periods are compared; its other periods pass through unshuffled.
    """
    check_same_schema(base, new)
    if period is None or not base_is_distinct:
        return base.unionByName(new).distinct()
    periods = small_side(distinct_values(new, period).where(F.col(period).isNotNull()).withColumn("_new", F.lit(True)))
    marked = base.join(periods, period, "left")
    shared = F.col("_new").isNotNull() | F.col(period).isNull()
    others = marked.where(~shared).select(base.columns)
    return others.unionByName(append_distinct(marked.where(shared).select(base.columns), new))


def studies_of(scores: DataFrame, study: str = "study") -> list:
    """Study names in order; a short list by nature."""
    return [r[0] for r in distinct_values(scores, study).orderBy(study).collect()]


def align_studies(
    scores: DataFrame, entity: str = "entity", study: str = "study", proba: str = "proba",
    studies: Sequence | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """Entities scored by every study: one `proba_<study>` column each and their mean.

    Repeated scores of a study (its seeds) are averaged. One aggregation by entity stands
    for the chain of inner joins. `keep` carries columns that are equal in all scores.
    """
    names = list(studies) if studies is not None else studies_of(scores, study)
    per_study = [F.avg(F.when(F.col(study) == s, F.col(proba))).alias(f"proba_{s}") for s in names]
    wide = scores.groupBy(entity).agg(*per_study, *[F.max(c).alias(c) for c in keep])
    complete = wide.dropna(subset=[f"proba_{s}" for s in names])
    summed = sum((F.col(f"proba_{s}") for s in names), F.lit(0.0))
    return complete.withColumn("probabilidad_ensemble", summed / len(names))


def alignment_loss(
    scores: DataFrame, entity: str = "entity", study: str = "study", studies: Sequence | None = None
) -> DataFrame:
    """Per study: entities it scored, entities all studies share, and the percentage lost."""
    names = list(studies) if studies is not None else studies_of(scores, study)
    has = [F.max((F.col(study) == s).cast("int")).alias(f"_{i}") for i, s in enumerate(names)]
    seen = scores.groupBy(entity).agg(*has)
    everywhere = F.least(*[F.col(f"_{i}") for i in range(len(names))]) if len(names) > 1 else F.col("_0")
    counts = seen.agg(
        *[F.sum(f"_{i}").alias(f"_{i}") for i in range(len(names))],
        F.coalesce(F.sum(everywhere), F.lit(0)).alias("n_shared"),
    )
    kind = scores.schema[study].dataType
    rows = F.explode(F.array(*[
        F.struct(F.lit(s).cast(kind).alias("study"), F.col(f"_{i}").alias("n_scored"))
        for i, s in enumerate(names)
    ]))
    return counts.select(rows.alias("r"), "n_shared").select(
        F.col("r.study").alias("study"), F.col("r.n_scored").alias("n_scored"), "n_shared",
        F.try_divide((F.col("r.n_scored") - F.col("n_shared")) * 100.0, F.col("r.n_scored")).alias("pct_lost"),
    )


def members(df: DataFrame, selected: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in `selected`."""
    return df.join(selected, [on] if isinstance(on, str) else list(on), "left_semi")


def key_agreement(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys both tables hold and how many only one of them; equal when both are 0."""
    tagged = (
        left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionByName(right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    )
    seen = tagged.groupBy(*keys).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return seen.agg(
        F.count(F.when((F.col("_l") == 1) & (F.col("_r") == 1), 1)).alias("n_both"),
        F.count(F.when(F.col("_r") == 0, 1)).alias("n_only_left"),
        F.count(F.when(F.col("_l") == 0, 1)).alias("n_only_right"),
    )
