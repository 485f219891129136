"""A score table stored in rank order, for any number of reports by rank.

Rows are written once, by group and key range: every bucket is a folder of its own, in key order. A small table tells how many rows
each bucket has, what they sum to, which keys it spans and what stands before it; another one has the facts of each group. A
report looks ranks up in the small tables and reads only the buckets that hold them, instead of cutting and counting the table anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mensula.operators.ranks import Ranking, match, with_buckets
from mensula.sizing import fetched, settle, side_of, small_side

# More buckets than this are looked up by a join instead of a list of folders.
LISTED = 10_000


@dataclass(frozen=True)
class RankIndex:
    """`rows`: group, score, ties, values and `_bucket_id`; `buckets` and `groups`: the small tables."""

    ranking: Ranking
    values: tuple[str, ...]
    rows: DataFrame
    buckets: DataFrame
    groups: DataFrame

    def at_ranks(self, ranks: Column) -> DataFrame:
        """What stands at the given ranks, in the form of `ranks.find`: the group's facts, `total_<value>`, and `found`, an array of
        (rank, key, `upto_<value>`). `ranks` is computed from the facts of a group (`n_rows`, `n_known`)."""
        group, sums = list(self.ranking.group), self.values
        facts = [c for c in self.groups.columns if c not in group]
        wanted = F.array_sort(F.array_distinct(F.filter(ranks.cast("array<long>"), lambda r: (r >= 1) & (r <= F.col("n_rows")))))
        own = F.filter("_all", lambda r: (r > F.col("first_rank")) & (r <= F.col("first_rank") + F.col("n")))
        # The first bucket of a group without any wanted rank tells of the group.
        needed = match(self.buckets, self.groups.withColumn("_all", wanted), group).withColumn("_ranks", own).where(
            (F.size("_ranks") > 0) | ((F.size("_all") == 0) & (F.col("first_rank") == 0))
        ).select("_bucket_id", *group, *facts, "first_rank", "_ranks", *[f"before_{v}" for v in sums])
        got = fetched(needed)
        needed = settle(needed) if got is None else side_of(got, needed)
        if got is not None and got.num_rows <= LISTED:
            rows = self.rows.where(F.col("_bucket_id").isin(got["_bucket_id"].to_pylist()))
        else:
            rows = self.rows.join(needed.select("_bucket_id"), "_bucket_id", "left_semi")
        local = Window.partitionBy("_bucket_id").orderBy(*self.ranking.order())
        upto = local.rowsBetween(Window.unboundedPreceding, 0)
        placed = rows.select(
            "_bucket_id", self.ranking.key().alias("key"), F.row_number().over(local).alias("_place"),
            *[F.coalesce(F.sum(v).over(upto), F.lit(0)).alias(f"_upto_{v}") for v in sums])
        here = F.array_contains("_ranks", F.col("rank"))
        hits = placed.join(needed, "_bucket_id").withColumn("rank", F.col("first_rank") + F.col("_place")).where(
            here | ((F.size("_ranks") == 0) & (F.col("_place") == 1)))
        entry = F.when(here, F.struct("rank", "key", *[(F.col(f"before_{v}") + F.col(f"_upto_{v}")).alias(f"upto_{v}") for v in sums]))
        return hits.groupBy(*group).agg(
            *[F.first(c).alias(c) for c in facts], F.array_sort(F.collect_list(entry)).alias("found"))


def build(df: DataFrame, ranking: Ranking, path: str, values: Sequence[str] = ()) -> RankIndex:
    """Writes the index of `df` below `path`. `values` are whole-number columns to be summed up in rank order.

    The facts of a group are `n_rows`, `n_known` (scores that are not NULL), `mean`, `std` (population), `min` and `max` of the score, and
    `total_<value>`.
    """
    group = list(ranking.group)
    columns = [*group, ranking.score, *ranking.ties, *[v for v in values if v not in (*group, ranking.score, *ranking.ties)]]
    bucketed = with_buckets(df.select(*columns), ranking)
    # A number per group and bucket, from hashes: the folder's name.
    named = bucketed.withColumn("_bucket_id", F.xxhash64(*group, "_bucket")).drop("_key")
    order = [F.col("_bucket_id"), *ranking.order()]
    named.repartition("_bucket_id").sortWithinPartitions(*order).write.partitionBy("_bucket_id").parquet(f"{path}/rows")
    stored = df.sparkSession.read.schema(named.schema).parquet(f"{path}/rows")
    key = ranking.key()
    per_bucket = stored.groupBy(*group, "_bucket", "_bucket_id").agg(
        F.count("*").alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key"),
        *[F.coalesce(F.sum(v), F.lit(0)).alias(f"sum_{v}") for v in values])
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    per_bucket.select(
        "*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"),
        *[F.coalesce(F.sum(f"sum_{v}").over(before), F.lit(0)).alias(f"before_{v}") for v in values],
    ).write.parquet(f"{path}/buckets")
    stored.groupBy(*group).agg(
        F.count("*").alias("n_rows"), F.count(ranking.score).alias("n_known"), F.avg(ranking.score).alias("mean"),
        F.stddev_pop(ranking.score).alias("std"), F.min(ranking.score).alias("min"), F.max(ranking.score).alias("max"),
        *[F.coalesce(F.sum(v), F.lit(0)).alias(f"total_{v}") for v in values],
    ).write.parquet(f"{path}/groups")
    return load(df.sparkSession, ranking, path, values, named)


def load(spark: SparkSession, ranking: Ranking, path: str, values: Sequence[str] = (), like: DataFrame | None = None) -> RankIndex:
    """The index written below `path`; its small tables are broadcast when their size allows."""
    rows = spark.read.parquet(f"{path}/rows") if like is None else spark.read.schema(like.schema).parquet(f"{path}/rows")
    rows = rows.withColumn("_bucket_id", F.col("_bucket_id").cast("long"))
    small = [small_side(spark.read.parquet(f"{path}/{name}")) for name in ("buckets", "groups")]
    return RankIndex(ranking, tuple(values), rows, *small)
