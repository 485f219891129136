"""Exact ranks, order statistics and running sums over a whole group, spread over tasks.

A window over a group without further partitioning sorts that group in one task. Here each
group is cut into ordered buckets at keys taken from a small sample. The cut keys are fixed
before the real work starts, so a row's bucket depends on the row alone and a recomputed
task gives the same answer. The sample only sets bucket sizes; results use every row. Cuts
are on (score, tie-break) together, so a score shared by a third of all rows is split too.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensula import sizing
from mensula.sizing import fetched, settle, side_of, small_side

SAMPLES_PER_BUCKET = 24
SHORT_ARRAY = 8
# Spans are a few numbers and group values each, so as many more of them are broadcast than of other small sides.
SPANS_TO_BROADCAST = 5


@dataclass(frozen=True)
class Ranking:
    """Order of rows inside groups: by score, NULL and NaN last, then by `ties` ascending."""

    score: str
    ties: tuple[str, ...] = ()
    group: tuple[str, ...] = ()
    descending: bool = True
    rows_per_bucket: int = 1_000_000

    def key(self) -> Column:
        return sort_key(F.col(self.score), self.ties, self.descending)

    def order(self) -> list[Column]:
        score = F.col(self.score)
        return [(-score if self.descending else score).asc_nulls_last(),
                *[F.col(t).asc() for t in self.ties]]

    def key_order(self) -> list[Column]:
        """The same order, from the fields of `_key`."""
        return [F.col("_key.score").asc_nulls_last(),
                *[F.col(f"_key.tie_{i}").asc() for i in range(len(self.ties))]]


def sort_key(score: Column, ties: Sequence[str], descending: bool = True) -> Column:
    """A struct that compares as the ranking orders."""
    return F.struct(
        score.isNull().cast("int").alias("missing"),
        (-score if descending else score).alias("score"),
        *[F.col(t).alias(f"tie_{i}") for i, t in enumerate(ties)],
    )


def with_place(
    df: DataFrame, array: str, key: Column, name: str, longest: int, closed: bool = True
) -> DataFrame:
    """Add how many elements of an ascending array column are at or below `key` (below it when
    not `closed`), for arrays of at most `longest` elements.

    A short array is compared element by element in one expression. A long one is searched
    by halving, one projection per bit. Each names the one before three times, so written out the search would have
    3^bits terms, and the optimizer writes it out for a filter or a join on the result. It does
    not look through an explode, here of an array of the one result.
    """
    def passed(at: Column) -> Column:
        probe = F.get(array, at)
        return probe <= key if closed else probe < key

    if longest <= SHORT_ARRAY:
        steps = [F.when(passed(F.lit(i)), 1).otherwise(0) for i in range(longest)]
        return df.withColumn(name, reduce(add, steps, F.lit(0)))
    out = df.withColumn(name, F.lit(0))
    for bit in reversed(range(longest.bit_length())):
        step = 1 << bit
        found = F.col(name)
        out = out.withColumn(name, F.when(passed(found + (step - 1)), found + step).otherwise(found))
    return out.withColumn(name, F.explode(F.array(name)))


def _cuts(keyed: DataFrame, ranking: Ranking) -> tuple[DataFrame, int] | None:
    """(`_g<i>` group values, `_cuts` ascending keys) of the groups that need cutting, and the longest list of cuts.

    Each group gets buckets by its own size: every `rows_per_bucket` rows give some samples on
    average, whatever the number of groups. The table is fixed before it is used: fetched when it is small, else written.
    """
    share = min(1.0, SAMPLES_PER_BUCKET / ranking.rows_per_bucket)
    per_bucket = share * ranking.rows_per_bucket
    names = [f"_g{i}" for i in range(len(ranking.group))]
    sample = (
        keyed.select(*[F.col(g).alias(n) for g, n in zip(ranking.group, names)], "_key").sample(share, seed=7)
        .groupBy(*names).agg(F.sort_array(F.collect_list("_key")).alias("_keys"))
    )
    length = F.size("_keys")
    parts = F.ceil(length / per_bucket).cast("int")
    at = lambda i: F.get("_keys", (i.cast("long") * length / parts).cast("int"))
    chosen = F.transform(F.sequence(F.lit(1), parts - 1), at)
    # Ascending, so that equal ones are neighbours: array_distinct would compare all pairs of structs.
    new = lambda key, i: (i == 0) | ~key.eqNullSafe(F.get("_at", i - 1))
    cuts = sample.where(length > per_bucket).select(*names, chosen.alias("_at")).select(*names, F.filter("_at", new).alias("_cuts"))
    table = small_side(cuts)
    if table is cuts:
        table = settle(cuts)
    longest = table.agg(F.max(F.size("_cuts"))).first()[0]
    return (table, longest) if longest else None


def with_buckets(df: DataFrame, ranking: Ranking) -> DataFrame:
    """Add `_key` and `_bucket`; every key in bucket b sorts before every key in b+1."""
    keyed = df.select("*", ranking.key().alias("_key"))
    return _bucketed(keyed, ranking, _cuts(keyed, ranking))


def _bucketed(keyed: DataFrame, ranking: Ranking, cuts: tuple[DataFrame, int] | None) -> DataFrame:
    if cuts is None:
        return keyed.withColumn("_bucket", F.lit(0))
    table, longest = cuts
    names = [f"_g{i}" for i in range(len(ranking.group))]
    if names:
        same = [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(ranking.group, names)]
        joined = keyed.join(table, same, "left")
    else:
        joined = keyed.select("*", table.select("_cuts").scalar().alias("_cuts"))
    return with_place(joined, "_cuts", F.col("_key"), "_bucket", longest).drop("_cuts", *names)


def _spans(bucketed: DataFrame, ranking: Ranking, sums: Sequence[str] = ()) -> DataFrame:
    """One row per bucket: rows and sums before it, its rows, and the group's rows."""
    group = list(ranking.group)
    per_bucket = bucketed.groupBy(*group, "_bucket").agg(
        F.count("*").alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in sums]
    )
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*group)
    return per_bucket.select(
        *group, "_bucket", "_n",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(everything).alias("n_rows"),
        *[F.col(f"_sum_{c}") for c in sums],
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in sums],
    )


def match(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """NULL-safe equi-join that keeps the left copy of the key columns.

    Without columns `right` has one row at most, which is put beside every row of `left`; its columns are NULL when it has none.
    """
    if not columns:
        only = right.select(F.struct(*right.columns)).scalar()
        return left.select("*", only.alias("_only")).select(*left.columns, "_only.*")
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in columns})
    same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in columns]
    return left.join(renamed, same, how).drop(*[f"_right_{c}" for c in columns])


def with_rank(df: DataFrame, ranking: Ranking, running: Sequence[str] = ()) -> DataFrame:
    """Add `rank` (from 1), the group's `n_rows`, and `running_<column>` sums in rank order."""
    bucketed = with_buckets(df, ranking)
    # Written, because all rows are read to count them; there is a span per bucket, so their number grows with the rows.
    spans = settle(_spans(bucketed, ranking, running))
    most = SPANS_TO_BROADCAST * sizing.BROADCAST_ROWS
    if spans.limit(most + 1).count() <= most:
        spans = F.broadcast(spans)
    local = Window.partitionBy(*ranking.group, "_bucket").orderBy(*ranking.order())
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    rows = bucketed.select(
        "*", F.row_number().over(local).alias("_place"),
        *[F.sum(c).over(upto).alias(f"_local_{c}") for c in running],
    )
    joined = match(rows, spans.drop("_n"), [*ranking.group, "_bucket"])
    return joined.select(
        *df.columns,
        (F.col("_before") + F.col("_place")).alias("rank"),
        "n_rows",
        *[(F.col(f"_before_{c}") + F.col(f"_local_{c}")).alias(f"running_{c}") for c in running],
    )


def best_prefix(df: DataFrame, ranking: Ranking, value: str) -> DataFrame:
    """Per group: rows, the largest running sum of `value` and the first rank that reaches it.

    Each bucket reports only its own best; the running offsets are added to those few rows.
    """
    group = list(ranking.group)
    bucketed = with_buckets(df.select(*group, ranking.score, *ranking.ties, value), ranking)
    local = Window.partitionBy(*group, "_bucket").orderBy(*ranking.order())
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    running = bucketed.select(
        *group, "_bucket", value,
        F.row_number().over(local).alias("_place"), F.sum(value).over(upto).alias("_running"),
    )
    per_bucket = running.groupBy(*group, "_bucket").agg(
        F.count("*").alias("_n"),
        F.sum(value).alias("_total"),
        F.max(F.struct("_running", (-F.col("_place")).alias("_place"))).alias("_best"),
    )
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_bucket.select(
        *group, "_n",
        (F.coalesce(F.sum("_total").over(earlier), F.lit(0)) + F.col("_best._running")).alias("best"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_best._place")).alias("at_rank"),
    )
    return placed.groupBy(*group).agg(
        F.sum("_n").alias("n_rows"),
        F.max("best").alias("best"),
        F.max(F.struct("best", (-F.col("at_rank")).alias("r"))).alias("_top"),
    ).select(*group, "n_rows", "best", (-F.col("_top.r")).alias("at_rank"))


# Size of a quantile sketch and how many of its quantiles are read off; the rank error is three times that which
# a sketch of this size exceeds in one case of a hundred. A wrong bracket is noticed, and the ranks are then found without brackets.
SKETCH_K, GRID, RANK_ERROR = 16_384, 4_096, 0.0011


def _as_double(key: Column) -> Column:
    """The score of a key as a double that never falls where keys rise; missing ones and NaN are infinite."""
    number = key["score"].cast("double")
    return F.when((key["missing"] == 1) | F.isnan(number), float("inf")).otherwise(number)


def _brackets(
    keyed: DataFrame, ranking: Ranking, ranks: Column, sums: list[str], extra: dict[str, Column], error: float
) -> DataFrame:
    """Per group: `n_rows`, totals, `extra`, the wanted `_ranks`, and for each the scores `_los` and `_his` between which it lies.

    `_near` tells about how many rows a bracket holds at most. One pass, with a mergeable sketch per group.
    """
    # One text instead of thousands of literals, which every rule of the optimizer would visit.
    parts = F.split(F.lit(" ".join(repr(i / GRID) for i in range(GRID + 1))), " ").cast("array<double>")
    sketched = _totals(keyed, ranking.group, sums, extra, F.kll_sketch_agg_double("_at", F.lit(SKETCH_K)).alias("_sketch"))
    n = F.col("n_rows")
    grid = F.when(n > 0, F.kll_sketch_get_quantile_double("_sketch", parts))
    table = sketched.select(*[c for c in sketched.columns if c != "_sketch"], grid.alias("_grid"), _wanted(ranks).alias("_ranks"))
    below = lambda r: F.floor(((r - 2) / n - error) * GRID).cast("int")
    above = lambda r: F.ceil(((r + 1) / n + error) * GRID).cast("int")
    los = F.transform("_ranks", lambda r: F.when(below(r) >= 0, F.get("_grid", below(r))).otherwise(float("-inf")))
    his = F.transform("_ranks", lambda r: F.when(above(r) <= GRID, F.get("_grid", above(r))).otherwise(float("inf")))
    table = table.withColumns({"_los": los, "_his": his})
    if ranking.ties:
        # Rows that share a score are not counted together, so a common score makes its bracket large.
        table = table.withColumn("_down", F.reverse("_grid"))
        first = lambda b: F.greatest(F.array_position("_grid", b["_los"]), F.lit(1))
        last = lambda b: F.lit(GRID + 2) - F.greatest(F.array_position("_down", b["_his"]), F.lit(1))
        held = F.transform(F.arrays_zip("_los", "_his"), lambda b: last(b) - first(b))
        share = (F.coalesce(F.array_max(held), F.lit(0)) + 2) / GRID
    else:
        share = F.lit(2 * (error + 2 / GRID))
    return table.withColumn("_near", F.least(n, F.ceil(n * share) + 4)).drop("_grid", "_down")


def _totals(keyed: DataFrame, group: Sequence[str], sums: list[str], extra: dict[str, Column], *more: Column) -> DataFrame:
    return keyed.groupBy(*group).agg(
        F.count("*").alias("n_rows"), *[F.coalesce(F.sum(f"_s_{name}"), F.lit(0)).alias(f"total_{name}") for name in sums],
        *[c.alias(name) for name, c in extra.items()], *more)


def _wanted(ranks: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(ranks.cast("array<long>"), lambda r: (r >= 1) & (r <= F.col("n_rows")))))


def find(
    df: DataFrame, ranking: Ranking, ranks: Column, sums: dict[str, Column] | None = None,
    extra: dict[str, Column] | None = None, error: float = RANK_ERROR,
) -> DataFrame:
    """What stands at the given ranks of each group, and what rows up to there sum to; one row per group, written or fetched.

    The result has the group, `n_rows`, `total_<name>` of all rows, and `found`, an array of (rank, key, `upto_<name>`) in rank
    order, where `upto_` is the sum over all rows up to that key. `extra` names aggregates of the whole group that are
    taken along. `ranks` is an array of longs, computed from `n_rows` and `extra`; ranks outside 1..n_rows are left out.

    A first pass sketches each group's scores, which puts every wanted rank between two scores, by a
    known error. A second pass counts the rows between the brackets and sorts only those inside. A
    bracket with more rows than a bucket is cut into buckets first. Without `ties`, equal scores are counted
    together before the shuffle; `ties` should make keys unique. Scores that are no numbers are cut into buckets at once.
    """
    sums, extra, group = sums or {}, extra or {}, list(ranking.group)
    keyed = df.select("*", ranking.key().alias("_key"), *[c.cast("long").alias(f"_s_{name}") for name, c in sums.items()])
    if not isinstance(df.schema[ranking.score].dataType, T.NumericType):
        return settle(_found_in_buckets(keyed, ranking, ranks, list(sums), extra))
    keyed = keyed.withColumn("_at", _as_double(F.col("_key")))
    table = _brackets(keyed, ranking, ranks, list(sums), extra, error)
    rows = fetched(table)
    if rows is None:
        table = settle(table)
        near, longest = table.agg(F.max("_near"), F.max(F.size("_ranks"))).first()
    else:
        table = side_of(rows, table)
        near = max(rows["_near"].to_pylist(), default=0)
        longest = max((len(r) for r in rows["_ranks"].to_pylist()), default=0)
    told = ["n_rows", *[f"total_{name}" for name in sums], *extra]
    if not longest:
        return table.select(*group, *told, F.array().cast(_found_type(keyed, list(sums))).alias("found"))

    counted = _counted(keyed, table, group, longest, list(sums))
    if near > ranking.rows_per_bucket:
        out = _found_in_large_brackets(settle(counted), table, ranking, list(sums), told)
    else:
        out = _found_in_brackets(counted, table, group, list(sums), told)
    got = fetched(out)
    written = settle(out) if got is None else side_of(got, out)
    whole = F.forall("found", lambda f: f["key"].isNotNull()) & (F.size("found") == F.size("_ranks"))
    if not written.where(~F.coalesce(whole, F.lit(False))).isEmpty():
        return settle(_found_in_buckets(keyed, ranking, ranks, list(sums), extra))
    return written.drop("_ranks")


def _found_type(keyed: DataFrame, sums: list[str]) -> str:
    more = "".join(f", upto_{name}: long" for name in sums)
    return f"array<struct<rank: long, key: {keyed.schema['_key'].dataType.simpleString()}{more}>>"


def _counted(keyed: DataFrame, table: DataFrame, group: list[str], longest: int, sums: list[str]) -> DataFrame:
    """`_copies` (rows) and sums per `_place`, ascending over the brackets and the gaps between them, and inside a bracket per key."""
    joined = match(keyed, table.select(*group, "_los", "_his"), group)
    begun = with_place(joined, "_los", F.col("_at"), "_begun", longest)
    passed = with_place(begun, "_his", F.col("_at"), "_passed", longest, closed=False)
    # Both counts rise with the score, so their sum tells every stretch apart.
    placed = passed.select(
        *group, (F.col("_begun") + F.col("_passed")).alias("_place"),
        F.when(F.col("_begun") > F.col("_passed"), F.col("_key")).alias("_key"), *[f"_s_{name}" for name in sums])
    return placed.groupBy(*group, "_place", "_key").agg(
        F.count("*").alias("_copies"), *[F.coalesce(F.sum(f"_s_{name}"), F.lit(0)).alias(f"_s_{name}") for name in sums])


def _listed(hits: DataFrame, group: list[str], others: list[str], sums: list[str]) -> DataFrame:
    """(rank, key, sums) rows as one array per group; rows without a rank give none."""
    entry = F.when(F.col("rank").isNotNull(), F.struct("rank", "key", *[f"upto_{name}" for name in sums]))
    return hits.groupBy(*group).agg(*[F.first(c).alias(c) for c in others], F.array_sort(F.collect_list(entry)).alias("found"))


def _found_in_brackets(counted: DataFrame, table: DataFrame, group: list[str], sums: list[str], told: list[str]) -> DataFrame:
    """Keys at the wanted ranks, from one running count per group over gaps and rows inside brackets."""
    upto = Window.partitionBy(*group).orderBy("_place", "_key").rowsBetween(Window.unboundedPreceding, 0)
    running = counted.select(
        *group, "_key", "_copies", F.sum("_copies").over(upto).alias("_upto"),
        *[F.sum(f"_s_{name}").over(upto).alias(f"upto_{name}") for name in sums],
    )
    others = [*told, "_ranks"]
    wanted = match(running, table.select(*group, *others), group)
    hit = F.filter("_ranks", lambda r: (r <= F.col("_upto")) & (r > F.col("_upto") - F.col("_copies")))
    # The first row of a group stays in any case, so that a group without wanted ranks is told of too.
    hits = wanted.where((F.size(hit) > 0) | (F.col("_upto") == F.col("_copies"))).select(
        *group, *others, F.explode_outer(hit).alias("rank"), F.col("_key").alias("key"), *[f"upto_{name}" for name in sums])
    return _listed(hits, group, others, sums)


def _found_in_large_brackets(
    counted: DataFrame, table: DataFrame, ranking: Ranking, sums: list[str], told: list[str]
) -> DataFrame:
    """The same for brackets that hold more rows than a task should sort: each is a group that is cut into buckets."""
    group, within = list(ranking.group), [*ranking.group, "_place"]
    before = Window.partitionBy(*group).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    spans = counted.groupBy(*within, F.col("_key").isNotNull().alias("_inside")).agg(
        *[F.sum(c).alias(c) for c in ("_copies", *[f"_s_{name}" for name in sums])])
    spans = spans.select("*", earlier("_copies").alias("_first"), *[earlier(f"_s_{name}").alias(f"_b_{name}") for name in sums])
    own = F.filter("_ranks", lambda r: (r > F.col("_first")) & (r <= F.col("_first") + F.col("_copies")))
    wanted = match(spans, table.select(*group, "_ranks"), group).withColumn("_own", own).where("_inside and size(_own) > 0").select(
        *within, "_first", F.transform("_own", lambda r: r - F.col("_first")).alias("_within"), *[f"_b_{name}" for name in sums])
    rows = fetched(wanted)
    wanted = settle(wanted) if rows is None else side_of(rows, wanted)
    near = match(counted, wanted.select(*within), within, "left_semi")
    keys = match(_keys_in_buckets(near, replace(ranking, group=tuple(within)), wanted.select(*within, "_within"), sums), wanted, within)
    hits = keys.select(
        *group, (F.col("_first") + F.col("rank")).alias("rank"), "key",
        *[(F.col(f"_b_{name}") + F.col(f"upto_{name}")).alias(f"upto_{name}") for name in sums])
    return _with_found(table.select(*group, *told, "_ranks"), _listed(hits, group, [], sums), group)


def _with_found(table: DataFrame, found: DataFrame, group: list[str]) -> DataFrame:
    kind = found.schema["found"].dataType
    both = match(table, found, group, "left")
    return both.withColumn("found", F.coalesce("found", F.array().cast(kind)))


def _found_in_buckets(keyed: DataFrame, ranking: Ranking, ranks: Column, sums: list[str], extra: dict[str, Column]) -> DataFrame:
    """The same without brackets."""
    group = list(ranking.group)
    table = small_side(_totals(keyed, group, sums, extra).withColumn("_within", _wanted(ranks)))
    rows = keyed.select(*group, "_key", F.lit(1).cast("long").alias("_copies"), *[f"_s_{name}" for name in sums])
    keys = _keys_in_buckets(rows, ranking, table.select(*group, "_within"), sums)
    return _with_found(table.drop("_within"), _listed(keys, group, [], sums), group)


def _keys_in_buckets(counted: DataFrame, ranking: Ranking, wanted: DataFrame, sums: list[str]) -> DataFrame:
    """Keys at wanted ranks (group, rank, key, `upto_<name>`), with every group cut into buckets at sampled keys.

    `counted` has the group, `_key`, `_copies` (how many rows a row stands for) and sums, `wanted` the group and ranks as an
    array `_within`. Only buckets that hold a wanted rank are sorted.
    """
    group = list(ranking.group)
    where, weights = [*group, "_bucket"], ["_copies", *[f"_s_{name}" for name in sums]]
    bucketed = _bucketed(counted, ranking, _cuts(counted, ranking))
    spans = match(_spans(bucketed, ranking, weights), wanted, group)
    inside = F.filter("_within", lambda r: (r > F.col("_before__copies")) & (r <= F.col("_before__copies") + F.col("_sum__copies")))
    needed = small_side(
        spans.select(*where, *[f"_before_{c}" for c in weights], inside.alias("_ranks")).where(F.size("_ranks") > 0))
    near = match(bucketed, needed.select(*where), where, "left_semi").groupBy(*where, "_key").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in weights])
    local = Window.partitionBy(*where).orderBy(*ranking.key_order()).rowsBetween(Window.unboundedPreceding, 0)
    upto = [F.sum(c).over(local).alias(f"_upto_{c}") for c in weights]
    placed = match(near.select(*where, "_key", "_copies", *upto), needed, where)
    last = F.col("_before__copies") + F.col("_upto__copies")
    hit = F.filter("_ranks", lambda r: (r <= last) & (r > last - F.col("_copies")))
    return placed.select(
        *group, F.explode(hit).alias("rank"), F.col("_key").alias("key"),
        *[(F.col(f"_before_{c}") + F.col(f"_upto_{c}")).alias(f"upto_{name}") for name, c in zip(sums, weights[1:])])


def keys_at_ranks(df: DataFrame, ranking: Ranking, ranks: Column) -> DataFrame:
    """Keys that stand at the given ranks of each group: (group, rank, key, n_rows); see `find`."""
    found = find(df, ranking, ranks)
    return found.select(*ranking.group, F.explode("found").alias("f"), "n_rows").select(
        *ranking.group, "f.rank", "f.key", "n_rows")


def top_rows(df: DataFrame, ranking: Ranking, n: int | Column) -> DataFrame:
    """The first `n` rows of each group (all of a smaller group).

    `n` may be a Column of the group's row count `n_rows`. One boundary key per group is
    found, then rows are filtered against it, so nothing is gathered in one place.
    """
    count = F.lit(n) if isinstance(n, int) else n
    last = F.least(count.cast("long"), F.col("n_rows"))
    edges = find(df, ranking, F.array(last)).withColumn("_edge", F.get("found", F.lit(0))["key"])
    if not ranking.group:
        return df.where(ranking.key() <= edges.select("_edge").scalar())
    edge = small_side(edges.select(*[F.col(g).alias(f"_edge_{g}") for g in ranking.group], "_edge"))
    same = [F.col(g).eqNullSafe(F.col(f"_edge_{g}")) for g in ranking.group]
    return df.join(edge, [*same, ranking.key() <= F.col("_edge")], "left_semi")


def value_of(key: Column, descending: bool = True) -> Column:
    """The score inside a key."""
    return -key["score"] if descending else key["score"]


def _quantiles(
    df: DataFrame, score: str, shares: Sequence[float], group: Sequence[str], rows_per_bucket: int, extra: dict[str, Column],
) -> DataFrame:
    """(group, n_rows, `extra`, `n_known`, `_at`: a map from rank to value) with the ranks on both sides of every share."""
    ranking = Ranking(score, (), tuple(group), descending=False, rows_per_bucket=rows_per_bucket)
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    place = lambda s: s * (F.col("n_known") - 1)
    lower = F.transform(wanted, lambda s: F.floor(place(s)) + 1)
    upper = F.transform(wanted, lambda s: F.ceil(place(s)) + 1)
    # NULL ranks last, so the known values have the ranks 1..n_known.
    known = F.filter(F.concat(lower, upper), lambda r: r <= F.col("n_known"))
    found = find(df.withColumn(score, F.col(score).cast("double")), ranking, known, extra={**extra, "n_known": F.count(score)})
    return found.withColumn("_at", F.map_from_entries(
        F.transform("found", lambda f: F.struct(f["rank"], f["key"]["score"])))).drop("found")


def _between(share: Column) -> Column:
    """The interpolated value at a share, from `_at` and `n_known`."""
    spot = share * (F.col("n_known") - 1)
    low = F.try_element_at("_at", F.floor(spot) + 1)
    high = F.try_element_at("_at", F.ceil(spot) + 1)
    return low + (high - low) * (spot - F.floor(spot))


def quantiles(
    df: DataFrame, score: str, shares: Sequence[float], group: Sequence[str] = (),
    rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """Exact quantiles, interpolated linearly: (group, share, value, n_rows), NULL ignored."""
    found = _quantiles(df, score, shares, group, rows_per_bucket, {}).where("n_known > 0")
    wanted = F.array(*[F.lit(float(s)) for s in shares])
    return found.select("*", F.explode(wanted).alias("share")).select(
        *group, "share", _between(F.col("share")).alias("value"), F.col("n_known").alias("n_rows"))


def quantile_arrays(
    df: DataFrame, score: str, shares: Sequence[float], group: Sequence[str] = (), rows_per_bucket: int = 1_000_000
) -> DataFrame:
    """The same as one array `values` per group with any value, in the order of the shares."""
    found = _quantiles(df, score, shares, group, rows_per_bucket, {}).where("n_known > 0")
    return found.select(*group, F.transform(F.array(*[F.lit(float(s)) for s in shares]), _between).alias("values"))


def named_quantiles(
    df: DataFrame, score: str, named: dict[str, float], group: Sequence[str] = (), rows_per_bucket: int = 1_000_000,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """`n_rows` (NULL scores included), a column per named share, NULL in a group without values, and `extra` aggregates of
    the group, in the same passes."""
    found = _quantiles(df, score, list(named.values()), group, rows_per_bucket, extra or {})
    return found.select(*group, "n_rows", *(extra or {}), *[_between(F.lit(float(share))).alias(name) for name, share in named.items()])
