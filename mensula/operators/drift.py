"""Data quality and drift between an expected and an actual sample.

All columns are handled at once in long form. Bin edges are exact quantiles of the expected
sample, found by rank selection; counting is one aggregation without sorting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensula.operators.ranks import quantile_arrays, with_place
from mensula.sizing import small_side

# Decimals of rounded edges, and the finest rounding tried.
EDGE_DECIMALS, EDGE_DECIMALS_MOST = 3, 19


def _share_table(df: DataFrame, sample: str, columns: Sequence[str], test) -> DataFrame:
    per_sample = df.groupBy(sample).agg(*[(F.avg(test(c).cast("int")) * 100).alias(c) for c in columns])
    return per_sample.unpivot([sample], list(columns), "feature", "pct")


def _compare_shares(shares: DataFrame, sample: str, expected: str, actual: str) -> DataFrame:
    side = lambda name: F.max(F.when(F.col(sample) == name, F.col("pct")))
    both = shares.groupBy("feature").agg(side(expected).alias("expected_pct"), side(actual).alias("actual_pct"))
    return both.withColumn("difference", F.abs(F.col("actual_pct") - F.col("expected_pct"))).orderBy(
        F.desc("difference"), "feature")


def null_shares(
    df: DataFrame, sample: str, expected: str, actual: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Percentage of NULL per column in both samples, largest difference first."""
    names = [c for c in (columns or df.columns) if c != sample]

    def missing(c: str) -> Column:
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            return F.col(c).isNull() | F.isnan(c)
        return F.col(c).isNull()

    return _compare_shares(_share_table(df, sample, names, missing), sample, expected, actual)


def zero_shares(
    df: DataFrame, sample: str, expected: str, actual: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Percentage equal to 0 per column; NULL and text never are."""
    names = [c for c in (columns or df.columns) if c != sample]

    def zero(c: str) -> Column:
        if isinstance(df.schema[c].dataType, T.NumericType):
            return F.coalesce(F.col(c) == 0, F.lit(False))
        return F.lit(False)

    return _compare_shares(_share_table(df, sample, names, zero), sample, expected, actual)


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(feature, value) rows with values as doubles; NaN counts as NULL."""
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns]
    return df.select(*keep, *values).unpivot(list(keep), list(columns), "feature", "value")


def _rounded(value: Column, decimals: int) -> Column:
    """To `decimals` places after the point, counted from the first digit below 1."""
    fraction = value - F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))
    small = (F.floor(value) == 0) | ((value < 0) & (F.ceil(value) == 0))
    digits = F.when(small, -F.floor(F.log10(F.abs(fraction))) - 1 + decimals).otherwise(decimals)
    scale = F.pow(F.lit(10.0), digits)
    return F.when(value == 0, value).otherwise(F.rint(value * scale) / scale)


def label_edges(edges: Column) -> Column:
    """Edges as interval labels show them: rounded as coarsely as keeps them apart, and the
    first one lowered by one unit of the last place."""
    def at(decimals: int) -> tuple[Column, Column]:
        rounded = F.transform(edges, lambda e: _rounded(e, decimals))
        first = F.get(rounded, F.lit(0)) - F.lit(10.0 ** -decimals)
        lowered = F.concat(F.array(first), F.slice(rounded, 2, F.greatest(F.size(rounded) - 1, F.lit(0))))
        return F.size(F.array_distinct(rounded)) == F.size(edges), lowered

    out = at(EDGE_DECIMALS)[1]
    for decimals in range(EDGE_DECIMALS_MOST, EDGE_DECIMALS - 1, -1):
        apart, lowered = at(decimals)
        out = F.when(apart, lowered).otherwise(out)
    return out


def quantile_edges(
    expected: DataFrame, buckets: int = 10, labelled: bool = True, rows_per_bucket: int = 1_000_000
) -> DataFrame:
    """(feature, edges) of long-form rows: ascending distinct quantiles.

    By default they are those of interval labels, rounded and the first one lowered; without
    `labelled` they are exact.
    """
    shares = [i / buckets for i in range(buckets + 1)]
    found = quantile_arrays(expected, "value", shares, ["feature"], rows_per_bucket)
    edges = F.array_sort(F.array_distinct("values"))
    return found.select("feature", (label_edges(edges) if labelled else edges).alias("edges"))


# Bins of values that no bin takes.
NULL_BIN, OUTSIDE = -1, -2


def _binned(long: DataFrame, edges: DataFrame, by: Sequence[str], most_edges: int) -> DataFrame:
    """Rows per (by, feature, bin), NULL values and values outside the edges in bins of their own."""
    placed = with_place(long.join(edges, "feature", "left"), "edges", F.col("value"), "_below", most_edges)
    last = F.coalesce(F.size("edges"), F.lit(0)) - 1
    bin_ = F.when(F.col("value") == F.get("edges", last), last - 1).otherwise(F.col("_below") - 1)
    rows = placed.select(*by, "feature", "value", bin_.alias("_bin"), last.alias("_last"))
    inside = (F.col("_bin") >= 0) & (F.col("_bin") < F.col("_last"))
    return rows.select(
        *by, "feature", F.when(F.col("value").isNull(), NULL_BIN).when(inside, F.col("_bin")).otherwise(OUTSIDE).alias("bin"),
    ).groupBy(*by, "feature", "bin").agg(F.count("*").alias("n"))


def histogram(long: DataFrame, edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts per (by, feature, bin) for bins [left, right), the last one closed.

    Values outside the edges and NULL give no bin. A feature may have any number of edges.
    `edges` has a row per feature and is read twice: give a `small_side`.
    """
    most_edges = edges.agg(F.max(F.size("edges"))).first()[0] or 0
    return _binned(long, edges, by, most_edges).where(F.col("bin") >= 0)


def _counted(
    df: DataFrame, sample: str, expected: str, actual: str, columns: Sequence[str],
    buckets: int, labelled: bool, rows_per_bucket: int,
) -> tuple[DataFrame, DataFrame]:
    """Edges, and rows of both samples per feature and bin (`e`, `a`), NULL and outside included; one pass each."""
    long = long_form(df.where(F.col(sample).isin(expected, actual)), columns, [sample])
    edges = small_side(quantile_edges(long.where(F.col(sample) == expected), buckets, labelled, rows_per_bucket))  # a row per feature
    side = lambda name: F.coalesce(F.sum(F.when(F.col(sample) == name, F.col("n"))), F.lit(0))
    both = _binned(long, edges, [sample], buckets + 1).groupBy("feature", "bin").agg(side(expected).alias("e"), side(actual).alias("a"))
    return edges, small_side(both)


def _all_bins(edges: DataFrame, counted: DataFrame) -> DataFrame:
    bins = edges.where(F.size("edges") > 1).select(
        "feature", "edges", F.posexplode(F.slice("edges", 1, F.size("edges") - 1)).alias("bin", "left_edge"))
    return bins.join(counted, ["feature", "bin"], "left").select(
        "feature", "bin", "left_edge", F.get("edges", F.col("bin") + 1).alias("right_edge"),
        F.coalesce("e", F.lit(0)).alias("n_expected"), F.coalesce("a", F.lit(0)).alias("n_actual"))


def bin_counts(
    df: DataFrame, sample: str, expected: str, actual: str, columns: Sequence[str],
    buckets: int = 10, labelled: bool = True, rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """Per feature and bin: its bounds and the rows of both samples, empty bins included."""
    return _all_bins(*_counted(df, sample, expected, actual, columns, buckets, labelled, rows_per_bucket))


def psi_term(expected: Column, actual: Column, empty: str, epsilon: float = 1e-6) -> Column:
    """(a - e) ln(a / e). A zero share gives infinity, two give NaN; `epsilon` replaces zeros."""
    if empty == "epsilon":
        expected, actual = F.greatest(expected, F.lit(epsilon)), F.greatest(actual, F.lit(epsilon))
    elif empty != "reference":
        raise ValueError(f"empty {empty!r}: use 'reference' or 'epsilon'")
    term = (actual - expected) * F.ln(actual / F.when(expected != 0, expected))
    return (
        F.when((expected == 0) & (actual == 0), F.lit(float("nan")))
        .when((expected == 0) | (actual == 0), F.lit(float("inf")))
        .otherwise(term)
    )


def psi(
    df: DataFrame, sample: str, expected: str, actual: str, columns: Sequence[str],
    buckets: int = 10, empty: str = "reference", labelled: bool = True,
    rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """Population stability index per feature, largest first.

    Shares are of each sample's non-NULL rows; a NULL term is added when both samples have
    NULLs.
    """
    edges, counted = _counted(df, sample, expected, actual, columns, buckets, labelled, rows_per_bucket)
    # A row per feature from here on: its counts as a map from bins.
    per = counted.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("bin", F.struct("e", "a")))).alias("_n"))
    none = F.struct(F.lit(0).cast("long").alias("e"), F.lit(0).cast("long").alias("a"))
    at = lambda b: F.coalesce(F.try_element_at("_n", b), none)
    known = F.map_values(F.map_filter("_n", lambda b, _: b != NULL_BIN))
    total = lambda side: F.aggregate(known, F.lit(0).cast("long"), lambda t, n: t + n[side])
    share = lambda n, of: F.try_divide(n.cast("double"), of)
    rows = per.join(edges, "feature", "left").select("feature", "_n", "edges", total("e").alias("_e"), total("a").alias("_a"))
    bins = F.when(F.size("edges") > 1, F.sequence(F.lit(0), F.size("edges") - 2)).otherwise(F.array().cast("array<int>"))
    terms = F.transform(bins, lambda b: psi_term(share(at(b)["e"], F.col("_e")), share(at(b)["a"], F.col("_a")), empty))
    binned = F.aggregate(terms, F.lit(0.0), lambda t, x: t + F.coalesce(x, F.lit(0.0)))
    missing = at(F.lit(NULL_BIN))
    all_null = share(missing["e"], missing["e"] + F.col("_e"))
    all_null_a = share(missing["a"], missing["a"] + F.col("_a"))
    null_term = F.when((missing["e"] > 0) & (missing["a"] > 0), psi_term(all_null, all_null_a, empty)).otherwise(0.0)
    return rows.select("feature", (binned + null_term).alias("psi")).orderBy(F.desc("psi"), "feature")
