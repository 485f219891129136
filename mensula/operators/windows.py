"""Features over an entity's history.

Every function returns aliased Columns over windows of one entity in period order, so any
number of them added in one projection costs one shuffle and one sort. Frames count rows
of the entity, not calendar periods.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensula.functions.columns import flag
from mensula.operators.ranks import Ranking, find, match, with_place
from mensula.panel import Panel, guarded
from mensula.sizing import small_side

AGGREGATES = {"max": F.max, "min": F.min, "avg": lambda c: F.avg(F.col(c).cast("double"))}


def lags(panel: Panel, columns: Iterable[str], n: int = 1) -> list[Column]:
    history = panel.history
    return [
        F.lag(c, i).over(history).alias(f"{c}_lag_{i}")
        for c in columns
        for i in range(1, n + 1)
    ]


def deltas(panel: Panel, columns: Iterable[str], n: int = 1) -> list[Column]:
    history = panel.history
    return [
        (F.col(c) - F.lag(c, i).over(history)).alias(f"{c}_delta_{i}")
        for c in columns
        for i in range(1, n + 1)
    ]


def rolling(
    panel: Panel,
    columns: Iterable[str],
    window: int = 3,
    kinds: Sequence[str] = ("max", "min", "avg"),
    include_current: bool = False,
) -> list[Column]:
    """Aggregates over the `window` rows before this one, with or without this one."""
    frame = panel.rows(-window, 0 if include_current else -1)
    return [
        AGGREGATES[kind](c).over(frame).alias(f"{c}_{kind}_{window}")
        for c in columns
        for kind in kinds
    ]


LONGEST_LAG_WINDOW = 12
# Rows of the recent average of momentum, and the stretch of rows before that it is held against.
RECENT, PAST_START, PAST_END = 2, 2, 5


def expand(
    df: DataFrame, panel: Panel, columns: Sequence[str], lags_n: int = 2, deltas_n: int = 2, window: int = 3,
    also: Iterable[Column] = (), trends: Sequence[str] = (), trend_window: int = 4, momenta: Sequence[str] = (),
    include_current: bool = False,
) -> DataFrame:
    """`lags`, `deltas` and `rolling` of the columns together, and `slopes` of `trends` and `momentum` of `momenta`.

    Each earlier value is fetched once; everything else is arithmetic
    on the fetched values, compiled, instead of a moving frame per aggregate (frames remain for long windows). `also` joins
    further window Columns to the same step. `include_current` as in `rolling`. A NULL key raises.
    """
    short, short_trend = window <= LONGEST_LAG_WINDOW, trend_window <= LONGEST_LAG_WINDOW
    shown = set(columns)
    depth = dict.fromkeys(columns, max(lags_n, deltas_n, window if short else 0))
    for c in trends if short_trend else ():
        depth[c] = max(depth.get(c, 0), trend_window)
    for c in momenta:
        depth[c] = max(depth.get(c, 0), PAST_END)
    history = panel.history

    def name(c: str, i: int) -> str:
        return f"{c}_lag_{i}" if c in shown and i <= lags_n else f"_{c}_lag_{i}"

    fetched = [
        guarded(F.lag(c, i).over(history), panel).alias(name(c, i)) for c, most in depth.items() for i in range(1, most + 1)]
    framed = [] if short else rolling(panel, columns, window, include_current=include_current)
    wide = df.select("*", *fetched, *also, *framed)

    def earlier(c: str, i: int) -> Column:
        return F.col(name(c, i) if i else c)

    derived = differences(columns, earlier, deltas_n)
    if short:
        derived += extremes(columns, earlier, window, include_current)
    if short_trend:
        derived += trend_slopes(trends, earlier, trend_window)
    derived += momentum_ratios(momenta, earlier)
    hidden = {name(c, i) for c, most in depth.items() for i in range(1, most + 1) if name(c, i).startswith("_")}
    out = wide.select(*[c for c in wide.columns if c not in hidden], *derived)
    return out if short_trend or not trends else add_slopes(out, panel, trends, trend_window)


# Arithmetic on earlier values, wherever they come from: `earlier(column, i)` is the value `i` rows before, 0 this row.
Earlier = Callable[[str, int], Column]


def differences(columns: Iterable[str], earlier: Earlier, n: int) -> list[Column]:
    return [(F.col(c) - earlier(c, i)).alias(f"{c}_delta_{i}") for c in columns for i in range(1, n + 1)]


def extremes(columns: Iterable[str], earlier: Earlier, window: int, include_current: bool = False) -> list[Column]:
    """Largest, smallest and mean value of the `window` rows before this one, with or without this one."""
    out = []
    for c in columns:
        values = [earlier(c, i) for i in range(window, -1 if include_current else 0, -1)]
        out += [
            _widest(F.greatest, values).alias(f"{c}_max_{window}"),
            _widest(F.least, values).alias(f"{c}_min_{window}"),
            _mean(values).alias(f"{c}_avg_{window}"),
        ]
    return out


def trend_slopes(columns: Iterable[str], earlier: Earlier, window: int) -> list[Column]:
    """Least-squares slope over the `window` rows before this one."""
    return [_slope([earlier(c, i) for i in range(window, 0, -1)]).alias(f"{c}_trend_{window}") for c in columns]


def momentum_ratios(columns: Iterable[str], earlier: Earlier) -> list[Column]:
    """Recent average over the average of an earlier stretch."""
    mean = lambda c, first, last: _mean([earlier(c, i) for i in range(last, first - 1, -1)])
    return [F.try_divide(mean(c, 0, RECENT - 1), mean(c, PAST_START, PAST_END)).alias(f"{c}_momentum") for c in columns]


def _widest(kind, values: Sequence[Column]) -> Column:
    return kind(*values) if len(values) > 1 else values[0]


def _mean(values: Sequence[Column]) -> Column:
    """Mean of the values that are not NULL, added in the given order."""
    summed = reduce(add, [F.coalesce(v.cast("double"), F.lit(0.0)) for v in values])
    return F.try_divide(summed, reduce(add, [v.isNotNull().cast("int") for v in values]))


def _slope(values: Sequence[Column]) -> Column:
    """Least-squares slope of values one place apart, the oldest first; NULL ones are left out, and below two there is no slope.

    Sums run over distances from the oldest known value, so that large values of like size do not cancel.
    """
    first = F.coalesce(*values).cast("double")
    known = [v.isNotNull().cast("int") for v in values]
    far = [F.coalesce(v.cast("double") - first, F.lit(0.0)) for v in values]
    total = lambda terms: reduce(add, terms)
    n, x, xx = total(known), total([k * i for i, k in enumerate(known)]), total([k * (i * i) for i, k in enumerate(known)])
    y, xy = total(far), total([f * float(i) for i, f in enumerate(far)])
    return F.try_divide(n * xy - x * y, n * xx - x * x)


def mean_steps(panel: Panel, columns: Iterable[str], window: int = 3) -> list[Column]:
    """Average change per row over `window` rows: last minus first by their distance."""
    steps, history = window - 1, panel.history
    return [
        F.try_divide((F.col(c) - F.lag(c, steps).over(history)).cast("double"), F.lit(steps))
        .alias(f"{c}_trend_{window}")
        for c in columns
    ]


def row_index(panel: Panel, name: str = "row_idx") -> Column:
    return F.row_number().over(panel.history).alias(name)


def slopes(
    panel: Panel, columns: Iterable[str], window: int = 3, index: str = "row_idx"
) -> list[Column]:
    """Least-squares slope over the `window` rows before this one; NULL below two points. A moving frame, for windows of any length.

    The table must hold `row_index(panel, index)`.
    """
    frame = panel.rows(-window, -1)
    return [
        F.regr_slope(F.col(c), F.col(index)).over(frame).alias(f"{c}_trend_{window}")
        for c in columns
    ]


def add_slopes(df: DataFrame, panel: Panel, columns: Sequence[str], window: int = 3) -> DataFrame:
    if window <= LONGEST_LAG_WINDOW:
        return expand(df, panel, [], trends=columns, trend_window=window)
    indexed = df.select("*", row_index(panel, "_row_idx"))
    return indexed.select("*", *slopes(panel, columns, window, "_row_idx")).drop("_row_idx")


def volatility(panel: Panel, columns: Iterable[str], window: int = 3) -> list[Column]:
    frame = panel.rows(-(window - 1), 0)
    return [
        F.try_divide(F.stddev_samp(c).over(frame), F.abs(F.avg(c).over(frame)))
        .alias(f"{c}_volatility_{window}")
        for c in columns
    ]


def momentum(
    panel: Panel, columns: Iterable[str], recent: int = RECENT, past_start: int = PAST_START, past_end: int = PAST_END
) -> list[Column]:
    """Recent average over the average of an earlier stretch."""
    now = panel.rows(-(recent - 1), 0)
    before = panel.rows(-past_end, -past_start)
    return [
        F.try_divide(F.avg(c).over(now), F.avg(c).over(before)).alias(f"{c}_momentum")
        for c in columns
    ]


def counted(panel: Panel, conditions: Mapping[str, str | Column], window: int = 3) -> list[Column]:
    """How many of the last `window` rows, this one included, satisfy each condition."""
    frame = panel.rows(-(window - 1), 0)
    return [F.sum(flag(test)).over(frame).alias(name) for name, test in conditions.items()]


def active_quarter(panel: Panel, inactive: str = "flag_inactivo") -> list[Column]:
    """Active rows among the last three."""
    return counted(panel, {"active_quarter": F.col(inactive) == 0}, window=3)


def months_of(period: Column) -> Column:
    """Month number of a yyyymm integer."""
    return F.floor(period / 100) * 12 + period % 100


def time_since(
    panel: Panel, conditions: Mapping[str, str | Column], unit: str = "raw"
) -> list[Column]:
    """Distance from the last row that satisfied the condition; NULL before the first one.

    `raw` subtracts period values as they are; `months` counts months of yyyymm values.
    """
    if unit not in ("raw", "months"):
        raise ValueError(f"unit {unit!r}: use 'raw' or 'months'")
    period, upto = F.col(panel.period), panel.to_date
    out = []
    for name, test in conditions.items():
        condition = F.expr(test) if isinstance(test, str) else test
        last = F.max(F.when(condition, period)).over(upto)
        gap = period - last if unit == "raw" else months_of(period) - months_of(last)
        out.append(gap.alias(name))
    return out


def sudden_changes(
    panel: Panel, columns: Iterable[str], threshold: float = 2.0, window: int = 6
) -> list[Column]:
    """Flags for values further than `threshold` deviations from the preceding rows' mean."""
    frame = panel.rows(-window, -1)
    out = []
    for c in columns:
        z = F.try_divide(F.col(c) - F.avg(c).over(frame), F.stddev_samp(c).over(frame))
        out.append(flag(z < -threshold).alias(f"sudden_drop_{c}"))
        out.append(flag(z > threshold).alias(f"sudden_increase_{c}"))
    return out


def against_max(panel: Panel, columns: Iterable[str], window: int | None = None) -> list[Column]:
    """Value over the maximum so far, or over the maximum of the last `window` rows."""
    frame = panel.to_date if window is None else panel.rows(-(window - 1), 0)
    suffix = "historico" if window is None else f"{window}m"
    return [
        F.try_divide(F.col(c).cast("double"), F.max(c).over(frame)).alias(f"ratio_{c}_vs_max_{suffix}")
        for c in columns
    ]


# Conditions for behaviour flags.

def falling(panel: Panel, column: str) -> Column:
    return F.col(column) < F.lag(column, 1).over(panel.history)


def rising(panel: Panel, column: str) -> Column:
    return F.col(column) > F.lag(column, 1).over(panel.history)


def at_peak(panel: Panel, column: str) -> Column:
    return F.col(column) == F.max(column).over(panel.to_date)


def turned_on(panel: Panel, column: str) -> Column:
    return (F.col(column) == 1) & (F.lag(column, 1).over(panel.history) == 0)


def is_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)) == 0


def is_positive(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)) > 0


def not_positive(column: str) -> Column:
    return F.col(column) <= 0


def deciles(
    df: DataFrame,
    panel: Panel,
    columns: Sequence[str],
    tiles: int = 10,
    rows_per_bucket: int = 1_000_000,
) -> DataFrame:
    """`<column>_decile`: equal-count tile inside the period, NULL last, ties by entity.

    A window per period would sort each whole period in one task for each column. Instead
    the rows that close a tile are found by exact rank selection on narrow
    (period, column, value, entity) rows, and every row is compared with its period's
    few closing rows, so the wide panel is not shuffled.
    """
    if not columns:
        return df
    names = list(columns)

    def score(c: str) -> tuple[Column, Column]:
        """The value as a double, and as it is where a double cannot tell whole numbers apart."""
        whole = df.schema[c].dataType.typeName() in ("byte", "short", "integer", "long", "boolean")
        return F.col(c).cast("double"), F.col(c).cast("long") if whole else F.lit(None).cast("long")

    cells = F.explode(F.array(*[
        F.struct(F.lit(i).alias("_feature"), score(c)[0].alias("_value"), score(c)[1].alias("_exact")) for i, c in enumerate(names)]))
    long = df.select(*panel.keys, cells.alias("_cell")).select(*panel.keys, "_cell.*")
    ranking = Ranking(
        "_value", ("_exact", panel.entity), (panel.period, "_feature"), descending=False, rows_per_bucket=rows_per_bucket)
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(tiles - 1)),
        lambda t: (t * F.floor(F.col("n_rows") / tiles) + F.least(t, (F.col("n_rows") % tiles))).cast("long"),
    )
    closing = find(long, ranking, ends).select(panel.period, "_feature", F.col("found.key").alias("_keys"))
    bounds = small_side(closing.groupBy(panel.period).agg(
        F.map_from_entries(F.collect_list(F.struct("_feature", "_keys"))).alias("_bounds")))
    placed = match(df, bounds, [panel.period], "left").select(
        *df.columns, *[F.col("_bounds")[i].alias(f"_bounds_{i}") for i in range(len(names))])
    for i, c in enumerate(names):
        value, exact = score(c)
        mine = F.struct(
            value.isNull().cast("int").alias("missing"), value.alias("score"), exact.alias("tie_0"), F.col(panel.entity).alias("tie_1"))
        placed = with_place(placed, f"_bounds_{i}", mine, f"_place_{i}", tiles - 1, closed=False)
    return placed.select(*df.columns, *[(F.col(f"_place_{i}") + 1).alias(f"{c}_decile") for i, c in enumerate(names)])
