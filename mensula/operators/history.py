"""History features of a new period from a stored state, without the periods before it.

The state has one row per entity: its last values, its largest values, the last period of each event, its recent
condition flags, how many rows it has had, and its last two periods with what is known of its absence. A new period is joined with it once,
by entity; the join gives the features of the new rows, the labels that the period settles, and the next
state. The result equals that of the window functions over all periods.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mensula.functions.columns import flag
from mensula.operators import windows as W
from mensula.panel import Panel, guarded, with_period_index


@dataclass(frozen=True)
class History:
    """What is derived from an entity's earlier rows.

    `columns` get lags, deltas and rolling values (`window` rows), `trends` slopes over `trend_window` rows, `momenta` momentum,
    `peaks` the ratio to the largest value so far; `counted` conditions are counted over `count_window` rows, this one included, and
    `events` conditions measured from their last row. Conditions are SQL over the period's own columns.
    """

    columns: Sequence[str] = ()
    lags: int = 2
    deltas: int = 2
    window: int = 3
    trends: Sequence[str] = ()
    trend_window: int = 4
    momenta: Sequence[str] = ()
    peaks: Sequence[str] = ()
    counted: Mapping[str, str] = field(default_factory=dict)
    count_window: int = 3
    events: Mapping[str, str] = field(default_factory=dict)
    unit: str = "raw"

    @property
    def depths(self) -> dict[str, int]:
        """How many earlier values of each column are kept."""
        out = dict.fromkeys(self.columns, max(self.lags, self.deltas, self.window))
        for c in self.trends:
            out[c] = max(out.get(c, 0), self.trend_window)
        for c in self.momenta:
            out[c] = max(out.get(c, 0), W.PAST_END)
        return out


def by_windows(df: DataFrame, panel: Panel, history: History) -> DataFrame:
    """The features of all periods, over all rows: what `advance` gives period by period."""
    h = history
    wide = W.expand(
        df, panel, h.columns, h.lags, h.deltas, h.window, trends=h.trends, trend_window=h.trend_window, momenta=h.momenta,
        also=[*W.against_max(panel, h.peaks), *W.counted(panel, h.counted, h.count_window), *W.time_since(panel, h.events, h.unit),
              W.row_index(panel)])
    return wide


def state_of(df: DataFrame, panel: Panel, history: History) -> DataFrame:
    """The state after all rows of a table, from the rows of each entity in one pass.

    An entity has a row per period at most. `pending` holds its rows in the last two periods of the table: how many periods back they
    are, counted from the next one, and whether the entity was there one period later.
    """
    h, period = history, panel.period
    indexed = with_period_index(df, panel)
    newest = Window.partitionBy(panel.entity).orderBy(F.desc(period))
    repeated = F.lag(period, 1).over(newest) == F.col(period)
    checked = F.when(repeated, F.raise_error(F.lit("entity and period are not unique")).cast("int")).otherwise(F.row_number().over(newest))
    stays = F.coalesce(F.lag("period_idx", 1).over(newest) == F.col("period_idx") + 1, F.lit(False))
    rows = indexed.select(
        "*", guarded(checked, panel).alias("_place"), (F.col("last_idx") - F.col("period_idx") + 1).cast("int").alias("_back"), stays.alias("_stays"))

    def last(value: Column, kept: Column) -> Column:
        """Values of the rows kept, the newest first."""
        return F.transform(F.array_sort(F.collect_list(F.when(kept, F.struct("_place", value.alias("v"))))), lambda e: e["v"])

    waiting = F.struct(F.col(period).alias("period"), F.col("_back").alias("back"), F.when(F.col("_back") == 2, F.col("_stays")).alias("stayed"))
    return rows.groupBy(panel.entity).agg(
        F.max(period).alias("last_period"), F.count("*").cast("int").alias("n_rows"),
        *[last(F.col(c), F.col("_place") <= n).alias(f"last_{c}") for c, n in h.depths.items()],
        *[F.max(c).alias(f"peak_{c}") for c in h.peaks],
        *[last(flag(t), F.col("_place") < h.count_window).alias(f"flags_{n}") for n, t in h.counted.items()],
        *[F.max(F.when(F.expr(t), F.col(period))).alias(f"event_{n}") for n, t in h.events.items()],
        last(waiting, F.col("_back") <= 2).alias("pending"),
    )


def advance(state: DataFrame, month: DataFrame, panel: Panel, history: History) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(features of the new period's rows, labels of the rows it bears on, next state).

    `month` holds one period, later than all before; a row with an earlier one, or a repeated or NULL key, raises. Both are joined once
    by entity, and the three tables are read off that join: write the state before the next period. Labels are those of the rows
    one and two periods back and of the new ones: `target_binario` and `target_ternario` as far as they are known now, `settled` once
    both periods after a row are there.
    """
    h, entity, period = history, panel.entity, panel.period
    old = state.withColumnsRenamed({c: f"_s_{c}" for c in state.columns})
    repeated = F.count("*").over(Window.partitionBy(entity)) > 1
    message = F.raise_error(F.lit("entity and period are not unique")).cast("boolean")
    now = month.withColumn("_new", guarded(F.when(repeated, message).otherwise(True), panel))
    both = now.join(old, F.col(entity) == F.col(f"_s_{entity}"), "full")
    here = F.coalesce("_new", F.lit(False))
    too_late = F.raise_error(F.lit("the new period is not later than the state")).cast("int")
    earlier_rows = F.coalesce("_s_n_rows", F.lit(0))
    n_rows = F.when(F.col(period) <= F.col("_s_last_period"), too_late).otherwise(earlier_rows + here.cast("int"))

    def earlier(c: str, i: int) -> Column:
        return F.get(f"_s_last_{c}", F.lit(i - 1)) if i else F.col(c)

    def event(name: str, test: str) -> Column:
        return F.greatest(F.when(here & F.expr(test), F.col(period)), F.col(f"_s_event_{name}"))

    def since(last: Column) -> Column:
        return F.col(period) - last if h.unit == "raw" else W.months_of(F.col(period)) - W.months_of(last)

    def count(name: str, test: str) -> Column:
        before = F.coalesce(f"_s_flags_{name}", F.array().cast("array<int>"))
        return flag(test).cast("long") + F.aggregate(before, F.lit(0).cast("long"), lambda t, x: t + x)

    features = both.where(here).select(
        *month.columns, *[earlier(c, i).alias(f"{c}_lag_{i}") for c in h.columns for i in range(1, h.lags + 1)],
        *[F.try_divide(F.col(c).cast("double"), F.greatest(c, f"_s_peak_{c}")).alias(f"ratio_{c}_vs_max_historico") for c in h.peaks],
        *[count(n, t).alias(n) for n, t in h.counted.items()], *[since(event(n, t)).alias(n) for n, t in h.events.items()],
        n_rows.alias("row_idx"),
        *W.differences(h.columns, earlier, h.deltas), *W.extremes(h.columns, earlier, h.window),
        *W.trend_slopes(h.trends, earlier, h.trend_window), *W.momentum_ratios(h.momenta, earlier),
    )

    who = F.coalesce(entity, f"_s_{entity}").alias(entity)
    waiting = f"struct<period: {month.schema[period].dataType.simpleString()}, back: int, stayed: boolean>"
    aged = F.transform(F.coalesce("_s_pending", F.array().cast(f"array<{waiting}>")), lambda e: F.struct(
        e["period"].alias("period"), (e["back"] + 1).alias("back"), F.when(e["back"] == 1, here).otherwise(e["stayed"]).alias("stayed")))
    fresh = F.when(here, F.array(F.struct(F.col(period).alias("period"), F.lit(1).alias("back"), F.lit(None).cast("boolean").alias("stayed"))))
    pending = F.concat(F.coalesce(fresh, F.array().cast(f"array<{waiting}>")), aged)
    told = both.select(who, here.alias("_here"), F.explode(pending).alias("e")).select(entity, "_here", "e.*")
    left_first, settled = ~F.col("stayed"), F.col("back") == 3
    left_second = settled & F.col("stayed") & ~F.col("_here")
    labels = told.select(
        entity, F.col("period").alias(period), (F.coalesce(left_first, F.lit(False)) | left_second).cast("int").alias("target_binario"),
        F.coalesce(left_second, F.lit(False)).cast("int").alias("target_ternario"), settled.cast("int").alias("settled"))

    def shifted(value: Column, name: str, kind: str, most: int) -> Column:
        before = F.coalesce(f"_s_{name}", F.array().cast(kind))
        return F.when(here, F.slice(F.concat(F.array(value), before), 1, most)).otherwise(before).alias(name)

    kinds = dict(state.dtypes)
    following = both.select(
        who, F.coalesce(period, "_s_last_period").alias("last_period"), n_rows.alias("n_rows"),
        *[shifted(F.col(c), f"last_{c}", kinds[f"last_{c}"], n) for c, n in h.depths.items()],
        *[F.greatest(c, f"_s_peak_{c}").alias(f"peak_{c}") for c in h.peaks],
        *[shifted(flag(t), f"flags_{n}", kinds[f"flags_{n}"], h.count_window - 1) for n, t in h.counted.items()],
        *[event(n, t).alias(f"event_{n}") for n, t in h.events.items()],
        F.filter(pending, lambda e: e["back"] <= 2).alias("pending"),
    )
    return features, labels, following
