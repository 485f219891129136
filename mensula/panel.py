"""The panel: one row per (entity, period), and how its columns and axis are found."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensula.sizing import small_side

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Panel:
    """Names of the two key columns.

    An (entity, period) pair occurs at most once, so an entity never has more rows than
    the table has periods. That bound is what makes windows per entity safe at any size.
    """

    entity: str = "entity"
    period: str = "period"

    @property
    def keys(self) -> list[str]:
        return [self.entity, self.period]

    @property
    def history(self) -> WindowSpec:
        return Window.partitionBy(self.entity).orderBy(self.period)

    def rows(self, first: int, last: int) -> WindowSpec:
        return self.history.rowsBetween(first, last)

    @property
    def to_date(self) -> WindowSpec:
        return self.rows(Window.unboundedPreceding, 0)


def with_columns(df: DataFrame, *groups: Column | Iterable[Column]) -> DataFrame:
    """Add aliased columns in one projection, so windows of one spec share one sort."""
    new: list[Column] = []
    for group in groups:
        new.extend([group] if isinstance(group, Column) else group)
    return df.select("*", *new) if new else df


def numeric_columns(
    df: DataFrame, exclude: Iterable[str] = (), integers: bool = True
) -> list[str]:
    """Number columns that are not excluded; `integers=False` leaves whole numbers out. Flags, dates and nested columns are no numbers."""
    skipped = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in skipped
        and isinstance(f.dataType, T.NumericType)
        and (integers or not isinstance(f.dataType, INTEGRAL))
    ]


def columns_like(
    df: DataFrame,
    contains: str | None = None,
    prefix: str = "",
    suffixes: Sequence[str] = ("",),
    without: str | None = None,
) -> list[str]:
    """Columns by literal prefix, any of the suffixes, and case-insensitive substring."""
    return [
        c
        for c in df.columns
        if c.startswith(prefix)
        and c.endswith(tuple(suffixes))
        and (contains is None or contains.lower() in c.lower())
        and (without is None or without.lower() not in c.lower())
    ]


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"columns not in the table: {missing}")


def unkeyed(df: DataFrame, panel: Panel) -> DataFrame:
    """Rows whose entity or period is NULL. They belong to no history; take them apart before history operators."""
    return df.where(F.col(panel.entity).isNull() | F.col(panel.period).isNull())


def guarded(value: Column, panel: Panel) -> Column:
    """`value`, which raises on rows with a NULL entity or period when it is read.

    Otherwise all rows with a NULL entity would pass for one entity, with one another's history and in one task.
    """
    missing = F.col(panel.entity).isNull() | F.col(panel.period).isNull()
    message = F.lit(f"NULL in key column {panel.entity} or {panel.period}: take `unkeyed` rows apart first")
    return F.when(missing, F.raise_error(message)).otherwise(value)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct periods or entities."""
    return df.select(column).distinct()


def period_axis(df: DataFrame, panel: Panel) -> DataFrame:
    """Observed periods with a dense index from 0 and the index of the last one.

    The single-partition window runs over the distinct periods only.
    """
    ordered = Window.orderBy(panel.period)
    axis = distinct_values(df, panel.period).where(F.col(panel.period).isNotNull())
    return axis.select(
        panel.period,
        (F.row_number().over(ordered) - 1).alias("period_idx"),
        (F.count("*").over(Window.partitionBy()) - 1).cast("int").alias("last_idx"),
    )


def with_period_index(df: DataFrame, panel: Panel) -> DataFrame:
    """Attach `period_idx` and `last_idx`, NULL for a NULL period; the axis is broadcast when its size is checked."""
    return df.join(small_side(period_axis(df, panel)), panel.period, "left")


def duplicate_keys(df: DataFrame, panel: Panel) -> DataFrame:
    """(entity, period) pairs that occur more than once."""
    return df.groupBy(*panel.keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def densify(df: DataFrame, panel: Panel) -> DataFrame:
    """Every entity at every observed period; measures are NULL where no row existed.

    The grid comes from exploding the list of periods, computed inside the same plan, for each
    entity, then one left join. An entity gets a row per period: the result itself is entities
    times periods, and nothing else in the library builds on it. NULL entities and periods have no place in it.
    """
    axis = distinct_values(df, panel.period).agg(F.array_sort(F.collect_set(panel.period)).alias("periods")).scalar()
    grid = (
        distinct_values(df, panel.entity)
        .where(F.col(panel.entity).isNotNull())
        .select(panel.entity, F.explode(axis).alias(panel.period))
    )
    present = df.withColumn("is_present", F.lit(1))
    return grid.join(present, panel.keys, "left").fillna({"is_present": 0})


def attach(df: DataFrame, features: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join of a separately built feature table on its key."""
    overlap = sorted((set(df.columns) & set(features.columns)) - set(on))
    if overlap:
        raise ValueError(f"columns in both tables: {overlap}")
    return df.join(features, list(on))
