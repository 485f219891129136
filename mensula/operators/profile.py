"""What a table's columns are like: types, cardinality, class counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensula.functions.columns import whole

# Type classes of the schema report.
TYPE_CLASSES = {"string": "int_categorico", "int": "int_numerico", "float": "float", "double": "float"}
OTHER_TYPE = "otro"


def schema_table(df: DataFrame) -> DataFrame:
    """(variable, tipo_dato) by name; metadata only."""
    rows = df.sparkSession.createDataFrame(sorted(df.dtypes), "variable string, tipo_dato string")
    return rows.orderBy("variable")


def classify_types(df: DataFrame) -> DataFrame:
    """The schema table with the class of every type."""
    kind = F.lit(OTHER_TYPE)
    for name, label in TYPE_CLASSES.items():
        kind = F.when(F.col("tipo_dato") == name, label).otherwise(kind)
    return schema_table(df).select(
        "variable", F.col("tipo_dato").alias("tipo_original"), kind.alias("tipo_de_dato")
    )


def _told_apart(df: DataFrame, column: str) -> Column:
    """The value as text that differs where values differ; NaN is one value, zero has no sign."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (F.col(column) + F.lit(0.0)).cast("string")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.when(F.col(column).isNotNull(), F.to_json(F.struct(column)))
    return F.col(column).cast("string")


# Fixed value: the largest size of a sketch.
LG_K_MOST = 21


def _sketch_size(max_unique: int) -> int:
    """Size (log2) of a sketch that still holds the codes themselves at `max_unique` values."""
    return (2 * max_unique).bit_length() + 3


def _few(df: DataFrame, columns: Sequence[str], max_unique: int) -> list[str]:
    """Columns that may hold fewer than `max_unique` values; none that does is left out.

    A sketch keeps a short code per value and holds the codes themselves until there are more than
    a fixed number, which is chosen above `max_unique`. Equal values have equal codes, so there are never more codes
    than values: a count of `max_unique` codes or more proves a column wide.
    """
    lg_k = max(8, _sketch_size(max_unique))
    row = df.agg(*[
        F.hll_sketch_estimate(F.hll_sketch_agg(_told_apart(df, c), lg_k)).alias(f"n{i}") for i, c in enumerate(columns)
    ]).first()
    return [c for i, c in enumerate(columns) if row[f"n{i}"] is None or row[f"n{i}"] < max_unique]


def _distinct(df: DataFrame, column: str) -> Column:
    """Distinct non-NULL values of a column that holds few; NaN counts once, zero has no sign."""
    if not isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return F.size(F.collect_set(column))
    number = F.when(~F.isnan(column), F.col(column) + F.lit(0.0))
    return F.size(F.collect_set(number)) + F.coalesce(F.max(F.isnan(column).cast("int")), F.lit(0))


def cardinality(df: DataFrame, max_unique: int = 10, columns: Iterable[str] | None = None) -> DataFrame:
    """(variable, n_distinct) of columns with fewer than `max_unique` non-NULL values, exactly.

    A sketch over the whole table proves the wide columns wide; the others hold few values, so
    their exact sets stay small in one aggregation without multiplying rows. A `max_unique` that no sketch holds codes for
    is compared with the exact counts of all columns.
    """
    names = list(columns if columns is not None else df.columns)
    if _sketch_size(max_unique) > LG_K_MOST:
        return distinct_counts(df, names).where(F.col("n_distinct") < max_unique)
    near = _few(df, names, max_unique) if names else []
    if not near:
        return df.sparkSession.createDataFrame([], "variable string, n_distinct long")
    exact = df.agg(*[_distinct(df, c).cast("long").alias(c) for c in near])
    return (
        exact.unpivot([], near, "variable", "n_distinct")
        .where(F.col("n_distinct") < max_unique)
    )


def distinct_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """(variable, n_distinct) of every column, exactly; NULL is not counted, NaN counts once, zero has no sign.

    Equal values meet map-side first and are spread over tasks by column and value together, so
    neither a wide column nor a very common value lands in one task. A column without values counts 0.
    """
    names = list(columns if columns is not None else df.columns)
    cells = F.array(*[_told_apart(df, c) for c in names])
    values = df.select(F.posexplode(cells).alias("i", "v")).where("v is not null").groupBy("i", "v").agg(F.lit(1).alias("one"))
    counts = values.groupBy("i").agg(F.count("*").alias("n"))
    every = df.sparkSession.createDataFrame(list(enumerate(names)), "i int, variable string")
    return every.join(counts, "i", "left").select("variable", F.coalesce("n", F.lit(0)).alias("n_distinct"))


def low_cardinality_columns(
    df: DataFrame, max_unique: int = 10, columns: Iterable[str] | None = None
) -> list[str]:
    """Names of `cardinality`, in column order."""
    found = {r["variable"] for r in cardinality(df, max_unique, columns).collect()}
    return [c for c in df.columns if c in found]


def to_integers(df: DataFrame, columns: Iterable[str], safe: bool = False) -> DataFrame:
    """Columns as integers, rounded half to even."""
    return df.withColumns({c: whole(c, "int", safe) for c in columns})


def class_counts(df: DataFrame, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows, rows per class, positives per negative and share of positives, in all or per group."""
    positive = F.count(F.when(F.col(y) == 1, 1))
    negative = F.count(F.when(F.col(y) == 0, 1))
    counts = df.groupBy(*by).agg(
        F.count("*").alias("n_rows"), negative.alias("n_class_0"), positive.alias("n_class_1")
    )
    return counts.select(
        "*",
        F.try_divide("n_class_1", "n_class_0").alias("ratio"),
        F.try_divide("n_class_1", "n_rows").alias("share_class_1"),
    )


def label_counts(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows and share per value of a label, in all or per group."""
    per_value = df.groupBy(*by, label).agg(F.count("*").alias("n_rows"))
    if not by:
        whole_table: Column = per_value.agg(F.sum("n_rows")).scalar()
        return per_value.withColumn("share", F.col("n_rows") / whole_table)
    # One row per group and label value: few, so a window over a group's values is small. A NULL group is a group.
    everything = F.sum("n_rows").over(Window.partitionBy(*by))
    return per_value.select(*by, label, "n_rows", (F.col("n_rows") / everything).alias("share"))
