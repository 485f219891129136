"""Loading tables and saved scores."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_schema(
    spark: SparkSession, path: str, wide_integers_as_doubles: Iterable[str] = (), sampling: float = 1.0
) -> T.StructType:
    """Header and types of a CSV: integer, double or string for every column.

    Integers too large for 32 bits stay whole numbers of 64 bits, except in the columns named, which become
    doubles, so that keys keep their digits; whatever else Spark infers (dates, booleans) stays text. Inference is a pass over the file:
    give `read_csv` a schema where one is known.
    """
    as_doubles = set(wide_integers_as_doubles)
    inferred = spark.read.csv(path, header=True, inferSchema=True, samplingRatio=sampling).schema

    def narrowed(field: T.StructField) -> T.DataType:
        kind = field.dataType
        if isinstance(kind, (T.IntegerType, T.DoubleType)):
            return kind
        if isinstance(kind, T.LongType) and field.name not in as_doubles:
            return kind
        if isinstance(kind, (T.LongType, T.DecimalType)):
            return T.DoubleType()
        return T.StringType()

    return T.StructType([T.StructField(f.name, narrowed(f)) for f in inferred.fields])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    wide_integers_as_doubles: Iterable[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """CSV with a header. A compressed file is read by one task: set `partitions` to spread it."""
    known = schema if schema is not None else csv_schema(spark, path, wide_integers_as_doubles)
    df = spark.read.csv(path, header=True, schema=known, mode="FAILFAST")
    return df.repartition(partitions) if partitions else df


def read_table(spark: SparkSession, path: str, **csv_options) -> DataFrame:
    """Parquet or CSV (plain or gzip) by the path's suffix."""
    lowered = path.lower().rstrip("/")
    if lowered.endswith(".parquet"):
        return spark.read.parquet(path)
    if lowered.endswith((".csv", ".csv.gz")):
        return read_csv(spark, path, **csv_options)
    raise ValueError(f"unsupported format: {path}")


def table_size(df: DataFrame) -> tuple[int, int]:
    """Rows and columns."""
    return df.count(), len(df.columns)


def read_scores(spark: SparkSession, base: str) -> DataFrame:
    """Saved scores with `study`, `seed` and `split` from the folder names."""
    return spark.read.parquet(base)


_SCORE_FILE = re.compile(r".*?([^/]*)_seed([0-9]+)_([^/]*)\.parquet")
_GLOB_SIGN = re.compile(r"([\\\[\]{}*?,])")


def read_score_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Score files, or folders of parts, named `<study>_seed<number>_<split>.parquet`; the name gives the columns.

    Each name is taken apart once, not in every row, and its columns are constants of its rows.
    """
    every = spark.read.parquet(pattern)
    names = {}
    for path in map(unquote, every.inputFiles()):
        found = _SCORE_FILE.match(path)
        if found is None:
            raise ValueError(f"not named <study>_seed<number>_<split>.parquet: {path}")
        names[found[0]] = found.groups()
    if not names:
        return every.select("*", F.lit("").alias("study"), F.lit(0).alias("seed"), F.lit("").alias("split")).limit(0)
    return reduce(DataFrame.unionByName, [
        spark.read.schema(every.schema).parquet(_GLOB_SIGN.sub(r"\\\1", path)).select(
            "*", F.lit(study).alias("study"), F.lit(int(seed)).alias("seed"), F.lit(split).alias("split"))
        for path, (study, seed, split) in sorted(names.items())
    ])


def read_period(spark: SparkSession, base: str, period, column: str = "period") -> DataFrame:
    """Scores of one period; an error when there are none."""
    df = spark.read.parquet(base)
    rows = df.where(F.col(column) == F.lit(period).cast(df.schema[column].dataType))
    if rows.isEmpty():
        raise FileNotFoundError(f"no scores for period {period} under {base}")
    return rows
