"""A table kept by period, to which a new file is added without touching other periods.

The table has a folder per period. Adding a file rewrites the periods that the file holds, from their present rows and the
new ones, by Spark's dynamic partition overwrite: rows go to a staging folder first and the finished folders are swapped in at the end,
so a run that fails leaves the old periods as they were. A record of the batch, written after that, makes a second run
of the same file do nothing; a run that failed between the two writes the same rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mensula.operators.combine import append_distinct, check_same_schema
from mensula.panel import distinct_values
from mensula.sources.writers import append_records

LOG = "batch string, n_rows long, periods array<string>, at timestamp"
# More periods than this in one file are found by a join instead of a list of values.
LISTED = 1_000


def read_months(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame | None:
    """The stored table, in the column order of `like` and with its type of the period, which folder names do not tell; None where
    there is none yet. Columns that are not those of `like` raise."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    if like is None:
        return stored
    if set(stored.columns) != set(like.columns):
        raise ValueError(f"columns that differ: {sorted(set(stored.columns) ^ set(like.columns))}")
    period = stored.columns[-1]
    return stored.withColumn(period, F.col(period).cast(like.schema[period].dataType)).select(*like.columns)


def batch_of(new: DataFrame) -> tuple[str, int]:
    """A name for the rows of a file, whatever their order and partitions, and their number."""
    row = F.struct(*sorted(new.columns))
    told = new.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64(row).cast("decimal(38,0)")).alias("a"),
        F.sum(F.xxhash64(F.lit(1), row).cast("decimal(38,0)")).alias("b")).first()
    return f"{told['n']}-{told['a'] or 0}-{told['b'] or 0}", told["n"]


def _holds(periods: Sequence, period: str) -> Column:
    known = [p for p in periods if p is not None]
    inside = F.col(period).isin(*known) if known else F.lit(False)
    return inside | F.col(period).isNull() if len(known) < len(periods) else inside


def append_month(new: DataFrame, path: str, period: str, log: str) -> bool:
    """Adds the distinct rows of `new` to the table at `path`; False when the log at `log` says that this was done before.

    Only folders of the periods in `new` are read and written. A revised row does not replace the old one. Rows with a NULL period
    have a folder of their own.
    """
    spark = new.sparkSession
    batch, n = batch_of(new)
    if _recorded(spark, log, batch):
        return False
    periods = [r[0] for r in distinct_values(new, period).limit(LISTED + 1).collect()]
    if len(periods) > LISTED:
        raise ValueError(f"more than {LISTED} periods in one file: split it")
    stored = read_months(spark, path, new)
    if stored is not None:
        check_same_schema(stored, new)
        rows = append_distinct(stored.where(_holds(periods, period)), new)
    else:
        rows = new.distinct()
    rows.hint("rebalance", period).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", "zstd").partitionBy(period).parquet(path)
    record = spark.createDataFrame([(batch, n, [None if p is None else str(p) for p in periods])], "batch string, n_rows long, periods array<string>")
    append_records(record.withColumn("at", F.current_timestamp()).coalesce(1), log)
    return True


def _recorded(spark: SparkSession, log: str, batch: str) -> bool:
    try:
        return not spark.read.json(log, schema=LOG).where(F.col("batch") == batch).isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
