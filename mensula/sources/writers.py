"""Saving tables, scores, contact lists, summaries and run records."""

from __future__ import annotations

from pyspark.sql import DataFrame

from mensula.panel import Panel

# Fixed value: rows per row group of saved tables.
ROWS_PER_GROUP = 100_000


def parquet_path(path: str) -> str:
    """The path with a .parquet suffix."""
    if path.endswith(".parquet"):
        return path
    return (path[:-len(".csv")] if path.endswith(".csv") else path) + ".parquet"


def save_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path, header=True)


def save_parquet(
    df: DataFrame, path: str, partition_by: str | None = None, mode: str = "errorifexists"
) -> str:
    """Zstandard Parquet; one folder per period when `partition_by` is given.

    Rebalancing before the partitioned write joins the small pieces of a period that all
    tasks hold and splits a period too big for one file.
    """
    target = parquet_path(path)
    rows = df.hint("rebalance", partition_by) if partition_by else df
    writer = (
        rows.write.mode(mode)
        .option("compression", "zstd")
        .option("parquet.block.row.count.limit", ROWS_PER_GROUP)
    )
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(target)
    return target


def save_by_entity(
    df: DataFrame, panel: Panel, table: str, buckets: int, path: str | None = None, mode: str = "errorifexists"
) -> DataFrame:
    """A table of the session's catalog, bucketed by entity and sorted by entity and period, and read back.

    Rows of an entity share a bucket, so windows over its history, and joins by entity with a table of as many buckets, need no
    shuffle. A join by entity and period needs none either where `spark.sql.requireAllClusterKeysForCoPartition` is false. Give
    `path` to keep the files in a folder of your own. Choose `buckets` so that a bucket fits a task; there is a file per bucket.
    """
    writer = df.repartition(buckets, panel.entity).write.mode(mode).format("parquet").option("compression", "zstd")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, panel.entity).sortBy(panel.entity, panel.period).saveAsTable(table)
    return df.sparkSession.table(table)


def save_scores(df: DataFrame, base: str, mode: str = "append") -> None:
    """Scores with columns `study`, `seed` and `split`, one folder each."""
    df.hint("rebalance", "study", "seed", "split").write.mode(mode).option(
        "compression", "zstd").partitionBy("study", "seed", "split").parquet(base)


def save_contacts(df: DataFrame, entity: str, path: str, mode: str = "errorifexists") -> None:
    """One-column CSV of the selected entities in order."""
    df.select(entity).orderBy(entity).write.mode(mode).csv(path, header=True)


def save_summary(df: DataFrame, path: str, kind: str = "csv", mode: str = "errorifexists") -> None:
    """A small report as one file of CSV or JSON lines. Only its finished rows meet in one task."""
    if kind == "csv":
        save_csv(df.repartition(1), path, mode)
    elif kind == "json":
        df.repartition(1).write.mode(mode).json(path)
    else:
        raise ValueError(f"kind {kind!r}: use 'csv' or 'json'")


def append_records(df: DataFrame, path: str) -> None:
    """Add trial or test records to a ledger of JSON lines; earlier records stay untouched."""
    df.write.mode("append").json(path)
