"""Size checks for what is broadcast, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
FIRST_ROWS = 4_096


def fetched(df: DataFrame, max_rows: int | None = None, max_bytes: int = BROADCAST_BYTES) -> pa.Table | None:
    """The rows of `df` when there are at most `max_rows` of about `max_bytes` bytes, else None.

    A first few rows tell how wide rows are; more are fetched only as far as the bytes allow.
    """
    bound = BROADCAST_ROWS if max_rows is None else max_rows
    step = min(bound, FIRST_ROWS)
    rows = df.limit(step + 1).toArrow()
    if rows.num_rows > step and step < bound:
        bound = min(bound, int(max_bytes / max(rows.nbytes / rows.num_rows, 1)))
        if bound < rows.num_rows:
            return None
        rows = df.limit(bound + 1).toArrow()
    return None if rows.num_rows > bound or rows.nbytes > max_bytes else rows


def side_of(rows: pa.Table, df: DataFrame) -> DataFrame:
    """The fetched rows of `df` as a table to broadcast."""
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def small_side(df: DataFrame, max_rows: int | None = None, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast copy of `df` when `fetched` finds it small, else `df` itself.

    A table above the bounds stays an ordinary join side that Spark shuffles, so the
    result is the same either way.
    """
    rows = fetched(df, max_rows, max_bytes)
    return df if rows is None else side_of(rows, df)


def shared_dir(spark: SparkSession) -> str:
    """Folder named by `spark.checkpoint.dir`; a local one only for local sessions without it."""
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="mensula-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later jobs read the written rows instead of recomputing them."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
