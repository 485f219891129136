"""Pieces shared by the operators: tables, words, and one-time evaluation inside a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mensula.sizing import fetched, side_of

# What separates words, as a set of characters and as a pattern.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Whole texts go to Python workers in batches of about so many bytes; both sides hold some copies of a batch per core.
TEXT_BATCH = "4m"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(df: DataFrame) -> DataFrame:
    """`df`, whose session from now on sends at most about `TEXT_BATCH` at once to Python workers, if it has no setting of its own.

    Spark's default is 64 MB a batch. It changes no result.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_BYTES, None) is None:
        conf.set(_BATCH_BYTES, TEXT_BATCH)
    return df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for NULL and for texts of spaces only."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN, -1))


def free_name(name: str, taken: list[str]) -> str:
    """`name`, with as many `_` after it as keep it apart from the names taken (in any case of letters)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


# A key with more than one row in this many is hot, so there are fewer than this many of them.
HOT_SHARE = 1_000


def join_by(rows: DataFrame, table: DataFrame, key: str, copies: str, total: int, few: bool = False) -> DataFrame:
    """Inner join with a table that has a row per `key`, of which `copies` says how many rows hold it, of `total` in all.

    The hot keys are broadcast and the others are shuffled: no key that is shuffled holds more than a thousandth of the rows. With
    `few`, for tables that grow slower than the rows, the whole table is broadcast when its size allows.
    """
    small = fetched(table) if few else None
    if small is not None:
        return rows.join(side_of(small, table), key)
    is_hot = F.col(copies) * HOT_SHARE > total
    hot = F.broadcast(table.where(is_hot))
    cold = rows.join(hot.select(key), key, "left_anti").join(table.where(~is_hot), key)
    return rows.join(hot, key).unionByName(cold)


class Known(dict):
    """What `make` gave, for the short strings asked for lately: at most twice `most` of them.

    A full generation is kept as the older one, so that common strings survive and rare ones go.
    """

    def __init__(self, make: Callable, most: int, longest: int):
        super().__init__()
        self.make, self.most, self.longest, self.older = make, most, longest, {}

    def __missing__(self, word):
        found = self.older.get(word)
        if found is None:
            found = self.make(word)
        if len(word) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found
