"""Cross-site boilerplate lines, found by the spread of a line over distinct sites.

Lines are spaces-trimmed and hashed. Every line gets a HyperLogLog sketch of the sites it stands on; sketches are made in
the tasks that read the lines and merged by the aggregation, so a line is a row per task at most when it is shuffled.
A line whose estimate is clearly at or above its threshold is boilerplate, one clearly below is
not, and only the lines near the threshold get an exact distinct count. Boilerplate stays where it
stands first (smallest key, then place) and goes everywhere else.

A short line says little, so it has to stand on more sites: the threshold is `min_sites` for lines of `short` characters or
more and grows in inverse proportion below that. No line is too short to be counted.

All built-in functions, no Python. Texts are not exploded for the removal: only documents that lose lines
get the list of their places, by a join on the document's own hash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensula.sizing import settle

from .common import SPACES, free_name, join_by


@dataclass(frozen=True)
class Config:
    """A line of `n` characters (code points) is boilerplate if it stands on enough distinct sites: sites * min(n, short) >=
    min_sites * short.

    `lg_k`: size of a sketch; `sigmas`: how many standard errors around the threshold are counted exactly.
    """

    min_sites: int = 10
    short: int = 20
    lg_k: int = 12
    sigmas: float = 6.0

    def need(self, line: Column) -> Column:
        """Sites that a line must stand on."""
        return F.ceil(F.lit(self.min_sites * self.short) / F.least(F.length(line), F.lit(self.short))).cast("int")

    def band(self, need: Column) -> tuple[Column, Column]:
        """Estimates between these are near the threshold."""
        error = self.sigmas * 1.04 / math.sqrt(1 << self.lg_k)
        return need * (1 - error) - 1, need * (1 + error) + 1


def _line(x: Column) -> Column:
    return F.btrim(x, F.lit(SPACES))


def _lines(df: DataFrame, key: str, text: str, site: str, config: Config) -> DataFrame:
    """`doc` (hash of key and text), `k`, `site`, `place`, `line` (hash) and `need` of every line that is not empty."""
    body = df.select(
        F.xxhash64(key, text).alias("doc"), F.col(key).alias("k"), F.col(site).cast("string").alias("site"),
        F.posexplode(F.split(text, "\n", -1)).alias("place", "raw"),
    ).withColumn("raw", _line(F.col("raw")))
    return body.where(F.col("raw") != "").select(
        "doc", "k", "site", "place", F.xxhash64("raw").alias("line"), config.need(F.col("raw")).alias("need"))


def boilerplate(lines: DataFrame, config: Config = Config(), total: int | None = None) -> DataFrame:
    """`line` of all lines on enough distinct sites, `first`, where each stands first, and `n`, how often. A NULL site counts for none.

    `total`: rows of `lines`, counted when not given.
    """
    order = F.struct(F.col("k").isNull().alias("no_key"), "k", "doc", "place")
    low, high = config.band(F.col("need"))
    spread = settle(
        lines.groupBy("line").agg(
            F.hll_sketch_agg("site", config.lg_k).alias("sketch"), F.min(order).alias("first"), F.max("need").alias("need"), F.count("*").alias("n"))
        .select("line", "first", "need", "n", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= low)
    )
    near = spread.where(F.col("sites") <= high)
    total = lines.count() if total is None else total
    exact = (
        join_by(lines.where("site is not null").select("line", "site"), near.select("line", "need", "n"), "line", "n", total, few=True)
        .groupBy("line", "need", "site").agg(F.lit(1).alias("one")).groupBy("line", "need").agg(F.count("*").alias("exact"))
        .where(F.col("exact") >= F.col("need"))
    )
    clear = spread.where(F.col("sites") > high)
    return clear.unionByName(near.join(exact.select("line"), "line")).select("line", "first", "n")


def removals(df: DataFrame, config: Config = Config(), key: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """`doc`, `k`, `places`: which lines each document loses (from 0); documents that lose none are left out."""
    lines = settle(_lines(df, key, text, site, config))
    total = lines.count()
    gone = join_by(lines, settle(boilerplate(lines, config, total)), "line", "n", total, few=True).where(
        (F.col("doc") != F.col("first.doc")) | (F.col("place") != F.col("first.place")))
    return gone.groupBy("doc", "k").agg(F.collect_set("place").alias("places"))


def clean(df: DataFrame, config: Config = Config(), key: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """`df` with boilerplate lines taken out of `text`, and `n_lines`, `n_removed` added.

    NULL texts stay NULL with no line; empty texts have one empty line. Rows that repeat a key and
    text are one document: they keep and lose the same lines. A NULL key comes after all others
    when the first place of a line is looked for. Every row stays, even if all its lines go. Other columns stay as they are,
    whatever their names; where `df` has an `n_lines` or `n_removed`, the added column gets a `_` behind its name. An empty table
    stays empty.
    """
    gone = settle(removals(df, config, key, text, site))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    own = df.select(row.alias("row"), F.xxhash64(key, text).alias("own"))
    marked = own.join(gone, (F.col("own") == F.col("doc")) & F.col("row")[key].eqNullSafe(F.col("k")), "left")
    body = F.col("row")[text]
    parts = F.split(body, "\n", -1)
    kept = F.filter(parts, lambda x, i: ~F.array_contains("places", i))
    cleaned = F.when(F.col("places").isNull(), body).otherwise(F.array_join(kept, "\n"))
    return marked.select(
        *[(cleaned if c == text else F.col("row")[c]).alias(c) for c in df.columns],
        F.coalesce(F.size(parts), F.lit(0)).cast("long").alias(free_name("n_lines", df.columns)),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias(free_name("n_removed", df.columns)),
    )
