"""Mixing of sources to target weights, by balanced sampling with the cube method.

Every source gets a target number of words; a document is then wanted target / source size times on average. The whole part of
that number is certain. The fraction is an inclusion probability, and the cube method rounds all of them to
0 or 1 without disturbing two totals of each source: its documents and its words. A move goes along the
null-space of the two constraints, for three documents at a time, until one of the three is decided (flight);
its direction is drawn so that no probability changes on average. What cannot move any further, two documents at most, lands by
the pair of outcomes with the smallest expected error that keeps both probabilities; the longest documents fly first.

Documents are dealt by a hash to blocks, and a task flies one block. Each block leaves two undecided documents at most,
which go on to a next round of blocks, until a source has one block left: it lands there. So every round is about two
thousand times smaller than the one before, a source of any size is spread over tasks, and draws depend on
the documents alone, not on how they are partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensula.operators.ranks import Ranking, with_rank
from mensula.sizing import settle, small_side

from .common import words_of


@dataclass(frozen=True)
class Config:
    """Sources in code-point order, NULL last, weigh `weights`, repeating. They share `share` times the words of all
    documents, and none gets more than `most` times its own. `block`: documents that one flight starts with, about."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.0
    most: int = 3
    block: int = 4_096
    seed: int = 11


NEARLY = 1e-9


# --- targets ---------------------------------------------------------------------------------------


def targets(sized: DataFrame, config: Config = Config()) -> DataFrame:
    """`source`, `source_size`, `target` per source, from (`source`, `size`) rows.

    The weights share the total; what a source cannot take goes to the others by weight, until none is above its bound. That is
    one level: source `i` gets the lesser of its bound and `weight * level`. The level rises from round to round, and only the
    level itself comes to the driver.
    """
    c = config
    sources = settle(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    ranked = with_rank(sources, Ranking("source", descending=False))
    weight = F.get(F.array(*[F.lit(float(w)) for w in c.weights]), ((F.col("rank") - 1) % len(c.weights)).cast("int"))
    weighed = settle(ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * float(c.most)).alias("bound")))
    wanted = (weighed.agg(F.sum("source_size")).first()[0] or 0) * c.share
    level, full = 0.0, F.col("bound") <= 0
    while True:
        row = weighed.agg(F.sum(F.when(full, F.col("bound"))).alias("taken"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if not row["open"]:
            level = float("inf")
            break
        higher = (wanted - (row["taken"] or 0.0)) / row["open"]
        if higher <= level:
            break
        level, full = higher, F.col("bound") <= F.col("weight") * higher
    target = F.least("bound", F.col("weight") * level) if level < float("inf") else F.col("bound")
    return weighed.select("source", "source_size", target.alias("target"))


# --- the cube --------------------------------------------------------------------------------------


def direction(columns: Sequence[Sequence[float]]) -> list[float]:
    """A vector other than zero that every constraint maps to zero, for one column of constraints per unit and more units than
    constraints, by elimination."""
    units = len(columns)
    rows = [list(r) for r in zip(*columns)]
    pivots: list[int] = []
    done = 0
    for j in range(units):
        best = max(range(done, len(rows)), key=lambda i: abs(rows[i][j]), default=None)
        if best is None or abs(rows[best][j]) <= NEARLY:
            continue
        rows[done], rows[best] = rows[best], rows[done]
        lead = rows[done][j]
        rows[done] = [x / lead for x in rows[done]]
        for i in range(len(rows)):
            if i != done and rows[i][j]:
                f = rows[i][j]
                rows[i] = [x - f * y for x, y in zip(rows[i], rows[done])]
        pivots.append(j)
        done += 1
        if done == len(rows):
            break
    free = next(j for j in range(units) if j not in pivots)
    out = [0.0] * units
    out[free] = 1.0
    for i, j in enumerate(pivots):
        out[j] = -rows[i][free]
    return out


def flight(p: np.ndarray, balance: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight: all but at most as many as there are constraints are 0 or 1.

    `balance` has a row per unit; the sum of `balance * p` stays as it was, up to rounding.
    """
    p = p.astype(float).copy()
    # Constraints of like size, so that one tolerance fits all; a constraint that is zero everywhere says nothing.
    scale = np.abs(balance).max(0, initial=0.0)
    rows = (balance / np.where(scale > 0, scale, 1.0)).tolist()
    need = balance.shape[1] + 1
    waiting = [i for i in range(len(p)) if NEARLY < p[i] < 1 - NEARLY]
    draws = rng.random(len(waiting) + 1)
    active, at, step = [], 0, 0
    while True:
        while len(active) < need and at < len(waiting):
            active.append(waiting[at])
            at += 1
        if len(active) < need:
            break
        u = direction([rows[i] for i in active])
        up = min((1 - p[i]) / x if x > 0 else p[i] / -x for i, x in zip(active, u) if abs(x) > NEARLY)
        down = min(p[i] / x if x > 0 else (1 - p[i]) / -x for i, x in zip(active, u) if abs(x) > NEARLY)
        move = up if draws[step] * (up + down) < down else -down
        step += 1
        left = []
        for i, x in zip(active, u):
            p[i] += move * x
            if p[i] <= NEARLY:
                p[i] = 0.0
            elif p[i] >= 1 - NEARLY:
                p[i] = 1.0
            else:
                left.append(i)
        active = left
    return np.where(p <= NEARLY, 0.0, np.where(p >= 1 - NEARLY, 1.0, p))


def landing(p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """0 or 1 for one or two undecided units (others are as they are).

    Each unit keeps its probability. Of the ways to decide two together, the one that takes both least often has the smallest
    expected squared error in documents and in words.
    """
    p, open_ = p.copy(), np.flatnonzero((p > 0) & (p < 1))
    draw = rng.random()
    if len(open_) == 1:
        p[open_] = float(draw < p[open_[0]])
    elif len(open_) == 2:
        i, j = open_
        a, b = p[i], p[j]
        both = max(0.0, a + b - 1)
        p[i] = float(draw < a)
        p[j] = float(draw < both or a <= draw < a + b - both)
    elif len(open_):
        raise ValueError("the flight leaves two units at most")
    return p


def _fly(group: pd.DataFrame) -> pd.DataFrame:
    """Decides a block of one source; the last block also lands.

    The longest and the shortest documents fly first, in turn, and those of middle length last. A long one then trades
    with the next long one and a short one with the next short one; between documents of nearly one length a much longer
    one would hardly move and be left to land.
    """
    group = group.sort_values(["size", "h", "h2"], ascending=[False, True, True], kind="stable")
    turn = np.arange(len(group)) // 2
    turn[1::2] = len(group) - 1 - turn[1::2]
    group = group.iloc[turn]
    first = group.iloc[0]
    rng = np.random.default_rng([int(first["block_seed"]) & 0xFFFFFFFF, int(first["h"]) & 0xFFFFFFFF, len(group)])
    size = group["size"].to_numpy(np.float64)
    p = flight(group["p"].to_numpy(), np.column_stack([np.ones(len(group)), size]), rng)
    if first["blocks"] == 1:
        p = landing(p, rng)
    return group.assign(p=p)[["h", "h2", "source", "size", "p"]]


def decide(units: DataFrame, config: Config = Config()) -> DataFrame:
    """`h`, `h2`, `source`, `size`, `p`: the units with every `p` rounded to 0 or 1, balanced within each source.

    `h` and `h2` are hashes that name a unit.
    """
    kind = units.schema["source"].dataType.simpleString()
    open_, out, level = settle(units.select("h", "h2", "source", "size", "p")), [], 0
    while True:
        # A source's blocks follow its own size; only as many as one block holds land.
        count = open_.groupBy(F.col("source").alias("s")).agg(F.ceil(F.count("*") / config.block).alias("blocks"))
        told = open_.join(small_side(count), F.col("source").eqNullSafe(F.col("s"))).select(
            *open_.columns, "blocks", F.pmod(F.xxhash64("h", F.lit(level)), F.col("blocks")).alias("block"),
            F.lit(config.seed * 1_000 + level).alias("block_seed"))
        flown = settle(told.groupBy("source", "block").applyInPandas(_fly, f"h long, h2 long, source {kind}, size long, p double"))
        out.append(flown.where("p = 0 or p = 1"))
        open_ = flown.where("p > 0 and p < 1")
        level += 1
        if open_.isEmpty():
            break
    done = out[0]
    for more in out[1:]:
        done = done.unionByName(more)
    return done


# --- the table -------------------------------------------------------------------------------------


def size_of(text: Column) -> Column:
    """Words of a text; 0 without one."""
    return F.size(words_of(text)).cast("long")


def _counted(units: DataFrame, config: Config) -> DataFrame:
    """`h`, `h2`, `source`, `size`, `n` (rows that are alike) with `source_size`, `target` and `copies` of all `n` together."""
    per_source = small_side(targets(units.select("source", (F.col("size") * F.col("n")).alias("size")), config))
    per_source = per_source.withColumnRenamed("source", "s")
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    wanted = settle(units.join(per_source, F.col("source").eqNullSafe(F.col("s"))).select(
        "h", "h2", "source", "size", "n", "source_size", "target", (rate * F.col("n")).alias("wanted")))
    whole = F.floor(F.col("wanted") + NEARLY)
    part = F.greatest(F.col("wanted") - whole, F.lit(0.0))
    decided = decide(wanted.select("h", "h2", "source", "size", part.alias("p")).where(F.col("p") > NEARLY), config)
    more = decided.where("p = 1").select(F.col("h").alias("a"), F.col("h2").alias("b"), F.lit(1).alias("one"))
    joined = wanted.join(more, (F.col("h") == F.col("a")) & (F.col("h2") == F.col("b")), "left")
    return joined.select("h", "h2", "source", "size", "n", "source_size", "target", (whole + F.coalesce("one", F.lit(0))).alias("copies"))


def _repeated(df: DataFrame, n: Column, name: str, chunk: int = 4_096) -> DataFrame:
    """Each row `n` times (none for 0), numbered from 0 as `name`; a row with a great `n` is dealt over tasks in chunks."""
    few = df.where((n > 0) & (n <= chunk)).withColumn(name, F.explode(F.sequence(F.lit(0), n - 1)))
    many = df.where(n > chunk).withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / chunk))))
    dealt = many.repartition(F.xxhash64(*many.columns))
    last = F.least((F.col("_chunk") + 1) * chunk, n) - 1
    return few.unionByName(dealt.withColumn(name, F.explode(F.sequence(F.col("_chunk") * chunk, last))).drop("_chunk"))


def mix(df: DataFrame, config: Config = Config(), key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """`key`, `source`, `size`, `source_size`, `target`, `copies` and `taken` (copies * size) per row of `df`.

    `copies` of all rows of a source add up to `target / source_size` times its rows, and `taken` to `target`, up to what the
    landing of two documents moves. Rows that agree in key, source and size are alike: they share their copies
    evenly. A NULL text has size 0, as has an empty one; a source without words has target 0 and no copies. A NULL source is a
    source of its own. A NULL key is a key. An empty table gives no row. Other columns are not read.
    """
    rows = df.select(F.col(key).alias("k"), F.col(source).cast("string").alias("source"), size_of(F.col(text)).alias("size"))
    alike = settle(rows.groupBy("k", "source", "size").agg(F.count("*").alias("n")).select(
        "*", F.xxhash64("k", "source", "size").alias("h"), F.xxhash64(F.lit(config.seed), "k", "size", "source").alias("h2")))
    counted = _counted(alike.drop("k"), config)
    names = alike.select(F.col("k"), F.col("h").alias("a"), F.col("h2").alias("b"))
    told = counted.join(names, (F.col("h") == F.col("a")) & (F.col("h2") == F.col("b")))
    each = _repeated(told.select("k", "source", "size", "n", "source_size", "target", "copies"), F.col("n"), "i")
    own = F.floor(F.col("copies") / F.col("n")) + (F.col("i") < F.col("copies") % F.col("n")).cast("long")
    return each.select(
        F.col("k").alias(key), "source", "size", "source_size", "target", own.alias("copies"), (own * F.col("size")).alias("taken"))


def mixed(df: DataFrame, config: Config = Config(), source: str = "source", text: str = "text") -> DataFrame:
    """The mixed corpus: every row of `df` as often as it is taken, with all its columns.

    Equal rows are one row with a count here; so the columns must be of types that can be grouped (no maps). Nulls and
    empty texts as in `mix`.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    alike = settle(df.select(row.alias("row")).groupBy("row").agg(F.count("*").alias("n")).select(
        "row", "n", F.col("row")[source].cast("string").alias("source"), size_of(F.col("row")[text]).alias("size"),
        F.xxhash64("row").alias("h"), F.xxhash64(F.lit(config.seed), "row").alias("h2")))
    counted = _counted(alike.drop("row"), config).where("copies > 0").select(F.col("h").alias("a"), F.col("h2").alias("b"), "copies")
    taken = alike.join(counted, (F.col("h") == F.col("a")) & (F.col("h2") == F.col("b"))).select("row", "copies")
    return _repeated(taken, F.col("copies"), "i").select("row.*")
