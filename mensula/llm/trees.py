"""Gradient-boosted trees, with scores mapped to frequencies: over arrays, or over all rows of a DataFrame.

Over a DataFrame, values become numbers of bins once. A level of a tree is one pass: each task sums gradients by node, feature and bin, and
the driver picks the splits from these sums, whose size depends on neither rows nor keys. Sums are of integers, so they do not
depend on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensula.sizing import settle

ROWS_PER_TASK = 50_000
UNIT = 1 << 24  # gradients are summed as integers of so many parts
SCORE_BITS = 10


@dataclass(frozen=True)
class Tree:
    """Complete binary tree: `feature` and `cut` of inner nodes by level, `leaf` values."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        inner = len(self.feature)
        rows = np.arange(len(x))
        for _ in range(int(np.log2(inner + 1))):
            node = 2 * node + 1 + (x[rows, self.feature[node]] > self.cut[node])
        return self.leaf[node - inner]


@dataclass(frozen=True)
class Boosted:
    """Sum of trees as a logit, then a monotone map to calibrated probabilities."""

    start: float
    trees: tuple[Tree, ...]
    knots: np.ndarray
    shares: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((t(x) for t in self.trees), np.zeros(len(x)))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.logit(x))

    def calibrated(self, logit: np.ndarray) -> np.ndarray:
        return np.interp(logit, self.knots, self.shares)


def _grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, rate: float, l2: float, cuts: list[np.ndarray]) -> Tree:
    inner = (1 << depth) - 1
    feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(len(x), np.int64)
    for place in range(inner):
        mine = node == place
        best = 1e-9
        if mine.sum() >= 2:
            gm, hm, xm = g[mine], h[mine], x[mine]
            whole = gm.sum() ** 2 / (hm.sum() + l2)
            for f, options in enumerate(cuts):
                below = xm[:, f, None] <= options[None, :]
                gl, hl = gm @ below, hm @ below
                gain = gl**2 / (hl + l2) + (gm.sum() - gl) ** 2 / (hm.sum() - hl + l2) - whole
                k = int(gain.argmax()) if len(options) else 0
                if len(options) and gain[k] > best:
                    best, feature[place], cut[place] = gain[k], f, options[k]
        node[mine] = 2 * place + 1 + (x[mine, feature[place]] > cut[place])
    leaf = np.zeros(inner + 1)
    np.add.at(leaf, node - inner, g)
    weight = np.full(inner + 1, l2)
    np.add.at(weight, node - inner, h)
    return Tree(feature, cut, -rate * leaf / weight)


def isotonic(score: np.ndarray, label: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: increasing shares of label 1 by score, as knots and shares."""
    order = np.argsort(score, kind="stable")
    weight = np.ones(len(score)) if weight is None else weight
    blocks: list[list[float]] = []
    for s, y, w in zip(score[order], label[order], weight[order]):
        blocks.append([w * y, w, s, s])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            y1, n1, _, high = blocks.pop()
            blocks[-1][0] += y1
            blocks[-1][1] += n1
            blocks[-1][3] = high
    knots = np.array([k for b in blocks for k in (b[2], b[3])])
    # One case of either label at each block keeps shares off 0 and 1.
    shares = np.repeat([(b[0] + 0.5) / (b[1] + 1) for b in blocks], 2)
    return knots, np.maximum.accumulate(shares)


def held_out(label: np.ndarray) -> np.ndarray:
    """Rows that the trees do not see: the odd ones."""
    return np.arange(len(label)) % 2 == 1


def boost(x: np.ndarray, label: np.ndarray, rounds: int = 30, depth: int = 3, rate: float = 0.3, l2: float = 1.0, bins: int = 16) -> Boosted:
    """Trees on the even rows, calibration on the odd ones. Without both labels every probability is the share of label 1, 0.5 without rows."""
    if len(label) < 4 or label.min() == label.max():
        p = float((label.sum() + 0.5) / (len(label) + 1))
        return Boosted(0.0, (), np.array([0.0]), np.array([p]))
    a, b = ~held_out(label), held_out(label)
    xa, ya = x[a], label[a].astype(float)
    cuts = [np.unique(np.quantile(xa[:, f], np.linspace(0, 1, bins + 1)[:-1])) for f in range(x.shape[1])]
    mean = (ya.sum() + 0.5) / (len(ya) + 1)
    start = float(np.log(mean / (1 - mean)))
    total, trees = np.full(len(ya), start), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        trees.append(_grow(xa, p - ya, p * (1 - p), depth, rate, l2, cuts))
        total = total + trees[-1](xa)
    raw = Boosted(start, tuple(trees), np.array([0.0]), np.array([0.5]))
    return Boosted(start, tuple(trees), *isotonic(raw.logit(x[b]), label[b].astype(float)))


# --- all rows of a DataFrame -----------------------------------------------------------------------


def coarse(score: np.ndarray) -> np.ndarray:
    """Scores on a grid: the next one below with ten bits behind the point, or ten significant bits above 1, so that there are some ten thousand.

    A score reaches a value of the grid exactly when its place on the grid does.
    """
    step = np.exp2(np.maximum(np.frexp(score)[1], 0) - SCORE_BITS)
    return np.floor(score / step) * step


def is_held_out(x: str = "x") -> Column:
    """The half of a row, by a hash of its values: trees of the other half do not see it."""
    return F.pmod(F.xxhash64(x, F.lit(13)), F.lit(2)) == 1


def _numbers(batch: pa.RecordBatch, column: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(column).to_pylist()), np.uint8).reshape(-1, width)


@dataclass
class _Half:
    """What is known of the trees of a half while they grow: cuts of each feature, and the nodes of the newest tree."""

    cuts: list[np.ndarray]
    start: float
    trees: list[Tree]
    feature: np.ndarray
    cut: np.ndarray

    def known(self) -> tuple[Tree, ...]:
        """The trees over values instead of numbers of bins."""
        return tuple(Tree(t.feature, np.array([np.inf if k == np.inf else self.cuts[f][int(k)] for f, k in zip(t.feature, t.cut)]), t.leaf) for t in self.trees)


def _sums(rows: DataFrame, halves: list[_Half], size: int, level: int) -> np.ndarray:
    """Gradients and their slopes, in `UNIT`s, by half, node of the level, feature and bin."""
    nodes, width = 1 << level, len(halves[0].cuts)
    known = [(h.start, h.trees, h.feature, h.cut) for h in halves]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(known), 2, width, nodes * size), np.int64)
        for batch in batches:
            bins, labels, held = _numbers(batch, "bins", width), batch.column("label").to_numpy(), batch.column("held").to_numpy(zero_copy_only=False)
            for side, (start, trees, feature, cut) in enumerate(known):
                x, y = bins[held == side], labels[held == side]
                p = 1 / (1 + np.exp(-sum((t(x) for t in trees), np.full(len(x), start))))
                node, at = np.zeros(len(x), np.int64), np.arange(len(x))
                for _ in range(level):
                    node = 2 * node + 1 + (x[at, feature[node]] > cut[node])
                place = (node - (nodes - 1)) * size
                for i, values in enumerate((p - y, p * (1 - p))):
                    values = np.rint(values * UNIT)
                    for f in range(width):
                        out[side, i, f] += np.bincount(place + x[:, f], values, nodes * size).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])

    found = rows.mapInArrow(add, "sums binary").collect()
    total = sum((np.frombuffer(r["sums"], np.int64) for r in found), np.zeros(len(known) * 2 * width * nodes * size, np.int64))
    return total.reshape(len(known), 2, width, nodes, size)


def _grow_on(rows: DataFrame, halves: list[_Half], depth: int, rate: float, l2: float) -> None:
    """A tree more for each half, over numbers of bins; a row is below the `k`-th cut of a feature if its bin is at most `k`."""
    inner, size = (1 << depth) - 1, 1 + max(len(c) for h in halves for c in h.cuts)
    leaf = np.zeros((len(halves), inner + 1))
    for h in halves:
        h.feature, h.cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
    for level in range(depth):
        sums = np.cumsum(_sums(rows, halves, size, level) / UNIT, axis=4)
        for h, below, leaves in zip(halves, sums, leaf):
            allowed = np.arange(size) < np.array([len(c) for c in h.cuts])[:, None]
            for i in range(1 << level):
                place, (gl, hl) = (1 << level) - 1 + i, below[:, :, i]
                g, s = gl[0, -1], hl[0, -1]
                gain = np.where(allowed, gl**2 / (hl + l2) + (g - gl) ** 2 / (s - hl + l2) - g**2 / (s + l2), -np.inf)
                f, k = np.unravel_index(int(gain.argmax()), gain.shape)
                split = gain[f, k] > 1e-9
                if split:
                    h.feature[place], h.cut[place] = f, k
                if level == depth - 1:
                    left = (gl[f, k], hl[f, k]) if split else (g, s)
                    leaves[2 * i], leaves[2 * i + 1] = left[0] / (left[1] + l2), (g - left[0]) / (s - left[1] + l2)
    for h, leaves in zip(halves, leaf):
        h.trees.append(Tree(h.feature, h.cut, -rate * leaves))


def _calibrated(start: float, trees: tuple[Tree, ...], judged: pd.DataFrame) -> Boosted:
    """Trees with the calibration over rows counted by score."""
    whole = judged.groupby("score")[["ones", "zeros"]].sum()
    count = whole["ones"].to_numpy() + whole["zeros"].to_numpy()
    return Boosted(start, trees, *isotonic(whole.index.to_numpy(), whole["ones"].to_numpy() / count, count.astype(float)))


def boost_rows(
    rows: DataFrame, group: Column, rounds: int = 30, depth: int = 3, rate: float = 0.3, l2: float = 1.0, bins: int = 16,
) -> tuple[Boosted, Boosted, pd.DataFrame]:
    """Trees and calibration from all rows of `label` (0 or 1), `x` and `n`: of one half, of all, and the scores of all rows.

    Each half of the rows has its trees, which grow in the same passes, and every row is scored by the trees of the half that it is not in; every
    row counts once. The first model has the trees of the rows that `is_held_out` leaves, calibrated on the others. The second is the mean of
    the trees of both halves, calibrated on the scores of all rows. Without both labels, or without rows in
    either half, every probability is the share of label 1. The scores are a row per `group` (a whole number) and `coarse` score: rows
    of label 1 and 0 (`ones`, `zeros`), and their sums of `n` (`right`, `wrong`). `rows` is read more than once.
    """
    held = F.col("held")
    told = rows.withColumn("held", is_held_out()).agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("label"), F.lit(0)).alias("ones"), F.count_if(held).alias("judged"),
        F.coalesce(F.sum(F.when(~held, F.col("label"))), F.lit(0)).alias("seen"), F.max(F.size("x")).alias("width")).first()
    counts = ["ones", "zeros", "right", "wrong"]
    if told["rows"] < 4 or told["ones"] in (0, told["rows"]) or told["judged"] in (0, told["rows"]):
        flat = Boosted(0.0, (), np.array([0.0]), np.array([(told["ones"] + 0.5) / (told["rows"] + 1)]))
        return flat, flat, pd.DataFrame({c: np.empty(0) for c in ("group", "score", *counts)})
    width, shares = told["width"], np.linspace(0, 1, bins + 1)[:-1].tolist()
    quantiles = rows.groupBy(is_held_out().alias("held")).agg(*[F.percentile(F.get("x", F.lit(f)), shares) for f in range(width)]).collect()
    halves = []
    for _, *found in sorted(quantiles, key=lambda r: r["held"]):
        ones, n = (told["seen"], told["rows"] - told["judged"]) if not halves else (told["ones"] - told["seen"], told["judged"])
        mean = (ones + 0.5) / (n + 1)
        halves.append(_Half([np.unique(q) for q in found], float(np.log(mean / (1 - mean))), [], np.empty(0), np.empty(0)))
    cuts = [h.cuts for h in halves]

    def bin_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, width)
            numbers = [np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(own)], 1).astype(np.uint8) for own in cuts]
            columns = [batch.column(c) for c in ("label", "n", "group", "held")]
            sides = np.where(batch.column("held").to_numpy(zero_copy_only=False)[:, None], numbers[::-1], numbers)
            bins = [pa.array([r.tobytes() for r in side], pa.binary()) for side in sides]
            yield pa.RecordBatch.from_arrays([*columns, *bins], names=["label", "n", "group", "held", "bins", "other"])

    dealt = rows.select("label", "n", group.cast("int").alias("group"), is_held_out().alias("held"), "x").repartition(-(-told["rows"] // ROWS_PER_TASK))
    # `bins` by the cuts of the half of the row, `other` by those of the half whose trees score it.
    binned = settle(dealt.mapInArrow(bin_of, "label int, n long, group int, held boolean, bins binary, other binary"))
    seen = binned.select("label", "held", "bins")
    for _ in range(rounds):
        _grow_on(seen, halves, depth, rate, l2)
    grown = [(h.start, h.trees) for h in halves]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, side = _numbers(batch, "other", width), batch.column("held").to_numpy(zero_copy_only=False)
            s = np.zeros(len(x))
            for half, (start, trees) in enumerate(grown):
                mine = side != half
                s[mine] = coarse(sum((t(x[mine]) for t in trees), np.full(mine.sum(), start)))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("label", "n", "group", "held")] + [pa.array(s, pa.float64())], names=["label", "n", "group", "held", "score"])

    one = F.col("label") == 1
    scored = binned.mapInArrow(score, "label int, n long, group int, held boolean, score double").groupBy("held", "group", "score").agg(
        F.count_if(one).alias("ones"), F.count_if(~one).alias("zeros"),
        F.sum(F.when(one, F.col("n")).otherwise(0)).alias("right"), F.sum(F.when(one, 0).otherwise(F.col("n"))).alias("wrong"))
    judged = scored.toPandas()
    first = _calibrated(halves[0].start, halves[0].known(), judged[judged["held"]])
    mean = tuple(Tree(t.feature, t.cut, t.leaf / 2) for h in halves for t in h.known())
    judged = judged.groupby(["group", "score"], as_index=False)[counts].sum()
    return first, _calibrated((halves[0].start + halves[1].start) / 2, mean, judged), judged
