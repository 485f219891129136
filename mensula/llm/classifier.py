"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Features of a text are hashed one- and two-grams of its words and of their shapes (letters, digits
and marks as classes, so that unseen words still say something). A word repeated at once gets one
bucket of its own. Vectors have unit length. Weights are learnt with FTRL-Proximal in parallel
shards that start from the same weights and are averaged after each round. A score is one sparse
dot product.

Every labelled row teaches: the number of shards grows with the rows, and equal rows are one row with
their number. What leaves the executors is bounded: `2**bits` weights. Scoring reads each whole text once, in place,
without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensula.sizing import settle

from .common import Known, in_small_batches

BUCKET_OF_REPEATS = 0
KNOWN_WORDS, LONGEST_KNOWN = 150_000, 24


@dataclass(frozen=True)
class Config:
    """`shards`: at least so many; `shard_rows`: rows of a shard, about, when there are more; `copies`: of a text, at most so many go to
    one shard before the next takes more; `broadcast`: labelled rows whose keys are broadcast, at most (more are joined by a shuffle)."""

    bits: int = 18
    shards: int = 8
    shard_rows: int = 4_096
    copies: int = 256
    broadcast: int = 1 << 20
    rounds: int = 2
    epochs: int = 2
    alpha: float = 0.3
    beta: float = 0.1
    l1: float = 0.0005
    l2: float = 0.0005
    seed: int = 17


@dataclass(frozen=True)
class Model:
    bits: int
    weights: np.ndarray
    bias: float


_CLASSES = re.compile(r"([A-ZÀ-ÖØ-Þ]+)|([a-zß-öø-ÿ]+)|([0-9]+)|([^\w\s]+)|(.)", re.DOTALL)


def _shape(word: str) -> str:
    """Runs of letters, digits and marks of a word, a run as one sign; marks stay as they are, once each."""
    out = []
    for m in _CLASSES.finditer(word):
        out.append("".join(sorted(set(m[0]))) if m.lastindex == 4 else "Aa9*?"[m.lastindex - 1])
    return "".join(out)


def _hashes(word: bytes) -> bytes:
    """Hash of the lower-cased word and hash of its shape, 8 bytes each."""
    text = word.decode("utf-8", "replace")
    return xxhash.xxh64_digest(text.lower().encode(), 1) + xxhash.xxh64_digest(_shape(text).encode(), 2)


_KNOWN = Known(_hashes, KNOWN_WORDS, LONGEST_KNOWN)


def features(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted feature numbers of a whole text and their values, of length one; both empty without words."""
    words = (text or "").encode("utf-8", "replace").split()
    n = len(words)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0)
    pairs = np.frombuffer(b"".join(map(_KNOWN.__getitem__, words)), np.uint64).reshape(n, 2)
    top = np.uint64(64 - bits)
    k1, k2, k3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    word, shape = pairs[:, 0], pairs[:, 1]
    both = ((word[:-1] * k2) ^ (word[1:] * k3)) * k1 >> top
    both[word[:-1] == word[1:]] = BUCKET_OF_REPEATS
    index = np.concatenate((
        word * k1 >> top, both, shape * k1 >> top, ((shape[:-1] * k3) ^ (shape[1:] * k2)) * k1 >> top,
    )).astype(np.int64)
    index, count = np.unique(index, return_counts=True)
    value = np.sqrt(count)
    return index, value / math.sqrt(float(value @ value))


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


class Ftrl:
    """FTRL-Proximal over one shard; the last weight is the bias. `start` is what the weights are drawn to at first."""

    def __init__(self, config: Config, start: np.ndarray):
        self.c, size = config, (1 << config.bits) + 1
        self.n = np.zeros(size)
        # The state whose weights are `start` before any gradient.
        rate = config.beta / config.alpha + config.l2
        self.z = -(start * rate) - np.sign(start) * config.l1

    def weights(self, index: np.ndarray) -> np.ndarray:
        c, z = self.c, self.z[index]
        rate = (c.beta + np.sqrt(self.n[index])) / c.alpha + c.l2
        return np.where(np.abs(z) <= c.l1, 0.0, (np.sign(z) * c.l1 - z) / rate)

    def learn(self, index: np.ndarray, value: np.ndarray, label: float) -> None:
        w = self.weights(index)
        g = (_sigmoid(float(w @ value)) - label) * value
        step = (np.sqrt(self.n[index] + g * g) - np.sqrt(self.n[index])) / self.c.alpha
        self.z[index] += g - step * w
        self.n[index] += g * g


def training_rows(docs: DataFrame, labels: DataFrame, config: Config, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """`text` and `label` of all labelled rows.

    Only the key and the label leave `labels`; rows whose key or label is NULL teach nothing. A key that stands twice in `labels`, or
    in `docs`, teaches twice. Other columns are not read, whatever their names.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(
        F.col(key).alias("_key"), F.col(label).cast("double").alias("label"))
    side = F.broadcast(known) if known.count() <= config.broadcast else known
    return docs.select(F.col(key).alias("_key"), "text").join(side, "_key").select("text", "label")


def dealt(rows: DataFrame, config: Config) -> DataFrame:
    """`text`, `label`, `n` and `shard` of `text` and `label` rows: a partition holds whole shards, in the order in which they are learnt.

    `n` equal rows are one row, of `copies` at most: a common text is spread over the shards from its own on.
    """
    rows = in_small_batches(rows).where("label is not null").select("text", "label")
    shards = max(config.shards, -(-rows.count() // config.shard_rows))
    place = F.pmod(F.xxhash64("text", F.lit(config.seed)), F.lit(shards))
    counted = rows.groupBy("text", "label").agg(F.count("*").alias("all"))
    spread = counted.select("text", "label", "all", F.explode(F.sequence(F.lit(0), F.expr(f"(all - 1) div {config.copies}"))).alias("part"))
    return spread.select(
        "text", "label", F.least(F.lit(config.copies), F.col("all") - F.col("part") * config.copies).alias("n"),
        F.pmod(place + F.col("part"), F.lit(shards)).alias("shard"),
    ).repartition(shards, "shard").sortWithinPartitions("shard", F.xxhash64("text", F.lit(config.seed + 1)), "text", "label")


def fit(rows: DataFrame, config: Config = Config()) -> Model:
    """A model of all `text` and `label` (0 or 1) rows. Without rows every score is 0.5. Repeated rows count as often as
    they stand; a NULL or empty text teaches the bias alone.

    Rows of a shard are taken in an order fixed by their text, so a recomputed shard learns the same. Shards that are dealt to one task
    learn one after the other and count as one in the mean.
    """
    size = (1 << config.bits) + 1
    start = np.zeros(size)
    # The shards are written once; rounds then read them alone.
    placed = settle(dealt(rows, config))

    for _ in range(config.rounds):
        given = rows.sparkSession.sparkContext.broadcast(start.astype(np.float32))

        def train(batches: Iterator[pd.DataFrame], given=given) -> Iterator[pd.DataFrame]:
            examples = []
            for batch in batches:
                for text, label, n in zip(batch["text"], batch["label"], batch["n"]):
                    index, value = features(text, config.bits)
                    examples.append((index.astype(np.int32), value, label, n))
            if not examples:
                return
            learner = Ftrl(config, given.value.astype(float))
            for _ in range(config.epochs):
                for index, value, label, n in examples:
                    index, value = np.append(index, size - 1), np.append(value, 1.0)
                    for _ in range(n):
                        learner.learn(index, value, label)
            touched = np.flatnonzero((learner.n > 0) | (learner.z != 0))
            w = learner.weights(touched)
            yield pd.DataFrame({"index": touched, "w": w, "learners": np.where(touched == size - 1, 1, 0)})

        learnt = placed.mapInPandas(train, "index long, w double, learners long")
        # At most one row per weight, however many rows were learnt from.
        mean = learnt.groupBy("index").agg(F.sum("w").alias("w"), F.sum("learners").alias("learners")).toPandas()
        given.unpersist()
        if mean.empty:
            return Model(config.bits, np.zeros(size - 1, np.float32), 0.0)
        start = np.zeros(size)
        start[mean["index"]] = mean["w"] / max(1, int(mean["learners"].sum()))
    return Model(config.bits, start[:-1].astype(np.float32), float(start[-1]))


def scorer(df: DataFrame, model: Model, text: str = "text") -> Column:
    """Column with the probability of label 1 of each whole text; NULL and empty texts get that of the bias. Repeated rows get one
    score each, and only `text` is read."""
    shared = in_small_batches(df).sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for batch in batches:
            out = np.empty(len(batch))
            for i, body in enumerate(batch):
                index, value = features(body, m.bits)
                out[i] = _sigmoid(float(m.weights[index] @ value) + m.bias)
            yield pd.Series(out)

    return score(F.col(text))


def held_out(key: str = "doc_id", of: int = 5) -> Column:
    """Whether crc32 of the key as text leaves no remainder; false for a NULL key, which no label can name."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(of)) == 0, F.lit(False))
