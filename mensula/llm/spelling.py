"""Spelling variants of words, found with k-d trees over letter-count vectors.

One inserted or deleted letter changes the letter counts of a word by 1 in all (L1), one replaced letter by 2. So the words near a
word of `L` letters lie, among the words of `L` letters, at L1 distance 2, and among those of `L + 1` letters at
distance 1; shorter ones are found from the other side. For each of the two pairs of lengths a box-pruned range search over a
k-d tree gives candidates, and the order of the letters decides.

A tree per length, grown on a bounded sample, cuts the words of all rows into leaves: a word is stored in its own leaf and sent as
a query to the leaves whose box its radius touches. With a radius of 2 a word crosses two cuts at most, so that it
visits about as many leaves as the square of the tree's depth. Every leaf is searched in one task by a finer tree over
its words, whose boxes are tight. A task returns a row per word it found near words for, not a row per pair.

Words are runs of Latin letters, so that a letter is one byte of Latin-1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensula.sizing import settle

# The letters of a word, and how many occurrences a form has for one of a variant.
LETTERS = r"A-Za-zÀ-ÿ"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOMINANCE = 5


@dataclass(frozen=True)
class Config:
    """Words of `least_letters` or more that occur `least_count` times or more.

    One occurrence in `slip` loses a letter (0: none does). `leaf_words`: words that a leaf should have; `sample`: words
    that the trees are grown on, at most about. Both set the size of tasks only: beyond `sample / 8` leaves, leaves grow.
    """

    least_letters: int = 6
    least_count: int = 5
    slip: int = 199
    leaf_words: int = 4_096
    sample: int = 200_000
    fine_leaf: int = 24
    block: int = 1_024


# --- counting --------------------------------------------------------------------------------------


def occurrences(df: DataFrame, config: Config = Config(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """`word` per run of enough letters in the whole texts, A-Z in lower case, with the slips made."""
    runs = F.regexp_extract_all(F.col(text), F.lit(f"([{LETTERS}]{{{config.least_letters},}})"))
    said = df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.explode(runs).alias("run")).select(
        "k", F.translate("run", CAPITALS, SMALL).alias("run"))
    if not config.slip:
        return said.select(F.col("run").alias("word"))
    hashed = said.select("run", F.crc32(F.concat_ws(":", "k", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return hashed.select(F.when(F.col("h") % config.slip == 0, slipped).otherwise(F.col("run")).alias("word"))


def vocabulary(df: DataFrame, config: Config = Config(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """`word` and `n`, its occurrences in all texts, for words long and frequent enough."""
    counted = occurrences(df, config, key, text).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.length("word") >= config.least_letters) & (F.col("n") >= config.least_count))


# --- letter counts and trees -----------------------------------------------------------------------


def letters(words: list[str] | np.ndarray) -> np.ndarray:
    """(words, length) of the letters of words of one length, as Latin-1 bytes."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


# A place for every letter that a word can have; other bytes are never asked for.
_PLACE = np.zeros(256, np.int64)
_PLACE[list(SMALL.encode()) + list(range(0xC0, 0x100))] = np.arange(90)


def letter_counts(spelt: np.ndarray) -> np.ndarray:
    """(words, 90) of how often each letter stands in a word."""
    rows, length = spelt.shape
    flat = np.bincount((_PLACE[spelt] + 90 * np.arange(rows)[:, None]).ravel(), minlength=90 * rows)
    return flat.reshape(rows, 90).astype(np.uint8 if length < 256 else np.int32)


@dataclass(frozen=True)
class Cuts:
    """Top of a k-d tree: node `i` sends counts of letter `letter[i]` up to `most[i]` to `left[i]`, others to `right[i]`.

    Numbers below zero are leaves: `-1 - leaf`.
    """

    letter: tuple[int, ...]
    most: tuple[int, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    leaves: int

    def home(self, counts: np.ndarray) -> np.ndarray:
        """Leaf of each word."""
        out = np.zeros(len(counts), np.int64)
        todo = [(0 if self.letter else -1, np.arange(len(counts)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                low = counts[rows, self.letter[node]] <= self.most[node]
                todo += [(self.left[node], rows[low]), (self.right[node], rows[~low])]
        return out

    def touched(self, counts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, leaves): every leaf whose box is within `radius` of a word, by what the cuts say of the boxes."""
        rows_out, leaves_out = [], []
        # Distance so far in all, and per letter, since a letter can be cut again further down.
        todo = [(0 if self.letter else -1, np.arange(len(counts)), np.zeros(len(counts), np.int64), {})]
        while todo:
            node, rows, far, parts = todo.pop()
            if node < 0:
                rows_out.append(rows)
                leaves_out.append(np.full(len(rows), -1 - node))
                continue
            d, most = self.letter[node], self.most[node]
            own = counts[rows, d].astype(np.int64)
            before = parts.get(d, np.zeros(len(rows), np.int64))
            for child, gap in ((self.left[node], own - most), (self.right[node], most + 1 - own)):
                part = np.maximum(before, gap)
                total = far - before + part
                near = total <= radius
                if near.any():
                    todo.append((child, rows[near], total[near], {k: (part if k == d else v)[near] for k, v in {**parts, d: part}.items()}))
        return np.concatenate(rows_out), np.concatenate(leaves_out)


def _split(counts: np.ndarray) -> tuple[int, int] | None:
    """Letter and count that halve the words best; None when all have the same counts."""
    best = None
    for d in np.flatnonzero(counts.min(0) != counts.max(0)):
        below = np.cumsum(np.bincount(counts[:, d]))[:-1]
        most = int(np.abs(2 * below - len(counts)).argmin())
        uneven = abs(2 * int(below[most]) - len(counts))
        if best is None or uneven < best[0]:
            best = (uneven, int(d), most)
    return best and best[1:]


def grow(counts: np.ndarray, leaf: int) -> Cuts:
    """Top of a tree whose leaves hold about `leaf` of the given words; words with equal counts stay together."""
    letter, most, left, right, leaves = [], [], [], [], 0
    todo = [(np.arange(len(counts)), None, 0)]
    while todo:
        rows, parent, side = todo.pop()
        cut = _split(counts[rows]) if len(rows) > leaf else None
        if cut is None:
            name, leaves = -1 - leaves, leaves + 1
        else:
            name = len(letter)
            low = counts[rows, cut[0]] <= cut[1]
            letter.append(cut[0])
            most.append(cut[1])
            left.append(0)
            right.append(0)
            todo += [(rows[low], name, 0), (rows[~low], name, 1)]
        if parent is not None:
            (left, right)[side][parent] = name
    return Cuts(tuple(letter), tuple(most), tuple(left), tuple(right), max(leaves, 1))


# --- search within a leaf --------------------------------------------------------------------------


def _in_range(stored: np.ndarray, asked: np.ndarray, radius: int, leaf: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(queries, stored words) whose counts differ by exactly `radius`, through a tree with tight boxes over the stored words."""
    todo = [(np.arange(len(stored)), np.arange(len(asked)))]
    while todo:
        words, queries = todo.pop()
        if not len(words) or not len(queries):
            continue
        inside = stored[words]
        low, high = inside.min(0), inside.max(0)
        near = []
        for s in range(0, len(queries), 8 * block):
            q = asked[queries[s:s + 8 * block]]
            over = np.maximum(q, high) - high
            under = low - np.minimum(q, low)
            near.append(over.sum(1, dtype=np.int64) + under.sum(1, dtype=np.int64) <= radius)
        queries = queries[np.concatenate(near)]
        if not len(queries):
            continue
        cut = _split(inside) if len(words) > leaf else None
        if cut is not None:
            below = inside[:, cut[0]] <= cut[1]
            todo += [(words[below], queries), (words[~below], queries)]
            continue
        # Only letters that the leaf's words or the query have count; large leaves (equal counts) go in blocks.
        for s in range(0, len(queries), block):
            q = asked[queries[s:s + block]]
            for t in range(0, len(words), leaf):
                w = inside[t:t + leaf]
                apart = (np.maximum(q[:, None], w[None]) - np.minimum(q[:, None], w[None])).sum(-1, dtype=np.int64)
                i, j = np.nonzero(apart == radius)
                yield queries[s + i], words[t + j]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether taking one letter out of `long` gives `short`: equal heads and equal tails cover the short word."""
    head = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(1)
    tail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= short.shape[1]


def _near_in_leaf(config: Config):
    """Near words of each word of a leaf: a row per word found, `n_near` and the best of them (`form_n`, `form`)."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        found: dict[str, list] = {}

        def note(word, n, near):
            mine = found.setdefault(word, [0, 0, ""])
            mine[0] += 1
            if n > mine[1] or (n == mine[1] and near < mine[2]):
                mine[1], mine[2] = n, near

        stored = group[group["role"] == 0]
        if len(stored):
            words, n = stored["word"].to_numpy(), stored["n"].to_numpy()
            spelt = letters(words)
            counts = letter_counts(spelt)
            home = stored["home"].to_numpy()
            for role, radius, check in ((1, 2, one_replaced), (2, 1, one_inserted)):
                asked = group[group["role"] == role]
                if not len(asked):
                    continue
                words_q, n_q, home_q = asked["word"].to_numpy(), asked["n"].to_numpy(), asked["home"].to_numpy()
                spelt_q = letters(words_q)
                for q, w in _in_range(counts, letter_counts(spelt_q).astype(counts.dtype), radius, config.fine_leaf, config.block):
                    # Of two words of one length each pair is looked at once: from the lower leaf, or the lower word.
                    if role == 1:
                        once = (home_q[q] < home[w]) | ((home_q[q] == home[w]) & (words_q[q] < words[w]))
                        q, w = q[once], w[once]
                    good = check(spelt_q[q], spelt[w])
                    for i, j in zip(q[good].tolist(), w[good].tolist()):
                        note(words_q[i], n[j], words[j])
                        note(words[j], n_q[i], words_q[i])
        return pd.DataFrame(
            [(word, *best) for word, best in found.items()], columns=["word", "n_near", "form_n", "form"]
        ).astype({"n_near": "int64", "form_n": "int64"})

    return run


def near_words(words: DataFrame, config: Config = Config()) -> DataFrame:
    """`word`, `n_near`, `form_n`, `form` (the near word of largest `form_n`, of equal ones the first in code-point order)
    for every word of the table (`word`, `n`; words distinct) that has a near word."""
    c = config
    sized = words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()  # a row per length
    rows = {r["length"]: r["n"] for r in sized}
    share = min(1.0, c.sample / max(1, sum(rows.values())))
    place = F.pmod(F.xxhash64("word", F.lit(11)), F.lit(1 << 30))
    drawn: dict[int, list[str]] = {}
    if max(rows.values(), default=0) > c.leaf_words:
        for r in words.where(place < F.lit(int(share * (1 << 30)) + 1)).select("word").toLocalIterator():
            drawn.setdefault(len(r["word"]), []).append(r["word"])
    trees = {}
    for length, n in rows.items():
        sample = sorted(drawn.get(length, [])) if n > c.leaf_words else []
        # As many sampled words a leaf as stand for `leaf_words`, but eight at least.
        trees[length] = grow(letter_counts(letters(sample)), max(8, math.ceil(c.leaf_words * len(sample) / n))) if sample else Cuts((), (), (), (), 1)
    shared = words.sparkSession.sparkContext.broadcast(trees)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, n = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
            size = np.array([len(w) for w in names], np.int64)
            out = []  # (rows, length of the leaf's words, leaf, own leaf, role)
            for length in np.unique(size):
                at = np.flatnonzero(size == length)
                counts = letter_counts(letters(names[at]))
                own = shared.value[length].home(counts)
                out.append((at, length, own, own, 0))
                i, leaf = shared.value[length].touched(counts, 2)
                once = leaf >= own[i]
                out.append((at[i[once]], length, leaf[once], own[i[once]], 1))
                if length + 1 in shared.value:
                    i, leaf = shared.value[length + 1].touched(counts, 1)
                    out.append((at[i], length + 1, leaf, own[i], 2))
            if not out:
                continue
            at = np.concatenate([o[0] for o in out])
            told = [np.concatenate([np.full(len(o[0]), o[k]) if k in (1, 4) else o[k] for o in out]) for k in (1, 2, 3, 4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(told[0], pa.int32()), pa.array(told[1], pa.int32()), pa.array(told[2], pa.int32()), pa.array(told[3], pa.int32()),
                 pa.array(names[at], pa.string()), pa.array(n[at], pa.int64())], names=["length", "leaf", "home", "role", "word", "n"])

    routed = words.select("word", "n").mapInArrow(route, "length int, leaf int, home int, role int, word string, n long")
    partial = routed.groupBy("length", "leaf").applyInPandas(_near_in_leaf(c), "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form")))
    return partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame, most: int, least: int, dominance: int = DOMINANCE) -> DataFrame:
    """`word`, `root` of every word with a form (`word`, `form`): the end of its chain of forms.

    A form occurs `dominance` times as often as its variant, so a chain from `least` to `most` occurrences has few links, and
    following all of them takes the binary logarithm of that many joins.
    """
    links = int(math.log(max(most / least, 1), dominance) + 1e-9)
    at = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, links - 1).bit_length()):
        at = settle(at)
        onward = at.select(F.col("word").alias("via"), F.col("root").alias("further"))
        at = at.join(onward, at["root"] == onward["via"], "left").select("word", F.coalesce("further", "root").alias("root"))
    return at


def variants(df: DataFrame, config: Config = Config(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near`, `form_n`: every word of the texts with the spelling it is a variant of.

    Two words are near if one inserted, deleted or replaced letter makes one the other. `form` is the near word of largest `n` (of
    equal ones the first in code-point order) if it occurs at least `DOMINANCE` times as often, else NULL, and so is `form_n`;
    `root` ends the chain of forms, and is the word itself without one. NULL, empty and letterless texts have no word.
    Repeated rows count as often as they stand. A NULL key slips as an empty one. An empty table gives no row.
    Other columns are not read.
    """
    words = settle(vocabulary(df, config, key, text))
    near = near_words(words, config)
    judged = settle(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *(F.when(F.col("form_n") >= DOMINANCE * F.col("n"), F.col(c)).alias(c) for c in ("form", "form_n"))))
    most = words.agg(F.max("n")).first()[0] or config.least_count
    ends = roots(judged.where("form is not null"), most, config.least_count)
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
