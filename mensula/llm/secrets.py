"""Secrets by fixed formats and by automata learnt from examples.

Base formats are patterns. Beyond them, every long run of credential characters that does not lie inside a base span is a candidate
(it may hold a base span: then it is reported beside it) and is scored by its format: a prefix tree of labelled credentials, as strings of character
classes, is generalised by merging states whose continuations are statistically compatible
(Hoeffding bounds), which gives a probabilistic automaton. The same is done with ordinary runs. A candidate
is a secret when its likelihood under the automaton of credentials exceeds that under the automaton of ordinary runs by a margin
per character.

Training reads bounded samples of labelled runs, drawn by hash over the whole corpus, each run whole; in the prefix tree a
chain that one string alone passes is one edge until something has to be compared with it. Scanning reads each text once, within its row, without
a shuffle, and takes time linear in the text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensula.sizing import settle

from . import spans
from .spans import Span

BASE_KINDS = ("assign", "access", "hex")
LEARNT = "format"
KINDS = (*BASE_KINDS, LEARNT)

_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_KEYWORD = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{12,}")


def base_spans(text: str) -> list[Span]:
    """Matches of the base formats: leftmost, not overlapping within a kind, in order."""
    found: list[Span] = []
    low = text.lower()
    if any(k in low for k in _KEYWORD):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return spans.in_order(found, KINDS)


# --- probabilistic automata --------------------------------------------------------------------

_SIGNS = {**dict.fromkeys("0123456789", "9"), **dict.fromkeys("abcdef", "a"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "g"),
          **dict.fromkeys("ABCDEF", "A"), **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "G"),
          **dict.fromkeys("+/", "+"), **dict.fromkeys("_-", "-"), **dict.fromkeys("=.", "=")}
_WIDTH = {"9": 10, "a": 6, "g": 20, "A": 6, "G": 20, "+": 2, "-": 2, "=": 2}
END = "$"


def signs(run: str) -> str:
    """The classes of the characters of a run."""
    return "".join(_SIGNS.get(c, "?") for c in run)


def shortened(word: str) -> str:
    """Signs with a number behind each, which tells how often it stands there in a row."""
    return " ".join(f"{sign}{len(list(same))}" for sign, same in groupby(word))


def restored(short: str) -> str:
    return "".join(part[0] * int(part[1:]) for part in short.split())


@dataclass
class State:
    """`rest`: a string and a place in it, when nothing but the rest of that string follows; it is not spelt out yet."""

    count: int = 0
    ends: int = 0
    hits: Counter = field(default_factory=Counter)
    to: dict[str, int] = field(default_factory=dict)
    rest: tuple[str, int] | None = None


@dataclass(frozen=True)
class Automaton:
    """Transitions with log-probabilities: state -> sign -> (next state, log p); `END` closes a string."""

    steps: tuple[dict[str, tuple[int, float]], ...]
    unseen: float

    def score(self, word: str) -> float:
        """Log-likelihood of a string of signs. What was never seen costs `unseen` and returns to the start."""
        at, total = 0, 0.0
        for sign in word:
            at, p = self.steps[at].get(sign, (0, self.unseen))
            total += p
        return total + self.steps[at].get(END, (0, self.unseen))[1]


def infer(words: list[str], alpha: float = 0.05) -> Automaton:
    """Automaton of the examples: their prefix tree with compatible states merged, lowest first.

    Whole strings count, however long. The result does not depend on the order of the examples. No example gives an automaton to which all is unseen.
    """
    if not words:
        return Automaton(({},), math.log(1e-3))
    states = [State()]

    def spelt(i: int) -> State:
        """The state, with the next step of its chain made."""
        state = states[i]
        if state.rest is not None:
            (word, at), state.rest = state.rest, None
            if at == len(word):
                state.ends = state.count
            else:
                state.hits[word[at]] = state.count
                state.to[word[at]] = len(states)
                states.append(State(state.count, rest=(word, at + 1)))
        return state

    for word, n in sorted(Counter(words).items()):
        at = 0
        for place, sign in enumerate(word):
            state = spelt(at)
            state.count += n
            state.hits[sign] += n
            if sign not in state.to:
                state.to[sign] = len(states)
                states.append(State(n, rest=(word, place + 1)))
                break
            at = state.to[sign]
        else:
            state = spelt(at)
            state.count += n
            state.ends += n

    far = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(f1: int, n1: int, f2: int, n2: int) -> bool:
        return n1 > 0 and n2 > 0 and abs(f1 / n1 - f2 / n2) > far * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            # A state that one string passed differs from none, nor does anything below it.
            if x == y or min(states[x].count, states[y].count) < 2:
                continue
            x, y = spelt(x), spelt(y)
            if differ(x.ends, x.count, y.ends, y.count):
                return False
            for sign in x.hits.keys() | y.hits.keys():
                if differ(x.hits[sign], x.count, y.hits[sign], y.count):
                    return False
                if sign in x.to and sign in y.to:
                    todo.append((x.to[sign], y.to[sign]))
        return True

    def fold(a: int, b: int) -> None:
        """Adds the tree below `b` to `a`."""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            into, tree = spelt(x), spelt(y)
            into.count += tree.count
            into.ends += tree.ends
            into.hits.update(tree.hits)
            for sign, child in tree.to.items():
                if sign in into.to:
                    todo.append((into.to[sign], child))
                else:
                    into.to[sign] = child

    kept = [0]
    while edge := next(((r, s) for r in kept for s in sorted(spelt(r).to) if states[r].to[s] not in kept), None):
        parent, sign = edge
        blue = states[parent].to[sign]
        for red in kept:
            if compatible(red, blue):
                states[parent].to[sign] = red
                fold(red, blue)
                break
        else:
            kept.append(blue)

    number = {state: i for i, state in enumerate(kept)}
    steps = []
    for state in (states[k] for k in kept):
        total = sum(state.hits.values()) + state.ends + 0.01 * (len(_WIDTH) + 1)
        step = {s: (number[state.to[s]], math.log((n + 0.01) / total / _WIDTH.get(s, 1))) for s, n in state.hits.items()}
        if state.ends:
            step[END] = (0, math.log((state.ends + 0.01) / total))
        steps.append(step)
    return Automaton(tuple(steps), math.log(1e-4))


@dataclass(frozen=True)
class Formats:
    credential: Automaton
    ordinary: Automaton
    margin: float

    def is_secret(self, run: str) -> bool:
        word = signs(run)
        return self.credential.score(word) - self.ordinary.score(word) > self.margin * len(word)


@dataclass(frozen=True)
class Config:
    """`examples`: runs of either label to learn from, and `characters`: how many these have together, both at most about;
    `margin`: log-likelihood per character that a secret must gain."""

    examples: int = 4_000
    characters: int = 4_000_000
    margin: float = 0.25
    alpha: float = 0.05


def candidates(text: str, base: list[Span], alone: bool = False) -> list[tuple[int, int]]:
    """All long runs of credential characters that do not lie inside a base span; with `alone`, those that touch none."""
    taken = sorted((s, e) for _, s, e in base)
    out, k, reach = [], 0, 0  # `reach`: where the base spans end that start early enough to matter
    for m in _RUN.finditer(text):
        start, end = m.span()
        while k < len(taken) and (taken[k][0] < end if alone else taken[k][0] <= start):
            reach = max(reach, taken[k][1])
            k += 1
        if reach <= start if alone else reach < end:
            out.append((start, end))
    return out


def examples(df: DataFrame, text: str = "text") -> DataFrame:
    """`label`, `h` (a hash), `word` (shortened signs) and `length` of all distinct labelled runs: values in base spans are
    credentials (1), long runs without a digit that touch no base span are ordinary (0)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for body in batch.column(0):
                t = body.as_py() or ""
                base = base_spans(t)
                for kind, start, end in base:
                    seen.add((1, _ASSIGN.fullmatch(t, start, end)[2] if kind == "assign" else t[start:end]))
                for start, end in candidates(t, base, alone=True):
                    run = t[start:end]
                    if not any(c.isdigit() for c in run):
                        seen.add((0, run))
            rows = sorted(seen)
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int32()), pa.array([xxhash.xxh64_intdigest(r[1], 7) >> 1 for r in rows], pa.int64()),
                pa.array([shortened(signs(r[1])) for r in rows], pa.string()), pa.array([len(r[1]) for r in rows], pa.int64()),
            ], names=["label", "h", "word", "length"])

    return df.select(text).mapInArrow(find, "label int, h long, word string, length long").distinct()


def learn(df: DataFrame, config: Config = Config(), text: str = "text") -> Formats:
    """Formats of the corpus, from about `config.examples` whole runs of each label at most.

    All distinct labelled runs are counted; the sample takes each of a label with the same chance, by a hash of the run,
    which keeps to `config.characters` as well.
    """
    runs = settle(examples(df, text))
    sizes = runs.groupBy("label").agg(F.count("*").alias("n"), F.sum("length").alias("length")).collect()
    share = {r["label"]: min(config.examples / r["n"], config.characters / r["length"]) for r in sizes}
    limit = lambda label: F.lit(int(min(1.0, share.get(label, 1.0)) * (1 << 30)))
    place = F.pmod(F.col("h"), F.lit(1 << 30))
    chosen = runs.where(place < F.when(F.col("label") == 1, limit(1)).otherwise(limit(0))).collect()
    words = {label: sorted(restored(r["word"]) for r in chosen if r["label"] == label) for label in (0, 1)}
    return Formats(infer(words[1], config.alpha), infer(words[0], config.alpha), config.margin)


def all_spans(text: str | None, formats: Formats) -> tuple[list[Span], list[Span]]:
    """(base spans, base and learnt spans) of a whole text, in order."""
    text = text or ""
    base = base_spans(text)
    extra = [(LEARNT, s, e) for s, e in candidates(text, base) if formats.is_secret(text[s:e])]
    return base, spans.in_order([*base, *extra], KINDS)


def scan(df: DataFrame, formats: Formats, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, counts of base spans, of learnt spans, a digest of the base spans, and all spans, per row.

    NULL and empty texts have no span. Repeated rows and NULL keys give a row each; other columns are not read.
    """
    shared = df.sparkSession.sparkContext.broadcast(formats)
    names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body in batch.column(1):
                base, found = all_spans(body.as_py(), shared.value)
                n = Counter(k for k, _, _ in found)
                rows.append((*(n[k] for k in KINDS), spans.digest(base), spans.as_text(found)))
            made = [pa.array([r[i] for r in rows], pa.int64() if i < len(KINDS) else pa.string()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=[key, *names])

    kind = df.schema[key].dataType.simpleString()
    types = ", ".join(f"{n} {'long' if n.startswith('n_') else 'string'}" for n in names)
    return df.select(key, text).mapInArrow(find, f"`{key}` {kind}, {types}")
