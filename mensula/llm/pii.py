"""Personal data by fixed formats and by boosted trees over overlapping candidates.

Base formats are patterns with checks. Beyond them, generators of high recall propose spans that
may overlap: addresses written with "at" and "dot", every run of neighbouring groups of digits with any separators
that has as many digits as a kind allows, dotted numbers. Trees see the
format of a span and its context; a threshold per kind, calibrated on all candidates weighted by how often they stand in the
corpus, each scored by trees that have not seen it, picks spans, and of overlapping ones those stay that together hold the most digits or letters, weighted by probability. Trees learn from the base formats themselves: what they accept
is personal, what has their form and misses a check (Luhn, ranges, lengths, domains) is not, and other spellings, which no
format judges, are left to the trees. Accepted telephones are learnt in their national spellings too.

Training counts every candidate of the corpus that has a label, in Spark: trees and thresholds come from all of them. There are trees of either
half of the candidates, a span is scored by the mean of both, and thresholds come from the scores of each half by the trees of the other. Scanning reads each
text once, within its row, without a shuffle, in time linear in the text.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensula.sizing import settle

from . import spans, trees
from .common import in_small_batches
from .spans import Span

BASE_KINDS = ("email", "ip", "card", "phone")
LEARNT = ("like_email", "like_ip", "like_card", "like_phone")
KINDS = (*BASE_KINDS, *LEARNT)

# --- base formats --------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, each found from its `@`."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", at + 1)


def _card_digits(s: str) -> bool:
    digits = _digits(s) if len(s) <= 40 else ""
    return 12 <= len(digits) <= 19 and luhn(digits)


# What a match of a base format must also be.
_CHECK = {
    "email": lambda s: "." in s.rpartition("@")[2],
    "ip": lambda s: all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split(".")),
    "card": _card_digits,
    "phone": lambda s: 9 <= sum("0" <= c <= "9" for c in s) <= 15,
}


def base_spans(text: str) -> list[Span]:
    """Matches of the base formats that pass their checks: leftmost, not overlapping within a kind, in order."""
    found: list[Span] = [("email", s, e) for s, e in _emails(text)]
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        if kind != "phone" or "+" in text:
            found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if _CHECK[kind](m[0])]
    return spans.in_order(found, KINDS)


# --- candidates ----------------------------------------------------------------------------------

_SPELT = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|[\[(]\x20?(?i:at)\x20?[\])])\x20?[A-Za-z0-9-]++"
    r"(?:\x20?(?:\.|[\[(]\x20?(?i:dot)\x20?[\])])\x20?[A-Za-z0-9-]++)*+"
)
_STRETCH = re.compile(r"(?<![0-9])[0-9]++(?:[\x20./()-]{1,3}[0-9]++)*+")
_GROUP = re.compile(r"[0-9]+")
_SIGN_AT = re.compile(r"\x20?[\[(]\x20?(?i:at)\x20?[\])]\x20?")
_SIGN_DOT = re.compile(r"\x20?[\[(]\x20?(?i:dot)\x20?[\])]\x20?")
_HAS_SIGN = re.compile(r"@|[\[(]\x20?(?i:at)\x20?[\])]")
DIGITS = {"like_phone": (7, 15), "like_card": (12, 19)}
LEAST_DIGITS, MOST_DIGITS = 7, 19


@dataclass(frozen=True)
class Candidate:
    kind: str
    start: int
    end: int


def _runs(text: str, groups: list[tuple[int, int]]) -> Iterator[Candidate]:
    """Every run of neighbouring groups of a stretch with as many digits as a kind allows, and of four groups with dots between.

    A run has no more groups than digits, so their number is linear in the text. It starts with its plus and the
    parenthesis that it closes.
    """
    dots = [text.count(".", e, s) == 1 for (_, e), (s, _) in zip(groups, groups[1:])]
    for i, (first, closed) in enumerate(groups):
        n = 0
        for j in range(i, len(groups)):
            n += groups[j][1] - groups[j][0]
            ip = j == i + 3 and all(dots[i:j])
            if n > MOST_DIGITS and j > i + 3:
                break
            start, end = first, groups[j][1]
            if j > i and text[start - 1:start] == "(" and text[closed:closed + 1] == ")":
                start -= 1
            if text[start - 1:start] == "+":
                start -= 1
            if ip:
                yield Candidate("like_ip", start, end)
            for kind, (least, most) in DIGITS.items():
                if least <= n <= most:
                    yield Candidate(kind, start, end)


def candidates(text: str) -> list[Candidate]:
    """Spans that may be personal, overlapping: every generator proposes for itself."""
    out = []
    if _HAS_SIGN.search(text):
        out += [Candidate("like_email", *m.span()) for m in _SPELT.finditer(text)]
    for m in _STRETCH.finditer(text):
        if m.end() - m.start() >= LEAST_DIGITS:
            out += _runs(text, [g.span() for g in _GROUP.finditer(text, *m.span())])
    return out


CUES = {
    "like_email": ("mail", "contact", "write"), "like_ip": ("ip", "host", "server", "address"),
    "like_card": ("card", "visa", "credit", "karte", "carte", "tarjeta"), "like_phone": ("phone", "tel", "call", "mobile", "fax"),
}
CONTEXT = 24


def features(text: str, c: Candidate) -> list[float]:
    """Format and context of a candidate."""
    s = text[c.start:c.end]
    if c.kind == "like_email":
        s = _SIGN_DOT.sub(".", _SIGN_AT.sub("@", s)).replace(" ", "")
    digits = _digits(s)
    parts = re.findall(r"[0-9]+", s)
    before, after = text[max(0, c.start - CONTEXT):c.start].lower(), text[c.end:c.end + CONTEXT].lower()
    sizes = [len(p) for p in parts] or [0]
    domain = s.rpartition("@")[2]
    return [
        float(LEARNT.index(c.kind)), len(s), len(digits), len(parts), max(sizes), min(sizes), sizes[0], sizes[-1],
        s.startswith("+"), "(" in s, s.count("."), s.count("-"), s.count(" "), s.count("@"), "." in domain and "@" in s,
        12 <= len(digits) <= 19 and luhn(digits), max((int(p) if len(p) < 5 else 9_999 for p in parts), default=0) <= 255,
        len(set(digits)), bool(digits) and digits[0] in "3456", before[-1:].isalnum(), after[:1].isalnum(),
        any(cue in before for cue in CUES[c.kind]), any(cue in after for cue in CUES[c.kind]),
    ]


_FORM = {
    "like_email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+"), "like_ip": re.compile(r"[0-9]+(?:\.[0-9]+){3}"),
    "like_card": _CARD, "like_phone": _PHONE,
}


def _wrong(text: str, c: Candidate) -> bool:
    """Has the base form of its kind and fails the check."""
    return bool(_FORM[c.kind].fullmatch(text, c.start, c.end)) and not _CHECK[c.kind.removeprefix("like_")](text[c.start:c.end])


_DATE = re.compile(r"(?:19|20)[0-9]{2}([./-])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])([./-])(?:0?[1-9]|1[0-2])\2(?:19|20)[0-9]{2}")
_COUNTRY = re.compile(r"\+[0-9]{1,3}[\x20().-]+(?=[0-9])")


def _national(phone: str) -> list[str]:
    """Spellings of a telephone with a plus that have none: without the plus, without the country code, with a 0 for it."""
    out = [phone[1:]]
    if m := _COUNTRY.match(phone):
        rest = phone[m.end():]
        opened = m[0].count("(") > m[0].count(")")
        out += ["(" + rest if opened else rest, "0" + rest.replace(")", "", 1) if opened else "0" + rest]
    return [s for s in out if sum("0" <= c <= "9" for c in s) >= LEAST_DIGITS]


def _within_other(c: Candidate, near: list[tuple[int, int, str]], k: int) -> bool:
    """Lies within a base span of another kind; base spans before the `k`-th end before the candidate."""
    while k < len(near) and near[k][0] <= c.start:
        if c.end <= near[k][1] and near[k][2] != c.kind:
            return True
        k += 1
    return False


def _labelled(text: str) -> Iterator[tuple[int, list[float]]]:
    """Label and features of the candidates that the base formats can judge: 1 what they accept, 0 what has the form of
    its kind and fails its check, what lies within a span they accept as another kind, and dates as telephones. Others have no label:
    what passes its check is not wrong because its neighbour kept the base pattern from seeing it, and no base format
    judges a telephone without a plus. For those, accepted telephones are repeated in national spellings, in their place."""
    base = base_spans(text)
    accepted = {(f"like_{k}", s, e) for k, s, e in base}
    near = sorted((s, e, f"like_{k}") for k, s, e in base)
    k = 0
    for c in sorted(candidates(text), key=lambda c: c.start):
        while k < len(near) and near[k][1] <= c.start:
            k += 1
        if (c.kind, c.start, c.end) in accepted:
            yield 1, features(text, c)
            if c.kind == "like_phone":
                before, after = text[max(0, c.start - CONTEXT):c.start], text[c.end:c.end + CONTEXT]
                for s in _national(text[c.start:c.end]):
                    yield 1, features(before + s + after, Candidate(c.kind, len(before), len(before) + len(s)))
        elif _within_other(c, near, k) or _wrong(text, c) or c.kind == "like_phone" and _DATE.fullmatch(text, c.start, c.end):
            yield 0, features(text, c)


# --- learning and scanning -------------------------------------------------------------------------


@dataclass(frozen=True)
class Config:
    """`precision`: share of right spans that the threshold of each kind has to reach; `judged`: candidates of a kind that its own
    threshold takes, of either label."""

    precision: float = 0.9
    judged: int = 20


@dataclass(frozen=True)
class Detector:
    """`model`: trees of one half of the candidates, calibrated on the other; `cuts`: the least score (logit) of a learnt span of each kind, in the
    order of `LEARNT`; `whole`: the mean of `model` and of the trees of the other half, calibrated on all, which scores spans."""

    model: trees.Boosted
    cuts: tuple[float, ...]
    whole: trees.Boosted


def thresholds(model: trees.Boosted, x: np.ndarray, label: np.ndarray, n: np.ndarray, config: Config = Config()) -> tuple[float, ...]:
    """The smallest score of each kind at which the share of label 1 reaches the wanted precision; infinite if none does.

    It is the share at that score, not of all rows above it: rows that are surely right do not pay for doubtful ones. The trees have not seen the
    rows, which weigh as often as they stand in the corpus; `learn` takes all candidates, each half scored by the trees of the other. A kind with too few rows of
    either label takes the score at which the calibration over all kinds reaches that precision.
    """
    score = model.logit(x) if model.trees else np.zeros(len(x))
    return _cuts(model, pd.DataFrame({"group": x[:, 0], "score": score, "ones": label, "zeros": 1 - label, "right": n * label, "wrong": n * (1 - label)}), config)


def _cuts(model: trees.Boosted, judged: pd.DataFrame, config: Config) -> tuple[float, ...]:
    """`thresholds` from rows counted by kind and score."""

    def least(knots: np.ndarray, shares: np.ndarray) -> float:
        enough = shares >= config.precision
        return float(knots[enough].min()) if enough.any() else math.inf

    common = least(model.knots, model.shares)
    if not model.trees:
        return (-math.inf if common < math.inf else math.inf,) * len(LEARNT)
    cuts = []
    for kind in range(len(LEARNT)):
        mine = judged[judged["group"] == kind]
        if min(mine["ones"].sum(), mine["zeros"].sum()) < config.judged:
            cuts.append(common)
            continue
        right, n = mine["right"].to_numpy(float), (mine["right"] + mine["wrong"]).to_numpy(float)
        cuts.append(least(*trees.isotonic(mine["score"].to_numpy(), right / n, n)))
    return tuple(cuts)


def learn(df: DataFrame, config: Config = Config(), text: str = "text") -> Detector:
    """Detector of the corpus, from all labelled candidates: equal feature rows are one row with their number. Every row teaches the trees of
    its half, and counts for the thresholds by its score from the trees of the other half, as often as it stands in the corpus."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter((y, tuple(float(v) for v in x)) for body in batch.column(0) for y, x in _labelled(body.as_py() or ""))
            rows = sorted(seen)
            yield pa.RecordBatch.from_arrays([
                pa.array([y for y, _ in rows], pa.int32()), pa.array([list(x) for _, x in rows], pa.list_(pa.float64())),
                pa.array([seen[r] for r in rows], pa.int64()),
            ], names=["label", "x", "n"])

    found = settle(in_small_batches(df).select(text).mapInArrow(find, "label int, x array<double>, n long").groupBy("label", "x").agg(F.sum("n").alias("n")))
    model, whole, judged = trees.boost_rows(found, F.get("x", F.lit(0)))
    return Detector(model, _cuts(whole, judged, config), whole)


def _choose(scored: list[tuple[Candidate, float]], text: str) -> list[Candidate]:
    """Candidates that do not overlap and hold the most digits (letters and digits of addresses), weighted by probability.

    Fewer spans win among equals, then the earlier ones.
    """
    order = sorted(scored, key=lambda cp: (cp[0].end, cp[0].start, KINDS.index(cp[0].kind)))
    ends = [c.end for c, _ in order]
    best, taken = [0.0], []
    for i, (c, p) in enumerate(order):
        before = bisect_right(ends, c.start, 0, i)
        gain = best[before] + p * sum(x.isalnum() for x in text[c.start:c.end]) - 1e-6
        taken.append(before if gain > best[-1] else -1)
        best.append(max(gain, best[-1]))
    chosen, i = [], len(order)
    while i:
        if taken[i - 1] >= 0:
            chosen.append(order[i - 1][0])
            i = taken[i - 1]
        else:
            i -= 1
    return chosen[::-1]


def all_spans(text: str | None, detector: Detector) -> tuple[list[Span], list[Span]]:
    """(base spans, base and learnt spans) of a whole text, in order. A learnt span overlaps no other span."""
    text = text or ""
    base = base_spans(text)
    near = sorted((s, e) for _, s, e in base)
    free, k = [], 0
    for c in sorted(candidates(text), key=lambda c: (c.start, c.end)):
        while k < len(near) and near[k][1] <= c.start:
            k += 1
        # Base spans of different kinds may overlap; looking on until they start behind the candidate sees them all.
        j, clear = k, True
        while clear and j < len(near) and near[j][0] < c.end:
            clear = near[j][1] <= c.start
            j += 1
        if clear:
            free.append(c)
    if not free:
        return base, base
    x = np.array([features(text, c) for c in free], float)
    logit = detector.whole.logit(x)
    sure = np.flatnonzero(logit >= np.array(detector.cuts)[x[:, 0].astype(int)])
    chosen = _choose([(free[i], p) for i, p in zip(sure.tolist(), detector.whole.calibrated(logit[sure]).tolist())], text)
    return base, spans.in_order([*base, *((c.kind, c.start, c.end) for c in chosen)], KINDS)


def scan(df: DataFrame, detector: Detector, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, counts of base spans, a digest of the base spans, and all spans, per row.

    NULL and empty texts have no span. Repeated rows and NULL keys give a row each; other columns are not read.
    """
    shared = in_small_batches(df).sparkSession.sparkContext.broadcast(detector)
    names = [*(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body in batch.column(1):
                base, found = all_spans(body.as_py(), shared.value)
                n = Counter(k for k, _, _ in base)
                rows.append((*(n[k] for k in BASE_KINDS), spans.digest(base), spans.as_text(found)))
            made = [pa.array([r[i] for r in rows], pa.int64() if i < len(BASE_KINDS) else pa.string()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=[key, *names])

    kind = df.schema[key].dataType.simpleString()
    types = ", ".join(f"{n} {'long' if n.startswith('n_') else 'string'}" for n in names)
    return df.select(key, text).mapInArrow(find, f"`{key}` {kind}, {types}")


def redacted(df: DataFrame, detector: Detector, text: str = "text") -> Column:
    """Column with the text whose spans are replaced by their kind; NULL stays NULL."""
    shared = in_small_batches(df).sparkSession.sparkContext.broadcast(detector)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: t if t is None else spans.redact(t, all_spans(t, shared.value)[1]))

    return clean(F.col(text))
