"""Spans of named patterns in texts, in code points."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

Span = tuple[str, int, int]  # kind, start, end (exclusive)


def in_order(spans: Iterable[Span], kinds: Sequence[str]) -> list[Span]:
    """By start, then by the order of the kinds, then by end; repeated spans once."""
    place = {kind: i for i, kind in enumerate(kinds)}
    return sorted(set(spans), key=lambda s: (s[1], place[s[0]], s[2]))


def as_text(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def digest(spans: Iterable[Span]) -> str:
    return hashlib.sha256(as_text(spans).encode()).hexdigest()


def overlaps(span: Span, others: Iterable[Span]) -> bool:
    return any(span[1] < end and start < span[2] for _, start, end in others)


def redact(text: str, spans: Iterable[Span]) -> str:
    """The text with spans replaced by `<KIND>`; of overlapping spans the union is replaced, named by the first."""
    out, at, done = [], 0, 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = done = max(done, end)
    return "".join(out) + text[at:]
