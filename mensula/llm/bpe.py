"""Byte-level BPE encoding and decoding in linear time.

Bytes are mapped to the Latin-1 characters of the same number, so that an Aho-Corasick automaton
of the vocabulary finds in one pass the longest token that starts at each byte. Encoding goes from
longest match to longest match. A token may follow another only if merging their joined bytes by
rank gives just these two; when it may not, the next shorter token is tried, and when none is
left, the last token is taken back and its end is marked as closed. The answers on neighbours are
kept (each asks only for the merges along the border). Each byte position is closed at most once and tokens have bounded length, so the work is
linear in the bytes, and what is found is exactly what the merges by rank give.

Texts are first cut by the pattern that belongs to the ranks. Pieces already seen are looked up;
their number is bounded. Texts are read whole, within their row; nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Known

KNOWN_PIECES, LONGEST_KNOWN = 300_000, 24
KNOWN_PAIRS = 300_000
# Letters and digits of the plain alphabet, in which the built-in patterns do for the Unicode classes.
PLAIN_LETTERS, PLAIN_DIGITS = "A-Za-zÀ-ÖØ-öø-ÿ", "0-9"
_PLAIN_TEXT = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*+")


def plain_pattern(pattern: str) -> str:
    """The pattern with `\\p{L}` and `\\p{N}` spelt out for the plain alphabet, inside and outside of brackets."""
    out, inside = [], False
    for part in re.split(r"(\\p\{[LN]\}|\\.|[\[\]])", pattern):
        if part in (r"\p{L}", r"\p{N}"):
            range_ = PLAIN_LETTERS if part == r"\p{L}" else PLAIN_DIGITS
            part = range_ if inside else f"[{range_}]"
        elif part in "[]" and part:
            inside = part == "["
        out.append(part)
    return "".join(out)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, of a file with a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Bpe:
    """Encoder and decoder of one vocabulary. All 256 single bytes must have a rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self._cut, self._cut_plain = regex.compile(pattern).findall, re.compile(plain_pattern(pattern)).findall
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), len(token) << 32 | rank)
        self.automaton.make_automaton()
        self._shorter: dict[int, int] = {}
        self._split: dict[int, tuple[int, int]] = {}
        self._pairs: dict[int, bool] = {}
        self._pieces = Known(self._ids_of, KNOWN_PIECES, LONGEST_KNOWN)

    def merge(self, data: bytes) -> list[int]:
        """Merges by rank as they are defined, for a few tokens' worth of bytes."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 62:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge made this one."""
        known = self._split.get(token)
        if known is None:
            data = self.bytes_of[token]
            parts = [data[i:i + 1] for i in range(len(data))]
            while len(parts) > 2:
                _, i = min((self.ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            known = self._split[token] = (self.ranks[parts[0]], self.ranks[parts[1]])
        return known

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives just these two.

        Going back in time from the two tokens, the later merge of the two at the border is undone
        each time; at no time may the pieces at the border have merged before the merge just undone.
        """
        pair = left << 32 | right
        known = self._pairs.get(pair)
        if known is not None:
            return known
        size, ranks = self.bytes_of, self.ranks
        limit, known = 1 << 62, True
        while known:
            merged = ranks.get(size[left] + size[right])
            if merged is not None and merged < limit:
                known = False
            elif len(size[left]) > 1 and (left > right or len(size[right]) == 1):
                limit, left = left, self._halves(left)[1]
            elif len(size[right]) > 1:
                limit, right = right + 1, self._halves(right)[0]  # of equal merges the left one comes first
            else:
                break
        if len(self._pairs) >= KNOWN_PAIRS:
            self._pairs.clear()
        self._pairs[pair] = known
        return known

    def _next_shorter(self, token: int) -> int:
        """Rank of the longest token that is a proper prefix, or -1."""
        known = self._shorter.get(token)
        if known is None:
            data = self.bytes_of[token]
            known = next((self.ranks[data[:n]] for n in range(len(data) - 1, 0, -1) if data[:n] in self.ranks), -1)
            self._shorter[token] = known
        return known

    def encode_piece(self, data: bytes) -> list[int]:
        """Ranks of one piece. A piece that is a token itself is that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        longest = [0] * n
        for end, found in self.automaton.iter(data.decode("latin-1")):
            start = end + 1 - (found >> 32)
            if found > longest[start]:
                longest[start] = found
        size, open_end = self.bytes_of, bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0] & 0xFFFFFFFF
        while True:
            while token >= 0:
                end = at + len(size[token])
                if open_end[end] and (not out or self._may_follow(out[-1], token)):
                    break
                token = self._next_shorter(token)
            if token >= 0:
                out.append(token)
                at = end
                if at == n:
                    return out
                token = longest[at] & 0xFFFFFFFF
            else:
                open_end[at] = 0
                token = out.pop()
                at -= len(size[token])

    def _ids_of(self, piece: str) -> bytes:
        return array("I", self.encode_piece(piece.encode("utf-8", "replace"))).tobytes()

    def encode(self, text: str) -> list[int]:
        cut = self._cut_plain if _PLAIN_TEXT.fullmatch(text) else self._cut
        return array("I", b"".join(map(self._pieces.__getitem__, cut(text)))).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_HERE: dict[str, Bpe] = {}


def _of(shared) -> Bpe:
    """The encoder of this Python process, built once."""
    name, ranks, pattern = shared.value
    if name not in _HERE:
        _HERE[name] = Bpe(ranks, pattern)
    return _HERE[name]


def _share(df: DataFrame, path: str, pattern: str):
    # The driver reads the vocabulary; tasks get it as a broadcast of fixed size, not by path.
    ranks = read_ranks(path)
    name = hashlib.sha256(repr(sorted(ranks.items())).encode() + pattern.encode()).hexdigest()
    return df.sparkSession.sparkContext.broadcast((name, ranks, pattern))


def encode_column(df: DataFrame, path: str, pattern: str, text: str = "text") -> Column:
    """Array column with the ids of each whole text; NULL counts as empty and gives an empty array."""
    shared = _share(df, path, pattern)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = _of(shared)
        for batch in batches:
            yield batch.map(lambda t: bpe.encode(t or ""))

    return encode(F.col(text))


def decode_column(df: DataFrame, path: str, pattern: str, ids: str = "ids") -> Column:
    """Binary column with the bytes of each array of ids; a NULL array gives no bytes, an unknown id is an error."""
    shared = _share(df, path, pattern)

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = _of(shared)
        for batch in batches:
            yield batch.map(lambda x: bpe.decode([] if x is None else list(x)))

    return decode(F.col(ids))


def digests(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `n_tokens`, and SHA-256 of the ids and of the bytes decoded from them, per row.

    NULL and empty texts have no token. Repeated rows and NULL keys give a row each; other columns are not read.
    """
    shared = _share(df, path, pattern)
    kind = df.schema[key].dataType
    schema = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _of(shared)
        for batch in batches:
            n, encoded, decoded = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py() or "")
                n.append(len(ids))
                encoded.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            made = [pa.array(x, f.type) for x, f in zip((n, encoded, decoded), schema)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=[key, *schema.names])

    return df.select(key, text).mapInArrow(
        run, f"`{key}` {kind.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
