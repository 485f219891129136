"""Packing of token sequences along a space-filling curve.

Each document becomes a hashed bag of its tokens, projected at random to three dimensions. The
place of that point on a Hilbert curve orders the documents, so that neighbours in the order use
like words. The documents are range-sorted by place and laid end to end; every `length` tokens a
sequence ends, wherever that falls in a document. The last tokens are cut into sequences whose
sizes are powers of two, which need no padding.

The tokens are written to the shared folder once, 16 bits each where they fit, and only places, keys and
lengths are sorted. The sort splits documents at the same place (copies) by key and row, so no place is too large for a
task. Offsets are a running sum within a range plus the sums of the ranges before, one number per
range; they go back to the tokens by row.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensula.sizing import scratch_path, settle

from .common import Known, in_small_batches

DIMENSIONS, PLACES = 3, 10  # places: bits per dimension
BUCKETS = 1 << 12
KNOWN_WORDS = 200_000
LONGEST_KNOWN = 24
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_PLAIN_TEXT = re.compile("[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*+")
# The tokenizer's rule for pieces (fixed value), with its classes of letters, digits and spaces in the plain alphabet.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\s0-9a-zß-öø-ÿ]+")
_PLAIN_SPACES = re.compile("[ \t\n\r]+")


class Encoder:
    """Ids of whole texts by a tokenizer that cuts them into pieces at fixed places and drops white space.

    A text of plain Latin letters, digits and ASCII marks is cut here, by the tokenizer's own rule
    in that alphabet; each piece goes in lower case and in the byte alphabet to the tokenizer's
    model, and a piece seen lately is looked up. Any other text takes the tokenizer's whole way word by
    word: white space is never part of a token and joins with nothing next to it, so a text's
    ids are its words' ids in order.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        # The sign of each byte, as the byte alphabet of the library spells it.
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xC0, 0x100)]
        self.spelling = str.maketrans({c: spell.pre_tokenize_str(c)[0][0] for c in letters})
        self.words, self.pieces = (Known(make, KNOWN_WORDS, LONGEST_KNOWN) for make in (self.word, self.piece))

    def word(self, word: str) -> bytes:
        """Ids of one word, 4 bytes each."""
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def piece(self, piece: str) -> bytes:
        tokens = self.model.tokenize(piece if piece.isascii() else piece.translate(self.spelling))
        return array("I", [t.id for t in tokens]).tobytes()

    def __call__(self, text: str) -> bytes:
        if _PLAIN_TEXT.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text.lower())))
        # str.split() also cuts at four control characters that the tokenizer keeps.
        words = _PLAIN_SPACES.split(text) if _ODD_SPACE.search(text) else text.split()
        return b"".join(map(self.words.__getitem__, words))


@lru_cache(1)
def _projection() -> np.ndarray:
    return np.random.default_rng(29).choice(np.array([-1.0, 1.0]), (BUCKETS, DIMENSIONS))


def places(documents: list[np.ndarray]) -> np.ndarray:
    """Place on the curve of each document's ids; the same for the same bag, that of the middle for none."""
    points = np.zeros((len(documents), DIMENSIONS))
    for i, ids in enumerate(documents):
        if len(ids):
            counts = np.bincount((ids * np.uint32(2_654_435_761)) >> np.uint32(20), minlength=BUCKETS)
            used = np.flatnonzero(counts)
            weight = np.sqrt(counts[used])
            points[i] = weight @ _projection()[used] / np.sqrt(weight @ weight)
    # Each coordinate is near a standard normal; this spreads it evenly over the axis.
    share = 1 / (1 + np.exp(-1.702 * points))
    return hilbert(np.minimum((share * (1 << PLACES)).astype(np.int64), (1 << PLACES) - 1))


def hilbert(points: np.ndarray, bits: int = PLACES) -> np.ndarray:
    """Distance along the Hilbert curve of points with integer coordinates below `2**bits`."""
    x = points.T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):  # undo the turns of each level, largest first
        low = (1 << level) - 1
        for i in range(n):
            turned = (x[i] >> level & 1).astype(bool)
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | (x[i] >> b & 1)
    return out


def tail_cuts(left: int) -> list[int]:
    """Sizes of the sequences for the last tokens: the powers of two that sum to them, largest first."""
    return [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]


def tokenized(df: DataFrame, definition: str, end_id: int, key: str, text: str) -> DataFrame:
    """`key`, `place`, `n`, `ids` (little-endian, 16 bits if all fit, else 32) of each row, with `end_id` after its ids."""
    shared = df.sparkSession.sparkContext.broadcast(definition)
    kind, end = df.schema[key].dataType.simpleString(), np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                ids = [np.frombuffer(encoder(t.as_py() or "") + end, "<u4") for t in part.column(1)]
                place = places([i[:-1] for i in ids])
                small = [i.astype("<u2") if i.max() < 1 << 16 else i for i in ids]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(place, pa.int64()), pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([i.tobytes() for i in small], pa.binary()),
                ], names=["key", "place", "n", "ids"])

    return df.select(key, text).mapInArrow(encode, f"key {kind}, place long, n long, ids binary")


@lru_cache(1)
def _encoder(definition: str) -> Encoder:
    return Encoder(definition)


def _laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of the range and the tokens before each row within it."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column("n").to_numpy()
        before = at + np.cumsum(n) - n
        at += int(n.sum())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(n), part, np.int32)), pa.array(before.astype(np.int64))],
            names=[*batch.schema.names, "part", "before"])


def pack(df: DataFrame, definition: str, end_id: int, length: int = 2_048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: `key`, `start`, `length`, `ids` (binary), `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`, `place`.

    `definition` is a tokenizer as JSON text. Every id of a row, and `end_id` after them, lies in
    exactly one piece. NULL and empty texts are `end_id` alone. Repeated rows and NULL keys are
    documents of their own; an empty table gives no piece. Other columns are not read.
    """
    spark = in_small_batches(df).sparkSession
    path = scratch_path(spark, "packing")
    kind = df.schema[key].dataType.simpleString()
    # Tokenized once and written: a range sort looks at its input twice.
    tokenized(df, definition, end_id, key, text).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    narrow = rows.select("place", "key", "row", "n").repartitionByRange("place", "key", "row").sortWithinPartitions("place", "key", "row")
    laid = settle(narrow.select("row", "n").mapInArrow(_laid, "row long, n long, part int, before long"))

    # One row per range of the sort, whose number Spark bounds by its shuffle partitions.
    base, total = {}, 0
    for r in laid.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        base[r["part"]], total = total, total + r["n"]
    whole = total - total % length
    shared = spark.sparkContext.broadcast((base, np.cumsum([0, *tail_cuts(total % length)]) + whole))
    schema = pa.schema([
        ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()), ("offset", pa.int64()), ("place", pa.int64()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, tail = shared.value
        for batch in (b.slice(s, 256) for b in batches for s in range(0, b.num_rows, 256)):
            which, made = [], []
            for i, row in enumerate(batch.drop_columns(["key"]).to_pylist()):
                first = base[row["part"]] + row["before"]
                last, at = first + row["n"], first
                all_ids = np.frombuffer(row["ids"], f"<u{len(row['ids']) // row['n']}").astype("<u4")
                while at < last:
                    if at < whole:
                        number, begin = divmod(at, length)
                        end = at - begin + length
                    else:
                        k = int(np.searchsorted(tail, at, "right"))
                        number, begin, end = whole // length + k - 1, at - int(tail[k - 1]), int(tail[k])
                    end = min(end, last)
                    ids = all_ids[at - first:end - first].tobytes()
                    which.append(i)
                    made.append((at - first, end - at, ids, zlib.crc32(ids), row["n"], number, begin, row["place"]))
                    at = end
            columns = [pa.array([m[j] for m in made], f.type) for j, f in enumerate(schema)]
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(which, pa.int64())), *columns], names=[key, *schema.names])

    fields = ", ".join(f"`{f.name}` {'binary' if f.name == 'ids' else 'long'}" for f in schema)
    joined = rows.join(laid.select("row", "part", "before"), "row").select("key", "place", "n", "ids", "part", "before")
    return joined.mapInArrow(cut, f"`{key}` {kind}, {fields}")
