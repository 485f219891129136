"""Centroid clustering of whole-number vectors, with exact distances from bit planes.

Every component is scaled and floored to an integer. Bit `j` of all 64 components of a vector is packed into one 64-bit
word, its plane `j`, in two's complement: the last plane has the negative weight. The dot product of
two vectors is then the sum over pairs of planes of weight * weight * popcount(plane AND plane), exactly, and so is
the squared distance. More than 64 components take several words a plane.

The packed vectors are written once and read in every round. A task adds up its own rows per
cluster and returns at most a row per cluster and component; the sums over tasks, clusters times components numbers, are
all that reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensula.sizing import settle


@dataclass(frozen=True)
class Config:
    """Vectors of `components` components times `scale`; `clusters` centroids move `rounds` times."""

    clusters: int = 16
    rounds: int = 3
    scale: float = 64.0
    components: int = 64
    salt: str = "1:"

    @property
    def largest(self) -> int:
        """Integers of this size at most keep every squared distance below 2^62."""
        return int((2**62 / self.components) ** 0.5 / 2)


# --- bit planes ------------------------------------------------------------------------------------


def planes(q: np.ndarray) -> np.ndarray:
    """(rows, planes, words) of the integers of (rows, components): as many planes as the widest value needs."""
    rows, size = q.shape
    widest = max(int(q.max(initial=0)), -1 - int(q.min(initial=0)))
    out = np.zeros((rows, widest.bit_length() + 1, -(-size // 64) * 8), np.uint8)
    for j in range(out.shape[1]):
        bits = np.packbits(((q >> j) & 1).astype(np.uint8), axis=1, bitorder="little")
        out[:, j, : bits.shape[1]] = bits
    return out.view("<u8")


def weights(count: int) -> list[int]:
    """What a bit of each plane is worth."""
    return [1 << j for j in range(count - 1)] + [-(1 << (count - 1))]


def numbers(p: np.ndarray, size: int) -> np.ndarray:
    """The integers that were packed."""
    out = np.zeros((len(p), size), np.int64)
    for j, w in enumerate(weights(p.shape[1])):
        out += w * np.unpackbits(np.ascontiguousarray(p[:, j]).view(np.uint8), axis=1, bitorder="little")[:, :size].astype(np.int64)
    return out


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of every row of `a` with every row of `b`, from their planes."""
    out = np.zeros((len(a), len(b)), np.int64)
    for i, u in enumerate(weights(a.shape[1])):
        for j, w in enumerate(weights(b.shape[1])):
            out += u * w * np.bitwise_count(a[:, None, i] & b[None, :, j]).sum(-1, dtype=np.int64)
    return out


def squares(a: np.ndarray) -> np.ndarray:
    """Dot product of every row with itself."""
    out = np.zeros(len(a), np.int64)
    for i, u in enumerate(weights(a.shape[1])):
        for j, w in enumerate(weights(a.shape[1])):
            out += u * w * np.bitwise_count(a[:, i] & a[:, j]).sum(-1, dtype=np.int64)
    return out


def assign(p: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of every packed row (ties: the smaller number) and the squared distance to it."""
    c = planes(centroids)
    far = squares(p)[:, None] + squares(c)[None, :] - 2 * dots(p, c)
    best = far.argmin(1)
    return best, far[np.arange(len(p)), best]


# --- the table -------------------------------------------------------------------------------------


def _unpacked(column: pa.Array, words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, planes) of a column of packed rows, together for rows with equally many planes."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    length = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for size in np.unique(length):
        at = np.flatnonzero(length == size)
        data = b"".join(column.take(pa.array(at)).to_pylist())
        yield at, np.frombuffer(data, "<u8").reshape(len(at), -1, words)


def packed(df: DataFrame, config: Config = Config(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`id` and `planes` of the rows that take part."""
    c, size = config, config.components
    v = F.col("v")
    fine = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))))
    kept = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        v.isNotNull() & (F.size(v) == size) & fine)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            with np.errstate(over="ignore"):
                q = np.floor(c.scale * x)
            if np.abs(q).max(initial=0) > c.largest:
                raise ValueError(f"a component times {c.scale} exceeds {c.largest}: its distances would not fit 64 bits")
            rows = [r.tobytes() for r in planes(q.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["id", "planes"])

    kind = df.schema[key].dataType.simpleString()
    return kept.mapInArrow(pack, f"id {kind}, planes binary")


def first_centroids(rows: DataFrame, config: Config = Config()) -> np.ndarray:
    """Rows whose salted id has the smallest SHA-256; NULL ids come last, equal ids in order of their packed form."""
    hashed = rows.select("planes", F.sha2(F.concat(F.lit(config.salt), F.col("id").cast("string")), 256).alias("h"))
    first = hashed.orderBy(F.asc_nulls_last("h"), "planes").limit(config.clusters).collect()
    words = -(-config.components // 64)
    if not first:
        return np.zeros((0, config.components), np.int64)
    return np.concatenate([numbers(np.frombuffer(bytes(r["planes"]), "<u8").reshape(1, -1, words), config.components) for r in first])


def _moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floored mean of their rows; those without rows stay."""
    k, size = centroids.shape
    words = -(-size // 64)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, p in _unpacked(batch.column(0), words):
                best, _ = assign(p, centroids)
                np.add.at(total, best, numbers(p, size))
                count += np.bincount(best, minlength=k)
        own = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(own, size + 1), pa.int32()), pa.array(np.tile(np.arange(-1, size), len(own)), pa.int32()),
            pa.array(np.column_stack([count[own], total[own]]).reshape(-1)),
        ], names=["cluster", "place", "n"])

    # Clusters times (components + 1) numbers.
    sums = rows.select("planes").mapInArrow(add_up, "cluster int, place int, n long").groupBy("cluster", "place").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    found = {(r["cluster"], r["place"]): int(r["n"]) for r in sums}
    return np.array([
        [found[c, i] // found[c, -1] if (c, -1) in found else int(old) for i, old in enumerate(row)]
        for c, row in enumerate(centroids)
    ], np.int64)


def cluster(df: DataFrame, config: Config = Config(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`key`, `cluster`, `distance` (squared), `cluster_inertia`, `inertia` and `centroid_sha256` per vector.

    Only vectors with exactly `components` components, none of them NULL, NaN or infinite, take part; other rows (NULL
    or empty vectors included) give no row. Every row that takes part gives one, repeated rows and NULL keys
    too; a NULL key starts a centroid only where other rows are lacking. Fewer rows than clusters give
    a centroid each. An empty table gives no row. Other columns are not read. A component
    above `Config.largest` after scaling raises, since its squared distances would not fit 64 bits.
    """
    c, words = config, -(-config.components // 64)
    rows = settle(packed(df, c, key, vector))
    centroids = first_centroids(rows, c)
    if len(centroids):
        for _ in range(c.rounds):
            centroids = _moved(rows, centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, far = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            for at, p in _unpacked(batch.column(1), words):
                best[at], far[at] = assign(p, centroids)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best), pa.array(far)], names=["id", "cluster", "distance"])

    kind = df.schema[key].dataType.simpleString()
    placed = settle(rows.mapInArrow(place, f"id {kind}, cluster int, distance long"))
    spread = {r["cluster"]: int(r["n"]) for r in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}  # a row per cluster
    facts = [
        (i, spread[i], sum(spread.values()), hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest())
        for i, centroid in enumerate(centroids) if i in spread
    ]
    told = df.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.withColumnRenamed("id", key).join(F.broadcast(told), "cluster").select(
        key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
