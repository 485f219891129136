"""Near-duplicates by 64-bit SimHash, found with the generalised pigeonhole principle.

A fingerprint is the majority of the XXH64 hashes of the word shingles of a text. Fingerprints
link when they differ in at most `distance` bits, and the links' components are the groups.

Search over the distinct fingerprints:

1. Bits that go together are put side by side (co-occurrence counts over all fingerprints), so
   that each of the `m` partitions of the bits keeps as much of the correlation as it can.
2. Partition `i` gets its own threshold `t_i >= -1` with `sum(t_i) = distance - m + 1`: two
   fingerprints within `distance` then agree within `t_i` in some partition, and a partition of
   threshold -1 need not be probed. A dynamic programme picks the thresholds, and the number of
   partitions, that cost least: probes sent plus pairs expected, estimated from histograms of
   neighbouring bits over all fingerprints.
3. Every fingerprint is stored under its value in each probed partition and probes all values
   within `t_i` bits of its own. What meets is verified on all 64 bits.

A value that many fingerprints share is cut into blocks; its probes go to every block. A task
holds one block and a stretch of probes. Within a crowded block only a spanning forest of the
links is returned, which has the same components and at most one row per member, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensula.sizing import settle, small_side

from .common import in_small_batches, join_by
from .components import components

BITS = 64
UNIT = 4  # bits of one histogram
BLOCK = 2_048  # stored fingerprints of one value in one task
PAIRS = 1 << 21  # comparisons held at a time
PROBE_COST, PAIR_COST = 1.0, 0.02


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of a whole text; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    k = min(shingle, len(words)) - 1
    digest, spans = xxhash.xxh64_digest, zip(starts[: len(words) - k].tolist(), ends[k:].tolist())
    hashes = b"".join([digest(joined[s:e], 42) for s, e in spans])
    octets = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(octets), 1 << 16):
        ones += np.unpackbits(octets[i:i + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(octets)).tobytes(), "big")


def fingerprints(df: DataFrame, shingle: int, text: str = "text", name: str = "fp") -> DataFrame:
    """`df` with the fingerprint as a signed long in `name`."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return in_small_batches(df).withColumn(name, of(F.col(text)))


# --- choice of partitions and thresholds -----------------------------------------------------


def _bits_of(fps: np.ndarray) -> np.ndarray:
    return ((fps[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)


def _counts(fps: DataFrame, name: str, of, size: int) -> np.ndarray:
    """Sum over all fingerprints of the `size` counters that `of(values)` gives; so many rows from each task and in the end."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(values), 1 << 16):
                total += of(values[i:i + (1 << 16)])
        yield pa.RecordBatch.from_pydict({name: np.arange(size), "n": total})

    rows = fps.select("fp").mapInArrow(count, f"{name} long, n long").groupBy(name).agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size)
    out[rows[name]] = rows["n"]
    return out


def correlated_order(fps: DataFrame, n: int) -> list[int]:
    """The 64 bits in an order that puts bits which go together into the same `UNIT`, and like units side by side."""

    def bit_pairs(values: np.ndarray) -> np.ndarray:
        bits = _bits_of(values).astype(np.float64)
        return (bits.T @ bits).astype(np.int64).ravel()

    together = _counts(fps, "bit_pair", bit_pairs, BITS * BITS).reshape(BITS, BITS)
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    link = np.abs(together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, order = set(range(BITS)), []
    while left:
        unit = [min(left)] if not order else [max(left, key=lambda b: (link[b, order].sum(), -b))]
        left.discard(unit[0])
        while len(unit) < UNIT and left:
            nxt = max(left, key=lambda b: (link[b, unit].sum(), -b))
            unit.append(nxt)
            left.discard(nxt)
        order += unit
    return order


def _distances(histogram: np.ndarray) -> np.ndarray:
    """Share of ordered pairs at each distance within one unit, from the counts of its values."""
    values = np.arange(len(histogram))
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    weight = np.outer(histogram, histogram) / max(histogram.sum(), 1) ** 2
    return np.bincount(apart.ravel(), weight.ravel(), UNIT + 1)


def allocate(near: list[np.ndarray], widths: list[int], n: float, distance: int) -> tuple[float, list[int]]:
    """Cheapest thresholds for given partitions, by a dynamic programme over what is left of the sum.

    `near[i][d]`: share of pairs at distance `d` in partition `i`.
    """
    def cost(i: int, t: int) -> float:
        if t < 0:
            return 0.0
        probes = sum(comb(widths[i], d) for d in range(t + 1))
        return n * (probes + 1) * PROBE_COST + n * n / 2 * float(near[i][: t + 1].sum()) * PAIR_COST

    m = len(widths)

    @lru_cache(None)
    def best(i: int, left: int) -> tuple[float, tuple[int, ...]]:
        if i == m:
            return (0.0, ()) if left == 0 else (float("inf"), ())
        options = []
        for t in range(-1, min(widths[i], distance) + 1):
            rest, chosen = best(i + 1, left - t)
            options.append((cost(i, t) + rest, (t, *chosen)))
        return min(options)

    total, chosen = best(0, distance - m + 1)
    return total, list(chosen)


def plan(fps: DataFrame, n: int, distance: int) -> list[tuple[list[int], int]]:
    """(bits of a partition, its threshold) for all partitions that are probed."""
    order = correlated_order(fps, n)
    units = [order[i:i + UNIT] for i in range(0, BITS, UNIT)]
    values = len(units) * (1 << UNIT)

    def histogram(v: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(_value(v, unit).astype(np.int64), minlength=1 << UNIT) for unit in units])

    apart = [_distances(h) for h in _counts(fps, "unit_value", histogram, values).reshape(len(units), -1)]
    found = []
    for m in range(1, min(distance + 1, len(units)) + 1):
        cuts = np.linspace(0, len(units), m + 1).round().astype(int)
        parts = [range(a, b) for a, b in zip(cuts, cuts[1:])]
        near = []
        for part in parts:
            d = np.ones(1)
            for u in part:
                d = np.convolve(d, apart[u])
            near.append(d)
        widths = [len(p) * UNIT for p in parts]
        total, chosen = allocate(near, widths, n, distance)
        found.append((total, m, [(sum((units[u] for u in p), []), t) for p, t in zip(parts, chosen) if t >= 0]))
    return min(found)[2]


def _value(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.uint64)
    for place, bit in enumerate(bits):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out


# --- probing and verifying -------------------------------------------------------------------


def _entries(fps: DataFrame, parts: list[tuple[list[int], int]]) -> DataFrame:
    """Stored (`probe` 0) and probing (1) entries of every fingerprint; a fixed number per fingerprint."""
    flips = [
        np.array([sum(1 << b for b in c) for d in range(t + 1) for c in combinations(range(len(bits)), d)], np.uint64)
        for bits, t in parts
    ]
    schema = pa.schema([("part", pa.int32()), ("value", pa.int64()), ("probe", pa.int8()), ("fp", pa.int64())])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i, (bits, _) in enumerate(parts):
                step = max(1, (1 << 18) // (len(flips[i]) + 1))
                for s in range(0, len(all_fps), step):
                    fp = all_fps[s:s + step]
                    own = _value(fp, bits)
                    value = np.concatenate((own, (own[:, None] ^ flips[i][None, :]).ravel()))
                    probe = np.repeat(np.array([0, 1], np.int8), (len(fp), len(fp) * len(flips[i])))
                    who = np.concatenate((fp, np.repeat(fp, len(flips[i]))))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(who), i, np.int32)), pa.array(value.view(np.int64)), pa.array(probe), pa.array(who.view(np.int64)),
                    ], schema=schema)

    return fps.select("fp").mapInArrow(expand, "part int, value long, probe byte, fp long")


def _spanning(stored: np.ndarray, probes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as all links between the two sets, at most one per member."""
    ends_a, ends_b = [], []
    step = max(1, PAIRS // max(1, len(stored)))
    for s in range(0, len(probes), step):
        q = probes[s:s + step]
        near = np.bitwise_count(stored[:, None] ^ q[None, :]) <= distance
        row, col = near.any(1), near.any(0)
        x, y, near = stored[row], q[col], near[np.ix_(row, col)]
        if not len(x):
            continue
        of_x, of_y = np.arange(len(x)), np.full(len(y), len(x))
        while True:  # lowest number reachable; ends after as many rounds as the links are long
            new_y = np.where(near, of_x[:, None], len(x)).min(0)
            new_x = np.minimum(of_x, np.where(near, new_y[None, :], len(x)).min(1))
            if (new_x == of_x).all() and (new_y == of_y).all():
                break
            of_x, of_y = new_x, new_y
        ends_a += [x, y]
        ends_b += [x[of_x], x[of_y]]
    if not ends_a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    a, b = np.concatenate(ends_a), np.concatenate(ends_b)
    return a[a != b], b[a != b]


def _verify(distance: int):
    """Links among entries sorted by (part, value, block, probe)."""

    def small(fp: np.ndarray, first: np.ndarray, mid: np.ndarray, last: np.ndarray):
        stored, probes = mid - first, last - mid
        pairs = stored * probes
        for lo, hi in _chunks(pairs):
            n = pairs[lo:hi]
            run = np.repeat(np.arange(lo, hi), n)
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            a = fp[first[run] + within % stored[run]]
            b = fp[mid[run] + within // stored[run]]
            ok = (np.bitwise_count(a ^ b) <= distance) & (a != b)
            yield a[ok], b[ok]

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            if len(held[0]) < 1 << 17:
                continue
            held, found = work(held, False)
            yield from found
        if held is not None:
            yield from work(held, True)[1]

    def work(cols: list[np.ndarray], over: bool):
        part, value, block, probe, fp = cols
        fp = fp.view(np.uint64)
        turn = np.flatnonzero((part[1:] != part[:-1]) | (value[1:] != value[:-1]) | (block[1:] != block[:-1])) + 1
        first = np.concatenate(([0], turn))
        last = np.concatenate((turn, [len(fp)]))
        probes_before = np.concatenate(([0], np.cumsum(probe)))
        mid = last - (probes_before[last] - probes_before[first])
        out = []
        rest = None
        if not over:  # the last value may go on: keep its stored rows, and its probes unless they are many
            f, m, e = first[-1], mid[-1], last[-1]
            if e - m > 1 << 16:
                out += emit(_spanning(fp[f:m], fp[m:e], distance))
                rest = [c[f:m] for c in cols]
            else:
                rest = [c[f:e] for c in cols]
            first, mid, last = first[:-1], mid[:-1], last[:-1]
        pairs = (mid - first) * (last - mid)
        crowded = pairs > 4_096
        for f, m, e in zip(first[crowded], mid[crowded], last[crowded]):
            out += emit(_spanning(fp[f:m], fp[m:e], distance))
        few = ~crowded & (pairs > 0)
        for ab in small(fp, first[few], mid[few], last[few]):
            out += emit(ab)
        return rest, out

    def emit(ab) -> list[pa.RecordBatch]:
        if not len(ab[0]):
            return []
        return [pa.RecordBatch.from_arrays([pa.array(ab[0].view(np.int64)), pa.array(ab[1].view(np.int64))], names=["a", "b"])]

    return links


def _chunks(pairs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of runs with about `PAIRS` pairs each."""
    if not len(pairs):
        return
    group = (np.cumsum(pairs) - 1) // PAIRS
    cuts = np.flatnonzero(np.diff(group)) + 1
    yield from zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(pairs)])))


def linked(fps: DataFrame, distance: int, block: int = BLOCK) -> DataFrame:
    """Links `a`, `b` whose components are those of all pairs of distinct `fp` within `distance` bits.

    `fps` has distinct fingerprints, as signed longs, and is read several times: give a written table.
    """
    n = fps.count()
    if n < 2:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    entries = _entries(fps, plan(fps, n, distance))
    crowded = (
        entries.where("probe = 0").groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > block)
        .select("part", "value", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    placed = entries.join(small_side(crowded), ["part", "value"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.array(F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    cut = placed.select("part", "value", F.explode(F.when(F.col("probe") == 0, own).otherwise(every)).alias("block"), "probe", "fp")
    sorted_rows = cut.repartition("part", "value", "block").sortWithinPartitions("part", "value", "block", "probe")
    return sorted_rows.mapInArrow(_verify(distance), "a long, b long")


def _members(df: DataFrame, shingle: int, distance: int, text: str) -> DataFrame:
    """`df` without its text, with `text_hash`, `fp` and `root`, the fingerprint that stands for the group."""
    kept = [c for c in df.columns if c != text]
    rows = settle(fingerprints(df, shingle, text, "fp").select(*kept, F.xxhash64(text).alias("text_hash"), "fp"))
    copies = settle(rows.groupBy("fp").agg(F.count("*").alias("n")))
    roots = components(linked(copies.select("fp"), distance))
    rooted = copies.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return join_by(rows, rooted, "fp", "n", rows.count()).select(*rows.columns, "root")


def groups(df: DataFrame, shingle: int = 4, distance: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `text_hash`, `fp` and `component_id` (the smallest key reachable) for every row of `df`.

    NULL and empty texts, and texts of spaces, have fingerprint 0 and link to each other and to
    what is near. Repeated rows share their group. A NULL key is a member like any other, but never names a group;
    a group of NULL keys only has a NULL id. Other columns are not read.
    """
    members = settle(_members(df.select(F.col(key).alias("k"), F.col(text).alias("t")), shingle, distance, "t"))
    named = settle(members.groupBy("root").agg(F.min("k").alias("component_id"), F.count("*").alias("n")))
    joined = join_by(members, named, "root", "n", members.count())
    return joined.select(F.col("k").alias(key), "text_hash", "fp", "component_id", F.col("root").alias("component_fp"))


def deduplicate(df: DataFrame, shingle: int = 4, distance: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`df` with one document of each group: that of the smallest key (NULL last), its columns unchanged whatever their names.

    Of rows with one key, the smallest by the hashes of the text and of the whole row stays, so that a rerun keeps the same. Rows that
    are alike in all columns are one. An empty table stays empty; NULL and empty texts as in `groups`.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    # Two hashes name a row: 128 bits in all.
    told = df.select(row.alias("row"), F.xxhash64(row).alias("h1"), F.xxhash64(F.lit(1), row).alias("h2"))
    narrow = told.select(F.col("row")[key].alias("k"), F.col("row")[text].alias("t"), "h1", "h2")
    order = F.struct(F.col("k").isNull().alias("no_key"), "k", "text_hash", "h1", "h2")
    chosen = _members(narrow, shingle, distance, "t").groupBy("root").agg(F.min(order).alias("best")).select(
        F.col("best.h1").alias("a"), F.col("best.h2").alias("b"))
    kept = told.join(settle(chosen), (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b")), "left_semi")
    return kept.dropDuplicates(["h1", "h2"]).select("row.*")
