"""Nearest neighbours over partitions learnt from a neighbour graph.

A bounded sample of the vectors gives a graph of nearest neighbours, which is cut into parts of
about equal size so that few neighbours are in different parts. A small network learns to say, from
a vector, how its neighbours spread over the parts. Every row is stored in its likeliest part;
a query goes to several of its most probable parts and is ranked by exact distance there. How many parts
that takes is read off held-back sample rows.

A router has a bounded number of parts. Parts that stay large get a router of their own, fitted on a bounded sample of their rows in
a task each, so that the number of parts grows with the rows: a query then visits the likeliest parts of the likeliest parts.

Parts with many rows (copies of one vector always share a part) are cut into blocks by a hash of the id; a query visits
all blocks of its parts. A task holds one block and a stretch of queries, and returns the nearest few of each
query. No row is left out for the size of its part.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mensula.sizing import settle


@dataclass(frozen=True)
class Config:
    """`sample`: rows a router is learnt from, at most about; `part_rows`: rows a part should have; `most_parts`: parts of one router;
    `split_rows`: rows from which on a part gets a router of its own; `recall`: share of neighbours of held-back rows that the visited
    parts must hold."""

    neighbours: int = 10
    sample: int = 8_192
    part_rows: int = 512
    most_parts: int = 256
    split_rows: int = 65_536
    least_sampled: int = 32
    recall: float = 0.92
    block: int = 4_096
    hidden: int = 128
    epochs: int = 15
    seed: int = 3


def nearest(x: np.ndarray, queries: np.ndarray, k: int, skip_self: bool) -> np.ndarray:
    """Rows of `x` nearest to each query, by brute force in blocks; with `skip_self` query `i` is row `i`."""
    square, out = (x * x).sum(1), []
    for s in range(0, len(queries), 512):
        q = queries[s:s + 512]
        d = square[None, :] - 2 * q @ x.T
        if skip_self:
            d[np.arange(len(q)), s + np.arange(len(q))] = np.inf
        top = np.argpartition(d, min(k, d.shape[1] - 1), axis=1)[:, :k]
        out.append(np.take_along_axis(top, np.take_along_axis(d, top, 1).argsort(1), 1))
    return np.concatenate(out)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int, slack: float = 0.1, passes: int = 6) -> np.ndarray:
    """Part of each row: halves along main axes first, then moves that keep more neighbours together within the size limits."""
    part = np.zeros(len(x), np.int64)
    todo = [(np.arange(len(x)), 0, parts)]
    while todo:
        rows, first, n = todo.pop()
        if n == 1 or len(rows) < 2:
            part[rows] = first
            continue
        inside = x[rows] - x[rows].mean(0)
        axis = np.linalg.svd(inside[:2_000], full_matrices=False)[2][0]
        order = rows[np.argsort(inside @ axis, kind="stable")]
        left = n // 2
        cut = len(rows) * left // n
        todo += [(order[:cut], first, left), (order[cut:], first + left, n - left)]

    both: list[list[int]] = [list(g) for g in graph]
    for i, g in enumerate(graph):
        for j in g:
            both[j].append(i)
    size = np.bincount(part, minlength=parts)
    most, least = int(np.ceil(len(x) / parts * (1 + slack))), int(len(x) / parts * (1 - slack))
    rng = np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0
        for i in rng.permutation(len(x)):
            count = np.bincount(part[both[i]], minlength=parts)
            own = part[i]
            if size[own] <= least:
                continue
            gain = np.where(size < most, count, -1)
            to = int(gain.argmax())
            if gain[to] > count[own]:
                part[i] = to
                size[own] -= 1
                size[to] += 1
                moved += 1
        if moved == 0:
            break
    return part


@dataclass(frozen=True)
class Router:
    """Network with one hidden layer; `probes` parts are visited."""

    mean: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]
    parts: int
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2

    def home(self, x: np.ndarray) -> np.ndarray:
        return self.logits(x).argmax(1)

    def visits(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, : self.probes]


def _train(x: np.ndarray, target: np.ndarray, c: Config) -> tuple[np.ndarray, ...]:
    """Weights that predict the rows of `target` (shares of parts), by Adam on the cross-entropy."""
    rng = np.random.default_rng(c.seed)
    dim, parts = x.shape[1], target.shape[1]
    p = [rng.normal(0, np.sqrt(2 / dim), (dim, c.hidden)), np.zeros(c.hidden), rng.normal(0, np.sqrt(1 / c.hidden), (c.hidden, parts)), np.zeros(parts)]
    m, v = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p]
    step = 0
    for epoch in range(c.epochs):
        rate = 3e-3 * 0.5 * (1 + np.cos(np.pi * epoch / c.epochs))
        order = rng.permutation(len(x))
        for s in range(0, len(x), 256):
            xb, tb = x[order[s:s + 256]], target[order[s:s + 256]]
            h = np.maximum(xb @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            z = np.exp(z - z.max(1, keepdims=True))
            g = (z / z.sum(1, keepdims=True) - tb) / len(xb)
            gh = (g @ p[2].T) * (h > 0)
            step += 1
            for i, grad in enumerate((xb.T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad * grad
                p[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(p)


def learn(sample: np.ndarray, rows: int, c: Config = Config()) -> Router:
    """Router for `rows` rows, from a sample of their vectors. Copies in the sample count once."""
    x = np.unique(sample, axis=0)
    dim = x.shape[1]
    parts = int(max(1, min(c.most_parts, rows // c.part_rows, len(x) // c.least_sampled)))
    if parts == 1:
        layers = (np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
        return Router(np.zeros(dim), np.ones(dim), layers, 1, 1)
    x = x[np.random.default_rng(c.seed).permutation(len(x))]
    back, x = x[: len(x) // 10], x[len(x) // 10:]
    k = min(c.neighbours, len(x) - 1)
    graph = nearest(x, x, k, skip_self=True)
    part = balanced_parts(x, graph, parts, c.seed)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.arange(len(x))[:, None], part[graph]), 1.0)
    np.add.at(target, (np.arange(len(x)), part), 1.0)
    mean, scale = x.mean(0), x.std(0) + 1e-12
    layers = _train((x - mean) / scale, target / target.sum(1, keepdims=True), c)
    router = Router(mean, scale, layers, parts, parts)
    # In the order in which a held-back row would visit parts: where do its neighbours live?
    turn = np.argsort(router.visits(back), axis=1)
    place = np.take_along_axis(turn, router.home(x)[nearest(x, back, k, skip_self=False)], 1)
    reached = (place[:, :, None] < np.arange(1, parts + 1)).mean((0, 1))
    probes = int(np.searchsorted(reached, min(c.recall, reached[-1]))) + 1
    return Router(mean, scale, layers, parts, min(probes, parts))


@dataclass(frozen=True)
class Levels:
    """A router, and routers of its large parts by number; a part without one is a single part."""

    top: Router
    below: dict[int, Router]
    most_parts: int

    def home(self, x: np.ndarray) -> np.ndarray:
        """The part that stores each row: the number above times `most_parts`, plus the number below."""
        out = self.top.home(x) * self.most_parts
        for part, router in self.below.items():
            rows = np.flatnonzero(out == part * self.most_parts)
            if len(rows):
                out[rows] += router.home(x[rows])
        return out

    def visits(self, x: np.ndarray) -> list[list[int]]:
        """The parts that each row visits as a query."""
        out: list[list[int]] = [[] for _ in x]
        above = self.top.visits(x)
        for part in np.unique(above):
            rows = np.flatnonzero((above == part).any(1))
            router = self.below.get(int(part))
            inside = router.visits(x[rows]) if router else np.zeros((len(rows), 1), np.int64)
            for i, found in zip(rows.tolist(), inside.tolist()):
                out[i] += [int(part) * self.most_parts + p for p in found]
        return out


def _usable(vector: str) -> Column:
    """Vectors without NULL and non-finite components that are not zero."""
    v = F.col(vector)
    fine = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))))
    return v.isNotNull() & fine & F.exists(v, lambda e: e != 0)


def _search(k: int, kind: pa.DataType):
    """Nearest `k` of each query within its block, among entries sorted by (part, block, query)."""
    schema = pa.schema([("query_id", kind), ("vec_id", kind), ("score", pa.float64())])

    def matrix(column: pa.Array) -> np.ndarray:
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return flat.reshape(len(column), -1)

    def closest(q_id: int, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        score = np.sqrt(((x - q) ** 2).sum(1))
        score[ids == q_id] = np.inf
        take = min(k, len(ids))
        while True:
            edge = np.partition(score, take - 1)[take - 1]
            near = np.flatnonzero((score <= edge) & (score < np.inf))
            near = near[np.lexsort((ids[near], score[near]))]
            _, first = np.unique(ids[near], return_index=True)  # an id that repeats counts once, at its nearest
            near = near[np.sort(first)]
            if len(near) >= k or take == len(ids):
                return ids[near[:k]], score[near[:k]]
            take = min(len(ids), 4 * take)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, x = None, [], []
        for batch in batches:
            part, block, query, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            turn = np.flatnonzero((part[1:] != part[:-1]) | (block[1:] != block[:-1]) | (query[1:] != query[:-1])) + 1
            vectors = batch.column(4)
            for f, e in zip([0, *turn], [*turn, batch.num_rows]):
                if (part[f], block[f]) != at:
                    at, ids, x = (part[f], block[f]), [], []
                v = matrix(vectors.slice(f, e - f))
                if not query[f]:
                    ids.append(own[f:e])
                    x.append(v)
                    continue
                if not ids:
                    continue
                ids, x = [np.concatenate(ids)], [np.concatenate(x)]
                found = [closest(i, q, ids[0], x[0]) for i, q in zip(own[f:e], v)]
                n = [len(f[0]) for f in found]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(own[f:e], n), kind), pa.array(np.concatenate([f[0] for f in found]), kind),
                    pa.array(np.concatenate([f[1] for f in found])),
                ], schema=schema)

    return run


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _levels(usable: DataFrame, sample: np.ndarray, rows: int, dim: int, config: Config) -> Levels:
    """A router for all rows and, when its parts would hold more than `split_rows`, routers for the large ones."""
    parts = min(config.most_parts, max(1, rows // config.part_rows), max(1, len(sample) // config.least_sampled))
    if rows // parts <= config.split_rows:
        return Levels(learn(sample, rows, config), {}, config.most_parts)
    each = replace(config, recall=config.recall ** 0.5)  # two levels must both find a neighbour
    top = learn(sample, rows, each)
    shared = usable.sparkSession.sparkContext.broadcast(top)

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = shared.value.home(_matrix(batch.column(1), dim)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(home)], names=["id", "v", "home"])

    kinds = {c: usable.schema[c].dataType.simpleString() for c in ("id", "v")}
    homed = settle(usable.select("id", "v").mapInArrow(at_home, f"id {kinds['id']}, v {kinds['v']}, home int"))
    counts = {r["home"]: r["n"] for r in homed.groupBy("home").agg(F.count("*").alias("n")).collect()}  # `most_parts` rows at most
    large = {home: n for home, n in counts.items() if n > config.split_rows}
    if not large:
        return Levels(top, {}, config.most_parts)
    share = F.create_map(*[F.lit(x) for home, n in large.items() for x in (home, int(min(1.0, config.sample / n) * (1 << 30)))])
    place = F.pmod(F.xxhash64("id", F.lit(config.seed + 1)), F.lit(1 << 30))
    drawn = homed.where(place < F.coalesce(F.try_element_at(share, F.col("home")), F.lit(0)))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        home = int(group["home"].iloc[0])
        x = np.array(group.sort_values("id")["v"].tolist(), float)
        return pd.DataFrame({"home": [home], "router": [pickle.dumps(learn(x, large[home], each))]})

    # A router per large part, fitted on a bounded sample each: their number and size are bounded by the configuration.
    fitted = drawn.groupBy("home").applyInPandas(fit, "home int, router binary").collect()
    return Levels(top, {r["home"]: pickle.loads(bytes(r["router"])) for r in fitted}, config.most_parts)


def search(df: DataFrame, is_query: Column, config: Config = Config(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score` (Euclidean distance): the nearest found for each query row.

    `is_query` picks the query rows of `df`; all usable rows but those of the query's own id are
    candidates. Keys are integers. Rows with a NULL key, and vectors that are NULL, empty, zero,
    or hold NULL or non-finite components, take no part; nor do vectors that have not the commonest length (of equal ones the
    greatest). Rows that repeat an id count once, at the nearest of their vectors. Ties go to the smaller id.
    An empty table, or one without queries, gives no row. Other columns are not read.
    """
    kind = df.schema[key].dataType
    arrow_kind = {"bigint": pa.int64(), "int": pa.int32()}[kind.simpleString()]
    usable = df.where(F.col(key).isNotNull() & _usable(vector)).select(
        F.col(key).alias("id"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("query"))
    lengths = usable.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if lengths is None:
        return usable.select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).where("false")
    dim, rows = lengths["size"], lengths["n"]
    usable = usable.where(F.size("v") == dim)

    place = F.pmod(F.xxhash64("id", F.lit(config.seed)), F.lit(1 << 30))
    drawn = usable.where(place < F.lit(min(1 << 30, int(config.sample / rows * (1 << 30)) + 1))).select("id", "v").toArrow()
    sample = np.sort(drawn["id"].to_numpy())
    order = np.argsort(drawn["id"].to_numpy(), kind="stable")
    flat = drawn["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sample), dim)
    if not len(sample):  # a few rows, none drawn
        flat, order = np.ones((1, dim)), np.array([0])
    levels = _levels(usable, flat[order], rows, dim, config)
    shared = df.sparkSession.sparkContext.broadcast(levels)
    vector_type = usable.schema["v"].dataType.simpleString()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, query = _matrix(batch.column(1), dim), np.array(batch.column(2).to_pylist(), bool)
            home, visits = shared.value.home(x), iter(shared.value.visits(x[query]))
            told = pa.array([next(visits) if q else [] for q in query.tolist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home.astype(np.int32)), told], names=["id", "v", "query", "part", "visits"])

    routed = settle(usable.mapInArrow(route, f"id {kind.simpleString()}, v {vector_type}, query boolean, part int, visits array<int>"))
    # A row per part: `most_parts` squared at most.
    sized = routed.groupBy("part").agg(F.ceil(F.count("*") / config.block).cast("int").alias("blocks")).collect()
    blocks = F.broadcast(df.sparkSession.createDataFrame(sized, "part int, blocks int"))
    stored = routed.join(blocks, "part").select(
        "part", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.lit(False).alias("query"), "id", "v")
    asked = routed.where("query").select(F.explode("visits").alias("part"), "id", "v").join(blocks, "part").select(
        "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("query"), "id", "v")
    entries = stored.unionByName(asked).repartition("part", "block").sortWithinPartitions("part", "block", "query")
    plain = kind.simpleString()
    found = entries.mapInArrow(_search(config.neighbours, arrow_kind), f"query_id {plain}, vec_id {plain}, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= config.neighbours).select("query_id", "rank", "vec_id", "score")
