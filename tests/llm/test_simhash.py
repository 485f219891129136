import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from mensula import sizing
from mensula.llm import simhash
from mensula.llm.common import table
from mensula.llm.components import components


def plain_fingerprint(text, k=4):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def close_links(fps, distance):
    v = np.array(fps, dtype=np.uint64)
    return [
        (fps[i], fps[j]) for i in range(len(v))
        for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= distance) + i + 1
    ]


def plain_groups(rows, distance=4):
    """{position: (fp, smallest id reachable)} of (id, text) rows."""
    fp = [plain_fingerprint(t) for _, t in rows]
    roots = plain_roots(set(fp), close_links(sorted(set(fp)), distance))
    low = {}
    for (i, _), f in zip(rows, fp):
        if i is not None:
            low[roots[f]] = min(i, low.get(roots[f], i))
    return [(i, f"{f:016x}", low.get(roots[f])) for (i, _), f in zip(rows, fp)]


def got_groups(df):
    return [tuple(r) for r in df.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect()]


def key(row):
    return tuple((x is None, x) for x in row)


def test_all_documents_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(got_groups(simhash.groups(docs)), key=key) == sorted(plain_groups(rows), key=key)


def test_edges(spark):
    long = " ".join(f"w{i % 977}x{i}" for i in range(40_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (None, "Ab cd"), (4, "aB CD"), (4, "aB CD"), (5, "one"), (6, long), (7, long + " more"),
        (8, "Ünï ÇÉ a b c d"), (9, "ünï çé a b c d"), (None, None),
    ]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, root long")
    assert sorted(got_groups(simhash.groups(df)), key=key) == sorted(plain_groups(rows), key=key)
    kept = simhash.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect())[:2] == [(1, None), (4, "aB CD")]
    assert simhash.groups(df.limit(0)).count() == 0


def test_the_kept_row_does_not_depend_on_order_names_or_joins(spark, monkeypatch):
    names = ["_k", "_h", "_th", "h1", "H2", "row", "root", "fp", "n", "t"]
    rows = [(i // 4, f"the same words for group {i // 8} of all {'x' * (i // 8)}", f"lang{i % 3}", *[f"{n}{i}" for n in names]) for i in range(40)]
    rows += rows[:5] + [(None, "alone here with some words", None, *names), (None, None, "a", *names), (None, "", "b", *names)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "lang", *names])
    kept = sorted((tuple(r) for r in simhash.deduplicate(df).collect()), key=key)
    assert simhash.deduplicate(df).columns == df.columns
    assert [r[0] for r in kept].count(0) == 1 and set(kept) <= set(rows) and len(kept) < 10
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    again = simhash.deduplicate(spark.createDataFrame(rows[::-1], df.schema).repartition(6))
    assert sorted((tuple(r) for r in again.collect()), key=key) == kept


@pytest.mark.parametrize("block", [8, 2_048])
@pytest.mark.parametrize("distance", [1, 4, 6])
def test_links_have_the_components_of_all_pairs(spark, block, distance):
    rng = random.Random(distance)
    fps = set()
    for _ in range(25):  # clouds around centres, chains, and scattered fingerprints
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 5, 60])):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = [int(x) for x in np.array(fps, np.uint64).view(np.int64)]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = simhash.linked(df, distance, block=block).collect()
    pairs = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in found]
    assert plain_roots(fps, pairs) == plain_roots(fps, close_links(fps, distance))


def test_allocation_is_the_cheapest():
    near = [np.array([0.5, 0.5]), np.array([0.01, 0.99]), np.array([0.2, 0.8])]
    _, chosen = simhash.allocate(near, [8, 8, 8], 1e9, 3)
    assert sum(chosen) == 3 - 3 + 1
    assert chosen[0] == -1  # the common values are not probed at all


def test_components_of_long_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(300)] + [(1_000, i) for i in range(1_001, 1_200)] + [(5_000, 5_000)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    roots = {r.node: r.root for r in components(df).collect()}
    want = plain_roots({x for l in links for x in l}, links)
    assert roots == {n: r for n, r in want.items() if n != r}
