import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from mensula.llm import mixing
from mensula.llm.mixing import Config

SCHEMA = "doc_id long, source string, text string, target int, h string, n int"


def plain_targets(sizes, c=Config()):
    """{source: target} by resharing, round for round."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: c.weights[i % len(c.weights)] for i, s in enumerate(names)}
    out, left, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * per >= c.most * sizes[s]}
        if not full:
            return out | {s: weight[s] * per for s in open_}
        for s in full:
            out[s] = float(c.most * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, got, c=Config()):
    """Sizes and targets by brute force; taken words and copies of every source near what they should be."""
    assert sorted((r["doc_id"] or -1, r["source"] or "", r["size"]) for r in got) == sorted((r[0] or -1, r[1] or "", words(r[2])) for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r[1]] += words(r[2])
    want = plain_targets(sizes, c)
    taken, copies, count, largest = Counter(), Counter(), Counter(), defaultdict(int)
    for r in got:
        s = r["source"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s], rel=1e-9, abs=1e-9)
        rate = want[s] / sizes[s] if sizes[s] else 0.0
        assert int(rate + 1e-9) <= r["copies"] <= -int(-(rate - 1e-9)) + 1 and r["copies"] <= c.most and r["taken"] == r["copies"] * r["size"]
        taken[s] += r["taken"]
        copies[s] += r["copies"]
        count[s] += 1
        largest[s] = max(largest[s], r["size"])
    for s in sizes:
        rate = want[s] / sizes[s] if sizes[s] else 0.0
        assert abs(taken[s] - want[s]) <= 2 * largest[s] + 1e-6
        assert abs(copies[s] - rate * count[s]) <= 2 + 1e-6
    return taken, want


def test_whole_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    got = mixing.mix(docs).collect()
    check(rows, got)
    order = lambda rs: sorted(tuple(r) for r in rs)
    assert order(got) == order(mixing.mix(docs.repartition(13)).collect())


def test_many_blocks_and_a_hot_source_keep_both_totals(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}", "w " * int(rng.lognormal(2, 1.2)), 0, "", 0) for i in range(6_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    # Two rounds of blocks that hold enough documents to trade with: what lands is of middle length.
    taken, want = check(rows, mixing.mix(df, Config(block=400)).collect())
    assert max(abs(taken[s] - want[s]) / want[s] for s in want) < 0.01
    # Four rounds of tiny blocks.
    c = Config(block=32)
    got = mixing.mix(df, c).collect()
    check(rows, got, c)
    again = mixing.mix(df.repartition(2), c).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    other = mixing.mix(df, Config(block=32, seed=4)).collect()
    assert sorted(map(tuple, got)) != sorted(map(tuple, other))


def test_targets_stop_at_three_times_a_source_and_are_reshared(spark):
    for sizes in ({"a": 1, "b": 1, "c": 98}, {"a": 10, "b": 0, "é": 5, "z": 70, None: 15}, {"a": 0}, {None: 9}, {"b": 5, "a": 5}):
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        assert got == pytest.approx(plain_targets(sizes), rel=1e-12)
        assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_nulls_empty_and_long_texts_ties_repeats_and_clashing_names(spark):
    rows = [(None, None, None, 1, "x", 1), (1, None, "a b c", 1, "x", 1), (2, "s", "", 1, "x", 1), (3, "s", "w " * 300_000, 1, "x", 1),
            (4, "t", "  x\x0b\x0cy", 1, "x", 1)] + [(7, "t", "same words", 1, "x", 1)] * 50 + [(None, "t", "p q", 1, "x", 1)] * 9
    df = spark.createDataFrame(rows, SCHEMA)
    check(rows, mixing.mix(df).collect())
    assert mixing.mix(df.where("false")).collect() == []
    assert [r["copies"] for r in mixing.mix(df.where("doc_id = 2")).collect()] == [0]
    out = mixing.mixed(df)
    assert out.columns == df.columns
    copies = Counter(r["doc_id"] for r in out.collect())
    want = Counter()
    for r in mixing.mix(df).collect():
        want[r["doc_id"]] += r["copies"]
    assert abs(copies[7] - want[7]) <= 2 and copies[2] <= 3


def test_a_row_that_repeats_very_often_is_dealt_in_chunks(spark):
    df = spark.createDataFrame([("a", 10_000), ("b", 3), ("c", 0)], "x string, n long")
    got = Counter()
    numbers = defaultdict(set)
    for r in mixing._repeated(df, df["n"], "i").collect():
        got[r["x"]] += 1
        numbers[r["x"]].add(r["i"])
    assert got == {"a": 10_000, "b": 3} and numbers["a"] == set(range(10_000))


def test_flight_keeps_totals_and_probabilities():
    rng = np.random.default_rng(0)
    size = np.concatenate([rng.integers(0, 500, 60), np.full(20, 7)]).astype(float)
    p = rng.random(80)
    p[:4] = [0, 1, 0.5, 0.5]
    balance = np.column_stack([np.ones(80), size])
    total = np.zeros(80)
    for seed in range(400):
        r = np.random.default_rng(seed)
        flown = mixing.flight(p, balance, r)
        assert ((flown > 0) & (flown < 1)).sum() <= 2
        assert np.allclose(balance.T @ flown, balance.T @ p, rtol=1e-6, atol=1e-5)
        landed = mixing.landing(flown, r)
        assert set(landed) <= {0.0, 1.0}
        assert abs(landed.sum() - p.sum()) <= 2 and abs(size @ landed - size @ p) <= 2 * size.max()
        total += landed
    assert np.abs(total / 400 - p).max() < 0.13  # five standard errors
    assert (mixing.flight(np.array([0.2, 0.7]), np.ones((2, 2)), rng) == [0.2, 0.7]).all()


def test_landing_keeps_both_probabilities_and_takes_the_smaller_error():
    for a, b in product((0.1, 0.5, 0.8), repeat=2):
        seen = np.array([mixing.landing(np.array([a, b]), np.random.default_rng(s)) for s in range(3_000)])
        assert np.abs(seen.mean(0) - [a, b]).max() < 0.05
        assert not (seen.sum(1) == (2 if a + b <= 1 else 0)).any()


def test_direction_lies_in_the_null_space():
    rng = np.random.default_rng(1)
    for columns in (rng.random((3, 2)), rng.random((5, 4)), np.array([[1, 7.0], [1, 7], [1, 7]]), np.zeros((3, 2))):
        u = np.array(mixing.direction(columns.tolist()))
        assert np.abs(u).max() >= 1 and np.allclose(columns.T @ u, 0, atol=1e-9)
