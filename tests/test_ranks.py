"""Rank selection and running sums against brute force, with heavy ties and tiny buckets."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from mensula import sizing
from mensula.operators import gain, ranks
from mensula.operators.ranks import Ranking


def scored(n=3000, groups=3, seed=1):
    """Rows where one score holds a third of each group and some are missing."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        score = 0.5 if i % 3 == 0 else None if i % 50 == 1 else float(np.round(rng.random(), 2))
        rows.append((i % groups, (i * 7919) % n, score, int(rng.random() < 0.2)))
    return rows


@pytest.fixture(params=["broadcast", "shuffled"])
def rows(request, spark, monkeypatch):
    if request.param == "shuffled":
        monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    data = scored()
    return spark.createDataFrame(data, "g int, e int, p double, y int"), data


def ordered(data, g):
    mine = [r for r in data if r[0] == g]
    return sorted(mine, key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))


GROUPED = Ranking("p", ("e",), ("g",), rows_per_bucket=150)


def test_buckets_split_a_heavy_score(rows):
    df, _ = rows
    sizes = [r["count"] for r in ranks.with_buckets(df, GROUPED).groupBy("g", "_bucket").count().collect()]
    assert len(sizes) > 12 and max(sizes) < 600


def test_rank_and_running_sum(rows):
    df, data = rows
    out = ranks.with_rank(df, GROUPED, running=["y"]).collect()
    got = {(r["g"], r["e"]): (r["rank"], r["running_y"], r["n_rows"]) for r in out}
    for g in range(3):
        total = 0
        for i, r in enumerate(ordered(data, g), 1):
            total += r[3]
            assert got[(g, r[1])] == (i, total, 1000)


def test_best_prefix_takes_the_first_maximum(rows):
    df, data = rows
    got = {r["g"]: (r["gain"], r["n_contacts"]) for r in gain.best_gain(df, GROUPED, "y", 5, 1).collect()}
    for g in range(3):
        curve = np.cumsum([5 if r[3] == 1 else -1 for r in ordered(data, g)])
        assert got[g] == (curve.max(), int(curve.argmax()) + 1)


def test_all_misses_lose_least_at_the_first_row(spark):
    df = spark.createDataFrame([(i, 0.5, 0) for i in range(10)], "e int, p double, y int")
    best = gain.best_gain(df, Ranking("p", ("e",), rows_per_bucket=3), "y", 5, 1).first()
    assert (best["gain"], best["n_contacts"], best["n_rows"]) == (-1, 1, 10)


def test_top_rows(rows):
    df, data = rows
    got = {(r["g"], r["e"]) for r in ranks.top_rows(df, GROUPED, 400).collect()}
    assert got == {(g, r[1]) for g in range(3) for r in ordered(data, g)[:400]}
    assert ranks.top_rows(df, GROUPED, 99_999).count() == len(data)
    assert ranks.top_rows(df, Ranking("p", ("e",), rows_per_bucket=200), 777).count() == 777


def test_top_sizes_count_hits(rows):
    df, data = rows
    got = {(r["g"], r["n_contacts"]): (r["TP"], r["threshold"]) for r in
           gain.top_n_sweep(df, GROUPED, "y", [1, 40, 500, 5000]).collect()}
    for g in range(3):
        order = ordered(data, g)
        for n in (1, 40, 500):
            assert got[(g, n)] == (sum(r[3] for r in order[:n]), order[n - 1][2])
        assert (g, 5000) not in got


def test_quantiles_equal_linear_interpolation(rows):
    df, data = rows
    shares = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    out = ranks.quantiles(df, "p", shares, ["g"], rows_per_bucket=150).collect()
    for r in out:
        values = [x[2] for x in data if x[0] == r["g"] and x[2] is not None]
        assert r["value"] == pytest.approx(np.percentile(values, r["share"] * 100), abs=1e-12)
    assert len(out) == 18


def test_one_row_and_empty_input(spark):
    one = spark.createDataFrame([(1, 0.3)], "e int, p double")
    assert ranks.quantiles(one, "p", [0.5]).first()["value"] == 0.3
    none = one.where("e > 1")
    assert ranks.top_rows(none, Ranking("p", ("e",)), 5).count() == 0
    assert ranks.with_rank(none, Ranking("p", ("e",))).count() == 0


def test_thresholds_are_evenly_spaced():
    assert np.allclose(gain.thresholds(), np.linspace(0.001, 0.1, 100), atol=0, rtol=1e-15)


def test_threshold_sweep_counts_every_cut(rows):
    df, data = rows
    cuts = [0.0, 0.25, 0.5, 0.75, 1.1]
    for r in gain.threshold_sweep(df, "p", "y", cuts).collect():
        hit = [x[3] for x in data if x[2] is not None and x[2] >= r["threshold"]]
        assert (r["TP"], r["FP"]) == (sum(hit), len(hit) - sum(hit))
        assert r["TP"] + r["FN"] == sum(x[3] for x in data)
        assert r["gain"] == r["TP"] * 780_000 - len(hit) * 20_000


def test_long_search_equals_short_compare(spark, monkeypatch):
    table = spark.createDataFrame([(list(range(0, 200, 3)),)], "a array<int>")
    keys = table.select("a", F.explode(F.sequence(F.lit(-2), F.lit(205))).alias("k"))
    long = ranks.with_place(keys, "a", F.col("k"), "n", 67)
    got = {r["k"]: r["n"] for r in long.collect()}
    assert got == {k: sum(v <= k for v in range(0, 200, 3)) for k in range(-2, 206)}
    monkeypatch.setattr(ranks, "SHORT_ARRAY", 100)
    short = ranks.with_place(keys, "a", F.col("k"), "n", 67, closed=False)
    assert {r["k"]: r["n"] for r in short.collect()} == {k: sum(v < k for v in range(0, 200, 3)) for k in range(-2, 206)}


@pytest.mark.parametrize("broadcast", [True, False])
def test_buckets_follow_the_size_of_each_group(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(ranks, "small_side", lambda df: df)
    rows = spark.range(110_000).select(
        F.when(F.col("id") < 100_000, F.lit(0)).otherwise(F.col("id")).alias("g"), F.xxhash64("id").alias("v"), "id")
    ranking = ranks.Ranking("v", ("id",), ("g",), rows_per_bucket=500)
    sizes = ranks.with_buckets(rows, ranking).groupBy("g", "_bucket").count()
    found = sizes.agg(F.max("count"), F.count("*")).first()
    assert found[0] <= 1_000 and found[1] >= 10_000 + 150
    top = ranks.with_rank(rows, ranking).where("g = 0").agg(F.max("rank"), F.count_distinct("rank")).first()
    assert tuple(top) == (100_000, 100_000)


def stored(found, names=()):
    return {r["g"]: [(f["rank"], f["key"]["score"], *(f[n] for n in names)) for f in r["found"]] for r in found.collect()}


@pytest.mark.parametrize("limit", [40, 150, 10_000])
@pytest.mark.parametrize("wanted", [[1, 2, 333, 334, 500, 980, 1000, 1001], list(range(1, 1000, 9))])
def test_keys_from_brackets(rows, limit, wanted):
    df, data = rows
    at = F.array(*[F.lit(w) for w in wanted])
    for ties in (("e",), ()):
        ranking = Ranking("p", ties, ("g",), rows_per_bucket=limit)
        found = ranks.find(df, ranking, at, {"y": F.col("y")})
        got = stored(found, ["upto_y"])
        for g in range(3):
            order = ordered(data, g)
            here = [w for w in wanted if w <= 1000]
            assert [f[:2] for f in got[g]] == [(w, -order[w - 1][2] if order[w - 1][2] is not None else None) for w in here]
            # Without ties, rows of one score have one key and are summed up together.
            last = {r[2]: i for i, r in enumerate(order, 1)}
            upto = [w if ties else last[order[w - 1][2]] for w in here]
            assert [f[2] for f in got[g]] == [sum(r[3] for r in order[:u]) for u in upto]
        assert {r["g"]: r["total_y"] for r in found.collect()} == {g: sum(r[3] for r in ordered(data, g)) for g in range(3)}


def test_a_bracket_that_missed_is_noticed(rows, monkeypatch):
    df, data = rows
    plain, calls = ranks._found_in_buckets, []
    monkeypatch.setattr(ranks, "_found_in_buckets", lambda *a: calls.append(1) or plain(*a))
    found = ranks.find(df, GROUPED, F.array(F.lit(200), F.lit(700)), error=-0.2)
    assert stored(found) == {g: [(w, -ordered(data, g)[w - 1][2]) for w in (200, 700)] for g in range(3)} and calls


@pytest.mark.parametrize("kind", ["long", "decimal(38,2)", "float", "string"])
def test_scores_of_any_type(spark, kind):
    values = [2**53 + i for i in range(200)] + [-5, 0, 7] if kind == "long" else list(range(-100, 101))
    df = spark.createDataFrame([(v,) for v in values], "v long").select(F.col("v").cast(kind).alias("v"))
    ranking = Ranking("v", descending=False, rows_per_bucket=20)
    got = [r["key"]["score"] for r in ranks.keys_at_ranks(df, ranking, F.array(F.lit(1), F.lit(57), F.lit(201))).orderBy("rank").collect()]
    order = [r["v"] for r in df.orderBy("v").collect()]
    assert got == [order[0], order[56], order[200]]


def test_nan_infinity_and_missing_scores_come_last_in_that_order(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(None, 1), (nan, 2), (inf, 3), (1.0, 4), (-inf, 5), (None, 6)], "p double, e int")
    ranking = Ranking("p", ("e",), descending=False)
    got = ranks.keys_at_ranks(df, ranking, F.sequence(F.lit(1), F.lit(9))).orderBy("rank").collect()
    assert [r["key"]["tie_0"] for r in got] == [5, 4, 3, 2, 1, 6]


def test_skewed_and_constant_columns_have_exact_quantiles(spark):
    rng = np.random.default_rng(4)
    columns = {"skewed": rng.lognormal(0, 4, 20_000), "constant": np.full(20_000, 3.5), "mostly": np.where(rng.random(20_000) < 0.9, 0, rng.random(20_000))}
    df = spark.createDataFrame([(c, float(v)) for c, vs in columns.items() for v in vs], "c string, v double")
    for limit in (100, 1_000_000):
        for r in ranks.quantiles(df, "v", [0.001, 0.1, 0.5, 0.999], ["c"], limit).collect():
            assert r["value"] == np.percentile(columns[r["c"]], 100 * r["share"]) or r["value"] == pytest.approx(
                np.percentile(columns[r["c"]], 100 * r["share"]), rel=1e-13)


@pytest.mark.parametrize("group", [(), ("g",)])
def test_plans_stay_small_however_many_buckets(spark, group):
    """The search for a bucket is never written out, and the cuts are no literals of the plan."""
    df = spark.range(60_000).select((F.col("id") * 7919 % 10_007).alias("p"), F.col("id").alias("e"), F.lit(1).alias("g"))
    sizes = {}
    for limit in (3_000, 40):
        out = ranks.with_rank(df, Ranking("p", ("e",), group, rows_per_bucket=limit), running=["e"])
        start = time.time()
        sizes[limit] = len(out._jdf.queryExecution().optimizedPlan().toString())
        assert time.time() - start < 1.0
        far = out.agg(F.max("rank"), F.count_distinct("rank"), F.max("running_e")).first()
        assert tuple(far) == (60_000, 60_000, 60_000 * 59_999 // 2)
    assert sizes[40] < 3 * sizes[3_000]
    # A filter on the result does not write the search out either.
    bucketed = ranks.with_buckets(df, Ranking("p", ("e",), group, rows_per_bucket=40))
    assert len(bucketed.where("_bucket = 7")._jdf.queryExecution().optimizedPlan().toString()) < 3 * sizes[3_000]
