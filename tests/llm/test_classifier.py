import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from mensula.llm import classifier, queries
from mensula.llm.common import table


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op2_quality_classifier(spark, sf).collect()
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    return got, labels


def test_held_out_rows_are_told_apart(scored):
    got, labels = scored
    known = [r for r in got if r.held_out and labels.get(r.doc_id) is not None]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert np.mean([r.predicted == labels[r.doc_id] for r in known]) > 0.9
    good = [r.score for r in known if labels[r.doc_id] == 1]
    bad = [r.score for r in known if labels[r.doc_id] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_edges(spark):
    long = "word " * 200_000
    rows = [(None, "a b"), (1, None), (1, ""), (2, "x y"), (2, "x y"), (3, long)]
    df = spark.createDataFrame([(i, t, 5.0) for i, t in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(2, 1), (None, 1), (3, None), (1, 0)], "doc_id long, quality int")
    model = classifier.fit(classifier.training_rows(df, labels, classifier.Config(bits=10)), classifier.Config(bits=10))
    got = df.select("doc_id", classifier.held_out().alias("h"), classifier.scorer(df, model).alias("s")).collect()
    assert len(got) == len(rows) and all(0 <= r.s <= 1 for r in got)
    none = classifier.fit(classifier.training_rows(df, labels.limit(0), classifier.Config()))
    assert {r.s for r in df.select(classifier.scorer(df, none).alias("s")).collect()} == {0.5}


def test_scores_repeat(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    a, b = (queries.quality_model(docs, labels) for _ in range(2))
    assert np.allclose(a.weights, b.weights) and a.bias == pytest.approx(b.bias)


def test_features_have_length_one():
    index, value = classifier.features("Ein Wort, ein Wort %%% 12", 12)
    assert value @ value == pytest.approx(1) and (np.diff(index) > 0).all()
    assert all(len(x) == 0 for x in classifier.features(" \n", 12))


# --- plain versions, from the docstrings ---------------------------------------------------------

MASK = 2**64 - 1
K1, K2, K3 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9


def plain_shape(word):
    """Runs of one class as one sign; of a run of marks its distinct marks in order."""
    out, last, marks = [], None, set()
    for x in [*word, None]:
        kind = None if x is None else (
            "A" if re.match("[A-ZÀ-ÖØ-Þ]", x) else "a" if re.match("[a-zß-öø-ÿ]", x) else "9" if re.match("[0-9]", x)
            else "*" if re.match(r"[^\w\s]", x) else "?")
        if kind != last and last == "*":
            out.append("".join(sorted(marks)))
            marks = set()
        if kind == "*":
            marks.add(x)
        elif kind == "?" or kind is not None and kind != last:
            out.append(kind)
        last = kind
    return "".join(out)


def plain_features(text, bits):
    """{feature: value}: one- and two-grams of words and of shapes, a repeated word's pair in bucket 0, length one."""
    words = [w.decode() for w in (text or "").encode().split()]
    word = [xxhash.xxh64_intdigest(w.lower().encode(), 1) for w in words]
    shape = [xxhash.xxh64_intdigest(plain_shape(w).encode(), 2) for w in words]
    # Digests are read in the byte order of the machine's integers.
    word, shape = ([int.from_bytes(h.to_bytes(8, "big"), "little") for h in hs] for hs in (word, shape))
    count = Counter()
    for h in word + shape:
        count[(h * K1 & MASK) >> (64 - bits)] += 1
    for a, b in zip(word, word[1:]):
        count[0 if a == b else (((a * K2 & MASK) ^ (b * K3 & MASK)) * K1 & MASK) >> (64 - bits)] += 1
    for a, b in zip(shape, shape[1:]):
        count[(((a * K3 & MASK) ^ (b * K2 & MASK)) * K1 & MASK) >> (64 - bits)] += 1
    norm = math.sqrt(sum(count.values()))
    return {f: math.sqrt(n) / norm for f, n in count.items()}


def plain_ftrl(examples, c, start):
    """Weights after all examples, feature by feature, as the algorithm is written down."""
    z = {f: -w * (c.beta / c.alpha + c.l2) - math.copysign(c.l1, w) * (w != 0) for f, w in start.items()}
    n = defaultdict(float)

    def weight(f):
        s = z.get(f, 0.0)
        return 0.0 if abs(s) <= c.l1 else (math.copysign(c.l1, s) - s) / ((c.beta + math.sqrt(n[f])) / c.alpha + c.l2)

    for x, y in examples:
        w = {f: weight(f) for f in x}
        p = 1 / (1 + math.exp(-sum(w[f] * v for f, v in x.items())))
        for f, v in x.items():
            g = (p - y) * v
            sigma = (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / c.alpha
            z[f] = z.get(f, 0.0) + g - sigma * w[f]
            n[f] += g * g
    return {f: weight(f) for f in z}


def test_features_of_all_documents_against_the_plain_ones(spark, sf):
    for r in table(spark, sf, "documents").select("text").collect():
        index, value = classifier.features(r.text, 14)
        want = plain_features(r.text, 14)
        assert index.tolist() == sorted(want) and np.allclose(value, [want[i] for i in index.tolist()], rtol=1e-12)


def test_learning_against_the_plain_loop():
    c, rng = classifier.Config(bits=6), np.random.default_rng(2)
    start = np.where(rng.random(65) < 0.5, rng.normal(size=65), 0.0)
    examples = []
    for _ in range(400):
        index = np.sort(rng.choice(65, rng.integers(1, 20), replace=False))
        examples.append((index, rng.random(len(index)), float(rng.random() < 0.4)))
    learner = classifier.Ftrl(c, start)
    assert np.allclose(learner.weights(np.arange(65)), start, atol=1e-12)
    for e in examples:
        learner.learn(*e)
    want = plain_ftrl([(dict(zip(i.tolist(), v.tolist())), y) for i, v, y in examples], c, dict(enumerate(start.tolist())))
    assert np.allclose(learner.weights(np.arange(65)), [want[i] for i in range(65)], atol=1e-9, rtol=1e-9)


@pytest.mark.parametrize("rounds", [1, 2])
def test_model_is_the_mean_over_shards(spark, rounds):
    c = classifier.Config(bits=8, shards=3, rounds=rounds, epochs=2)
    rows = [(f"word{i % 13} text{i % 5} {'good' if i % 3 else 'bad!!'} {i}", float(i % 3 > 0)) for i in range(90)] + [("word1 twice", 1.0)] * 2 + [(None, 1.0)]
    df = spark.createDataFrame(rows, "text string, label double")
    model = classifier.fit(df, c)
    # Shards that Spark deals to one task learn one after the other and count as one.
    shard = df.select("text", "label", F.pmod(F.xxhash64("text", F.lit(c.seed)), F.lit(3)).alias("shard"), F.xxhash64("text", F.lit(c.seed + 1)).alias("o"))
    placed = shard.repartition(3, "shard").withColumn("s", F.spark_partition_id()).collect()
    weights = {}
    for _ in range(rounds):
        learnt = []
        for s in range(3):
            mine = sorted((r for r in placed if r.s == s), key=lambda r: (r.shard, r.o, r.text is not None, r.text or "", r.label))
            examples = [({**plain_features(r.text, 8), 256: 1.0}, r.label) for r in mine]
            if examples:
                learnt.append(plain_ftrl(examples * c.epochs, c, weights))
        weights = {f: float(np.float32(sum(w.get(f, 0.0) for w in learnt) / len(learnt))) for f in set().union(*learnt)}
    assert np.allclose(model.weights, [weights.get(f, 0.0) for f in range(256)], atol=2e-6) and model.bias == pytest.approx(weights[256], abs=2e-6)


def test_scores_of_all_documents_against_the_plain_sum(spark, sf):
    docs = table(spark, sf, "documents")
    model = queries.quality_model(docs, table(spark, sf, "labels"))
    for r in docs.select("text", classifier.scorer(docs, model).alias("s")).collect():
        x = sum(float(model.weights[f]) * v for f, v in plain_features(r.text, model.bits).items()) + model.bias
        assert r.s == pytest.approx(1 / (1 + math.exp(-x)), rel=1e-5, abs=1e-9)


def test_a_label_that_stands_twice_teaches_twice_and_names_do_not_clash(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, "c d", "y")], "doc_id long, text string, _key string").withColumns({"label": F.lit(3), "shard": F.lit("s"), "index": F.lit(0)})
    labels = spark.createDataFrame([(1, 1, 7), (1, 1, 8), (2, 0, 9)], "doc_id long, quality int, text int")
    rows = classifier.training_rows(df, labels, classifier.Config())
    assert sorted(map(tuple, rows.collect())) == [("a b", 1.0), ("a b", 1.0), ("c d", 0.0)]
    assert df.withColumn("score", classifier.scorer(df, classifier.fit(rows))).columns[-1] == "score"


def test_all_labelled_rows_teach_and_common_texts_are_spread(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 15_000, "copy").otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    labels = spark.range(40_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    c = classifier.Config(bits=4, shard_rows=1_000, copies=100, rounds=1, epochs=1)
    for config in (c, classifier.Config(broadcast=10)):
        rows = classifier.training_rows(docs, labels, config)
        assert rows.count() == 40_000
        assert rows.agg(F.sum("label"), F.countDistinct("text")).first()[:] == (20_000.0, 25_001)
    placed = classifier.dealt(rows, c)
    sizes = {r.shard: r.n for r in placed.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    assert set(sizes) == set(range(40)) and sum(sizes.values()) == 40_000 and max(sizes.values()) <= 1_300
    assert {tuple(r) for r in placed.groupBy("text", "label").agg(F.sum("n").alias("n")).where("text = 'copy'").collect()} == {("copy", 0.0, 7_500), ("copy", 1.0, 7_500)}
    assert placed.select("shard", F.spark_partition_id().alias("p")).distinct().count() == 40
    assert classifier.fit(rows, c).bias != classifier.fit(rows.where("text != 'copy'"), c).bias
