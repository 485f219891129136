import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from mensula.llm import spelling
from mensula.llm.spelling import Config


def plain(docs, c):
    """{word: (form, root, n, n_near, form_n)} of (key, text) rows; near words by wild cards and by deletion."""
    count = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(x.lower() if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if c.slip and h % c.slip == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            count[run] += 1
    n = {w: k for w, k in count.items() if len(w) >= c.least_letters and k >= c.least_count}
    wild, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            wild[w[:i] + "*" + w[i + 1:]].add(w)
            if (shorter := w[:i] + w[i + 1:]) in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in wild.values():
        for w in group:
            near[w] |= group - {w}
    best = {w: min(near[w], key=lambda x: (-n[x], x)) for w in n if near[w]}
    form = {w: b for w, b in best.items() if n[b] >= 5 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), k, len(near[w]), n[form[w]] if w in form else None) for w, k in n.items()}


def rows(frame):
    got = frame.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}
    assert len(out) == len(got)
    return out


def test_whole_documents_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = plain([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], Config())
    assert len(want) > 300 and sum(v[0] is not None for v in want.values()) >= 20
    assert rows(spelling.variants(docs)) == want
    few = Config(leaf_words=40, fine_leaf=4, block=16)
    assert rows(spelling.variants(docs.repartition(7), few)) == want


def crowd(seed, size):
    """Texts of many near words: spellings around a few stems, with accents, anagrams and several lengths."""
    rng = np.random.default_rng(seed)
    stems = ["kalende", "kalendes", "marinad", "oberstra", "étudénts", "×÷ÿÀÉé", "aaaaaa", "abcabcabc"]
    words = []
    for _ in range(size):
        w = list(stems[rng.integers(len(stems))])
        for _ in range(rng.integers(0, 3)):
            at, what = rng.integers(len(w)), rng.integers(4)
            if what == 0:
                w[at] = "abekséÿ"[rng.integers(7)]
            elif what == 1:
                w.insert(at, "abekséÀ"[rng.integers(7)])
            elif what == 2:
                del w[at]
            else:
                rng.shuffle(w)
        words += ["".join(w)] * int(rng.integers(1, 40) ** rng.integers(1, 3))
    rng.shuffle(words)
    return [(i, " ".join(words[i::50])) for i in range(50)]


@pytest.mark.parametrize("config", [Config(), Config(leaf_words=16, fine_leaf=3, block=5), Config(leaf_words=1, sample=60, slip=0, least_count=2)])
def test_crowded_words_against_brute_force(spark, config):
    docs = crowd(3, 700)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = plain(docs, config)
    assert any(v[1] != v[0] and v[0] for v in want.values())  # a chain of more than one link
    assert rows(spelling.variants(df, config)) == want


def test_nulls_empty_and_long_texts_repeats_and_clashing_names(spark):
    long = "é" * 5_000
    docs = [(None, "Walnuts walnuts WALNUTS"), (1, None), (2, ""), (3, "12 -- a bc"), (4, f"{long} {long}a " * 6), (4, f"{long} {long}a " * 6),
            (5, "walnuts walnut " * 9), (5, "walnuts walnut " * 9), (6, "ЖЖЖЖЖЖЖ " * 9), (7, "walnuts× " * 7)]
    df = spark.createDataFrame([(k, t, "x", 1, "y") for k, t in docs], "doc_id int, text string, word string, n int, h string")
    want = plain(docs, Config())
    assert rows(spelling.variants(df)) == want and want["walnuts"][3] >= 1 and long in want
    assert rows(spelling.variants(df.where("false"))) == {}
    assert rows(spelling.variants(df.where("doc_id < 4"))) == {}


def test_a_word_visits_few_leaves():
    rng = np.random.default_rng(2)
    words = sorted({"".join(chr(97 + int(x)) for x in rng.zipf(1.4, 9) % 26) for _ in range(60_000)})
    counts = spelling.letter_counts(spelling.letters(words))
    tree = spelling.grow(counts, 30)
    depth = [0] * len(tree.letter)  # counts halve unevenly, so some leaves lie deeper than the logarithm
    for i in range(len(depth)):
        for child in (tree.left[i], tree.right[i]):
            if child >= 0:
                depth[child] = depth[i] + 1
    for radius in (1, 2):
        row, leaf = tree.touched(counts[:2_000], radius)
        assert len(row) / 2_000 < min(tree.leaves / 20, (max(depth) + 2) ** radius)
    # No leaf within the radius is left out: its words' true distances say so.
    home = tree.home(counts)
    told = set(zip(row.tolist(), leaf.tolist()))
    for i in range(50):
        near = np.flatnonzero(np.abs(counts.astype(int) - counts[i]).sum(1) <= 2)
        assert {(i, int(home[j])) for j in near} <= told
