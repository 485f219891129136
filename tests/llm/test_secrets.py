import hashlib
import random
import re

from mensula.llm import queries, secrets
from mensula.llm.common import table

CHECKS = {
    "assign": (r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
               r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 12),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
}


def plain(text):
    found = [(m.start(), i, m.end(), k) for i, (k, (p, ok)) in enumerate(CHECKS.items()) for m in re.finditer(p, text) if ok(m)]
    return [(k, s, e) for s, _, e, k in sorted(found)]


def test_base_spans_of_all_documents(spark, sf):
    docs = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    got = {r.doc_id: r for r in queries.op7_secret_formats(spark, sf).collect()}
    assert set(got) == set(docs)
    for i, text in docs.items():
        want = plain(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == n for k, _, _ in want) for n in CHECKS]
        assert set(filter(None, joined.split(","))) <= set(got[i].spans.split(","))


def test_base_spans_of_odd_texts():
    rng = random.Random(2)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGHIJKLMN0123", "0123456789abcdef", "fa", "x.y/z", "é", "ſecret=abcdefghijklmnop", "\n"]
    for _ in range(5_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert secrets.base_spans(text) == plain(text), text


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["ther", "ing", "ous", "re", "nation", "el"]) for _ in range(rng.randint(1, 7)))
    key = lambda: "sk-" + "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789") for _ in range(24))
    known = [f"{word()} token={key()} {word().upper()}-{word()}" for _ in range(400)]
    bare = [f"{word()} {key()} {word()}{word()}{word()}" for _ in range(200)]
    clean = [" ".join(word() for _ in range(40)) + " " + word().title() + "-" + word() + "-" + word() for _ in range(400)]
    return known, bare, clean


def test_learnt_formats_find_what_has_no_keyword(spark):
    known, bare, clean = corpus()
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*known, *bare, *clean])], "doc_id long, text string")
    got = sorted(secrets.scan(df, secrets.learn(df)).collect(), key=lambda r: r.doc_id)
    found = [r.n_format for r in got]
    assert sum(f == 1 for f in found[400:600]) >= 190
    assert sum(found[600:]) == 0


def test_automata_generalise_and_do_not_depend_on_order():
    rng = random.Random(1)
    words = ["k9" + "a9" * rng.randint(2, 9) for _ in range(500)]
    learnt = secrets.infer(words)
    assert secrets.infer(words[::-1]) == learnt
    assert len(learnt.steps) < 30
    assert learnt.score("k9" + "a9" * 14) > learnt.score("k9" + "99" * 14) + 20
    assert secrets.infer([]).score("a9") < 0


def test_whole_runs_are_learnt():
    rng = random.Random(3)
    pick = lambda of, n: "".join(rng.choice(of) for _ in range(n))
    for tail, wrong in (("0123456789", "+"), ("ABCDEFGHIJKLM", "+"), ("0123456789", "z")):
        words = [secrets.signs(pick("abcdefghijklmnopqrstuvwxyz", 80) + pick(tail, 30)) for _ in range(600)]
        learnt = secrets.infer(words)
        head = pick("abcdefghijklmnopqrstuvwxyz", 80)
        assert learnt.score(secrets.signs(head + pick(tail, 30))) > learnt.score(secrets.signs(head + wrong * 30)) + 30


def test_long_and_few_words():
    assert len(secrets.infer(["a" * 100_000 + "9", "g9"]).steps) == 1
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("a9g") * rng.randint(1, 4) for _ in range(rng.randint(1, 6)))
    for _ in range(20):
        words = [word() for _ in range(40)]
        assert all(secrets.restored(secrets.shortened(w)) == w for w in words)
        learnt = secrets.infer(words)
        assert all(learnt.score(w) > learnt.unseen for w in words if len(w) == 1) and secrets.infer(words[::-1]) == learnt


def test_candidates_hold_or_avoid_base_spans():
    text = "sk_live_0123456789abcdef0123XYZW 0123456789abcdef token=abcdefghijklmn some-ordinary-words 12+chars-here"
    base = secrets.base_spans(text)
    held = [text[s:e] for s, e in secrets.candidates(text, base)]
    assert held == ["sk_live_0123456789abcdef0123XYZW", "some-ordinary-words", "12+chars-here"]
    assert [text[s:e] for s, e in secrets.candidates(text, base, alone=True)] == held[1:]


def planted(docs, rng, share=0.3):
    """Whole documents with keys put between words, with and without a keyword, some around a hex part; and what was put where."""
    pick = lambda of, n: "".join(rng.choice(of) for _ in range(n))
    letters, digits = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz", "0123456789"
    kinds = [
        lambda: "sk-" + pick(letters + digits, 24), lambda: "ghp_" + pick(letters + digits, 36),
        lambda: pick("ABCDEF" + digits, 8) + "-" + pick("ABCDEF" + digits, 24), lambda: "whsec_" + pick(letters + digits + "+/", 88),
        lambda: "sk_live_" + pick("abcdef" + digits, 24) + pick("XYZW", 4),
    ]
    out, bare = [], {}
    for i, text in docs:
        words = (text or "").split(" ")
        for kind in kinds:
            key, at = kind(), rng.randrange(len(words) + 1)
            if rng.random() < share:
                words.insert(at, f"token={key}")
            elif rng.random() < share:
                words.insert(at, key)
                bare.setdefault(i, []).append(key)
        out.append((i, " ".join(words)))
    return out, bare


def precision_and_recall(spark, docs, seed=6):
    rows, bare = planted(docs, random.Random(seed))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    hit = told = 0
    for r in secrets.scan(df, secrets.learn(df)).collect():
        spans = [x.split(":") for x in r.spans.split(",") if x.startswith("format:")]
        found = [texts[r.doc_id][int(s):int(e)] for _, s, e in spans]
        told += len(found)
        hit += sum(any(k in f or f in k for f in found) for k in bare.get(r.doc_id, []))
    return hit / max(told, 1), hit / sum(map(len, bare.values()))


def test_planted_keys_in_whole_documents(spark, sf):
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    precision, recall = precision_and_recall(spark, docs)
    assert precision >= 0.95 and recall >= 0.9, (precision, recall)


def test_edges(spark):
    rows = [(None, "token=abcdefghijkl"), (1, None), (1, ""), (2, "ff" * 9), (2, "ff" * 9), (3, "x" * 400_000 + " " + "0123456789abcdef" * 9_000)]
    df = spark.createDataFrame([(*r, "q", 0) for r in rows], "doc_id long, text string, spans string, n_hex int")
    got = secrets.scan(df, secrets.learn(df)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[None].n_assign == 1 and by[2].n_hex == 1 and by[3].n_hex == 1 and by[1].spans == ""
    assert secrets.scan(df.limit(0), secrets.learn(df.limit(0))).count() == 0
