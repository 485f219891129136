import re
from collections import Counter

from mensula.llm import quality_rules as Q
from mensula.llm.common import table


def plain(text):
    """Measurements of one text."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x.strip(" \t\n\x0b\x0c\r") and x for x in text.split("\n")]
    lines = [x for x in lines if x]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def bits(m):
    tests = [
        m["n_words"] < 50, 100 * m["n_repeat_words"] > 50 * m["n_words"], m["word_chars"] < 3 * m["n_words"],
        m["word_chars"] > 12 * m["n_words"], 10 * m["n_symbols"] > m["n_words"], 100 * m["n_dup_lines"] > 30 * m["n_lines"],
        100 * m["n_repeat_words"] > 30 * m["n_words"],
    ]
    return sum(1 << i for i, t in enumerate(tests) if t)


def test_all_documents_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    got = {r.doc_id: r for r in Q.ledger(docs).collect()}
    assert len(got) == docs.count()
    for doc_id, text in docs.select("doc_id", "text").collect():
        want = plain(text)
        assert {k: got[doc_id][k] for k in want} == want
        assert got[doc_id].fail_bits == bits(want)


def test_edges(spark):
    rows = [
        (None, "a b c a b c"), (1, None), (1, ""), (2, " \t\n\x0b\f\r\n"), (3, "x y"), (3, "x y"), (4, "é # ñ\né # ñ\n\n \né # ñ"),
        (5, "aa bb " * 60_000), (6, "a a a a"), (7, "p q r s p q r s \x1c|"),
    ]
    df = spark.createDataFrame([(*r, 5, "z") for r in rows], "doc_id long, text string, n_words int, fail_bits string")
    got = Q.ledger(df).collect()
    key = lambda x: repr(x)
    found = sorted(((r.doc_id, {k: r[k] for k in plain("")}, r.fail_bits) for r in got), key=key)
    assert found == sorted(((i, plain(t), bits(plain(t))) for i, t in rows), key=key)
    assert Q.ledger(df.limit(0)).count() == 0 and Q.ablation(Q.ledger(df.limit(0))).count() == 0


def test_policies_and_ablation_read_the_ledger_alone(spark):
    rows = [(i, b) for i, b in enumerate([0, 1, 1, 16, 17, 32, 64, 0])]
    led = spark.createDataFrame(rows, "doc_id long, fail_bits long")
    kept = {r.doc_id: (r.kept_v1, r.kept_v2, r.kept_v3) for r in Q.apply_policies(led).collect()}
    assert kept[0] == (True, True, True) and kept[1] == (False, False, False) and kept[3] == (True, False, False) and kept[5] == (True, True, False)
    found = {r.rule: (r.failed, r.failed_alone, r.documents) for r in Q.ablation(led, Q.POLICIES[1]).collect()}
    assert found["few_words"] == (3, 2, 8) and found["symbols"] == (2, 1, 8) and found["short_words"] == (0, 0, 8)


def test_no_python_on_the_main_path(spark, sf):
    text = Q.ledger(table(spark, sf, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", text)
