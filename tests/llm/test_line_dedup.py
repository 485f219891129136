from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from mensula import sizing
from mensula.llm import line_dedup
from mensula.llm.line_dedup import Config


def plain(rows, c):
    """Cleaned texts of (id, text, site) rows."""
    sites, first = defaultdict(set), {}
    for i, (k, text, site) in enumerate(rows):
        for at, raw in enumerate((text or "").split("\n")):
            line = raw.strip(" \t\n\x0b\x0c\r")
            if text is not None and line:
                if site is not None:
                    sites[line].add(site)
                here = ((k is None, k or 0), text, at)
                first[line] = min(first.get(line, here), here)
    out = []
    for k, text, site in rows:
        if text is None:
            out.append((k, None))
            continue
        keep = []
        for at, raw in enumerate(text.split("\n")):
            line = raw.strip(" \t\n\x0b\x0c\r")
            if len(sites[line]) * min(len(line), c.short) < c.min_sites * c.short or first[line] == ((k is None, k or 0), text, at):
                keep.append(raw)
        out.append((k, "\n".join(keep)))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))


@pytest.mark.parametrize("config", [Config(3, 5), Config(3, 1, lg_k=4), Config(2, 14), Config(1, 1)])
def test_against_brute_force(spark, config):
    rows = []
    for i in range(60):
        lines = [f"own line {i}", "one of us all", "  one of us all\t", f"shared by ten {i % 6}", f"rare pair {i // 2}", "", "x"]
        rows.append((i, "\n".join(lines[: 1 + i % 7] * (1 + i % 2)), f"s{i % 9}" if i % 11 else None))
    rows += [(None, "one of us all\nnothing else", "s1"), (100, None, "s2"), (101, "", None), (5, rows[5][1], rows[5][2])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, line int, doc int")
    for frame in (df, df.repartition(9)):
        got = line_dedup.clean(frame, config)
        assert set(df.columns) < set(got.columns)
        assert ordered((r.doc_id, r.text) for r in got.collect()) == ordered(plain(rows, config))


def test_short_lines_and_lines_without_spaces_go_too(spark):
    lines = {"All rights reserved.": 10, "All rights reserved": 10, "版权所有。未经许可不得转载本站内容谢谢合作": 10, "版权所有。未经许可不得转载": 16, "版权所有": 50, "OK": 99}
    rows = [(i, "\n".join(f"{line}\nown {i}" for line, sites in lines.items() if i < sites), f"s{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id, r.text) for r in line_dedup.clean(df).collect())
    assert got == sorted(plain(rows, Config()))
    left = {line for _, t in got[1:] for line in t.split("\n")}
    assert left & set(lines) == {"All rights reserved", "OK"}  # 19 characters need eleven sites, two need a hundred


def test_a_hot_line_and_a_shuffled_plan(spark, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    rows = [(i, f"the line of every page\nown line number {i}\nshared by a few {i % 90}", f"s{i % 12}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = sorted((r.doc_id, r.text) for r in line_dedup.clean(df, Config(4, 4)).collect())
    assert got == sorted(plain(rows, Config(4, 4)))


def test_columns_with_names_of_the_plan_stay_as_they_are(spark):
    names = ["_gone", "_doc", "_k", "_own", "n_lines", "N_REMOVED", "row", "own", "doc", "k", "places", "line"]
    rows = [(i, "one line on every page here\nown " + str(i), f"s{i}", *[f"{n}{i}" for n in names]) for i in range(12)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    got = line_dedup.clean(df).orderBy("doc_id")
    assert got.columns == [*df.columns, "n_lines_", "n_removed_"]
    assert [tuple(r)[3:-2] for r in got.collect()] == [r[3:] for r in rows]
    assert [r["n_removed_"] for r in got.collect()] == [0] + [1] * 11


def test_empty_and_long(spark):
    schema = "doc_id long, text string, source string"
    assert line_dedup.clean(spark.createDataFrame([], schema)).count() == 0
    long = "word " * 300_000
    df = spark.createDataFrame([(i, f"{long}\na line of quite a few words", f"s{i}") for i in range(12)], schema)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text == f"{long}\na line of quite a few words") for r in line_dedup.clean(df).collect()}
    assert got[0] == (2, 0, True) and all(got[i] == (2, 2, False) for i in range(1, 12))


def test_band_holds_the_threshold(spark):
    config = Config()
    need = F.col("id").cast("int")
    for r in spark.createDataFrame([(2,), (10,), (1_000,)], "id int").select("id", *[b.alias(n) for b, n in zip(config.band(need), "lh")]).collect():
        assert r["l"] < r["id"] < r["h"]
    lengths = spark.createDataFrame([("x" * n,) for n in (1, 7, 19, 20, 500)], "s string")
    assert [r[0] for r in lengths.select(config.need(F.col("s"))).collect()] == [200, 29, 11, 10, 10]
