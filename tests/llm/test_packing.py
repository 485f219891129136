import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mensula.llm import packing, queries
from mensula.llm.common import table

DEFINITION = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_str(DEFINITION)


def plain_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, want, length):
    """`want`: list of (id, ids); every id in one piece, sequences gapless, no padding."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.doc_tokens, r.start, r.length, r.ids_crc32, bytes(r.ids)))
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length and r.length > 0
    for spans in sequences.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at == length or at & (at - 1) == 0
    assert sorted(sequences) == list(range(len(sequences)))
    return pieces


def test_all_documents(spark, sf, tokenizer):
    docs = table(spark, sf, "documents")
    want = {r.doc_id: plain_ids(tokenizer, r.text) for r in docs.collect()}
    pieces = check(queries.packed(docs).collect(), want, 2_048)
    assert set(pieces) == set(want)
    for doc_id, ids in want.items():
        parts = sorted(pieces[doc_id], key=lambda p: p[1])
        assert np.frombuffer(b"".join(p[4] for p in parts), "<u4").tolist() == ids
        assert [p[1] for p in parts] == list(np.cumsum([0, *(p[2] for p in parts[:-1])])) and {p[0] for p in parts} == {len(ids)}


def test_edges(spark, tokenizer):
    texts = [
        (None, "a b"), (1, None), (2, ""), (3, "same text"), (3, "same text"), (4, "w " * 9_000),
        (5, "ÀÉß straße. <|endoftext|> it's é \x1c x\x1dy  z ΟΔΟΣ İ don't!! 12a"), (6, "A" * 3_000),
    ]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in texts], "doc_id long, text string, place int, start int")
    rows = packing.pack(df, DEFINITION, 1, length=16).collect()
    pieces = check(rows, None, 16)
    for i, text in texts:
        n = sum(t == (i, text) for t in texts)
        assert sum(p[2] for p in pieces[i]) == n * len(plain_ids(tokenizer, text))
        if n == 1:
            got = b"".join(p[4] for p in sorted(pieces[i], key=lambda p: p[1]))
            assert np.frombuffer(got, "<u4").tolist() == plain_ids(tokenizer, text)
    assert packing.pack(df.limit(0), DEFINITION, 1).count() == 0


def test_hilbert_visits_every_cell_and_steps_to_a_neighbour():
    cells = np.array(np.meshgrid(*[np.arange(8)] * 3)).reshape(3, -1).T
    place = packing.hilbert(cells, 3)
    assert sorted(place) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1) == 1).all()


def test_neighbours_on_the_curve_are_alike(spark, sf):
    rows = queries.packed(table(spark, sf, "documents")).where("start = 0").orderBy("place").collect()
    bags = [set(np.frombuffer(r.ids, "<u4").tolist()) for r in rows]
    share = [len(a & b) / len(a | b) for a, b in zip(bags, bags[1:])]
    rng = np.random.default_rng(1)
    other = [len(bags[i] & bags[j]) / len(bags[i] | bags[j]) for i, j in rng.integers(0, len(bags), (500, 2)) if i != j]
    assert np.mean(share) > np.mean(other)


def test_tail_cuts():
    assert packing.tail_cuts(1_300) == [1_024, 256, 16, 4] and packing.tail_cuts(0) == []
