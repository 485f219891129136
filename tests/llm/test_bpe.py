import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from mensula.llm import bpe
from mensula.llm.common import table

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def both():
    ranks = bpe.read_ranks(PATH)
    return bpe.Bpe(ranks, PATTERN), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_encode_as_by_merges(both):
    ours, theirs = both
    rng = random.Random(5)
    alphabets = ["ab", "the quick ", "éèüß ñ", "0123456789.,", " \n\t", "日本語のテキスト", "".join(map(chr, range(32, 500))), "🙂🙃é"]
    for _ in range(3_000):
        text = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 120)))
        ids = ours.encode(text)
        assert ids == theirs.encode_ordinary(text)
        assert ours.decode(ids) == text.encode()


def test_neighbours_agree_with_merges(both):
    ours, rng = both[0], random.Random(6)
    for _ in range(20_000):
        a, b = (rng.choice([rng.randrange(50_256), rng.randrange(1_500)]) for _ in range(2))
        assert ours._may_follow(a, b) == (ours.merge(ours.bytes_of[a] + ours.bytes_of[b]) == [a, b])


def test_long_pieces(both):
    ours, theirs = both
    for text in ("a" * 20_000, "ab" * 5_000, "ththeanderinge" * 3_000, "!" * 3_001 + "x" * 7):
        assert ours.encode(text) == theirs.encode_ordinary(text)


def test_all_documents(spark, sf, both):
    docs = table(spark, sf, "documents")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs, PATH, PATTERN).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = both[1].encode_ordinary(text or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert got[doc_id] == want


def test_edges(spark, both):
    rows = [(None, "a"), (1, None), (1, ""), (2, "x <|endoftext|> y"), (2, "x <|endoftext|> y"), (3, "wörd " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = bpe.digests(df.selectExpr("*", "1 as n_tokens", "2 as ids"), PATH, PATTERN).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == sorted((i or 0, len(both[1].encode_ordinary(t or ""))) for i, t in rows)
    assert bpe.digests(df.limit(0), PATH, PATTERN).count() == 0
    again = df.withColumn("ids", bpe.encode_column(df, PATH, PATTERN))
    back = again.withColumn("back", bpe.decode_column(again, PATH, PATTERN)).collect()
    assert all(bytes(r.back).decode() == (r.text or "") for r in back)
