import public_tokenizers
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from mensula.llm import classifier, pii, queries, simhash, spans
from mensula.llm.common import table
from mensula.llm.line_dedup import Config

from .test_line_dedup import plain as plain_lines
from .test_packing import check, plain_ids
from .test_simhash import plain_groups


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=lambda r: r[0])


def test_stages_against_plain_versions(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "line dedup", "SimHash near-dedup", "PII", "packing"]
    held = {r[0]: r for r in rows_of(docs)}

    def step(name, df):
        out = stages[name](spark, df, sf)
        assert out.columns == docs.columns
        out.write.parquet(path := f"{tmp_path}/{name}")
        return spark.read.parquet(path)

    kept = step("quality classifier", docs)
    model = queries.quality_model(docs, table(spark, sf, "labels"))
    for doc_id, text, *_ in held.values():
        index, value = classifier.features(text, model.bits)
        held[doc_id] += (1 / (1 + np.exp(-(model.weights[index] @ value + model.bias))) >= queries.QUALITY_CUT,)
    want = [r[:5] for r in sorted(held.values()) if r[5]]
    assert rows_of(kept) == want

    lined = step("line dedup", kept)
    cleaned = dict(plain_lines([(r[0], r[1], r[3]) for r in want], Config()))
    want = [(i, cleaned[i], lang, source, len(cleaned[i])) for i, _, lang, source, _ in want]
    assert rows_of(lined) == want

    single = step("SimHash near-dedup", lined)
    want = [r for r, (i, _, low) in zip(want, plain_groups([r[:2] for r in want])) if i == low]
    assert rows_of(single) == want

    redacted = step("PII", single)
    detector = pii.learn(single)
    hidden = [spans.redact(r[1], pii.all_spans(r[1], detector)[1]) for r in want]
    want = [(i, t, lang, source, len(t)) for (i, _, lang, source, _), t in zip(want, hidden)]
    assert rows_of(redacted) == want
    assert all(not pii.base_spans(t) for t in hidden)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = check(stages["packing"](spark, redacted, sf).collect(), None, 2_048)
    assert set(pieces) == {r[0] for r in want}
    for i, text, *_ in want:
        ids = b"".join(p[4] for p in sorted(pieces[i], key=lambda p: p[1]))
        assert np.frombuffer(ids, "<u4").tolist() == plain_ids(tokenizer, text)


def test_edges(spark, sf, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "some words here " * 50_000, "en", None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf)
        docs.count()


def test_run_keeps_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    good = table(spark, sf, "documents").join(table(spark, sf, "labels").where("quality = 1"), "doc_id")
    kept = corpus_pipeline.quality_classifier(spark, table(spark, sf, "documents"), sf)
    assert good.join(kept, "doc_id").count() >= 0.97 * good.count()
    packed = corpus_pipeline.run(spark, sf)
    assert packed.agg(F.sum("length")).first()[0] > 0 and packed.select("doc_id").distinct().count() <= kept.count()


def test_texts_reach_python_in_small_batches(spark):
    size = "spark.sql.execution.arrow.maxBytesPerBatch"

    def largest(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], names=["n"]) for b in batches)

    df = spark.range(0, 1_500, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 4_000).alias("text"))
    model = classifier.Model(4, np.zeros(16, np.float32), 0.0)
    detector = pii.learn(df.limit(0))
    for use in (
        lambda: classifier.scorer(df, model), lambda: simhash.fingerprints(df, 4), lambda: pii.scan(df, detector),
        lambda: pii.redacted(df, detector), lambda: pii.learn(df.limit(0)), lambda: queries.packed(df.limit(0)),
    ):
        spark.conf.unset(size)
        use()
        found = df.select("text").mapInArrow(largest, "n long").agg(F.max("n"), F.sum("n")).first()
        assert found[0] < 5 << 20 and found[1] >= 30_000_000
    spark.conf.set(size, "8m")
    classifier.scorer(df, model)
    assert spark.conf.get(size) == "8m"
    spark.conf.unset(size)
