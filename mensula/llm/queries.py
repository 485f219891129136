"""The registered queries of the operators and, where SQL can say it, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, centroids, classifier, line_dedup, mixing, packing, pii, quality_rules, secrets, simhash, spelling, warc
from .common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    base = quality_rules.POLICIES[0]
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "fail_bits",
        (~quality_rules.passes(base)).alias("base_failed"), quality_rules.passes(quality_rules.CURRENT).alias("kept"),
    )


OP1_SQL = r"""
with words as (
    select row_number() over () as r, doc_id, coalesce(text, '') as text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
    from documents),
lines as (
    select r, len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines
    from (select r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from words)),
windows as (
    select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as s
    from (select r, w, unnest(range(1, greatest(len(w) - 1, 1))) as i from words)),
again as (select r, i from (select r, i, count(*) over (partition by r, s) as n from windows) where n > 1),
covered as (select r, count(distinct i + k) as n from again, (select unnest(range(3)) as k) group by r),
measured as (
    select doc_id, cast(len(w) as bigint) as n_words,
        cast(length(list_aggregate(list_concat([''], w), 'string_agg', '')) as bigint) as word_chars,
        cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
        cast(n_dup_lines as bigint) as n_dup_lines, cast(coalesce(n, 0) as bigint) as n_repeat_words,
        cast(n_lines as bigint) as n_lines
    from words join lines using (r) left join covered using (r)),
failed as (
    select *, n_words < 50 as f0, 100 * n_repeat_words > 50 * n_words as f1, word_chars < 3 * n_words as f2,
        word_chars > 12 * n_words as f3, 10 * n_symbols > n_words as f4, 100 * n_dup_lines > 30 * n_lines as f5,
        100 * n_repeat_words > 30 * n_words as f6
    from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    cast(f0::int + 2 * f1::int + 4 * f2::int + 8 * f3::int + 16 * f4::int + 32 * f5::int + 64 * f6::int as bigint) as fail_bits,
    f0 or f1 as base_failed, not (f0 or f1 or f2 or f3 or f4) as kept
from failed"""

def quality_model(docs: DataFrame, labels: DataFrame, config: classifier.Config = classifier.Config()) -> classifier.Model:
    """Model of `labels.quality`, learnt from rows that are not held out."""
    return classifier.fit(classifier.training_rows(docs, labels.where(~classifier.held_out()), config), config)


QUALITY_CUT = 0.3


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", classifier.held_out().alias("held_out"), classifier.scorer(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_CUT).cast("int"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.clean(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("text_md5"))


OP5_SQL = r"""
with docs as (select row_number() over () as r, doc_id, source, text from documents),
parts as (select r, doc_id, source, string_split(text, chr(10)) as l from docs),
lines as (
    select r, doc_id, source, i, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as line, raw
    from (select r, doc_id, source, unnest(range(len(l))) as i, unnest(l) as raw from parts)),
wide as (
    select line, arg_min(r, (doc_id, i)) as r, arg_min(i, (doc_id, i)) as i from lines
    where line <> '' group by line having count(distinct source) * least(length(line), 20) >= 10 * 20),
marked as (
    select l.*, w.line is not null and not (w.r = l.r and w.i = l.i) as gone from lines l left join wide w on l.line = w.line),
cleaned as (
    select r, count(*) as n_lines, count(*) filter (gone) as n_removed,
        coalesce(string_agg(raw, chr(10) order by i) filter (not gone), '') as text
    from marked group by r)
select doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed, md5(c.text) as text_md5
from docs left join cleaned c using (r)"""


def packed(docs: DataFrame) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as definition:
        return packing.pack(docs, definition.read(), end_id=1, length=2_048)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents")).drop("ids")


def op7_secret_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.learn(docs))


def op8_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.archive(pages).drop("payload", "target_uri")


OP9_SQL = """
with rows as (select page_id, coalesce(html, '') as body from pages),
firsts as (select body, min(page_id) as first from rows where strlen(body) >= 100 group by body)
select page_id, cast(strlen(r.body) as bigint) as payload_bytes, sha256(r.body) as payload_digest,
    case when page_id <> first then 'revisit' else 'response' end as record_type,
    case when page_id <> first then first end as refers_to
from rows r left join firsts f on r.body = f.body"""


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.scan(docs, pii.learn(docs))


def op11_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op12_bit_plane_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def _op12_sql(rounds: int = 3) -> str:
    """The rounds one after the other, with plain squares of differences."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
far{i} as (select q.r, c, sum((q.x - m.x) * (q.x - m.x)) as d from q join mid{i} m using (i) group by q.r, c),
near{i} as (select r, cast(min(c) as integer) as c, cast(min(d) as bigint) as d from far{i}
    join (select r, min(d) as least from far{i} group by r) using (r) where d = least group by r)""")
        if i < rounds:
            steps.append(f"""
sum{i} as (select c, i, sum(x) as s, count(*) as n from near{i} join q using (r) group by c, i),
mid{i + 1} as (select m.c, m.i, cast(case when n is null then m.x else (s - ((s % n) + n) % n) // n end as bigint) as x
    from mid{i} m left join sum{i} using (c, i))""")
    return f"""
with kept as (
    select row_number() over () as r, vec_id, embedding as e from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
q as (select r, i, cast(floor(64 * cast(e[i] as double)) as bigint) as x from kept, (select unnest(range(1, 65)) as i)),
first as (select r, row_number() over (order by sha256('1:' || vec_id), vec_id) - 1 as c from kept qualify c < 16),
mid0 as (select c, i, x from first join q using (r)),{",".join(steps)},
told as (select c, sha256(string_agg(cast(x as varchar), ',' order by i)) as h from mid{rounds} group by c)
select vec_id, c as cluster, d as distance, cast(sum(d) over (partition by c) as bigint) as cluster_inertia,
    cast(sum(d) over () as bigint) as inertia, h as centroid_sha256
from near{rounds} join kept using (r) join told using (c)"""


OP12_SQL = _op12_sql()


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_simhash": op3_simhash,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_line_dedup": op5_line_dedup,
    "op6_packing": op6_packing,
    "op7_secret_formats": op7_secret_formats,
    "op8_learned_partitions": op8_learned_partitions,
    "op9_warc": op9_warc,
    "op10_pii": op10_pii,
    "op11_cube_mixing": op11_cube_mixing,
    "op12_bit_plane_centroids": op12_bit_plane_centroids,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLES = {"op1_quality_rules": OP1_SQL, "op5_line_dedup": OP5_SQL, "op9_warc": OP9_SQL, "op12_bit_plane_centroids": OP12_SQL}
