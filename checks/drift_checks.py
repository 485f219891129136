"""Data quality and drift (D1-D7)."""

from functools import partial

from pyspark.sql import functions as F

from checks.settings import ROWS_PER_BUCKET
from checks.views import sql
from checks import fixtures as fx
from mensula.operators import drift as D

COLUMNS = ("price", "quantity", "discount", "discount_known")


def nulls(spark, sf):
    out = D.null_shares(fx.drift_pair(spark, sf), "sample", "expected", "actual")
    return out.select("feature", *[F.round(c, 9).alias(c) for c in out.columns[1:]])


def zeros(spark, sf):
    out = D.zero_shares(fx.drift_pair(spark, sf), "sample", "expected", "actual")
    return out.select("feature", *[F.round(c, 9).alias(c) for c in out.columns[1:]])


def edges(spark, sf, labelled=False):
    long = D.long_form(fx.drift_pair(spark, sf), COLUMNS, ["sample"]).where("sample = 'expected'")
    out = D.quantile_edges(long, 10, labelled, ROWS_PER_BUCKET)
    return out.select("feature", F.posexplode("edges").alias("i", "edge")).select(
        "feature", "i", F.round("edge", 9).alias("edge"))


def counts(spark, sf, labelled=False):
    out = D.bin_counts(fx.drift_pair(spark, sf), "sample", "expected", "actual", COLUMNS, 10, labelled, ROWS_PER_BUCKET)
    return out.select("feature", "bin", "n_expected", "n_actual")


FINE = (20, 60, 200)


def fine(spark, sf):
    pair = fx.drift_pair(spark, sf)
    parts = [
        D.bin_counts(pair, "sample", "expected", "actual", ["price", "quantity"], b, labelled=False, rows_per_bucket=ROWS_PER_BUCKET)
        .select(F.lit(b).alias("buckets"), "feature", "bin", "n_expected", "n_actual") for b in FINE
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def stability(spark, sf, labelled=False):
    out = D.psi(fx.drift_pair(spark, sf), "sample", "expected", "actual", ["price"], labelled=labelled, rows_per_bucket=ROWS_PER_BUCKET)
    return out.select("feature", F.round("psi", 9).alias("psi"))


def ranking(spark, sf, labelled=False):
    out = D.psi(fx.drift_pair(spark, sf), "sample", "expected", "actual", COLUMNS, labelled=labelled, rows_per_bucket=ROWS_PER_BUCKET)
    return out.select("feature", F.round("psi", 9).alias("psi"))


def deep(spark, sf, labelled=False):
    parts = [
        D.bin_counts(fx.drift_pair(spark, sf), "sample", "expected", "actual", [c], b, labelled, ROWS_PER_BUCKET)
        .withColumn("buckets", F.lit(b))
        for c, b in (("price", 3), ("quantity", 20))
    ]
    return parts[0].unionByName(parts[1]).select(
        "feature", "buckets", "bin", F.round("left_edge", 6).alias("left_edge"),
        F.round("right_edge", 6).alias("right_edge"), "n_expected", "n_actual")


EVERY = ("price", "quantity", "discount", "discount_known", "flag")


def share_sql(test):
    rows = "\nunion all ".join(
        f"select '{c}' as feature, sample, avg(cast({test(c)} as integer)) * 100 as pct from d_pair group by sample"
        for c in EVERY)
    return f"""select feature, round(max(pct) filter (sample = 'expected'), 9) as expected_pct,
        round(max(pct) filter (sample = 'actual'), 9) as actual_pct,
        round(abs(max(pct) filter (sample = 'actual') - max(pct) filter (sample = 'expected')), 9) as difference
        from ({rows}) group by feature"""


# Edges as interval labels show them: the fewest decimals from 3 on that keep them apart, the first edge one unit lower.
LABELLED = ("""digits as (select feature, d, i, count(*) over (partition by feature, d) as n, case when e = 0 then e else
            round_even(e * pow(10.0, p), 0) / pow(10.0, p) end as r
        from (select *, case when trunc(e) = 0 then -floor(log10(abs(e - trunc(e)))) - 1 + d else d end as p
            from exact, (select unnest(range(3, 20)) as d))),
    chosen as (select feature, min(d) as d from (select feature, d from digits group by feature, d having count(distinct r) = any_value(n)) group by feature),
    edge as (select feature, i, case when i = 0 then r - pow(10.0, -d) else r end as e from digits join chosen using (feature, d))""",)


def long_parts(columns, buckets, labelled=False):
    rows = "\nunion all ".join(f"select sample, '{c}' as feature, {c} as value from d_pair" for c in columns)
    shares = "[" + ", ".join(f"{i}::double / {buckets}" for i in range(buckets + 1)) + "]"
    first = "exact" if labelled else "edge"
    return (
        f"lng as ({rows})",
        f"""{first} as (select feature, cast(row_number() over (partition by feature order by e) - 1 as integer) as i, e from (
            select distinct feature, unnest(quantile_cont(value, {shares})) as e from lng
            where sample = 'expected' and value is not null group by feature))""",
        *(LABELLED if labelled else ()),
        """bins as (select a.feature, a.i as bin, a.e as lo, b.e as hi, b.i = max(b.i) over (partition by a.feature) as closed
            from edge a join edge b on a.feature = b.feature and b.i = a.i + 1)""",
        """cnt as (select b.feature, bin, lo, hi, count(*) filter (sample = 'expected') as ne, count(*) filter (sample = 'actual') as na
            from bins b left join lng l on l.feature = b.feature and value >= lo and (value < hi or closed and value = hi)
            group by all)""",
    )


PSI = """select feature, round(known + nul, 9) as psi from (
    select c.feature, sum(case when ne = 0 and na = 0 then 'nan'::double when ne = 0 or na = 0 then 'inf'::double
        else (na::double / a - ne::double / e) * ln((na::double / a) / (ne::double / e)) end) as known,
        any_value(case when en > 0 and an > 0 then (an::double / (an + a) - en::double / (en + e))
            * ln((an::double / (an + a)) / (en::double / (en + e))) else 0 end) as nul
    from cnt c join (select feature, count(value) filter (sample = 'expected') as e, count(value) filter (sample = 'actual') as a,
        count(*) filter (sample = 'expected' and value is null) as en, count(*) filter (sample = 'actual' and value is null) as an
        from lng group by feature) s on s.feature = c.feature group by c.feature)"""


def fine_sql():
    from checks.views import VIEWS
    parts = [
        "select * from (" + sql("", f"select {b} as buckets, feature, bin, ne as n_expected, na as n_actual from cnt", *long_parts(["price", "quantity"], b)) + ")"
        for b in FINE
    ]
    return f"with d_pair as ({VIEWS['d_pair']}) " + " union all ".join(parts)


def deep_sql(labelled=False):
    halves = []
    for c, b in (("price", 3), ("quantity", 20)):
        halves.append("select * from (" + sql("", f"""select feature, {b} as buckets, bin, round(lo, 6) as left_edge,
            round(hi, 6) as right_edge, ne as n_expected, na as n_actual from cnt""", *long_parts([c], b, labelled)) + ")")
    from checks.views import VIEWS
    return f"with d_pair as ({VIEWS['d_pair']}) " + " union all ".join(halves)


CHECKS = {
    "D1_null_shares": (nulls, sql("d_pair", share_sql(lambda c: f"{c} is null"))),
    "D2_zero_shares": (zeros, sql("d_pair", share_sql(lambda c: "false" if c == "flag" else f"coalesce({c} = 0, false)"))),
    "D4_histogram_fine": (fine, fine_sql()),
}
for _end, _labelled in (("", False), ("_labelled", True)):
    _sql = lambda select, columns: sql("d_pair", select, *long_parts(columns, 10, _labelled))
    CHECKS |= {
        f"D3_quantile_edges{_end}": (partial(edges, labelled=_labelled), _sql("select feature, i, round(e, 9) as edge from edge", COLUMNS)),
        f"D4_histogram{_end}": (partial(counts, labelled=_labelled), _sql("select feature, bin, ne as n_expected, na as n_actual from cnt", COLUMNS)),
        f"D5_psi{_end}": (partial(stability, labelled=_labelled), _sql(PSI, ["price"])),
        f"D6_psi_ranking{_end}": (partial(ranking, labelled=_labelled), _sql(PSI, COLUMNS)),
        f"D7_deep_dive{_end}": (partial(deep, labelled=_labelled), deep_sql(_labelled)),
    }
