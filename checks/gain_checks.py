"""Gain, selection and ensembles (E1-E14), joins of scores (J4-J6), top-k by score (O1, O2)."""

from pyspark.sql import functions as F

from checks.settings import ROWS_PER_BUCKET
from checks.views import sql
from checks import fixtures as fx
from mensula.operators import combine as B
from mensula.operators import gain as G
from mensula.operators import trials as A
from mensula.operators.rank_index import build
from mensula.operators.ranks import Ranking, top_rows, with_rank
from mensula.sizing import scratch_path

HIT, COST = 40_000, 20_000
SIZES = (50, 500, 2000, 5000)
MODEL = ("study", "seed")


def rank(*group):
    return Ranking("proba", ("entity",), tuple(group), rows_per_bucket=ROWS_PER_BUCKET)


def one(spark, sf):
    """One score per entity: the mean of all models, summed in whole numbers so that every engine gets the same."""
    whole = F.sum(F.round(F.col("proba") * 10_007).cast("long"))
    return fx.scores(spark, sf).groupBy("entity", "period", "y").agg((whole / F.lit(60_042.0)).alias("proba"))


_INDEXES = {}


def index(spark, sf):
    """Index of `one` by period, built once for all reports of a session."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _INDEXES:
        _INDEXES[at] = build(one(spark, sf), rank("period"), scratch_path(spark, "rank-index"), ["y"])
    return _INDEXES[at]


def rounded(df, digits, *names):
    return df.withColumns({n: F.round(n, digits) for n in names})


def curve(spark, sf):
    return G.gain_curve(one(spark, sf), rank(), "y", HIT, COST).select("entity", "rank", "gain")


def best(spark, sf):
    return G.best_gain(fx.scores(spark, sf), rank(*MODEL), "y", HIT, COST)


def at_labels(spark, sf):
    return G.gain_at_labels(fx.scores(spark, sf).withColumn("pred", (F.col("proba") > 0.6).cast("int")),
                            "y", "pred", ["study"])


def at_cut(spark, sf):
    return G.gain_at_cut(fx.scores(spark, sf), "proba", "y", by=["study", "seed"])


def cut_sweep(spark, sf):
    out = G.threshold_sweep(fx.scores(spark, sf), "proba", "y", by=["study"])
    return rounded(out, 9, "gain_per_contact", "precision", "recall", "f1")


def size_sweep(spark, sf):
    out = G.top_n_sweep(fx.scores(spark, sf), rank(*MODEL), "y", SIZES)
    return rounded(out, 9, "gain_per_contact", "precision")


def size_sweep_whole(spark, sf):
    out = G.top_n_sweep(fx.scores(spark, sf), Ranking("proba", ("entity", "study", "seed"), rows_per_bucket=ROWS_PER_BUCKET),
                        "y", (5000, 7000, 9000, 11000))
    return rounded(out, 9, "gain_per_contact", "precision")


def months(spark, sf):
    return _months(one(spark, sf))


def months_indexed(spark, sf):
    return _months(index(spark, sf))


def sizes_indexed(spark, sf):
    return rounded(G.top_n_sweep(index(spark, sf), rank("period"), "y", (100, 300, 500)), 9, "gain_per_contact", "precision")


def _months(source):
    out = G.month_report(source, rank("period"), "y", sizes=(100, 300, 500), fixed_size=300)
    return out.select(
        "period", "n_rows", "n_positive", F.round("churn_rate", 9).alias("churn_rate"),
        *[F.col(f"best_threshold.{f}").alias(f"cut_{f}") for f in ("threshold", "gain", "n_contacts", "TP", "FP")],
        *[F.col(f"best_size.{f}").alias(f"size_{f}") for f in ("n_contacts", "gain", "TP", "threshold")],
        *[F.col(f"fixed_size.{f}").alias(f"fixed_{f}") for f in ("gain", "TP")],
    )


def chosen(spark, sf):
    return G.select_top(one(spark, sf), rank(), 3000).select("entity", "proba")


def chosen_cut(spark, sf):
    return G.cut_score(G.select_top(one(spark, sf), rank(), 3000), "proba")


def top_few(spark, sf):
    return top_rows(fx.scores(spark, sf), Ranking("proba", ("entity", "study", "seed"), rows_per_bucket=ROWS_PER_BUCKET), 100)


def break_even(spark, sf):
    return G.select_break_even(one(spark, sf), "proba").select("entity")


def expected(spark, sf):
    df = one(spark, sf)
    out = G.expected_gain(B.members(df, G.select_top(df, rank(), 3000).select("entity"), "entity"), "proba")
    return out.select(F.round("expected_gain", 2).alias("expected_gain"), "n_contacts",
                      F.round("expected_positives", 6).alias("expected_positives"),
                      F.round("gain_per_contact", 4).alias("gain_per_contact"),
                      F.round("mean_score", 9).alias("mean_score"))


def strategies(spark, sf):
    out = G.compare_strategies(one(spark, sf), rank(), 3000)
    return out.select("strategy", "n_contacts", "recommended", F.round("expected_gain", 2).alias("expected_gain"))


def seeds_mean(spark, sf):
    return rounded(G.seed_average(fx.scores(spark, sf), ["entity", "study"], keep=["y"]), 9, "proba")


def halves(spark, sf):
    """Scores split by even and odd years."""
    split = F.when(F.col("period") % 2 == 0, "test1").otherwise("test2")
    return fx.scores(spark, sf).withColumn("split", split)


def ensembles(spark, sf):
    df = halves(spark, sf)
    return G.ensemble_report(df, split=["split"], gain=HIT, cost=COST, rows_per_bucket=ROWS_PER_BUCKET)


def test_records(spark, sf):
    """Two tests of one study, recorded one after the other with what they were fitted with."""
    ledger, params = scratch_path(spark, "tests"), {"max_depth": 3, "learning_rate": 0.1}
    for study, years in ((0, [1996, 1997]), (1, [1998])):
        rows = fx.scores(spark, sf).where((F.col("study") == study) & F.col("period").isin(years))
        report = G.seed_report(rows, gain=HIT, cost=COST, rows_per_bucket=ROWS_PER_BUCKET)
        A.record_tests(report, ledger, f"study{study}", params, 40, [1995], years, 0.1)
    return rounded(A.read_tests(spark, ledger), 6, "pct_contacted").withColumn(
        "test_periods", F.array_join("test_periods", "+")).withColumn("train_periods", F.array_join("train_periods", "+")).drop("at")


def seed_test(spark, sf):
    """A report per study: it takes the scores of one ensemble."""
    reports = [
        G.seed_report(fx.scores(spark, sf).where(F.col("study") == study), gain=HIT, cost=COST, rows_per_bucket=ROWS_PER_BUCKET)
        .withColumn("study", F.lit(study)) for study in range(3)
    ]
    return rounded(B.stack(*reports), 6, "pct_contacted")


def results(spark, sf):
    df = halves(spark, sf)
    return G.model_results(df, ["test1", "test2"], gain=HIT, cost=COST, rows_per_bucket=ROWS_PER_BUCKET)


def uneven(spark, sf):
    """Scores where the studies do not cover the same entities."""
    return fx.scores(spark, sf).where("(entity + study) % 7 != 0")


def aligned(spark, sf):
    out = B.align_studies(uneven(spark, sf), keep=["y"])
    return rounded(out, 9, "proba_0", "proba_1", "proba_2", "probabilidad_ensemble")


def loss(spark, sf):
    return rounded(B.alignment_loss(uneven(spark, sf)), 6, "pct_lost")


def semi(spark, sf):
    rich = fx.table(spark, sf, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return B.members(fx.table(spark, sf, "orders"), rich, "o_custkey").select("o_orderkey", "o_custkey")


def agreement(spark, sf):
    df = uneven(spark, sf)
    return B.key_agreement(df.where("study <= 1"), df.where("study >= 1"), ["entity", "seed"])


def ranked(spark, sf):
    return with_rank(fx.scores(spark, sf), rank("study", "seed")).select("entity", "study", "seed", "rank", "n_rows")


GAIN = f"case when y = 1 then {HIT} else -{COST} end"


def running(group, source="s_long", order="proba desc, entity"):
    part = f"partition by {group}" if group else ""
    return (f"run as (select *, row_number() over w as pos, sum({GAIN}) over (w rows unbounded preceding) as cum "
            f"from {source} window w as ({part} order by {order}))")


def peak(group):
    return (f"select {group}, count(*) as n_rows, cast(max(cum) as bigint) as gain, "
            f"min(case when cum = top then pos end) as n_contacts from "
            f"(select *, max(cum) over (partition by {group}) as top from run) group by {group}")


CUTS = "[" + ", ".join(repr(t) for t in G.thresholds()) + "]::double[]"
SWEEP = f"""select {{by}}, threshold, tp + fp as n_contacts, tp as TP, fp as FP, n0 - fp as TN, n1 - tp as FN,
    tp * 780000 - (tp + fp) * 20000 as gain,
    round(case when tp + fp > 0 then (tp * 780000 - (tp + fp) * 20000)::double / (tp + fp) else 0.0 end, 9) as gain_per_contact,
    round(case when tp + fp > 0 then tp::double / (tp + fp) else 0.0 end, 9) as precision,
    round(case when n1 > 0 then tp::double / n1 else 0.0 end, 9) as recall,
    round(case when tp > 0 then 2 * (tp::double / (tp + fp)) * (tp::double / n1) / ((tp::double / (tp + fp)) + (tp::double / n1)) else 0.0 end, 9) as f1
    from (select {{by}}, threshold, count(*) filter (y = 1 and proba >= threshold) as tp,
          count(*) filter (y = 0 and proba >= threshold) as fp, count(*) filter (y = 1) as n1, count(*) filter (y = 0) as n0
          from {{source}}, (select unnest({CUTS}) as threshold) group by all)"""


def top_sql(by, source, sizes, order):
    part = f"partition by {by}" if by else ""
    head = f"{by}, " if by else ""
    group = f"{by}, n" if by else "n"
    return (f"select {head}n as n_contacts, min(case when pos = n then proba end) as threshold, "
            f"cast(sum(y) as bigint) as TP, cast(n - sum(y) as bigint) as FP, "
            f"cast(sum(y) * 780000 - n * 20000 as bigint) as gain, "
            f"round((sum(y) * 780000 - n * 20000)::double / n, 9) as gain_per_contact, "
            f"round(sum(y)::double / n, 9) as precision from "
            f"(select *, row_number() over ({part} order by {order}) as pos from {source}), "
            f"(select cast(unnest([{', '.join(map(str, sizes))}]) as bigint) as n) "
            f"where pos <= n group by {group} having count(*) = n")


ONE = """one as (select entity, period, y, sum(cast(round(proba * 10007) as bigint))::double / 60042.0 as proba
    from s_long group by entity, period, y)"""
TOP3000 = "top as (select * from one order by proba desc, entity limit 3000)"
SPLIT_SQL = "case when period % 2 = 0 then 'test1' else 'test2' end as split"

CHECKS = {
    "E1_gain_curve": (curve, sql("s_long", "select entity, pos as rank, cast(cum as bigint) as gain from run",
                                 ONE, running("", "one"))),
    "E1_best_gain": (best, sql("s_long", peak("study, seed"), running("study, seed"))),
    "E2_gain_at_labels": (at_labels, sql("s_long", """select study, cast(sum(case when proba > 0.6::double then
        case when y = 1 then 780000 else -20000 end else 0 end) as bigint) as gain from s_long group by study""")),
    "E3_gain_at_cut": (at_cut, sql("s_long", """select study, seed, cast(count(*) filter (y = 1) * 780000
        - count(*) filter (y = 0) * 20000 as bigint) as gain from s_long where proba > 0.025::double group by all""")),
    "E4_threshold_sweep": (cut_sweep, sql("s_long", SWEEP.format(by="study", source="s_long"))),
    "E5_top_n_sweep": (size_sweep, sql("s_long", top_sql("study, seed", "s_long", SIZES, "proba desc, entity"))),
    "E5_top_n_sweep_whole": (size_sweep_whole, sql("s_long", top_sql(
        "", "s_long", (5000, 7000, 9000, 11000), "proba desc, entity, study, seed"))),
    "E5_top_n_indexed": (sizes_indexed, sql("s_long", top_sql("period", "one", (100, 300, 500), "proba desc, entity"), ONE)),
    "E6_month_report": (months, sql("s_long", """select b.period, b.n_rows, b.n_positive, b.churn_rate,
        t.threshold as cut_threshold, t.gain as cut_gain, t.n_contacts as cut_n_contacts, t.TP as cut_TP, t.FP as cut_FP,
        z.n_contacts as size_n_contacts, z.gain as size_gain, z.TP as size_TP, z.threshold as size_threshold,
        f.gain as fixed_gain, f.TP as fixed_TP
        from (select period, count(*) as n_rows, cast(sum(y) as bigint) as n_positive, round(avg(y), 9) as churn_rate from one group by 1) b
        left join (select * from cuts qualify row_number() over (partition by period order by gain desc, threshold) = 1) t using (period)
        left join (select * from sizes qualify row_number() over (partition by period order by gain desc, n_contacts) = 1) z using (period)
        left join (select * from sizes where n_contacts = 300) f using (period)""", ONE,
        f"cuts as ({SWEEP.format(by='period', source='one')})",
        f"sizes as ({top_sql('period', 'one', (100, 300, 500), 'proba desc, entity')})")),
    "E7_select_top": (chosen, sql("s_long", "select entity, proba from top", ONE, TOP3000)),
    "E7_cut_score": (chosen_cut, sql("s_long", "select count(*) as n_contacts, min(proba) as threshold from top", ONE, TOP3000)),
    "E8_break_even": (break_even, sql("s_long", "select entity from one where proba > 20000::double / 780000", ONE)),
    "E9_expected_gain": (expected, sql("s_long", """select round(sum(proba * 780000 - 20000), 2) as expected_gain,
        count(*) as n_contacts, round(sum(proba), 6) as expected_positives,
        round(sum(proba * 780000 - 20000) / count(*), 4) as gain_per_contact, round(avg(proba), 9) as mean_score
        from top""", ONE, TOP3000)),
    "E10_compare_strategies": (strategies, sql("s_long", """select strategy, n_contacts,
        cast(row_number() over (order by g desc, strategy) = 1 as integer) as recommended, round(g, 2) as expected_gain
        from (select 'top_n' as strategy, count(*) as n_contacts, sum(proba * 780000 - 20000) as g from top
              union all select 'break_even', count(*), sum(proba * 780000 - 20000) from one where proba > 2.0::double / 78)""",
        ONE, TOP3000)),
    "E11_seed_average": (seeds_mean, sql("s_long", """select entity, study, round(avg(proba), 9) as proba, max(y) as y
        from s_long group by entity, study""")),
    "E12_ensemble_report": (ensembles, sql("s_long", """select split, strategy, gain, n_contacts,
        gain - max(case when strategy = 'simple' then gain end) over (partition by split) as difference from peaks""",
        f"halves as (select *, {SPLIT_SQL} from s_long)",
        "per_study as (select split, entity, study, avg(proba) as proba, max(y) as y from halves group by all)",
        """ens as (select split, entity, 'simple' as strategy, avg(proba) as proba, max(y) as y from halves group by 1, 2
           union all select split, entity, 'two_stage', (sum(case when study = 0 then proba end) + sum(case when study = 1 then proba end)
               + sum(case when study = 2 then proba end)) / 3, max(y) from per_study group by 1, 2
           union all select split, entity, 'study_' || study, proba, y from per_study)""",
        running("split, strategy", "ens"), f"peaks as ({peak('split, strategy')})")),
    "E13_seed_report": (seed_test, sql("s_long", "select study, model, n_rows, gain, n_contacts, "
        "round(n_contacts * 100.0::double / n_rows, 6) as pct_contacted from peaks",
        """models as (select study, cast(seed as varchar) as model, entity, y, proba from s_long
           union all select study, 'mean', entity, max(y), avg(proba) from s_long group by study, entity)""",
        running("study, model", "models"), f"peaks as ({peak('study, model')})")),
    "E13_test_record": (test_records, sql("s_long", """select 'study' || study as study, model, n_rows, gain, n_contacts,
        round(n_contacts * 100.0::double / n_rows, 6) as pct_contacted, cast(40 as integer) as trees,
        '{"learning_rate": 0.1, "max_depth": 3}' as params, '1995' as train_periods,
        case when study = 0 then '1996+1997' else '1998' end as test_periods, 0.1::double as ratio from peaks""",
        """tested as (select * from s_long where study = 0 and period in (1996, 1997) or study = 1 and period = 1998)""",
        """models as (select study, cast(seed as varchar) as model, entity, y, proba from tested
           union all select study, 'mean', entity, max(y), avg(proba) from tested group by study, entity)""",
        running("study, model", "models"), f"peaks as ({peak('study, model')})")),
    "E14_model_results": (results, sql("s_long", """select study, seed, n_rows, n_class_0, n_class_1,
        gain_test1, n_contacts_test1, gain_test2, n_contacts_test2 from
        (select study, seed, count(*) as n_rows, count(*) filter (y = 0) as n_class_0, count(*) filter (y = 1) as n_class_1
         from s_long group by all)
        join (select study, seed, max(gain) filter (split = 'test1') as gain_test1, max(gain) filter (split = 'test2') as gain_test2,
         max(n_contacts) filter (split = 'test1') as n_contacts_test1, max(n_contacts) filter (split = 'test2') as n_contacts_test2
         from peaks group by all) using (study, seed)""",
        f"halves as (select *, {SPLIT_SQL} from s_long)", running("study, seed, split", "halves"),
        f"peaks as ({peak('study, seed, split')})")),
    "J4_align_studies": (aligned, sql("s_long", """select entity, y, round(p0, 9) as proba_0, round(p1, 9) as proba_1,
        round(p2, 9) as proba_2, round((p0 + p1 + p2) / 3, 9) as probabilidad_ensemble
        from (select entity, avg(proba) as p0, max(y) as y from u where study = 0 group by 1)
        join (select entity, avg(proba) as p1 from u where study = 1 group by 1) using (entity)
        join (select entity, avg(proba) as p2 from u where study = 2 group by 1) using (entity)""",
        "u as (select * from s_long where (entity + study) % 7 != 0)")),
    "J4_alignment_loss": (loss, sql("s_long", """select study, n_scored, n_shared,
        round((n_scored - n_shared) * 100.0::double / n_scored, 6) as pct_lost
        from (select study, count(distinct entity) as n_scored from u group by 1),
        (select count(*) as n_shared from (select entity from u group by 1 having count(distinct study) = 3))""",
        "u as (select * from s_long where (entity + study) % 7 != 0)")),
    "J5_members": (semi, """select o_orderkey, o_custkey from orders
        where o_custkey in (select c_custkey from customer where c_acctbal > 5000)"""),
    "J6_key_agreement": (agreement, sql("s_long", """select count(*) filter (a.entity is not null and b.entity is not null) as n_both,
        count(*) filter (b.entity is null) as n_only_left, count(*) filter (a.entity is null) as n_only_right
        from (select distinct entity, seed from s_long where study <= 1 and (entity + study) % 7 != 0) a
        full join (select distinct entity, seed from s_long where study >= 1 and (entity + study) % 7 != 0) b using (entity, seed)""")),
    "O1_rank_by_score": (ranked, sql("s_long", """select entity, study, seed,
        row_number() over (partition by study, seed order by proba desc, entity) as rank,
        count(*) over (partition by study, seed) as n_rows from s_long""")),
    "O2_top_rows": (top_few, sql("s_long", "select * from s_long order by proba desc, entity, study, seed limit 100")),
}
CHECKS["E6_month_report_indexed"] = (months_indexed, CHECKS["E6_month_report"][1])
