"""Score distributions and their shifts (E15-E19)."""

from pyspark.sql import functions as F

from checks.gain_checks import ONE, index, one, rank
from checks.settings import ROWS_PER_BUCKET
from checks.views import sql
from mensula.operators import scores as S

SIZES = (100, 500, 2000)


def _round(df, digits=9):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def stats(spark, sf):
    return _round(S.distribution(one(spark, sf), "proba", rows_per_bucket=ROWS_PER_BUCKET))


def by_class(spark, sf):
    return _round(S.class_distribution(one(spark, sf), "proba", "y", rows_per_bucket=ROWS_PER_BUCKET))


def tops(spark, sf):
    return _round(S.top_scores(one(spark, sf), rank("period"), "y", SIZES))


def stats_indexed(spark, sf):
    return _round(S.distribution(index(spark, sf), "proba"))


def tops_indexed(spark, sf):
    return _round(S.top_scores(index(spark, sf), rank("period"), "y", SIZES))


def full(spark, sf):
    df = one(spark, sf)
    return S.distribution(df, "proba").join(S.class_distribution(df, "proba", "y"), "period")


def shifts(spark, sf):
    return _round(S.distribution_shifts(full(spark, sf)))


PERIODS = tuple(range(1995, 2002))
METRICS = ("n_rows", "mean", "median", "q99", "churn_rate")


def comparison(spark, sf):
    return _round(S.comparison_table(full(spark, sf), METRICS, PERIODS))


QUANTILES = ", ".join(f"quantile_cont(proba, {q}) as {n}" for n, q in S.PERCENTILES.items())
BASE = (f"base as (select period, count(*) as n_rows, avg(proba) as mean, stddev_pop(proba) as std, min(proba) as min, "
        f"max(proba) as max, {QUANTILES} from one group by period)")
SIDE = ", ".join(
    f"count(*) filter (y = {v}) as n_{n}, avg(proba) filter (y = {v}) as mean_{n}, stddev_pop(proba) filter (y = {v}) as std_{n}, "
    f"quantile_cont(proba, 0.25) filter (y = {v}) as q25_{n}, quantile_cont(proba, 0.5) filter (y = {v}) as median_{n}, "
    f"quantile_cont(proba, 0.75) filter (y = {v}) as q75_{n}" for n, v in (("churners", 1), ("no_churners", 0)))
CLASSES = (f"classes as (select *, n_churners::double / (n_churners + n_no_churners) as churn_rate, "
           f"mean_churners / mean_no_churners as mean_ratio, median_churners / median_no_churners as median_ratio "
           f"from (select period, {SIDE} from one group by period))")


def rounded_sql(names):
    return ", ".join(f"round({n}, 9) as {n}" for n in names)


FLOATS = ["mean", "std", "min", "max", *S.PERCENTILES]
CLASS_FLOATS = [f"{a}_{n}" for n in ("churners", "no_churners") for a in ("mean", "std", "q25", "median", "q75")]
DELTA = "{0} - lag({0}) over w"

CHECKS = {
    "E15_distribution": (stats, sql("s_long", f"select period, n_rows, {rounded_sql(FLOATS)} from base", ONE, BASE)),
    "E16_class_distribution": (by_class, sql(
        "s_long", f"select period, n_churners, n_no_churners, {rounded_sql(CLASS_FLOATS + ['churn_rate', 'mean_ratio', 'median_ratio'])} from classes",
        ONE, CLASSES)),
    "E17_top_scores": (tops, sql("s_long", """select period, cast(n as integer)::bigint as size,
        round(min(case when pos = n then proba end), 9) as threshold,
        round(sum(y)::double / any_value(n1), 9) as recall, round(sum(y)::double / n, 9) as precision
        from (select *, row_number() over (partition by period order by proba desc, entity) as pos,
              sum(y) over (partition by period) as n1 from one), (select unnest([100, 500, 2000]) as n)
        where pos <= n group by period, n having count(*) = n""", ONE)),
    "E18_distribution_shifts": (shifts, sql("s_long", f"""select * from (select period, lag(period) over w as previous,
        {', '.join(f"round({DELTA.format(c)}, 9) as delta_{c}" for c in ('mean', 'median', 'std', 'mean_churners', 'churn_rate'))},
        round((mean - lag(mean) over w) / lag(mean) over w * 100, 9) as pct_change_mean
        from base join classes using (period) window w as (order by period)) where previous is not null""", ONE, BASE, CLASSES)),
    "E19_comparison_table": (comparison, sql("s_long", "\nunion all ".join(
        f"""select '{m}' as metric, {', '.join(f'round(max(case when period = {p} then {m} end)::double, 9) as "{p}"' for p in PERIODS)} from joined"""
        for m in METRICS), ONE, BASE, CLASSES, "joined as (select * from base join classes using (period))")),
}
CHECKS["E15_distribution_indexed"] = (stats_indexed, CHECKS["E15_distribution"][1])
CHECKS["E17_top_scores_indexed"] = (tops_indexed, CHECKS["E17_top_scores"][1])
