"""Features over an entity's history (W1-W18) and the flagship query."""

from pyspark.sql import functions as F

from checks.settings import ROWS_PER_BUCKET
from checks.views import sql
from checks import fixtures as fx
from mensula.operators import targets as T
from mensula.operators import windows as W
from mensula.panel import numeric_columns, with_columns

P = fx.PANEL
KEY = ["c", "m"]
SPAN = "partition by c order by m rows between {} preceding and {}"


def over(a, b="current row"):
    return "(" + SPAN.format(a, b) + ")"


def _windowed(view, builder, digits=None, keep=()):
    """A query that adds the built columns to a fixture and keeps the key and the new ones."""
    def run(spark, sf):
        df = view(spark, sf)
        out = with_columns(df, builder(df))
        new = [c for c in out.columns if c not in df.columns]
        kept = [F.round(c, digits).alias(c) if digits is not None else F.col(c) for c in new]
        return out.select(*KEY, *keep, *kept)
    return run


MEASURES = ("n_all", *[p + t for t in fx.EVENT_TYPES for p in "cm"])


def lag_sql(names):
    return ", ".join(f"lag({c}, {i}) over (partition by c order by m) as {c}_lag_{i}"
                     for c in names for i in (1, 2))


def delta_sql(names):
    return ", ".join(f"{c} - lag({c}, {i}) over (partition by c order by m) as {c}_delta_{i}"
                     for c in names for i in (1, 2))


def roll_sql(names, kinds, n, last):
    return ", ".join(f"{k}({c}) over {over(n, last)} as {c}_{k}_{n}" for c in names for k in kinds)


def slopes(spark, sf):
    df = fx.user_days(spark, sf)
    out = W.add_slopes(df, P, ["n_all", "mview", "mpurchase"], 4)
    return out.select(*KEY, *[F.round(f"{c}_trend_4", 3).alias(f"{c}_trend_4")
                              for c in ("n_all", "mview", "mpurchase")])


def slope_sql(c):
    s = f"regr_slope({c}, i) over (partition by c order by m rows between 4 preceding and 1 preceding)"
    return f"round(case when isnan({s}) then null else {s} end, 3) as {c}_trend_4"


def time_since(spark, sf):
    df = fx.customer_months(spark, sf)
    raw = W.time_since(P, {"raw_gap": "c_open > 0"})
    real = W.time_since(P, {"month_gap": "c_open > 0"}, unit="months")
    return df.select(*KEY, *raw, *real)


def deciles(spark, sf):
    df = fx.user_days(spark, sf).withColumn("half", F.col("mview") / 2.0)
    out = W.deciles(df, P, ["n_all", "mpurchase", "half"], rows_per_bucket=ROWS_PER_BUCKET)
    return out.select(*KEY, "n_all_decile", "mpurchase_decile", "half_decile")


def behaviour(spark, sf):
    df = fx.user_days(spark, sf).withColumn("signed", (F.col("csignup") > 0).cast("int"))
    level1 = with_columns(df, [W.flag(test).alias(name) for name, test in {
        "f_no_gain": W.not_positive("mpurchase"),
        "f_falling": W.falling(P, "mview"),
        "f_rising": W.rising(P, "mview"),
        "f_no_clicks": W.is_zero("mclick"),
        "f_clicks": W.is_positive("mclick"),
        "f_peak": W.at_peak(P, "mview"),
        "f_on": W.turned_on(P, "signed"),
    }.items()])
    return level1.select(*KEY, *[c for c in level1.columns if c.startswith("f_")])


def active_quarter(spark, sf):
    df = fx.user_days(spark, sf).withColumn("flag_inactivo", (F.col("cview") == 0).cast("int"))
    return df.select(*KEY, *W.active_quarter(P))


def flagship(spark, sf):
    df = fx.user_days(spark, sf)
    columns = numeric_columns(df, exclude=KEY)
    labelled = T.churn_targets(df, P)
    return W.expand(labelled, P, columns, lags_n=2, deltas_n=2, window=3)


FLAGSHIP = sql("p_ud", f"""select p.*, {lag_sql(MEASURES)}, {delta_sql(MEASURES)},
    {roll_sql(MEASURES, ('max', 'min', 'avg'), 3, '1 preceding')}, target_binario, target_ternario
    from p_ud p join labels_grid using (c, m)""",
    "days as (select distinct m from p_ud)", "users as (select distinct c from p_ud)",
    "grid as (select users.c, days.m, p.c is not null as here from users cross join days "
    "left join p_ud p on p.c = users.c and p.m = days.m)",
    "ahead as (select *, lead(here, 1) over (partition by c order by m) as h1, "
    "lead(here, 2) over (partition by c order by m) as h2 from grid)",
    "labels_grid as (select c, m, case when not h1 or not h2 then 1 else 0 end as target_binario, "
    "case when h1 and not h2 then 1 else 0 end as target_ternario from ahead where here)")

U, S, M = fx.user_days, fx.supplier_months, fx.customer_months

CHECKS = {
    "flagship_user_churn": (flagship, FLAGSHIP),
    "W1_lags": (_windowed(U, lambda df: W.lags(P, numeric_columns(df, KEY), 2)),
                sql("p_ud", f"select c, m, {lag_sql(MEASURES)} from p_ud")),
    "W2_deltas": (_windowed(U, lambda df: W.deltas(P, numeric_columns(df, KEY), 2)),
                  sql("p_ud", f"select c, m, {delta_sql(MEASURES)} from p_ud")),
    "W3_rolling_max": (_windowed(S, lambda df: W.rolling(P, ["A_amount", "N_qty"], 3, ["max"], True)),
                       sql("p_sm", "select c, m, " + roll_sql(["A_amount", "N_qty"], ["max"], 3, "current row") + " from p_sm")),
    "W4_rolling_min": (_windowed(S, lambda df: W.rolling(P, ["A_amount", "N_qty"], 3, ["min"], True)),
                       sql("p_sm", "select c, m, " + roll_sql(["A_amount", "N_qty"], ["min"], 3, "current row") + " from p_sm")),
    "W5_rolling_avg": (_windowed(S, lambda df: W.rolling(P, ["A_amount", "N_qty"], 3, ["avg"], True), 4),
                       sql("p_sm", """select c, m, round(avg(A_amount) over w, 4) as A_amount_avg_3,
                       round(avg(N_qty) over w, 4) as N_qty_avg_3 from p_sm window w as """ + over(3))),
    "W5b_rolling_avg_no_integers": (
        _windowed(lambda s, d: fx.user_days(s, d).withColumn("half", F.col("mview") / 2.0),
                  lambda df: W.rolling(P, numeric_columns(df, KEY, integers=False), 2, ["avg"], True), 4),
        sql("p_ud", "select c, m, round(avg(mview / 2.0::double) over w, 4) as half_avg_2 from p_ud window w as " + over(2))),
    "W6_rolling_all": (_windowed(S, lambda df: W.rolling(P, ["A_amount", "R_amount", "N_qty"], 3)),
                       sql("p_sm", "select c, m, " + roll_sql(["A_amount", "R_amount", "N_qty"], ["max", "min", "avg"], 3, "1 preceding") + " from p_sm")),
    "W7_mean_steps": (_windowed(U, lambda df: W.mean_steps(P, ["n_all", "mview"], 3)),
                      sql("p_ud", """select c, m, (n_all - lag(n_all, 2) over w) / 2.0::double as n_all_trend_3,
                      (mview - lag(mview, 2) over w) / 2.0::double as mview_trend_3
                      from p_ud window w as (partition by c order by m)""")),
    "W8_slopes": (slopes, sql("p_ud", "select c, m, " + ", ".join(slope_sql(c) for c in ("n_all", "mview", "mpurchase"))
                              + " from (select *, row_number() over (partition by c order by m) as i from p_ud)")),
    "W9_volatility": (_windowed(U, lambda df: W.volatility(P, ["n_all", "mview"], 3), 6),
                      sql("p_ud", """select c, m, round(stddev(n_all) over w / nullif(abs(avg(n_all) over w), 0), 6) as n_all_volatility_3,
                      round(stddev(mview) over w / nullif(abs(avg(mview) over w), 0), 6) as mview_volatility_3
                      from p_ud window w as """ + over(2))),
    "W10_momentum": (_windowed(U, lambda df: W.momentum(P, ["n_all", "mview"]), 6),
                     sql("p_ud", """select c, m, round(avg(n_all) over now_ / nullif(avg(n_all) over past_, 0), 6) as n_all_momentum,
                     round(avg(mview) over now_ / nullif(avg(mview) over past_, 0), 6) as mview_momentum from p_ud
                     window now_ as """ + over(1) + ", past_ as " + over(5, "2 preceding"))),
    "W11_counted": (_windowed(U, lambda df: W.counted(P, {"streak_buy": "cpurchase > 0", "streak_quiet": "mview < 2000"}, 3)),
                    sql("p_ud", """select c, m, cast(count(case when cpurchase > 0 then 1 end) over w as bigint) as streak_buy,
                    cast(count(case when mview < 2000 then 1 end) over w as bigint) as streak_quiet
                    from p_ud window w as """ + over(2))),
    "W12_time_since": (time_since, sql("p_cm", """select c, m, cast(m - l as integer) as raw_gap,
        cast((m // 100) * 12 + m % 100 - (l // 100) * 12 - l % 100 as bigint) as month_gap
        from (select c, m, max(case when c_open > 0 then m end) over (partition by c order by m) as l from p_cm)""")),
    "W13_sudden_changes": (_windowed(U, lambda df: W.sudden_changes(P, ["n_all", "mview"], 2.0, 6)),
                           sql("p_ud", "select c, m, " + ", ".join(
                               f"""case when ({c} - avg({c}) over w) / nullif(stddev({c}) over w, 0) < -2 then 1 else 0 end as sudden_drop_{c},
                               case when ({c} - avg({c}) over w) / nullif(stddev({c}) over w, 0) > 2 then 1 else 0 end as sudden_increase_{c}"""
                               for c in ("n_all", "mview")) + " from p_ud window w as " + over(6, "1 preceding"))),
    "W14_against_max": (_windowed(U, lambda df: W.against_max(P, ["mview"]) + W.against_max(P, ["n_all"], 3), 6),
                        sql("p_ud", f"""select c, m,
                        round(cast(mview as double) / nullif(max(mview) over {over('unbounded')}, 0), 6) as ratio_mview_vs_max_historico,
                        round(cast(n_all as double) / nullif(max(n_all) over {over(2)}, 0), 6) as ratio_n_all_vs_max_3m from p_ud""")),
    "W15_deciles": (deciles, sql("p_ud", "select c, m, " + ", ".join(
        f"cast(ntile(10) over (partition by m order by {c} asc nulls last, c) as integer) as {n}_decile"
        for c, n in (("n_all", "n_all"), ("mpurchase", "mpurchase"), ("mview / 2.0", "half"))) + " from p_ud")),
    "W16_behaviour_flags": (behaviour, sql("p_ud", """select c, m,
        case when mpurchase <= 0 then 1 else 0 end as f_no_gain,
        case when mview < lag(mview) over w then 1 else 0 end as f_falling,
        case when mview > lag(mview) over w then 1 else 0 end as f_rising,
        case when coalesce(mclick, 0) = 0 then 1 else 0 end as f_no_clicks,
        case when coalesce(mclick, 0) > 0 then 1 else 0 end as f_clicks,
        case when mview = max(mview) over w then 1 else 0 end as f_peak,
        case when csignup > 0 and lag(csignup) over w = 0 then 1 else 0 end as f_on
        from p_ud window w as (partition by c order by m)""")),
    "W17_active_quarter": (active_quarter, sql("p_ud", """select c, m,
        cast(count(case when cview > 0 then 1 end) over w as bigint) as active_quarter
        from p_ud window w as """ + over(2))),
    "W18_row_index": (_windowed(M, lambda df: [W.row_index(P)]),
                      sql("p_cm", "select c, m, cast(row_number() over (partition by c order by m) as integer) as row_idx from p_cm")),
}
