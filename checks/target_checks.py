"""Churn labels (T1-T4), joins of the panel (J1-J3) and duplicates; the SQL uses the grid form."""

from pyspark.sql import functions as F

from checks.views import sql
from checks import fixtures as fx
from mensula.operators import targets as T
from mensula.operators import windows as W
from mensula.panel import attach, densify

P = fx.PANEL
KEY = ["c", "m"]


def grid(view):
    return (
        f"times as (select distinct m from {view})", f"who as (select distinct c from {view})",
        f"grid as (select who.c, times.m, p.c is not null as here from who cross join times "
        f"left join {view} p on p.c = who.c and p.m = times.m)",
        "ahead as (select *, lead(here, 1) over (partition by c order by m) as h1, "
        "lead(here, 2) over (partition by c order by m) as h2 from grid)",
    )


CLASS = "case when not h1 then 'baja+1' when not h2 then 'baja+2' else 'continua' end as clase_ternaria"
BINARY = "case when not h1 or not h2 then 1 else 0 end as target_binario"
TERNARY = "case when h1 and not h2 then 1 else 0 end as target_ternario"


def labelled(op, view):
    def run(spark, sf):
        df = view(spark, sf)
        out = op(df, P)
        return out.select(*KEY, *[c for c in out.columns if c not in df.columns])
    return run


def complete(spark, sf):
    out = T.churn_targets(fx.customer_months(spark, sf), P, labels_complete=True)
    return out.groupBy("labels_complete", "target_binario", "target_ternario").agg(F.count("*").alias("n"))


def dense(spark, sf):
    return densify(fx.user_days(spark, sf).select(*KEY, "n_all"), P)


def attached(spark, sf):
    df = fx.user_days(spark, sf)
    extra = df.select(*KEY, *W.lags(P, ["n_all"], 1))
    return attach(df.select(*KEY, "n_all"), extra, KEY)


CHECKS = {
    "T1_churn_class": (labelled(T.churn_class, fx.customer_months),
                       sql("p_cm", f"select c, m, {CLASS} from ahead where here", *grid("p_cm"))),
    "T2_binary_target": (labelled(T.binary_target, fx.user_days),
                         sql("p_ud", f"select c, m, {BINARY} from ahead where here", *grid("p_ud"))),
    "T3_ternary_target": (labelled(T.ternary_target, fx.user_days),
                          sql("p_ud", f"select c, m, {TERNARY} from ahead where here", *grid("p_ud"))),
    "T4_churn_targets": (labelled(T.churn_targets, fx.supplier_months),
                         sql("p_sm", f"select c, m, {BINARY}, {TERNARY} from ahead where here", *grid("p_sm"))),
    "T4_labels_complete": (complete, sql("p_cm", f"""select labels_complete, target_binario, target_ternario, count(*) as n
        from (select {BINARY}, {TERNARY}, cast(m <= (select min(m) from (select m from times order by m desc limit 3)) as integer) as labels_complete
              from ahead where here) group by all""", *grid("p_cm"))),
    "J1_J2_densify": (dense, sql("p_ud", """select g.c, g.m, p.n_all, cast(here as integer) as is_present
        from grid g left join p_ud p on p.c = g.c and p.m = g.m""", *grid("p_ud"))),
    "J3_attach": (attached, sql("p_ud", """select c, m, n_all,
        lag(n_all) over (partition by c order by m) as n_all_lag_1 from p_ud""")),
}
