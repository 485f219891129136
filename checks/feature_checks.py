"""Row-wise features (R1-R14)."""

from pyspark.sql import functions as F

from checks.views import sql
from checks import fixtures as fx
from mensula.functions import columns as C
from mensula.operators import windows as W
from mensula.panel import columns_like, with_columns

KEY = ["c", "m"]


def one_hot(spark, sf):
    df = fx.customer_months(spark, sf).withColumn(
        "visa_status", F.element_at(F.array(*[F.lit(v) for v in (0, 6, 7, 9, None)]),
                                    (F.pmod(F.col("m_total"), F.lit(5)) + 1).cast("int")))
    return df.select(*KEY, "visa_status", *C.one_hot("visa_status", C.CARD_STATUS))


ONE_HOT = sql("p_cm", """select c, m, s as visa_status,
    cast(coalesce(s = 0, false) as integer) as visa_status_abierta,
    cast(coalesce(s = 6, false) as integer) as visa_status_pcierre,
    cast(coalesce(s = 7, false) as integer) as visa_status_pacierre,
    cast(coalesce(s = 9, false) as integer) as visa_status_cerrada
    from (select c, m, case m_total % 5 when 0 then 0 when 1 then 6 when 2 then 7 when 3 then 9 end as s
          from p_cm)""")


def latest_earliest(spark, sf):
    df = fx.supplier_months(spark, sf)
    pairs = [("A_last", "R_last", "ar_last"), ("A_first", "N_first", "an_first")]
    return df.select(*KEY, *C.latest_and_earliest(pairs))


def paired_sums(spark, sf):
    df = fx.supplier_months(spark, sf).select(
        *KEY, F.col("A_amount").alias("Visa_amount"), F.col("A_qty").alias("visa_qty"),
        F.col("R_qty").alias("master_qty"), F.col("R_amount").alias("Master_amount"))
    visa, master = (columns_like(df, contains=b, without="status") for b in ("visa", "master"))
    return df.select(*KEY, *C.paired_sums(visa, master))


def amount_count_ratios(spark, sf):
    df = fx.user_days(spark, sf)
    return df.select(*KEY, *[F.round(c, 6).alias(f"r{i}") for i, c in enumerate(C.amount_count_ratios(df, exclude=KEY))])


def totals(spark, sf):
    df = fx.user_days(spark, sf).withColumns({
        "half": F.col("mview") / 200.0, "text": F.col("cclick").cast("string")})
    return df.select(*KEY, *C.totals({
        "traffic": ["half", "cview", "text"], "money": ["mclick", "mview", "mpurchase"]}))


def differences(spark, sf):
    df = fx.user_days(spark, sf)
    return df.select(*KEY, *C.differences({"net": ("mpurchase", "merror"), "gap": ("cclick", "cview")}))


def flags(spark, sf):
    df = fx.user_days(spark, sf)
    return df.select(*KEY, *C.flags({
        "buys": "cpurchase > 0", "quiet": "mpurchase = 0 OR msignup > 5000", "rich": F.col("mview") > 9000}))


def ratios(spark, sf):
    df = fx.user_days(spark, sf)
    picked = C.ratios({"per_view": ("mpurchase", "cview"), "share": ("cclick", "n_all")})
    return df.select(*KEY, *[F.round(p, 6).alias(n) for p, n in zip(picked, ("per_view", "share"))])


def accelerations(spark, sf):
    df = with_columns(fx.user_days(spark, sf), W.deltas(fx.PANEL, ["n_all", "mview"], 2))
    return df.select(*KEY, *C.accelerations(df, ["n_all", "mview"]))


def class_to_target(spark, sf):
    label = F.element_at(F.array(*[F.lit(v) for v in ("CONTINUA", "baja+1", "BAJA+2", "otra")]),
                         (F.pmod(F.col("o_orderkey"), F.lit(4)) + 1).cast("int"))
    df = fx.table(spark, sf, "orders").select(label.alias("clase_ternaria"))
    return (df.groupBy(C.churn_target("clase_ternaria").alias("target"))
            .agg(F.count("*").alias("n")))


def class_to_binary(spark, sf):
    label = F.element_at(F.array(*[F.lit(v) for v in ("CONTINUA", "BAJA+1", "BAJA+2", None)]),
                         (F.pmod(F.col("o_orderkey"), F.lit(4)) + 1).cast("int"))
    df = fx.table(spark, sf, "orders").select("o_orderkey", label.alias("clase_ternaria"))
    return df.select("o_orderkey", C.is_second_month_churn(df).alias("clase_real"))


def probability_cut(spark, sf):
    return fx.scores(spark, sf).select("entity", "study", "seed", C.predicted_positive("proba").alias("hit"))


def mean_of_columns(spark, sf):
    df = fx.user_days(spark, sf)
    return df.select(*KEY, F.round(C.row_mean(["mclick", "mview", "msignup"]), 6).alias("mean"))


def period_filter(spark, sf):
    df = fx.customer_months(spark, sf)
    return df.where(C.in_periods(df, "m", ["199701", 199805]) & (F.col("c_open") > 0)).select(*KEY, "c_open")


CHECKS = {
    "R1_status_one_hot": (one_hot, ONE_HOT),
    "R2_latest_earliest": (latest_earliest, sql("p_sm", """select c, m,
        greatest(A_last, R_last) as ar_last_latest, least(A_last, R_last) as ar_last_earliest,
        greatest(A_first, N_first) as an_first_latest, least(A_first, N_first) as an_first_earliest from p_sm""")),
    "R3_paired_sums": (paired_sums, sql("p_sm", """select c, m,
        coalesce(A_amount, 0) + coalesce(R_amount, 0) as amount_tc,
        coalesce(A_qty, 0) + coalesce(R_qty, 0) as qty_tc from p_sm""")),
    "R4_amount_per_count": (amount_count_ratios, sql("p_ud", "select c, m, " + ", ".join(
        f"round(m{t} / (c{t} + 0.01::double), 6) as r{i}"
        for i, t in enumerate(("click", "view", "purchase", "error", "signup"))) + " from p_ud")),
    "R5_totals": (totals, sql("p_ud", """select c, m,
        coalesce(cast(mview / 200.0::double as bigint), 0) + cview + cclick as traffic,
        coalesce(mclick, 0) + coalesce(mview, 0) + coalesce(mpurchase, 0) as money from p_ud""")),
    "R6_differences": (differences, sql("p_ud", """select c, m,
        coalesce(mpurchase, 0) - coalesce(merror, 0) as net, cclick - cview as gap from p_ud""")),
    "R7_flags": (flags, sql("p_ud", """select c, m,
        case when cpurchase > 0 then 1 else 0 end as buys,
        case when mpurchase = 0 or msignup > 5000 then 1 else 0 end as quiet,
        case when mview > 9000 then 1 else 0 end as rich from p_ud""")),
    "R8_ratios": (ratios, sql("p_ud", """select c, m,
        round(cast(mpurchase as double) / nullif(cview, 0), 6) as per_view,
        round(cast(cclick as double) / nullif(n_all, 0), 6) as share from p_ud""")),
    "R9_accelerations": (accelerations, sql("p_ud", """select c, m,
        (n_all - lag(n_all, 1) over w) - (n_all - lag(n_all, 2) over w) as n_all_accel,
        (mview - lag(mview, 1) over w) - (mview - lag(mview, 2) over w) as mview_accel
        from p_ud window w as (partition by c order by m)""")),
    "R10_class_to_target": (class_to_target, """select case o_orderkey % 4 when 0 then 0 when 1 then 1
        when 2 then 1 end as target, count(*) as n from orders group by 1"""),
    "R11_class_to_binary": (class_to_binary, """select o_orderkey,
        case when o_orderkey % 4 = 2 then 1 else 0 end as clase_real from orders"""),
    "R12_probability_cut": (probability_cut, sql("s_long", """select entity, study, seed,
        cast(proba > 0.025::double as integer) as hit from s_long""")),
    "R13_row_mean": (mean_of_columns, sql("p_ud", """select c, m, round(avg(v), 6) as mean from (
        select c, m, unnest([mclick, mview, msignup]) as v from p_ud) group by c, m""")),
    "R14_period_filter": (period_filter, sql("p_cm", """select c, m, c_open from p_cm
        where m in (199701, 199805) and c_open > 0""")),
}
