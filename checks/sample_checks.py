"""Training sets and folds (K1-K10), class counts (C9), unions (U1)."""

from pyspark.sql import functions as F

from checks.settings import ROWS_PER_BUCKET
from checks.views import sql
from checks import fixtures as fx
from mensula.operators import combine as B
from mensula.operators import profile as R
from mensula.operators import samples as K
from mensula.operators import targets as T
from mensula.panel import distinct_values

P = fx.PANEL
KEY = ["c", "m"]
Y = "target_binario"
OLD, NEW = (199701, 199702, 199703, 199705), (199804, 199805)


def labelled(spark, sf):
    return T.churn_targets(fx.customer_months(spark, sf), P)


def chance(seed):
    """A draw that SQL can repeat."""
    return F.pmod(F.col("c") * 7919 + F.col("m").cast("long") * 104729 + seed, F.lit(1000)) / 1000.0


def role(df, name):
    return df.select(*KEY, F.lit(name).alias("role"))


def single(spark, sf):
    train, validation = K.period_split(labelled(spark, sf), P, [199701], [199703])
    return B.stack(role(train, "train"), role(validation, "validation"))


def lists(spark, sf):
    df = labelled(spark, sf)
    train, validation = K.period_split(df, P, OLD, ["199804"])
    final = K.final_fit_rows(df, P, OLD, [199804])
    return B.stack(role(train, "train"), role(validation, "validation"), role(final, "final"))


def by_class(spark, sf):
    return K.class_period_rows(labelled(spark, sf), P, Y, OLD, NEW).select(*KEY, Y)


def thinned(spark, sf):
    sampling = K.Sampling(ratio=0.25, periods=OLD)
    return K.training_rows(labelled(spark, sf), P, sampling, 3, chance(3)).select(*KEY, Y)


def thinned_by_class(spark, sf):
    sampling = K.Sampling(ratio=0.25, positive_periods=OLD, negative_periods=NEW)
    return K.training_rows(labelled(spark, sf), P, sampling, 5, chance(5)).select(*KEY, Y)


def strategies(spark, sf):
    df = labelled(spark, sf)
    options = {"one_list": K.Sampling(0.5, periods=OLD),
               "per_class": K.Sampling(0.5, positive_periods=OLD, negative_periods=NEW)}
    parts = [K.training_rows(df, P, s, 1, chance(1)).groupBy(Y).agg(F.count("*").alias("n")).withColumn("strategy", F.lit(n))
             for n, s in options.items()]
    return B.stack(*parts)


def exact(spark, sf):
    df = labelled(spark, sf)
    sampling = K.Sampling(ratio=1.5, periods=(*OLD, *NEW), y="target_ternario")
    return K.exact_undersample(df, P, sampling, chance(9), rows_per_bucket=ROWS_PER_BUCKET).select(*KEY, "target_ternario")


def folds(spark, sf):
    rows = K.with_fold(labelled(spark, sf), P, 5, 17, number=F.col("c") * 31 + F.col("m"))
    return R.class_counts(rows, Y, ["fold"])


def even_folds(spark, sf):
    """Rows counted off in the order of a number."""
    df = labelled(spark, sf)
    number = F.col("c") * 31 + F.col("m")
    return K.with_fold(df, P, 5, 1, number=number, even=True, rows_per_bucket=ROWS_PER_BUCKET).select("c", "m", "fold")


def hashed_folds(spark, sf):
    """Every row in one fold; by entity, an entity's rows share it."""
    df = labelled(spark, sf)
    by_row = K.with_fold(df, P, 5, 17)
    by_entity = K.with_fold(df, P, 5, 17, by_entity=True)
    spread = by_entity.groupBy("c").agg(F.count_distinct("fold").alias("k"), F.count("*").alias("n"))
    return spread.agg(
        F.max("k").cast("int").alias("most_folds_of_entity"), F.sum("n").cast("long").alias("n_rows"),
    ).withColumn("n_outside", by_row.where("fold < 0 or fold > 4").agg(F.count("*")).scalar())


SPLITS = (("grow", "expanding"), ("roll", "rolling"))


def temporal(spark, sf):
    df = labelled(spark, sf)
    out = []
    for name, strategy in SPLITS:
        rows = K.with_temporal_folds(df, P, 3, strategy=strategy, min_train_size=2, val_size=1, gap=1)
        out.append(rows.groupBy("fold", "role").agg(
            F.count("*").alias("n"), F.min("m").alias("first"), F.max("m").alias("last"),
        ).withColumn("strategy", F.lit(name)))
    return B.stack(*out)


def features(spark, sf):
    df = labelled(spark, sf)
    return df.select(*K.feature_columns(df, P))


def counts(spark, sf):
    out = R.class_counts(fx.label_docs(spark, sf), "toxic", ["quality"])
    return out.withColumns({"ratio": F.round("ratio", 9), "share_class_1": F.round("share_class_1", 9)})


def label_shares(spark, sf):
    out = R.label_counts(T.churn_class(fx.user_days(spark, sf), P), "clase_ternaria")
    return out.withColumn("share", F.round("share", 9))


def class_union(spark, sf):
    df = labelled(spark, sf)
    return B.stack(df.where(f"{Y} = 1"), df.where(f"{Y} = 0 and c_open > 0")).select(*KEY, Y)


def axis(spark, sf):
    return distinct_values(fx.customer_months(spark, sf), "m")


LABELS = ("""lab as (select p.*, case when not h1 or not h2 then 1 else 0 end as target_binario,
        case when h1 and not h2 then 1 else 0 end as target_ternario from p_cm p join
        (select c, m, lead(here, 1) over w as h1, lead(here, 2) over w as h2, here from
          (select who.c, times.m, p.c is not null as here from (select distinct c from p_cm) who
           cross join (select distinct m from p_cm) times left join p_cm p on p.c = who.c and p.m = times.m)
         window w as (partition by c order by m)) g on g.c = p.c and g.m = p.m where here)""")
OLD_SQL, NEW_SQL = str(OLD), str(NEW)


def drawn(seed):
    return f"(c * 7919 + m::bigint * 104729 + {seed}) % 1000 / 1000.0::double"


def lab(select, *more):
    return sql("p_cm", select, LABELS, *more)


def temporal_sql():
    rows = [f"""select '{name}' as strategy, fold, role, m from placed join (select unnest(['train', 'validation']) as role) on
        case role when 'train' then i < stop {"" if name == "grow" else "and i >= stop - 2"} else i = stop + 1 end"""
            for name, _ in SPLITS]
    return lab("""select strategy, fold, role, count(*) as n, min(m) as first, max(m) as last from ("""
               + " union all ".join(rows) + ") group by all",
               "axis as (select m, row_number() over (order by m) - 1 as i, count(*) over () as n from (select distinct m from lab))",
               """placed as (select lab.*, axis.i, fold, 2 + (fold - 1) * greatest(1, (n - 4) // 2) as stop
                from lab join axis using (m), (select cast(unnest([1, 2, 3]) as integer) as fold))""")


CHECKS = {
    "K1_single_period_split": (single, lab("""select c, m, 'train' as role from lab where m = 199701
        union all select c, m, 'validation' from lab where m = 199703""")),
    "K2_period_list_split": (lists, lab(f"""select c, m, 'train' as role from lab where m in {OLD_SQL}
        union all select c, m, 'validation' from lab where m = 199804
        union all select c, m, 'final' from lab where m in {OLD_SQL} or m = 199804""")),
    "K3_class_periods": (by_class, lab(f"""select c, m, {Y} from lab
        where m in {OLD_SQL} and {Y} = 1 or m in {NEW_SQL} and {Y} = 0""")),
    "K4_undersample": (thinned, lab(f"""select c, m, {Y} from lab
        where m in {OLD_SQL} and ({Y} = 1 or {drawn(3)} < 0.25::double)""")),
    "K5_undersample_by_class": (thinned_by_class, lab(f"""select c, m, {Y} from lab
        where m in {OLD_SQL} and {Y} = 1 or m in {NEW_SQL} and {Y} = 0 and {drawn(5)} < 0.25::double""")),
    "K6_strategies": (strategies, lab(f"""select {Y}, count(*) as n, 'one_list' as strategy from lab
        where m in {OLD_SQL} and ({Y} = 1 or {drawn(1)} < 0.5::double) group by 1
        union all select {Y}, count(*), 'per_class' from lab
        where m in {OLD_SQL} and {Y} = 1 or m in {NEW_SQL} and {Y} = 0 and {drawn(1)} < 0.5::double group by 1""")),
    "K7_exact_undersample": (exact, lab(f"""select c, m, target_ternario from chosen where target_ternario = 1
        union all select c, m, target_ternario from (select *, row_number() over (order by {drawn(9)}, c, m) as i
            from chosen where target_ternario = 0)
        where i <= (select cast(floor(count(*) / 1.5::double) as bigint) from chosen where target_ternario = 1)""",
        f"chosen as (select * from lab where m in {OLD_SQL} or m in {NEW_SQL})")),
    "K8_fold_counts": (folds, lab(f"""select cast((c * 31 + m) % 5 as integer) as fold, count(*) as n_rows,
        count(*) filter ({Y} = 0) as n_class_0, count(*) filter ({Y} = 1) as n_class_1,
        count(*) filter ({Y} = 1)::double / nullif(count(*) filter ({Y} = 0), 0) as ratio,
        count(*) filter ({Y} = 1)::double / count(*) as share_class_1 from lab group by 1""")),
    "K8_even_folds": (even_folds, lab("""select c, m, cast((row_number() over (order by c * 31 + m, c, m) - 1) % 5 as integer) as fold from lab""")),
    "K8_hashed_folds": (hashed_folds, lab("""select cast(1 as integer) as most_folds_of_entity, count(*) as n_rows,
        cast(0 as bigint) as n_outside from lab""")),
    "K9_period_folds": (temporal, temporal_sql()),
    "K10_feature_columns": (features, lab("select n_orders, m_total, m_max, c_open, c_final, c_pending from lab")),
    "C9_class_counts": (counts, sql("l_doc", """select quality, count(*) as n_rows, count(*) filter (toxic = 0) as n_class_0,
        count(*) filter (toxic = 1) as n_class_1,
        round(count(*) filter (toxic = 1)::double / nullif(count(*) filter (toxic = 0), 0), 9) as ratio,
        round(count(*) filter (toxic = 1)::double / count(*), 9) as share_class_1 from l_doc group by 1""")),
    "C9_label_shares": (label_shares, sql("p_ud", """select clase_ternaria, count(*) as n_rows,
        round(count(*)::double / sum(count(*)) over (), 9) as share from (
          select case when not h1 then 'baja+1' when not h2 then 'baja+2' else 'continua' end as clase_ternaria from
            (select here, lead(here, 1) over w as h1, lead(here, 2) over w as h2 from
              (select who.c, times.m, p.c is not null as here from (select distinct c from p_ud) who
               cross join (select distinct m from p_ud) times left join p_ud p on p.c = who.c and p.m = times.m)
             window w as (partition by c order by m)) where here) group by 1""")),
    "U1_class_union": (class_union, lab(f"""select c, m, {Y} from lab where {Y} = 1 or c_open > 0""")),
    "U3_distinct_periods": (axis, sql("p_cm", "select distinct m from p_cm")),
}
