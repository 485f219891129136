"""Sources and sinks (S1-S13), profiles (C1-C8), month append (U2), trials (O3-O5, A2-A5)."""

import itertools
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures as fx
from checks.gain_checks import ONE, one
from checks.views import sql
from mensula.functions.columns import latest_and_earliest
from mensula.operators import combine as B
from mensula.operators import gain as G
from mensula.operators import history as H
from mensula.operators import profile as R
from mensula.operators import targets, windows
from mensula.operators import trials as A
from mensula.operators.ranks import Ranking
from mensula.panel import attach, columns_like, numeric_columns
from mensula.sizing import scratch_path, settle
from mensula.sources import readers, writers
from mensula.sources.months import append_month, read_months

KEY = ["c", "m"]


def csv_scan(spark, sf):
    """Written as CSV, read back with inferred types."""
    path = scratch_path(spark, "orders.csv")
    df = fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    writers.save_csv(df, path)
    back = readers.read_csv(spark, path)
    return back.withColumn("o_orderdate", F.substring("o_orderdate", 1, 10))


def gzip_scan(spark, sf):
    path = scratch_path(spark, "orders") + ".csv.gz"
    fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice").write.csv(
        path, header=True, compression="gzip")
    schema = "o_orderkey long, o_custkey long, o_totalprice double"
    return readers.read_table(spark, path, schema=schema, partitions=8)


def either_format(spark, sf):
    df = fx.customer_months(spark, sf).select(*KEY, "n_orders", "c_open")
    parquet = writers.save_parquet(df, scratch_path(spark, "panel"))
    text = scratch_path(spark, "panel") + ".csv"
    writers.save_csv(df, text)
    schema = "c long, m int, n_orders long, c_open long"
    both = [readers.read_table(spark, parquet), readers.read_table(spark, text, schema=schema)]
    return B.stack(*[d.withColumn("source", F.lit(n)) for d, n in zip(both, ("parquet", "csv"))])


def sizes(spark, sf):
    names = ("orders", "lineitem", "events", "customer")
    rows = [(n, *readers.table_size(fx.table(spark, sf, n))) for n in names]
    return spark.createDataFrame(rows, "name string, n_rows long, n_columns int")


def csv_sink(spark, sf):
    path = scratch_path(spark, "panel.csv")
    writers.save_csv(fx.customer_months(spark, sf), path)
    return spark.read.csv(path, header=True, schema="c long, m int, n_orders long, m_total long, m_max long, "
                          "c_open long, c_final long, c_pending long")


def parquet_sink(spark, sf):
    path = writers.save_parquet(fx.customer_months(spark, sf), scratch_path(spark, "panel.csv"), partition_by="m")
    return spark.read.parquet(path)


def saved_scores(spark, sf):
    base = scratch_path(spark, "scores")
    df = fx.scores(spark, sf).withColumn("split", F.when(F.col("period") < 1998, "train").otherwise("test"))
    writers.save_scores(df, base)
    return base


def score_sink(spark, sf):
    back = readers.read_scores(spark, saved_scores(spark, sf))
    return back.groupBy("study", "seed", "split").agg(
        F.count("*").alias("n"), F.round(F.sum("proba"), 6).alias("total"))


def contacts(spark, sf):
    path = scratch_path(spark, "contacts.csv")
    df = one(spark, sf)
    writers.save_contacts(G.select_top(df, Ranking("proba", ("entity",)), 3000), "entity", path)
    return spark.read.csv(path, header=True, schema="entity long")


def summaries(spark, sf):
    ranking = Ranking("proba", ("entity",), ("study", "seed"))
    report = G.best_gain(fx.scores(spark, sf), ranking, "y", 40_000, 20_000)
    csv, json = scratch_path(spark, "summary"), scratch_path(spark, "summary")
    writers.save_summary(report, csv)
    writers.save_summary(report, json, kind="json")
    schema = report.schema
    parts = [spark.read.csv(csv, header=True, schema=schema), spark.read.json(json, schema=schema)]
    return B.stack(*[p.withColumn("source", F.lit(n)) for p, n in zip(parts, ("csv", "json"))])


def trials(spark, sf):
    """Trials made of customers: value is their order total, NULL for some; two parameters."""
    return (
        fx.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("trial_number"))
        .agg(F.sum(fx.cents("o_totalprice")).alias("total"), F.count("*").alias("n"))
        .select("trial_number",
                F.when(F.col("trial_number") % 11 != 0, F.col("total")).alias("value"),
                F.struct((F.col("n") * 2).alias("num_leaves"), (F.col("n") / 100).alias("learning_rate")).alias("params"))
    )


def ledger(spark, sf):
    path = scratch_path(spark, "ledger")
    df = trials(spark, sf)
    writers.append_records(df.where("trial_number % 2 = 0"), path)
    writers.append_records(df.where("trial_number % 2 = 1"), path)
    return spark.read.json(path, schema=df.schema).select("trial_number", "value", "params.num_leaves")


def score_reload(spark, sf):
    base = scratch_path(spark, "files")
    df = fx.scores(spark, sf)
    for study, seed in itertools.product(range(3), range(2)):
        df.where((F.col("study") == study) & (F.col("seed") == seed)).select("entity", "proba", "y").write.parquet(
            f"{base}/model{study}_seed{seed}_test1.parquet")
    back = readers.read_score_files(spark, f"{base}/*_test1.parquet")
    return back.groupBy("study", "seed", "split").agg(F.count("*").alias("n"), F.round(F.sum("proba"), 6).alias("total"))


def one_period(spark, sf):
    base = scratch_path(spark, "by_period")
    fx.scores(spark, sf).hint("rebalance", "period").write.partitionBy("period").parquet(base)
    return readers.read_period(spark, base, "1997").select("entity", "study", "seed", "proba")


def selected_columns(spark, sf):
    df = fx.user_days(spark, sf).withColumn("label", F.lit("x"))
    names = [*columns_like(df, prefix="m", suffixes=("click", "view")), *columns_like(df, contains="CSIGN")]
    assert set(names) <= set(numeric_columns(df, exclude=KEY))
    return df.select(*KEY, *names)


def classes(spark, sf):
    df = fx.user_days(spark, sf).withColumns({
        "kind": F.when(F.col("n_all") > 2, "busy").otherwise("calm"), "half": F.col("n_all") / 2.0})
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "variable", "n_filled")
    return R.classify_types(df).join(filled, "variable").select("variable", "tipo_de_dato", "n_filled")


def schema_report(spark, sf):
    path = scratch_path(spark, "schema")
    df = fx.table(spark, sf, "orders")
    writers.save_summary(R.schema_table(df), path)
    back = spark.read.csv(path, header=True, schema="variable string, tipo_dato string")
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "variable", "n_filled")
    return back.join(filled, "variable").select("variable", "tipo_dato", "n_filled")


def few_values(spark, sf):
    return R.cardinality(fx.customer_months(spark, sf), 10)


def few_values_sorted(spark, sf):
    return R.cardinality(fx.table(spark, sf, "lineitem"), 51).orderBy("variable")


def as_integers(spark, sf):
    df = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_tax")
    halves = df.withColumn("half", F.col("l_linenumber") / 2.0)
    return R.to_integers(halves, ["l_extendedprice", "half"]).select("l_orderkey", "l_linenumber", "l_extendedprice", "half")


def dropped(spark, sf):
    df = fx.supplier_months(spark, sf)
    return df.drop(*columns_like(df, suffixes=("_first", "_last", "_qty")))


def projected(spark, sf):
    df = fx.supplier_months(spark, sf)
    helped = df.select("*", *latest_and_earliest([("A_last", "N_last", "ship")]))
    return helped.drop("A_first", "A_last", "N_first", "N_last", "R_first", "R_last")


def appended(spark, sf):
    return B.append_period(fx.order_base(spark, sf), fx.order_news(spark, sf))


def appended_by_period(spark, sf):
    month = fx.month("o_orderdate").alias("m")
    base, news = (d.select("*", month) for d in (fx.order_base(spark, sf), fx.order_news(spark, sf)))
    return B.append_period(base, news, "m", base_is_distinct=True)


def top_parts(spark, sf):
    df = fx.table(spark, sf, "part").groupBy(F.col("p_brand").alias("feature")).agg(
        F.sum(fx.cents("p_retailprice")).alias("importance"))
    return A.top_features(df, 10)


def best_trials(spark, sf):
    return A.top_trials(trials(spark, sf), 5).select("trial_number", "value", "params.num_leaves")


def best_trial(spark, sf):
    return A.best_trial(trials(spark, sf)).select("trial_number", "value", "params.num_leaves", "params.learning_rate")


def trial_statistics(spark, sf):
    return A.trial_statistics(trials(spark, sf)).withColumn("mean_gain", F.round("mean_gain", 3))


def study_means(spark, sf):
    df = fx.scores(spark, sf).groupBy("study", "seed").agg(
        F.sum("y").alias("gain_test1"), F.count("*").alias("gain_test2"))
    return A.mean_by_study(df, ["gain_test1", "gain_test2"])


def folds(spark, sf):
    df = fx.scores(spark, sf).groupBy("study", F.pmod("entity", F.lit(5)).alias("fold")).agg(
        F.sum("y").alias("gain"), F.max("period").alias("best_iteration"))
    out = A.fold_summary(df, ["study"])
    return out.withColumns({"gain_mean": F.round("gain_mean", 6), "gain_std": F.round("gain_std", 6)})


def distinct_counts(spark, sf):
    return R.distinct_counts(fx.table(spark, sf, "lineitem"), LI)


def count_rows(table, names):
    return " union all ".join(f"select '{c}' as variable, count({c}) as n_filled from {table}" for c in names)


def few_sql(table, names, bound):
    parts = " union all ".join(f"select '{c}' as variable, count(distinct {c}) as n_distinct from {table}" for c in names)
    return f"select * from ({parts}) where n_distinct < {bound}"


UD = ("c", "m", "n_all", *[p + t for t in fx.EVENT_TYPES for p in "cm"])
CM = ("c", "m", "n_orders", "m_total", "m_max", "c_open", "c_final", "c_pending")
LI = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
      "l_returnflag", "l_linestatus", "l_shipdate")
TRIALS = """trials as (select trial_number, case when trial_number % 11 <> 0 then total end as value,
    n * 2 as num_leaves, n / 100.0::double as learning_rate from
    (select o_custkey as trial_number, cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as total,
     count(*) as n from orders group by 1))"""
SPLIT = "case when period < 1998 then 'train' else 'test' end as split"
PEAK = """select study, seed, count(*) as n_rows, cast(max(cum) as bigint) as gain,
    min(case when cum = top then pos end) as n_contacts from (select *, max(cum) over (partition by study, seed) as top from
    (select study, seed, row_number() over w as pos, sum(case when y = 1 then 40000 else -20000 end) over (w rows unbounded preceding) as cum
     from s_long window w as (partition by study, seed order by proba desc, entity))) group by 1, 2"""

HISTORY = H.History(
    columns=("n_all", "mview"), trends=("mview",), momenta=("n_all",), peaks=("n_all",), counted={"busy": "cview > 1"}, events={"sold": "cpurchase > 0"})


def _last_day(spark, sf):
    days = settle(fx.user_days(spark, sf).select("c", "m", "n_all", "mview", "cview", "cpurchase"))
    return days, days.agg(F.max("m")).first()[0]


def month_from_state(spark, sf):
    """The last day's features from the state after all days before it."""
    days, last = _last_day(spark, sf)
    state = settle(H.state_of(days.where(F.col("m") < last), fx.PANEL, HISTORY))
    features = H.advance(state, days.where(F.col("m") == last), fx.PANEL, HISTORY)[0]
    return features.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in features.dtypes])


def labels_from_state(spark, sf):
    """Labels that the last day bears on."""
    days, last = _last_day(spark, sf)
    state = settle(H.state_of(days.where(F.col("m") < last), fx.PANEL, HISTORY))
    return H.advance(state, days.where(F.col("m") == last), fx.PANEL, HISTORY)[1]


def panel_by_entity(spark, sf):
    """History features, labels and an attached table, all from tables stored by entity."""
    name, days = f"days_{uuid.uuid4().hex}", fx.user_days(spark, sf)
    stored = writers.save_by_entity(days, fx.PANEL, name, 4, scratch_path(spark, "by-entity"))
    other = writers.save_by_entity(days.select("c", "m", F.col("cview").alias("seen")), fx.PANEL, f"{name}_more", 4, scratch_path(spark, "by-entity"))
    wide = windows.expand(targets.churn_targets(stored, fx.PANEL), fx.PANEL, ["n_all"], 1, 1, 3)
    return attach(wide, other, ["c", "m"]).select(
        "c", "m", "n_all", "seen", "target_binario", "target_ternario", "n_all_lag_1", "n_all_delta_1", "n_all_max_3")


def month_appended_twice(spark, sf):
    """Orders by month; a file with one month that is there and later ones comes twice."""
    orders = fx.table(spark, sf, "orders").withColumn("m", (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int"))
    path, log = scratch_path(spark, "months"), scratch_path(spark, "months-log")
    new = orders.where("o_orderdate >= '2000-12-01'")
    append_month(orders.where("o_orderdate < '2001-01-01'"), path, "m", log)
    for _ in range(2):
        append_month(new, path, "m", log)
    return read_months(spark, path, new)


CHECKS = {
    "S1_csv_scan": (csv_scan, """select cast(o_orderkey as integer) as o_orderkey, o_totalprice, o_orderstatus,
        strftime(o_orderdate, '%Y-%m-%d') as o_orderdate from orders"""),
    "S2_gzip_csv": (gzip_scan, "select o_orderkey, o_custkey, o_totalprice from orders"),
    "S3_S4_either_format": (either_format, sql("p_cm", """select c, m, n_orders, c_open, unnest(['parquet', 'csv']) as source from p_cm""")),
    "S5_table_size": (sizes, " union all ".join(
        f"select '{n}' as name, count(*) as n_rows, cast({k} as integer) as n_columns from {n}"
        for n, k in (("orders", 6), ("lineitem", 11), ("events", 6), ("customer", 5)))),
    "S6_csv_sink": (csv_sink, sql("p_cm", "select * from p_cm")),
    "S7_parquet_sink": (parquet_sink, sql("p_cm", "select * from p_cm")),
    "S8_score_sink": (score_sink, sql("s_long", f"""select study, seed, {SPLIT}, count(*) as n, round(sum(proba), 6) as total
        from s_long group by all""")),
    "S9_contact_list": (contacts, sql("s_long", "select entity from one order by proba desc, entity limit 3000", ONE)),
    "S10_summaries": (summaries, sql("s_long", f"select *, unnest(['csv', 'json']) as source from ({PEAK})")),
    "S11_ledger": (ledger, sql("", "select trial_number, value, num_leaves from trials", TRIALS)),
    "S12_score_reload": (score_reload, sql("s_long", """select 'model' || study as study, seed, 'test1' as split,
        count(*) as n, round(sum(proba), 6) as total from s_long group by all""")),
    "S13_one_period": (one_period, sql("s_long", "select entity, study, seed, proba from s_long where period = 1997")),
    "C1_selected_columns": (selected_columns, sql("p_ud", "select c, m, mclick, mview, csignup from p_ud")),
    "C2_type_classes": (classes, sql("p_ud", f"""select variable, case when variable = 'kind' then 'int_categorico'
        when variable = 'm' then 'int_numerico' when variable = 'half' then 'float' else 'otro' end as tipo_de_dato, n_filled
        from ({count_rows('p_ud', UD)} union all select 'kind', count(*) from p_ud union all select 'half', count(*) from p_ud)""")),
    "C3_schema_report": (schema_report, f"""select variable, case variable when 'o_orderkey' then 'bigint' when 'o_custkey' then 'bigint'
        when 'o_totalprice' then 'double' when 'o_orderdate' then 'timestamp_ntz' else 'string' end as tipo_dato, n_filled
        from ({count_rows('orders', ('o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority'))})"""),
    "C4_low_cardinality": (few_values, sql("p_cm", few_sql("p_cm", CM, 10))),
    "C5_low_cardinality_sorted": (few_values_sorted, few_sql("lineitem", LI, 51)),
    "C6_to_integers": (as_integers, """select l_orderkey, l_linenumber, cast(round_even(l_extendedprice, 0) as integer) as l_extendedprice,
        cast(round_even(l_linenumber / 2.0::double, 0) as integer) as half from lineitem"""),
    "C7_drop_columns": (dropped, sql("p_sm", "select c, m, A_amount, N_amount, R_amount from p_sm")),
    "C8_exclude_columns": (projected, sql("p_sm", """select c, m, A_amount, A_qty, N_amount, N_qty, R_amount, R_qty,
        greatest(A_last, N_last) as ship_latest, least(A_last, N_last) as ship_earliest from p_sm""")),
    "U2_append_month": (appended, """select * from orders where o_orderdate < '2001-01-01'
        union select * from orders where o_orderdate >= '2000-12-01'"""),
    "U2_append_month_by_period": (appended_by_period, """select *, cast(year(o_orderdate) * 100 + month(o_orderdate) as integer) as m from
        (select * from orders where o_orderdate < '2001-01-01' union select * from orders where o_orderdate >= '2000-12-01')"""),
    "S7_panel_by_entity": (panel_by_entity, sql("p_ud", """select c, m, n_all, cview as seen,
        cast(case when i + 1 <= last and not h1 or i + 2 <= last and not h2 then 1 else 0 end as integer) as target_binario,
        cast(case when h1 and i + 2 <= last and not h2 then 1 else 0 end as integer) as target_ternario,
        lag(n_all, 1) over w as n_all_lag_1, n_all - lag(n_all, 1) over w as n_all_delta_1,
        max(n_all) over (partition by c order by m rows between 3 preceding and 1 preceding) as n_all_max_3
        from (select p.*, d.i, d.last, coalesce(lead(i, 1) over v = i + 1, false) as h1,
                coalesce(lead(i, 1) over v = i + 2, false) or coalesce(lead(i, 2) over v = i + 2, false) as h2
            from p_ud p join (select m, row_number() over (order by m) as i, count(*) over () as last from (select distinct m from p_ud)) d using (m)
            window v as (partition by c order by m))
        window w as (partition by c order by m)""")),
    "U2_append_month_twice": (month_appended_twice, """select *, cast(year(o_orderdate) * 100 + month(o_orderdate) as integer) as m from
        (select * from orders where o_orderdate < '2001-01-01' union select * from orders where o_orderdate >= '2000-12-01')"""),
    "U2_month_from_state": (month_from_state, sql("p_ud", """select * from (select c, m, n_all, mview, cview, cpurchase,
        lag(n_all, 1) over w as n_all_lag_1, lag(n_all, 2) over w as n_all_lag_2, lag(mview, 1) over w as mview_lag_1, lag(mview, 2) over w as mview_lag_2,
        n_all - lag(n_all, 1) over w as n_all_delta_1, n_all - lag(n_all, 2) over w as n_all_delta_2,
        mview - lag(mview, 1) over w as mview_delta_1, mview - lag(mview, 2) over w as mview_delta_2,
        max(n_all) over p3 as n_all_max_3, min(n_all) over p3 as n_all_min_3, round(avg(n_all) over p3, 6) as n_all_avg_3,
        max(mview) over p3 as mview_max_3, min(mview) over p3 as mview_min_3, round(avg(mview) over p3, 6) as mview_avg_3,
        round(case when isnan(regr_slope(mview, ri) over p4) then null else regr_slope(mview, ri) over p4 end, 6) as mview_trend_4,
        round(avg(n_all) over c2 / nullif(avg(n_all) over past, 0), 6) as n_all_momentum,
        round(n_all::double / max(n_all) over w, 6) as ratio_n_all_vs_max_historico,
        cast(count(case when cview > 1 then 1 end) over c3 as bigint) as busy,
        m - max(case when cpurchase > 0 then m end) over w as sold, cast(ri as integer) as row_idx
        from (select *, row_number() over (partition by c order by m) as ri from p_ud)
        window w as (partition by c order by m), p3 as (partition by c order by m rows between 3 preceding and 1 preceding),
        p4 as (partition by c order by m rows between 4 preceding and 1 preceding), c2 as (partition by c order by m rows between 1 preceding and current row),
        c3 as (partition by c order by m rows between 2 preceding and current row), past as (partition by c order by m rows between 5 preceding and 2 preceding))
        where m = (select max(m) from p_ud)""")),
    "T4_labels_from_state": (labels_from_state, sql("p_ud", """select c, m, cast(case when i = 0 then 0 when i = 1 then not h1 else not (h1 and h2) end as integer) as target_binario,
        cast(i = 2 and h1 and not h2 as integer) as target_ternario, cast(i = 2 as integer) as settled
        from (select p.c, p.m, d.i, n1.c is not null as h1, n2.c is not null as h2 from p_ud p
            join (select m, row_number() over (order by m desc) - 1 as i from (select distinct m from p_ud)) d using (m)
            left join (select distinct c, i from p_ud join (select m, row_number() over (order by m desc) - 1 as i from (select distinct m from p_ud)) using (m)) n1
                on n1.c = p.c and n1.i = d.i - 1
            left join (select distinct c, i from p_ud join (select m, row_number() over (order by m desc) - 1 as i from (select distinct m from p_ud)) using (m)) n2
                on n2.c = p.c and n2.i = d.i - 2)
        where i <= 2""")),
    "O3_top_features": (top_parts, """select p_brand as feature, cast(sum(cast(round(p_retailprice * 100) as bigint)) as bigint) as importance
        from part group by 1 order by importance desc, feature limit 10"""),
    "O4_top_trials": (best_trials, sql("", """select trial_number, value, num_leaves from trials where value is not null
        order by value desc, trial_number limit 5""", TRIALS)),
    "O5_A4_best_trial": (best_trial, sql("", "select * from trials where value is not null order by value desc, trial_number limit 1", TRIALS)),
    "A1_distinct_counts": (distinct_counts, few_sql("lineitem", LI, 10**12)),
    "A2_mean_by_study": (study_means, sql("s_long", """select study, count(*) as n_models, avg(g1) as gain_test1_mean, avg(g2) as gain_test2_mean
        from (select study, seed, sum(y) as g1, count(*) as g2 from s_long group by all) group by 1""")),
    "A3_fold_summary": (folds, sql("s_long", """select study, round(avg(g), 6) as gain_mean, round(stddev_pop(g), 6) as gain_std,
        cast(floor(avg(b)) as integer) as best_iteration from
        (select study, entity % 5 as fold, sum(y) as g, max(period) as b from s_long group by all) group by 1""")),
    "A5_trial_statistics": (trial_statistics, sql("", """select count(*) as total_trials, max(value) as best_gain, min(value) as worst_gain,
        round(avg(value), 3) as mean_gain from trials where value is not null""", TRIALS)),
}
