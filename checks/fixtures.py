"""Panels and score tables derived from the star-schema and event tables.

Money is counted in whole cents, so sums are exact whatever the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensula.panel import Panel

PANEL = Panel("c", "m")
EVENT_TYPES = ("click", "view", "purchase", "error", "signup")
RETURN_FLAGS = ("A", "N", "R")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str):
    return F.round(F.col(column) * 100).cast("long")


def day(column: str):
    return F.date_format(column, "yyyyMMdd").cast("int")


def month(column: str):
    return (F.year(column) * 100 + F.month(column)).cast("int")


def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by day: event counts, and cents per event type (NULL when there was none)."""
    measures = [F.count("*").alias("n_all")]
    for kind in EVENT_TYPES:
        hit = F.col("event_type") == kind
        measures.append(F.count(F.when(hit, 1)).alias(f"c{kind}"))
        measures.append(F.sum(F.when(hit, cents("value"))).alias(f"m{kind}"))
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("c"), day("ts").alias("m"))
        .agg(*measures)
    )


def customer_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by order month."""
    status = F.col("o_orderstatus")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c"), month("o_orderdate").alias("m"))
        .agg(
            F.count("*").alias("n_orders"),
            F.sum(cents("o_totalprice")).alias("m_total"),
            F.max(cents("o_totalprice")).alias("m_max"),
            F.count(F.when(status == "O", 1)).alias("c_open"),
            F.count(F.when(status == "F", 1)).alias("c_final"),
            F.count(F.when(status == "P", 1)).alias("c_pending"),
        )
    )


def supplier_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers by ship month, measures per return flag."""
    measures = []
    for code in RETURN_FLAGS:
        hit = F.col("l_returnflag") == code
        measures += [
            F.sum(F.when(hit, cents("l_extendedprice"))).alias(f"{code}_amount"),
            F.sum(F.when(hit, F.col("l_quantity").cast("long"))).alias(f"{code}_qty"),
            F.min(F.when(hit, day("l_shipdate"))).alias(f"{code}_first"),
            F.max(F.when(hit, day("l_shipdate"))).alias(f"{code}_last"),
        ]
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("c"), month("l_shipdate").alias("m"))
        .agg(*measures)
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of three studies with two seeds each, with many equal scores."""
    grid = F.array(*[
        F.struct(F.lit(s).alias("study"), F.lit(k).alias("seed")) for s in range(3) for k in range(2)
    ])
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("entity"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        F.year("o_orderdate").alias("period"),
        F.explode(grid).alias("g"),
    )
    mixed = (F.col("entity") * 7919 + F.col("g.study") * 101 + F.col("g.seed") * 13) % 10007
    return rows.select(
        "entity", F.col("g.study").alias("study"), F.col("g.seed").alias("seed"),
        (mixed / F.lit(10007.0)).alias("proba"), "y", "period",
    )


def label_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id"
    )


def drift_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items shipped until 1998 (expected) and later (actual)."""
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            F.when(F.year("l_shipdate") <= 1998, "expected").otherwise("actual").alias("sample"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_discount").alias("discount"),
            F.nullif("l_discount", F.lit(0.0)).alias("discount_known"),
            F.col("l_returnflag").alias("flag"),
        )
    )


def order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))


def order_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a later file; its first month repeats rows of the base."""
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= F.lit("2000-12-01").cast("timestamp_ntz"))


CARD_MEASURES = ("msaldototal", "mlimitecompra", "mconsumototal", "mpagado", "mpagominimo", "madelantopesos")


def bank_columns(recipe) -> list[str]:
    """Input columns a bank recipe names, cards as brand pairs, in sorted order."""
    made = {f"{m}_tc" for m in CARD_MEASURES}
    used: set[str] = set()
    for kind, spec in recipe.steps:
        made |= set(spec)
        if kind != "flags":
            used |= {c for columns in spec.values() for c in columns}
    used |= {c for _, c in recipe.behaviour.values()} | {*recipe.trends, *recipe.accelerations, *recipe.momenta}
    cards = [f"{brand}_{m}" for m in CARD_MEASURES for brand in ("Visa", "Master")]
    dates = [c for a, b, _ in recipe.date_triples for c in (a, b)]
    return sorted({*(used - made), *cards, *dates, *recipe.not_expanded, "ccuenta_corriente", "ccaja_ahorro"})


def bank_months(spark: SparkSession, sf_dir: str, recipe) -> DataFrame:
    """Users by day in the shape of the bank panel: every input column is a mix of the user's
    key, day and event count, NULL now and then."""
    def mixed(i: int):
        return F.pmod(F.col("c") * (i + 11) + F.col("m") * (i % 5 + 3) + F.col("n_all") * (i + 5), F.lit(40 + i)) - i % 7 * 4

    def present(i: int):
        return F.pmod(F.col("c") + F.col("m") + i, F.lit(13)) != 0

    columns = []
    for i, name in enumerate(bank_columns(recipe)):
        quarter = name.startswith(("m", "Visa", "Master"))
        columns.append(F.when(present(i), mixed(i) / 4.0 if quarter else mixed(i)).alias(name))
    codes = F.array(*[F.lit(v) for v in (0, 6, 7, 9, None)])
    for i, name in enumerate(recipe.status_columns):
        columns.append(F.get(codes, F.pmod(F.col("c") + F.floor(F.col("m") / 2) * (i + 1), F.lit(5)).cast("int")).alias(name))
    return user_days(spark, sf_dir).select(
        F.col("c").alias("numero_de_cliente"), F.col("m").alias("foto_mes"), *columns)
