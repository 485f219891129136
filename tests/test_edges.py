"""Hand-computed rows for gaps, NULLs, zero divisors, rounding, ties and year ends."""

import pytest
from pyspark.sql import functions as F

from mensula import Panel
from mensula.functions import columns as C
from mensula.operators import profile, targets, windows
from mensula.panel import columns_like, duplicate_keys, numeric_columns, require_columns, unkeyed, with_columns

P = Panel("e", "t")


def rows_of(df, *names):
    return [tuple(r) for r in df.orderBy("e", "t").select(*names).collect()]


@pytest.fixture
def gaps(spark):
    keys = [(1, 1), (1, 2), (1, 4), (2, 1), (2, 2), (3, 1), (3, 2), (3, 3), (3, 4)]
    return spark.createDataFrame(keys, "e int, t int")


def test_targets_on_gaps(gaps):
    out = targets.churn_targets(gaps, P)
    assert [r[2:] for r in rows_of(out, "e", "t", "target_binario", "target_ternario")] == [
        (1, 1), (1, 0), (0, 0), (1, 1), (1, 0), (0, 0), (0, 0), (0, 0), (0, 0)]


def test_class_follows_targets(gaps):
    both = targets.churn_class(targets.churn_targets(gaps, P), P)
    for label, binary, ternary in rows_of(both, "clase_ternaria", "target_binario", "target_ternario"):
        assert binary == (label != "continua")
        assert ternary == (label == "baja+2")


def test_skipped_calendar_month_is_not_absence(spark):
    df = spark.createDataFrame([(1, 202101), (1, 202105)], "e int, t int")
    assert rows_of(targets.binary_target(df, P), "target_binario") == [(0,), (0,)]


def test_last_periods_are_marked_incomplete(gaps):
    out = targets.churn_targets(gaps, P, labels_complete=True).where("e = 3")
    assert rows_of(out, "t", "labels_complete") == [(1, 1), (2, 1), (3, 0), (4, 0)]


def test_repeated_key_raises(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "e int, t int")
    assert duplicate_keys(df, P).count() == 1
    with pytest.raises(Exception, match="not unique"):
        targets.binary_target(df, P).collect()


def test_single_row_windows_are_null(spark):
    df = spark.createDataFrame([(1, 1, 5.0)], "e int, t int, v double")
    out = with_columns(df, windows.lags(P, ["v"]), windows.momentum(P, ["v"]), windows.volatility(P, ["v"]))
    assert rows_of(out, "v_lag_1", "v_momentum", "v_volatility_3") == [(None, None, None)]
    assert rows_of(windows.add_slopes(df, P, ["v"]), "v_trend_3") == [(None,)]


def test_frames_count_rows_before_the_current_one(spark):
    df = spark.createDataFrame([(1, t, v) for t, v in enumerate([4.0, None, 1.0, 3.0])], "e int, t int, v double")
    out = with_columns(df, windows.rolling(P, ["v"], 2))
    assert rows_of(out, "v_max_2", "v_min_2", "v_avg_2") == [
        (None, None, None), (4.0, 4.0, 4.0), (4.0, 4.0, 4.0), (1.0, 1.0, 1.0)]
    now = with_columns(df, windows.rolling(P, ["v"], 1, ["avg"], include_current=True))
    assert rows_of(now, "v_avg_1") == [(4.0,), (4.0,), (1.0,), (2.0,)]


@pytest.mark.parametrize("window", [1, 3, 14])
def test_expand_equals_its_parts(spark, window):
    values = [7, None, 2, 2, None, None, 9, 4]
    df = spark.createDataFrame([(e, t, v, v and v / 4.0) for e in (1, 2) for t, v in enumerate(values[e - 1:])],
                               "e int, t int, a int, b double")
    one = windows.expand(df, P, ["a", "b"], 2, 1, window)
    parts = with_columns(df, windows.lags(P, ["a", "b"], 2), windows.deltas(P, ["a", "b"], 1),
                         windows.rolling(P, ["a", "b"], window))
    assert set(one.columns) == set(parts.columns)
    assert rows_of(one, *sorted(one.columns)) == rows_of(parts, *sorted(one.columns))


def test_zero_divisors_give_null(spark):
    df = spark.createDataFrame([(1, 1, 3.0, 0.0), (1, 2, 3.0, None), (1, 3, None, 2.0), (1, 4, 0.0, -0.01)],
                               "e int, t int, mx double, cx double")
    out = with_columns(df, C.ratios({"r": ("mx", "cx")}), [C.amount_per_count("mx", "cx").alias("q")])
    assert rows_of(out, "r") == [(None,), (None,), (None,), (-0.0,)]
    assert rows_of(out, "q")[3] == (None,)


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(i, 0, v) for i, v in enumerate([2.5, 3.5, -2.5, -2.7])], "e int, t int, v double")
    assert rows_of(df.select("e", "t", C.whole("v").alias("w")), "w") == [(2,), (4,), (-2,), (-3,)]


def test_text_to_integer(spark):
    df = spark.createDataFrame([(1, 1, "2.7"), (1, 2, "x")], "e int, t int, v string")
    assert rows_of(profile.to_integers(df, ["v"], safe=True), "v") == [(3,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        profile.to_integers(df, ["v"]).collect()


def test_null_ranks_last_in_tiles(spark):
    df = spark.createDataFrame([(1, 1, 3.0), (2, 1, None), (3, 1, 1.0), (4, 1, 2.0)], "e int, t int, v double")
    out = windows.deciles(df, P, ["v"], tiles=3)
    assert {r["v"]: r["v_decile"] for r in out.collect()} == {1.0: 1, 2.0: 1, 3.0: 2, None: 3}


def test_year_end_distance(spark):
    df = spark.createDataFrame([(1, 202012, 1), (1, 202101, 0)], "e int, t int, v int")
    out = with_columns(df, windows.time_since(P, {"raw": "v = 1"}), windows.time_since(P, {"months": "v = 1"}, "months"))
    assert rows_of(out, "raw", "months") == [(0, 0), (89, 1)]
    with pytest.raises(ValueError):
        windows.time_since(P, {"x": "v = 1"}, unit="years")


def test_conditions_with_null_do_not_hold(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 1)], "e int, t int, v int")
    assert rows_of(df.select("e", "t", *C.flags({"f": "v = 1"})), "f") == [(0,), (1,)]


def test_pairs_of_cards_match_by_name(spark):
    df = spark.createDataFrame([(1, 1, 1, 2, 3, None)],
                               "e int, t int, Visa_a int, visa_b int, Master_b int, Master_a int")
    left, right = columns_like(df, contains="visa"), columns_like(df, contains="master")
    assert rows_of(df.select("e", "t", *C.paired_sums(left, right)), "a_tc", "b_tc") == [(1, 5)]
    with pytest.raises(ValueError, match="unpaired"):
        C.paired_sums(left, right[:1])
    assert C.card_stem("mtarjeta_visa_consumo", "visa") == "mtarjeta_consumo"


def test_classes_of_churn(spark):
    df = spark.createDataFrame([(1, 1, "baja+2"), (2, 1, "CONTINUA"), (3, 1, "other"), (4, 1, None)],
                               "e int, t int, clase_ternaria string")
    out = df.select("e", "t", C.churn_target("clase_ternaria").alias("y"), C.is_second_month_churn(df).alias("b"))
    assert rows_of(out, "y", "b") == [(1, 1), (0, 0), (None, 0), (None, 0)]
    with pytest.raises(ValueError):
        C.is_second_month_churn(df.drop("clase_ternaria"))


def test_accelerations_need_deltas(spark):
    df = spark.createDataFrame([(1, 1, 2)], "e int, t int, v int")
    with pytest.raises(ValueError, match="v_delta_1"):
        C.accelerations(df, ["v"])
    with pytest.raises(ValueError, match="nothing"):
        require_columns(df, ["v", "nothing"])


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3, True, [1])], "a int, b double, c string, d long, e boolean, f array<int>")
    assert numeric_columns(df, ["a"]) == ["b", "d"]
    assert numeric_columns(df, integers=False) == ["b"]


def test_cardinality_counts_values_not_nulls(spark):
    df = spark.range(5000).select(
        "id", (F.col("id") % 9).alias("nine"), (F.col("id") % 10).alias("ten"), F.lit(None).cast("int").alias("none"),
        F.when(F.col("id") > 4990, F.col("id")).otherwise(0).alias("late"), F.lit(float("nan")).alias("nan"))
    assert {r["variable"]: r["n_distinct"] for r in profile.cardinality(df, 10).collect()} == {
        "nine": 9, "none": 0, "nan": 1}
    assert profile.low_cardinality_columns(df, 11) == ["nine", "ten", "none", "late", "nan"]


def test_null_keys_are_refused_and_can_be_taken_apart(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (None, 1, 6.0), (None, 2, 7.0), (2, None, 8.0)], "e int, t int, v double")
    panel = Panel("e", "t")
    for build in (lambda d: windows.expand(d, panel, ["v"]), lambda d: targets.churn_targets(d, panel)):
        with pytest.raises(Exception, match="NULL in key column"):
            build(df).collect()
    assert unkeyed(df, panel).count() == 3
    assert windows.expand(df.exceptAll(unkeyed(df, panel)), panel, ["v"]).count() == 1


@pytest.mark.parametrize("kind", ["int", "bigint", "float", "double", "decimal(10,2)"])
def test_types_do_not_depend_on_the_window(spark, kind):
    df = spark.range(20).select(F.lit(1).alias("e"), F.col("id").alias("t"), F.col("id").cast(kind).alias("v"))
    panel, found = Panel("e", "t"), []
    for window in (12, 13):
        out = windows.expand(df, panel, ["v"], window=window)
        found.append([dict(out.dtypes)[f"v_{k}_{window}"] for k in ("max", "min", "avg")])
        mean = out.where("t = 15").first()[f"v_avg_{window}"]
        assert mean == pytest.approx(sum(range(15 - window, 15)) / window)
    assert found[0] == found[1] and found[0][2] == "double"


def test_distinct_counts_of_every_column(spark):
    df = spark.range(3000).select(
        "id", (F.col("id") % 7).cast("double").alias("seven"), F.lit(None).cast("string").alias("none"),
        F.when(F.col("id") % 2 == 0, float("nan")).otherwise(-0.0).alias("two"), F.array(F.col("id") % 3).alias("nested"))
    got = {r["variable"]: r["n_distinct"] for r in profile.distinct_counts(df).collect()}
    assert got == {"id": 3000, "seven": 7, "none": 0, "two": 2, "nested": 3}
