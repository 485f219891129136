"""Row-wise features. Every function returns aliased Columns to add in one projection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Codes of the two card-status columns and the label of each.
CARD_STATUS = {0: "abierta", 6: "pcierre", 7: "pacierre", 9: "cerrada"}

# Churn classes and the binary target of each.
CHURN_TARGET = {"CONTINUA": 0, "BAJA+1": 1, "BAJA+2": 1}

# Fixed value: offset that keeps the amount-per-count ratio away from a zero divisor.
COUNT_OFFSET = 0.01

# Fixed value: probability above which a row counts as predicted positive.
PROBABILITY_CUT = 0.025


def whole(column: Column | str, kind: str = "int", safe: bool = False) -> Column:
    """Nearest whole number, halves to even. `safe` turns unparsable text into NULL."""
    value = F.col(column) if isinstance(column, str) else column
    value = value.try_cast("double") if safe else value.cast("double")
    return F.rint(value).cast(kind)


def or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0))


def flag(condition: Column | str) -> Column:
    """1 where the condition holds; 0 where it does not or is NULL."""
    test = F.expr(condition) if isinstance(condition, str) else condition
    return F.when(test, 1).otherwise(0)


def one_hot(column: str, labels: Mapping[int, str]) -> list[Column]:
    return [flag(F.col(column) == code).alias(f"{column}_{label}") for code, label in labels.items()]


def latest_and_earliest(triples: Iterable[tuple[str, str, str]]) -> list[Column]:
    """Whole-number maximum and minimum of two columns; a NULL side is skipped."""
    out = []
    for left, right, name in triples:
        out.append(whole(F.greatest(left, right)).alias(f"{name}_latest"))
        out.append(whole(F.least(left, right)).alias(f"{name}_earliest"))
    return out


def sum_without_nulls(left: str, right: str) -> Column:
    return or_zero(left) + or_zero(right)


def card_stem(name: str, brand: str) -> str:
    """Column name without its brand and the underscore after it, in any spelling."""
    start = name.lower().find(brand)
    if start < 0:
        return name
    return name[:start] + name[start + len(brand):].removeprefix("_")


def paired_sums(
    left: Sequence[str], right: Sequence[str], brands: tuple[str, str] = ("visa", "master"),
    suffix: str = "_tc",
) -> list[Column]:
    """Sum of the two columns that share a stem; status columns are left out."""
    lefts = {card_stem(c, brands[0]): c for c in left if "_status" not in c}
    rights = {card_stem(c, brands[1]): c for c in right if "_status" not in c}
    if lefts.keys() != rights.keys():
        raise ValueError(f"unpaired columns: {sorted(lefts.keys() ^ rights.keys())}")
    return [sum_without_nulls(c, rights[stem]).alias(f"{stem}{suffix}") for stem, c in lefts.items()]


def amount_per_count(amount: str, count: str) -> Column:
    return F.try_divide(F.col(amount), F.col(count) + F.lit(COUNT_OFFSET))


def amount_count_pairs(names: Iterable[str]) -> list[tuple[str, str]]:
    """(m<x>, c<x>) pairs by name."""
    known = list(names)
    counts = {c[1:] for c in known if c.startswith("c")}
    return [(m, "c" + m[1:]) for m in known if m.startswith("m") and m[1:] in counts]


def amount_count_ratios(df: DataFrame, exclude: Iterable[str] = ()) -> list[Column]:
    skipped = set(exclude)
    pairs = amount_count_pairs(c for c in df.columns if c not in skipped)
    return [amount_per_count(m, c).alias(f"ratio_{m}_{c}") for m, c in pairs]


def total(columns: Sequence[str]) -> Column:
    """Sum of the columns, each rounded to a whole number first, NULL as 0."""
    return reduce(add, [F.coalesce(whole(c, "long"), F.lit(0)) for c in columns])


def totals(groups: Mapping[str, Sequence[str]]) -> list[Column]:
    return [total(columns).alias(name) for name, columns in groups.items()]


def differences(pairs: Mapping[str, tuple[str, str]]) -> list[Column]:
    return [(or_zero(a) - or_zero(b)).alias(name) for name, (a, b) in pairs.items()]


def flags(conditions: Mapping[str, str | Column]) -> list[Column]:
    return [flag(test).alias(name) for name, test in conditions.items()]


def ratios(pairs: Mapping[str, tuple[str, str]]) -> list[Column]:
    """Quotient as double, NULL when the divisor is zero or NULL."""
    return [
        F.try_divide(F.col(a).cast("double"), F.col(b)).alias(name) for name, (a, b) in pairs.items()
    ]


def accelerations(df: DataFrame, columns: Iterable[str]) -> list[Column]:
    """Change of the one-step change; both delta columns must exist."""
    out = []
    for c in columns:
        first, second = f"{c}_delta_1", f"{c}_delta_2"
        if first not in df.columns or second not in df.columns:
            raise ValueError(f"{c}: needs {first} and {second}")
        out.append((F.col(first) - F.col(second)).alias(f"{c}_accel"))
    return out


def churn_target(column: str) -> Column:
    """Churn class to 0/1; any other text is NULL."""
    label = F.upper(F.col(column))
    target = F.lit(None).cast("int")
    for name, value in CHURN_TARGET.items():
        target = F.when(label == name, value).otherwise(target)
    return target


def is_second_month_churn(df: DataFrame) -> Column:
    """1 for the class that leaves in the second month, from whichever class column exists."""
    for name in ("target_ternario", "clase_ternaria"):
        if name in df.columns:
            if df.schema[name].dataType.typeName() == "string":
                return flag(F.upper(F.col(name)) == "BAJA+2")
            return flag(F.col(name) == 1)
    raise ValueError("neither target_ternario nor clase_ternaria is in the table")


def predicted_positive(probability: str, cut: float = PROBABILITY_CUT) -> Column:
    return (F.col(probability) > cut).cast("int")


def row_mean(columns: Sequence[str]) -> Column:
    """Mean of the non-NULL values of the columns."""
    counted = reduce(add, [F.col(c).isNotNull().cast("int") for c in columns])
    summed = reduce(add, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    return F.try_divide(summed, counted)


def in_periods(df: DataFrame, column: str, periods: Iterable) -> Column:
    """Membership test with the list cast to the column's own type."""
    kind = df.schema[column].dataType
    values = [F.lit(p).cast(kind) for p in periods]
    return F.col(column).isin(*values) if values else F.lit(False)
