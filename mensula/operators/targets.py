"""Churn labels from absence in the next two observed periods.

No entity-by-period grid is built: one window over an entity's own rows sees its next two
appearances, which settles presence one and two periods ahead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensula.panel import Panel, guarded, with_period_index

# Class names of the ternary label.
LEAVES_FIRST, LEAVES_SECOND, STAYS = "baja+1", "baja+2", "continua"


def _absences(df: DataFrame, panel: Panel) -> DataFrame:
    """Adds `_gone_1`, `_gone_2`: absent one and two observed periods later.

    Past the last observed period nothing counts as absence. A repeated or NULL key raises.
    """
    indexed = with_period_index(df, panel)
    at = F.col("period_idx")
    first = F.lead(at, 1).over(panel.history)
    second = F.lead(at, 2).over(panel.history)
    repeated = F.lag(at, 1).over(panel.history) == at
    message = F.concat(
        F.lit("entity and period are not unique: "), F.col(panel.entity).cast("string"),
        F.lit(", "), F.col(panel.period).cast("string"),
    )

    def gone(k: int) -> Column:
        seen = F.coalesce((first == at + k) | (second == at + k), (first == at + k), F.lit(False))
        return (at + k <= F.col("last_idx")) & ~seen

    checked = F.when(repeated, F.raise_error(message).cast("boolean"))
    return indexed.select(
        "*", guarded(checked.otherwise(gone(1)), panel).alias("_gone_1"), guarded(gone(2), panel).alias("_gone_2"))


def _labelled(df: DataFrame, panel: Panel, labels: list[Column], complete: bool) -> DataFrame:
    labels = list(labels)
    if complete:
        labels.append((F.col("period_idx") + 2 <= F.col("last_idx")).cast("int").alias("labels_complete"))
    return _absences(df, panel).select(*df.columns, *labels)


def _ternary_class() -> Column:
    return (
        F.when(F.col("_gone_1"), LEAVES_FIRST).when(F.col("_gone_2"), LEAVES_SECOND).otherwise(STAYS)
    ).alias("clase_ternaria")


def _binary() -> Column:
    return F.when(F.col("_gone_1") | F.col("_gone_2"), 1).otherwise(0).alias("target_binario")


def _ternary() -> Column:
    return F.when(~F.col("_gone_1") & F.col("_gone_2"), 1).otherwise(0).alias("target_ternario")


def churn_class(df: DataFrame, panel: Panel, labels_complete: bool = False) -> DataFrame:
    """`clase_ternaria`: leaves next period, leaves the one after, or stays."""
    return _labelled(df, panel, [_ternary_class()], labels_complete)


def binary_target(df: DataFrame, panel: Panel, labels_complete: bool = False) -> DataFrame:
    """`target_binario`: 1 for absence in either of the next two periods."""
    return _labelled(df, panel, [_binary()], labels_complete)


def ternary_target(df: DataFrame, panel: Panel, labels_complete: bool = False) -> DataFrame:
    """`target_ternario`: 1 for presence next period and absence in the one after."""
    return _labelled(df, panel, [_ternary()], labels_complete)


def churn_targets(df: DataFrame, panel: Panel, labels_complete: bool = False) -> DataFrame:
    """Both targets in one pass."""
    return _labelled(df, panel, [_binary(), _ternary()], labels_complete)
