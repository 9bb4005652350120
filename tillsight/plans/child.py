"""CHILD: customers who buy often and for very small amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.rows import to_detections
from tillsight.operators.pairs import average_below
from tillsight.settings import Clock, Options, Thresholds


def is_child(limits: Thresholds, opts: Options) -> Column:
    return average_below(limits.max_avg_amount, opts) & (F.col("n") >= limits.min_pair_txns)


def child(
    pairs: DataFrame,
    limits: Thresholds,
    clock: Clock,
    opts: Options,
    scope: tuple[str, ...] = (),
) -> DataFrame:
    """A plain filter on pair state; null ids form pairs of their own and are kept."""
    return to_detections(pairs.filter(is_child(limits, opts)), "child", clock, scope=scope)
