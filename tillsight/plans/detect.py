"""All rules over one table, or over every chunk by itself."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.operators.pairs import PairTable, pair_state, save_pairs
from tillsight.plans.child import child
from tillsight.plans.gender_skew import clear_customers, gender_skew, skewed_merchants
from tillsight.plans.upgrade import pair_weights, upgrade
from tillsight.settings import PATTERNS, Clock, Options, Thresholds
from tillsight.workspace import Workspace


def detect_on_pairs(
    pairs: PairTable,
    weights: DataFrame | None,
    limits: Thresholds,
    clock: Clock,
    opts: Options,
    ws: Workspace,
    patterns: tuple[str, ...] = PATTERNS,
) -> DataFrame:
    """Union of the chosen rules over written pair state and average weights per pair."""
    unknown = set(patterns) - set(PATTERNS)
    if unknown or not patterns:
        raise ValueError(f"patterns must be some of {PATTERNS}, not {patterns}")
    found = []
    if "upgrade" in patterns:
        found.append(upgrade(pairs, weights, limits, clock, opts, ws))
    if "child" in patterns:
        found.append(child(pairs.df, limits, clock, opts, pairs.scope))
    if "gender_skew" in patterns:
        found.append(gender_skew(pairs, limits, clock, opts))
    return reduce(DataFrame.unionByName, found)


def detect(
    txns: DataFrame,
    importance: DataFrame | None,
    limits: Thresholds,
    clock: Clock,
    opts: Options = Options(),
    ws: Workspace | None = None,
    patterns: tuple[str, ...] = PATTERNS,
    scope: tuple[str, ...] = (),
) -> DataFrame:
    """Detections of a transaction table; with scope=("chunk_id",) of each chunk alone.

    The transactions are scanned and shuffled once; every rule reads the written pair state. A
    single rule that reads it only once is left as one lazy plan.
    """
    if set(patterns) == {"child"}:
        pairs = pair_state(txns, opts, scope, patterns)
        return child(pairs, limits, clock, opts, scope)
    if set(patterns) == {"gender_skew"}:
        return skewed_merchants(clear_customers(txns, opts, scope), limits, clock, scope)
    ws = ws or Workspace(txns.sparkSession)
    pairs = save_pairs(pair_state(txns, opts, scope, patterns), ws, scope)
    weights = pair_weights(importance, opts) if "upgrade" in patterns else None
    return detect_on_pairs(pairs, weights, limits, clock, opts, ws, patterns)


def detections_by_pattern(detections: DataFrame) -> DataFrame:
    return detections.groupBy("patternId").agg(F.count(F.lit(1)).alias("detections"))
