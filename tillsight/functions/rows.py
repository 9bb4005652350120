"""The one constructor of detection rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.schemas import DETECTION_COLUMNS
from tillsight.settings import Clock

# Pattern id and action of each rule.
LABELS = {
    "upgrade": ("PatId1", "UPGRADE"),
    "child": ("PatId2", "CHILD"),
    "gender_skew": ("PatId3", "DEI-NEEDED"),
}


def to_detections(
    df: DataFrame,
    pattern: str,
    clock: Clock,
    customer: Column | None = None,
    merchant: Column | None = None,
    scope: tuple[str, ...] = (),
) -> DataFrame:
    """Detection rows of one rule; scope columns, if any, come first."""
    pattern_id, action = LABELS[pattern]
    values = [
        F.lit(clock.start),
        F.lit(clock.detected),
        F.lit(pattern_id),
        F.lit(action),
        F.col("customerId") if customer is None else customer,
        F.col("merchantId") if merchant is None else merchant,
    ]
    named = [v.alias(c) for v, c in zip(values, DETECTION_COLUMNS)]
    return df.select(*scope, *named)
