"""Emit-once and duplicate handling on detection keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.schemas import DETECTION_KEYS


def not_seen(new: DataFrame, emitted: DataFrame, keys: list[str] = DETECTION_KEYS) -> DataFrame:
    """Rows whose keys were not emitted before; null keys count as equal."""
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return new.alias("a").join(emitted.select(*keys).alias("b"), same, "left_anti")


def emit_once(
    detections: DataFrame, order: str = "chunk_id", keys: list[str] = DETECTION_KEYS
) -> DataFrame:
    """Each chunk's detections less those of any earlier chunk."""
    same = F.col("b._order") < F.col(f"a.{order}")
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    earlier = detections.groupBy(*keys).agg(F.min(order).alias("_order"))
    return detections.alias("a").join(earlier.alias("b"), same, "left_anti")


def keep_first(
    detections: DataFrame, order: str = "chunk_id", keys: list[str] = DETECTION_KEYS
) -> DataFrame:
    """The first row of each key in the given order, whole.

    Both forms aggregate map-side, so a key with very many rows is no hot group; a plain min
    also stays in a hash aggregate.
    """
    columns = detections.columns
    rest = [c for c in columns if c not in keys and c != order]
    if not rest:
        return detections.groupBy(*keys).agg(F.min(order).alias(order)).select(*columns)
    first = detections.groupBy(*keys).agg(F.min(F.struct(order, *rest)).alias("_first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_first.{c}") for c in columns])


def occurs_once(df: DataFrame, keys: list[str] = DETECTION_KEYS) -> DataFrame:
    """Rows whose keys occur exactly once; every copy of a repeated key is dropped."""
    rest = [c for c in df.columns if c not in keys]
    single = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.min(c).alias(c) for c in rest]
    )
    return single.filter(F.col("_rows") == 1).select(*df.columns)


def held_once(intervals: DataFrame, first: str, last: str, keys: list[str] = DETECTION_KEYS) -> DataFrame:
    """Rows of intervals, which do not overlap, whose keys hold in exactly one chunk."""
    chunks = F.sum(F.col(last) - F.col(first) + 1)
    single = intervals.groupBy(*keys).agg(chunks.alias("_chunks"), F.min(first).alias(first), F.min(last).alias(last))
    return single.filter(F.col("_chunks") == 1).select(first, last, *keys)
