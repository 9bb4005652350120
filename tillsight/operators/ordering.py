"""Row numbers and running sums over data of any size, with no task holding a whole group.

Both sort by range, write the sorted slices once (so the numbering cannot change on a retry), and
add per-slice offsets. The offsets number at most the sort's partitions per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.workspace import Workspace

# Fixed value: monotonically_increasing_id keeps the row's place within its partition in the
# low 33 bits and the partition in the bits above.
PLACE_BITS = 33


def global_sequence(df: DataFrame, order: list[Column | str], ws: Workspace) -> DataFrame:
    """Add `seq`, 1-based and gapless, in the given order; the order should be total."""
    return number_placed(ws.save(place_in_order(df, order), "sorted"), [])


def place_in_order(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """Sort and note each row's slice and place. To be written before it is numbered."""
    return df.sort(*order).withColumn("_at", F.monotonically_increasing_id())


def number_placed(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Turn written places into `seq`, counted from 1 for each of the keys.

    Rows that were sorted together are numbered together or by keys that lead their order. There is one
    offset per key and sort partition.
    """
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    placed = placed.withColumn("_slice", F.shiftright("_at", PLACE_BITS))
    group = Window.partitionBy(*keys) if keys else Window
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(place).alias("_first"))
        .select(
            *keys,
            "_slice",
            (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_before"),
        )
    )
    # Without keys the offsets are at most the sort's partitions, so they may be broadcast.
    offsets = offsets if keys else F.broadcast(offsets)
    return (
        placed.join(offsets, [*keys, "_slice"])
        .withColumn("seq", F.col("_before") + place + 1)
        .drop("_slice", "_before", "_at")
    )


def running_sums(
    df: DataFrame, keys: list[str], order: Column, values: list[str], ws: Workspace
) -> DataFrame:
    """Add `before_<v>` (sum of v over earlier rows of the group) and `all_<v>` (over the group).

    `order` must be unique within a group; without keys the whole frame is one group.
    """
    sliced = ws.save(df.sort(*keys, order).withColumn("_slice", F.spark_partition_id()), "slices")
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*keys, "_slice")
        .agg(*[F.sum(v).alias(v) for v in values])
        .select(
            *keys,
            "_slice",
            *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_offset_{v}") for v in values],
            *[F.sum(v).over(group).alias(f"all_{v}") for v in values],
        )
    )
    within = (
        Window.partitionBy(*keys, "_slice")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = {f"_in_{v}": F.coalesce(F.sum(v).over(within), F.lit(0)) for v in values}
    return (
        sliced.withColumns(inside)
        .join(offsets, [*keys, "_slice"])
        .withColumns({f"before_{v}": F.col(f"_offset_{v}") + F.col(f"_in_{v}") for v in values})
        .drop("_slice", *inside, *[f"_offset_{v}" for v in values])
    )
