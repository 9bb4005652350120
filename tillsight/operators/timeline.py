"""Order statistics over time, and the first time a bound is met, for groups of any size.

Both go digit by digit. A group's values are counted by their leading digits at each time, so no window holds
more of a group than a row per time, and the next digit is looked up within the values that share the
leading ones. Times are grouped likewise, in blocks with the highest bound of each part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tillsight.operators.lookup import lookup_join, tasks_for
from tillsight.settings import Options
from tillsight.workspace import Workspace

# Bits of a digit of values, and of a digit of times.
VALUE_BITS, TIME_BITS = 4, 6


def highest_place(share: float, rank: Callable[[Column, Column], Column], about: float) -> Callable[[Column], Column]:
    """The highest place, from 0, of `total` rows with `rank(place, total)` at most a share; null if there is none.

    Ranks do not fall with the place, and at `about` of all places they pass the share, but for rounding."""

    def place(total: Column) -> Column:
        near = F.floor(F.lit(min(max(float(about), 0.0), 1.0)) * (total - 1)).cast("long")
        places = F.array(*[near + k for k in range(-2, 3)])
        fit = F.filter(places, lambda p: (p >= 0) & (p < total) & (rank(p, total) <= share))
        return F.when(total > 0, F.array_max(fit))

    return place


def value_over_time(
    changes: DataFrame, asked: DataFrame, keys: list[str], time: str, top: int, place: Callable[[Column], Column], ws: Workspace
) -> DataFrame:
    """`asked` (keys, time and what else it has) with `code`, the value at a place of those there at the time,
    lowest first.

    `changes` tell at which time how many of a `code` from 0 to `top` come (`change` above 0) or go. Rows without
    a value at that place are dropped."""
    count = 1 << VALUE_BITS
    parts = [f"_part{k}" for k in range(count)]
    changes = ws.save(changes.groupBy(*keys, time, "code").agg(F.sum("change").alias("change")), "changes")
    found = asked.withColumns({"_node": F.lit(0).cast("long"), "_left": F.lit(None).cast("long")})
    digits = max(1, -(-top.bit_length() // VALUE_BITS))
    for digit in reversed(range(digits)):
        part = F.shiftright("code", VALUE_BITS * digit)
        node = F.shiftright(part, VALUE_BITS).alias("_node")
        moves = changes.groupBy(*keys, node, time).agg(
            *[F.sum(F.when(part.bitwiseAND(count - 1) == k, F.col("change")).otherwise(0)).alias(p) for k, p in enumerate(parts)]
        )
        # A row per time at most, and those asked for.
        so_far = Window.partitionBy(*keys, "_node").orderBy(time)
        both = moves.withColumn("_asked", F.lit(False)).unionByName(found.withColumn("_asked", F.lit(True)), True)
        there = both.select(*found.columns, "_asked", *[F.coalesce(F.sum(p).over(so_far), F.lit(0)).alias(p) for p in parts])
        there = there.filter("_asked").drop("_asked")
        for before, p in zip(parts, parts[1:]):
            there = there.withColumn(p, F.col(before) + F.col(p))
        if digit == digits - 1:
            there = there.withColumn("_left", place(F.col(parts[-1])))
        there = there.filter(F.col("_left").isNotNull())
        sums = F.array(*[F.col(p) for p in parts])
        there = there.withColumn("_below", F.filter(sums, lambda s: s <= F.col("_left")))
        there = there.withColumns(
            {
                "_node": F.shiftleft("_node", VALUE_BITS) + F.size("_below"),
                "_left": F.col("_left") - F.coalesce(F.array_max("_below"), F.lit(0)),
            }
        )
        found = ws.save(there.select(*found.columns), "digits")
    return found.drop("_left").withColumnRenamed("_node", "code")


class Bounds:
    """Bounds of groups over time: rows of keys, `_time` from 0 to `last` and `bound`, one per time and group at most.

    With `_until` among them, a bound is that of all times from `_time` to there."""

    def __init__(self, bounds: DataFrame, keys: list[str], rows: int, last: int, opts: Options, ws: Workspace):
        self.keys, self.rows, self.opts, self.ws = keys, rows, opts, ws
        self.height = max(1, -(-last.bit_length() // TIME_BITS))
        until = F.col("_until") if "_until" in bounds.columns else F.col("_time")
        nodes = bounds.select(*keys, F.col("_time").alias("_node"), F.col("bound").alias("_top"), until.alias("_until"))
        self.levels = []
        for level in range(self.height):
            kid = [F.col("_node").bitwiseAND((1 << TIME_BITS) - 1).alias("place"), F.col("_top").alias("top")]
            lasting = [] if level else [F.sum(F.col("_until") - F.col("_node") + 1).alias("_lasting")]
            kid = F.struct(*kid) if level else F.struct(*kid, F.col("_until").alias("until"))
            blocks = nodes.groupBy(*keys, F.shiftright("_node", TIME_BITS).alias("_block")).agg(
                F.sort_array(F.collect_list(kid)).alias("_kids"), F.max("_top").alias("_top"), *lasting
            )
            self.levels.append(ws.save(blocks, "blocks"))
            nodes = self.levels[-1].select(*keys, F.col("_block").alias("_node"), "_top")
        self.highest = nodes.groupBy(*keys).agg(F.max("_top").alias("_highest"))

    def _look(self, rows: DataFrame, level: int, block: Column, least: Column) -> DataFrame:
        """Adds `_found`, the first part of a block from a place on whose bound is not below the code."""
        blocks = self.levels[level].select(*self.keys, "_block", "_kids")
        rows = lookup_join(rows.withColumn("_block", block), blocks, [*self.keys, "_block"], "customerId", self.rows, self.opts, "left")
        fit = F.filter("_kids", lambda kid: (kid["place"] >= least) & (kid["top"] >= F.col("code")))
        node = F.shiftleft("_block", TIME_BITS) + F.get(fit, F.lit(0))["place"]
        return rows.withColumn("_found", node).drop("_kids", "_block")

    def met(self, rows: DataFrame) -> DataFrame:
        """Rows whose `code` is within the bound at any time from `_from` on, with the first such `_time`."""
        columns = rows.columns
        rows = lookup_join(rows, self.highest, self.keys, "customerId", self.rows, self.opts)
        rows = rows.filter(F.col("code") <= F.col("_highest")).drop("_highest")
        rows = rows.withColumns({"_node": F.lit(None).cast("long"), "_level": F.lit(None).cast("int")})
        for level in range(self.height):
            at = F.shiftright("_from", TIME_BITS * level)
            block = F.when(F.col("_node").isNull(), F.shiftright(at, TIME_BITS))
            rows = self._look(rows, level, block, at.bitwiseAND((1 << TIME_BITS) - 1) + (1 if level else 0))
            here = F.when(F.col("_found").isNotNull(), F.lit(level))
            rows = rows.withColumns({"_level": F.coalesce("_level", here), "_node": F.coalesce("_node", "_found")})
            rows = rows.drop("_found")
        rows = rows.filter(F.col("_node").isNotNull())
        for level in reversed(range(self.height - 1)):
            above = F.col("_level") == level + 1
            rows = self._look(rows, level, F.when(above, F.col("_node")), F.lit(0))
            rows = rows.withColumns(
                {"_node": F.when(above, F.col("_found")).otherwise(F.col("_node")), "_level": F.when(above, level).otherwise(F.col("_level"))}
            ).drop("_found")
        return rows.select(*columns, F.col("_node").alias("_time"))

    def all_met(self, rows: DataFrame) -> DataFrame:
        """A row for every time from `_from` on at which the `code` is within the bound, with its `_until`.

        Those of one row may be as many as there are times, so rows are dealt to tasks by blocks of times, with as
        many tasks as the times that may come out need."""
        blocks = self.levels[0]
        near = lookup_join(rows, self.highest, self.keys, "customerId", self.rows, self.opts)
        near = near.filter(F.col("code") <= F.col("_highest")).drop("_highest")
        tops = blocks.select(*self.keys, "_block", "_top", "_lasting")
        near = lookup_join(near, tops, self.keys, "customerId", self.rows, self.opts)
        near = near.filter((F.col("code") <= F.col("_top")) & (F.col("_block") >= F.shiftright("_from", TIME_BITS)))
        seen = Observation()
        near = near.observe(seen, F.sum("_lasting").alias("rows")).select(*rows.columns, "_block")
        near = self.ws.save(near, "near")
        kids = blocks.select(*self.keys, "_block", "_kids")
        on = [*self.keys, "_block"]
        near = lookup_join(near, kids, on, "customerId", self.rows, self.opts, tasks=tasks_for(seen.get.get("rows")))
        start = F.shiftleft("_block", TIME_BITS)
        fit = F.filter("_kids", lambda kid: (start + kid["place"] >= F.col("_from")) & (kid["top"] >= F.col("code")))
        times = F.transform(fit, lambda kid: F.struct((start + kid["place"]).alias("_time"), kid["until"].alias("_until")))
        return near.select(*rows.columns, F.inline(times))
