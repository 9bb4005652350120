"""Detections of every chunk given all chunks up to it, as one batch plan over intervals.

A pair's state only changes in chunks where the pair has rows, so its history is kept as versions,
each valid from one chunk until the pair's next. What a rule reports of a version holds for as long, so
each rule gives intervals of chunks, and nothing is repeated per chunk unless `cumulative` is asked for
the rows of every chunk. For UPGRADE a merchant's cuts can only move in chunks that touch it. Both cuts
are found as order statistics over time (`operators.timeline`), and then the touches at which a customer is
within them: all, or only the first, so that no customer is repeated per touch.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from math import floor

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tillsight.functions.rows import to_detections
from tillsight.operators.lookup import lookup_join, tasks_for
from tillsight.operators.ordering import global_sequence
from tillsight.operators.pairs import (
    MERGE,
    PAIR,
    PairTable,
    by_stripped_ids,
    pair_state,
    save_pairs,
)
from tillsight.operators.ranking import percent
from tillsight.operators.timeline import Bounds, highest_place, value_over_time
from tillsight.plans.child import is_child
from tillsight.plans.gender_skew import is_skewed, one_letter
from tillsight.plans.upgrade import pair_weights
from tillsight.settings import PATTERNS, Clock, Options, Thresholds
from tillsight.workspace import Workspace

SCOPE = ("chunk_id",)
SPAN = ("first_chunk", "last_chunk")


@dataclass(frozen=True)
class History:
    """Per-chunk pair state and its running versions, both written."""

    per_chunk: PairTable
    versions: DataFrame
    first_chunk: int
    last_chunk: int


def running(values: dict[str, Column], keys: tuple[str, ...]) -> dict[str, Column]:
    so_far = (
        Window.partitionBy(*keys)
        .orderBy("chunk_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return {name: value.over(so_far) for name, value in values.items()}


def pair_versions(per_chunk: DataFrame) -> DataFrame:
    """Running pair state per touched chunk, with the count before and the next touched chunk.

    The window sees one row per chunk that touches the pair, never the pair's raw rows.
    """
    ordered = Window.partitionBy(*PAIR).orderBy("chunk_id")
    state = {c: merge(F.col(c)) for c, merge in MERGE.items() if c in per_chunk.columns}
    totals = running(state, PAIR)
    return per_chunk.select(
        "chunk_id",
        *PAIR,
        *[c.alias(name) for name, c in totals.items()],
        (totals["n"] - F.col("n")).alias("n_before"),
        F.lead("chunk_id").over(ordered).alias("next_chunk"),
    )


def build_history(txns: DataFrame, opts: Options, ws: Workspace) -> History:
    return history_of(pair_state(txns, opts, SCOPE), ws)


def history_of(pairs: DataFrame, ws: Workspace) -> History:
    """History of pair state by chunk; all that came before may be the rows of one chunk."""
    per_chunk = save_pairs(pairs, ws, SCOPE)
    versions = ws.save(pair_versions(per_chunk.df), "versions")
    first, last = per_chunk.df.agg(F.min("chunk_id"), F.max("chunk_id")).first()
    return History(per_chunk, versions, 0 if first is None else first, -1 if last is None else last)


def spans(history: History) -> list[Column]:
    """First and last chunk in which a version is valid."""
    last = F.coalesce(F.col("next_chunk"), F.lit(history.last_chunk + 1)) - 1
    return [F.col("chunk_id").alias("first_chunk"), last.cast("long").alias("last_chunk")]


def child_intervals(history: History, limits: Thresholds, clock: Clock, opts: Options) -> DataFrame:
    firing = history.versions.filter(is_child(limits, opts))
    return to_detections(firing.select(*PAIR, *spans(history)), "child", clock, scope=SPAN)


def gender_skew_intervals(
    history: History, limits: Thresholds, clock: Clock, opts: Options
) -> DataFrame:
    """Follow each merchant's counts of clear women and men by their changes.

    A pair adds 1 when it first shows one letter and takes it back when a second one appears.
    """
    versions = history.versions
    if opts.id_style == "clean" or not history.per_chunk.stray_ids:
        pairs = by_stripped_ids(replace(history.per_chunk, df=versions, stray_ids=False), opts)
    else:
        pairs = pair_versions(by_stripped_ids(history.per_chunk, opts))
    code = F.when(one_letter(), F.col("code_lo"))
    before = F.lag("_code").over(Window.partitionBy(*PAIR).orderBy("chunk_id"))
    letters = pairs.withColumn("_code", code).withColumn("_code_before", before)

    def change(letter: str) -> Column:
        now = F.coalesce((F.col("_code") == ord(letter)).cast("int"), F.lit(0))
        was = F.coalesce((F.col("_code_before") == ord(letter)).cast("int"), F.lit(0))
        return F.sum(now - was).alias(letter)

    changes = (
        letters.groupBy("merchantId", "chunk_id")
        .agg(change("F"), change("M"))
        .filter((F.col("F") != 0) | (F.col("M") != 0))
    )
    counts = changes.select(
        "merchantId",
        "chunk_id",
        F.lead("chunk_id")
        .over(Window.partitionBy("merchantId").orderBy("chunk_id"))
        .alias("next_chunk"),
        *[
            c.alias(name)
            for name, c in running({"F": F.sum("F"), "M": F.sum("M")}, ("merchantId",)).items()
        ],
    )
    rows = counts.filter(is_skewed(limits)).select("merchantId", *spans(history))
    return to_detections(rows, "gender_skew", clock, customer=F.lit(""), scope=SPAN)


def merchant_touches(history: History) -> DataFrame:
    """Chunks that touch each merchant, with its rows so far and its next such chunk."""
    per_chunk = (
        history.per_chunk.df.filter(F.col("merchantId").isNotNull())
        .groupBy("merchantId", "chunk_id")
        .agg(F.sum("n").alias("n"))
    )
    ordered = Window.partitionBy("merchantId").orderBy("chunk_id")
    return per_chunk.select(
        "merchantId",
        "chunk_id",
        F.lead("chunk_id").over(ordered).alias("next_chunk"),
        running({"total": F.sum("n")}, ("merchantId",))["total"].alias("total"),
    )


def upgrade_intervals(
    history: History,
    weights: DataFrame,
    limits: Thresholds,
    clock: Clock,
    opts: Options,
    ws: Workspace,
    firings: int | None = None,
) -> DataFrame:
    """An interval for every touch of a merchant at which a customer fires, or for the first `firings` (1 or 2)
    of each customer and cut.

    A merchant's cuts are order statistics of its customers' counts at its touches. Customers that have once
    reached a cut stay above it, so of each cut that a merchant ever has a customer becomes a member once, and
    the weight that still passes at a touch is an order statistic of the members of the cut of that touch.
    """
    first = history.first_chunk
    touches = merchant_touches(history).filter(F.col("total") >= limits.min_merchant_txns)
    seen = Observation()
    touches = ws.save(touches.observe(seen, F.count(F.lit(1)).alias("rows")), "touches")
    rows = seen.get.get("rows") or 0
    eligible = touches.select("merchantId").distinct()

    def of_eligible(df: DataFrame) -> DataFrame:
        return lookup_join(df, eligible, ["merchantId"], "customerId", rows, opts, "left_semi")

    versions = of_eligible(history.versions.filter(F.col("merchantId").isNotNull()))
    most = versions.agg(F.max("n")).first()[0] or 0
    moves = F.array(
        F.struct(F.col("n").alias("n"), F.lit(1).alias("change")),
        F.struct(F.col("n_before").alias("n"), F.lit(-1).alias("change")),
    )
    moves = versions.select("merchantId", "chunk_id", F.inline(moves)).filter(F.col("n") > 0)
    moves = moves.select("merchantId", "chunk_id", (F.lit(most) - F.col("n")).alias("code"), "change")
    passes = (floor(limits.top_share * 10_000 + 1e-6) + 0.5) / 10_000  # rounded to 4 places
    in_top = highest_place(limits.top_share, lambda before, total: F.round(percent(before, total), 4), passes)
    times = touches.select("merchantId", "chunk_id", "next_chunk")
    cuts = value_over_time(moves, times, ["merchantId"], "chunk_id", most, in_top, ws)
    cuts = ws.save(cuts.select(*times.columns, (F.lit(most) - F.col("code")).alias("cut")), "cuts")

    # Average weights by their place among all of them, nulls as the lowest.
    weights = ws.save(of_eligible(weights), "weights")
    values = global_sequence(weights.filter(F.col("avg_weight").isNotNull()).select("avg_weight").distinct(), ["avg_weight"], ws)
    values = ws.save(values.withColumnRenamed("seq", "code"), "values")
    heaviest = values.count()
    weights = lookup_join(weights, values, ["avg_weight"], "customerId", heaviest, opts, "left")
    weights = weights.select(*PAIR, F.coalesce("code", F.lit(0)).cast("long").alias("code"))

    kinds = cuts.select("merchantId", "cut").distinct()
    ends = kinds.groupBy("merchantId").agg(F.min("cut").alias("_low"), F.max("cut").alias("_high"))
    risen = versions.filter(F.col("customerId").isNotNull()).select("chunk_id", "n", "n_before", *PAIR)
    risen = lookup_join(risen, ends, ["merchantId"], "customerId", rows, opts)
    low, high = F.greatest(F.col("n_before") + 1, F.col("_low")), F.least("n", "_high")
    risen = risen.withColumns({"_from": low, "_to": high}).filter(F.col("_from") <= F.col("_to")).join(weights, list(PAIR))
    risen = risen.select("chunk_id", *PAIR, "code", F.explode(F.sequence("_from", "_to")).alias("cut"))
    keys = ["merchantId", "cut"]
    members = ws.save(lookup_join(risen, kinds, keys, "customerId", rows, opts, "left_semi"), "members")
    in_bottom = highest_place(limits.bottom_share, percent, limits.bottom_share)
    joined = members.withColumn("change", F.lit(1))
    bounds = value_over_time(joined, cuts, keys, "chunk_id", heaviest, in_bottom, ws)
    began, ended = [(c - first).alias(name) for c, name in zip(spans(history), ("_time", "_until"))]
    bounds = bounds.select(*keys, began, ended, F.col("code").alias("bound"))
    bounds = Bounds(bounds, keys, rows, history.last_chunk - first, opts, ws)

    members = members.select(*PAIR, "cut", "code", (F.col("chunk_id") - first).alias("_from"))
    if firings is None:
        ends = [(F.col(c) + first).alias(name) for c, name in zip(("_time", "_until"), SPAN)]
        return to_detections(bounds.all_met(members).select(*PAIR, *ends), "upgrade", clock, scope=SPAN)
    fired = bounds.met(members)
    if firings > 1:
        fired = ws.save(fired, "firings")
        again = fired.withColumn("_from", F.col("_time") + 1).drop("_time")
        fired = fired.unionByName(bounds.met(again))
    fired = fired.select(*PAIR, (F.col("_time") + first).alias("chunk_id"))
    placed = lookup_join(fired, times, ["merchantId", "chunk_id"], "customerId", rows, opts)
    return to_detections(placed.select(*PAIR, *spans(history)), "upgrade", clock, scope=SPAN)


def coalesced(intervals: DataFrame) -> DataFrame:
    """Intervals of equal rows that follow each other without a gap as one; none may overlap."""
    keys = [c for c in intervals.columns if c not in SPAN]
    ordered = Window.partitionBy(*keys).orderBy("first_chunk")
    apart = F.coalesce(F.col("first_chunk") > F.lag("last_chunk").over(ordered) + 1, F.lit(False)).cast("int")
    return (
        intervals.withColumn("_apart", apart)
        .withColumn("_island", F.sum("_apart").over(ordered))
        .groupBy(*keys, "_island")
        .agg(F.min("first_chunk").alias("first_chunk"), F.max("last_chunk").alias("last_chunk"))
        .select(*SPAN, *keys)
    )


def cumulative_intervals(
    txns: DataFrame,
    importance: DataFrame | None,
    limits: Thresholds,
    clock: Clock,
    opts: Options = Options(),
    ws: Workspace | None = None,
    patterns: tuple[str, ...] = PATTERNS,
) -> DataFrame:
    """All chosen rules for all chunks, each detection with the chunks from `first_chunk` to `last_chunk`
    in which it holds, as long as it does; `txns` carries chunk_id."""
    return coalesced(version_intervals(txns, importance, limits, clock, opts, ws, patterns))


def version_intervals(
    txns: DataFrame,
    importance: DataFrame | None,
    limits: Thresholds,
    clock: Clock,
    opts: Options = Options(),
    ws: Workspace | None = None,
    patterns: tuple[str, ...] = PATTERNS,
    firings: int | None = None,
) -> DataFrame:
    """The same with an interval for each version that fires; intervals of one key do not overlap.

    With `firings` (1 or 2) at least the first so many intervals of a key, and not all that follow."""
    ws = ws or Workspace(txns.sparkSession)
    weights = pair_weights(importance, opts) if "upgrade" in patterns else None
    return intervals_of(build_history(txns, opts, ws), weights, limits, clock, opts, ws, patterns, firings)


def intervals_of(
    history: History,
    weights: DataFrame | None,
    limits: Thresholds,
    clock: Clock,
    opts: Options,
    ws: Workspace,
    patterns: tuple[str, ...] = PATTERNS,
    firings: int | None = None,
) -> DataFrame:
    """Intervals of the chosen rules over a written history and average weights per pair."""
    found = []
    if "upgrade" in patterns:
        found.append(upgrade_intervals(history, weights, limits, clock, opts, ws, firings))
    if "child" in patterns:
        found.append(child_intervals(history, limits, clock, opts))
    if "gender_skew" in patterns:
        found.append(gender_skew_intervals(history, limits, clock, opts))
    return reduce(DataFrame.unionByName, found)


def cumulative(
    txns: DataFrame,
    importance: DataFrame | None,
    limits: Thresholds,
    clock: Clock,
    opts: Options = Options(),
    ws: Workspace | None = None,
    patterns: tuple[str, ...] = PATTERNS,
) -> DataFrame:
    """The same with a row for every chunk, dealt to as many tasks as these rows need."""
    ws = ws or Workspace(txns.sparkSession)
    history = build_history(txns, opts, ws)
    found = []
    if "upgrade" in patterns:
        found.append(intervals_of(history, pair_weights(importance, opts), limits, clock, opts, ws, ("upgrade",)))
    others = tuple(p for p in patterns if p != "upgrade")
    if others:
        seen = Observation()
        lasting = F.sum(F.col("last_chunk") - F.col("first_chunk") + 1).alias("rows")
        held = intervals_of(history, None, limits, clock, opts, ws, others).observe(seen, lasting)
        held = ws.save(held, "held")
        found.append(held.repartition(tasks_for(seen.get.get("rows")), *held.columns))
    found = reduce(DataFrame.unionByName, found)
    return found.select(F.explode(F.sequence(*SPAN)).alias("chunk_id"), *[c for c in found.columns if c not in SPAN])
