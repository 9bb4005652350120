"""Exact percent_rank cuts per merchant that do not gather a merchant's customers in one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tillsight.operators.lookup import lookup_join
from tillsight.operators.ordering import running_sums
from tillsight.operators.pairs import PairTable
from tillsight.settings import Options, Thresholds
from tillsight.workspace import Workspace


def percent(before: Column, total: Column) -> Column:
    """percent_rank of a row with `before` strictly smaller rows out of `total`."""
    return F.when(total > 1, before / (total - 1)).otherwise(F.lit(0.0))


def count_levels(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Histogram: how many customers of each merchant have n transactions.

    A merchant with T transactions has fewer than sqrt(2T)+1 distinct values of n, since k
    distinct values need at least k(k+1)/2 transactions. So a window over one merchant's levels
    stays small however many customers it has.
    """
    return (
        pairs.filter(F.col("merchantId").isNotNull())
        .groupBy(*keys, "n")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


def top_levels(levels: DataFrame, keys: list[str], limits: Thresholds) -> DataFrame:
    """Levels in the top share of eligible merchants, with their rounded percent rank."""
    group = Window.partitionBy(*keys)
    higher = group.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("customers").over(higher), F.lit(0))
    return (
        levels.withColumns(
            {
                "_before": before,
                "_customers": F.sum("customers").over(group),
                "_txns": F.sum(F.col("customers") * F.col("n")).over(group),
            }
        )
        .filter(F.col("_txns") >= limits.min_merchant_txns)
        .withColumn(
            "txn_percentile_rank", F.round(percent(F.col("_before"), F.col("_customers")), 4)
        )
        .filter(F.col("txn_percentile_rank") <= limits.top_share)
        .drop("_before", "_customers", "_txns")
    )


@dataclass(frozen=True)
class Cuts:
    """Smallest n in the top share, per merchant, with upper bounds on its sizes."""

    df: DataFrame
    rows: int
    largest: int  # top customers of any one merchant


def cuts_of(top: DataFrame, keys: list[str]) -> DataFrame:
    return top.groupBy(*keys).agg(
        F.min("n").alias("cut"), F.sum("customers").alias("top_customers")
    )


def save_cuts(top: DataFrame, keys: list[str], ws: Workspace) -> Cuts:
    """Write the cuts and count them in the same job."""
    seen = Observation()
    counted = cuts_of(top, keys).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.max("top_customers").alias("largest")
    )
    df = ws.save(counted, "cuts")
    return Cuts(df, seen.get.get("rows") or 0, seen.get.get("largest") or 0)


def pair_cuts(
    pairs: PairTable, keys: list[str], limits: Thresholds, opts: Options, ws: Workspace
) -> Cuts:
    """Cuts of written pair state.

    An eligible merchant has at least `min_merchant_txns` transactions, so the totals known from
    writing the pair state bound the number of cuts, and the number of pairs bounds every
    merchant's customers. Where those bounds do, the cuts stay part of the final plan; otherwise
    they are written and counted.
    """
    top = top_levels(count_levels(pairs.df, keys), keys, limits)
    most = pairs.txns // max(limits.min_merchant_txns, 1)
    if most <= opts.broadcast_rows and pairs.rows <= opts.window_rows:
        return Cuts(cuts_of(top, keys), most, pairs.rows)
    return save_cuts(top, keys, ws)


def average_weights(importance: DataFrame) -> DataFrame:
    """Average weight per pair; averaging before the join collapses a hot pair map-side."""
    return (
        importance.filter(F.col("merchantId").isNotNull() & F.col("customerId").isNotNull())
        .groupBy("merchantId", "customerId")
        .agg(F.avg("weight").alias("avg_weight"))
    )


def lowest_weights(
    weighted: DataFrame,
    keys: list[str],
    largest: int,
    limits: Thresholds,
    opts: Options,
    ws: Workspace,
) -> DataFrame:
    """Rows whose percent_rank by average weight (nulls first) is in the bottom share.

    `largest` is a proven upper bound on the rows of one group. Within the window bound the
    built-in rank is used. Otherwise distinct weights are counted, range-sorted and summed in
    slices, which gives each group the largest weight that still passes.
    """
    if largest <= opts.window_rows:
        rank = F.percent_rank().over(Window.partitionBy(*keys).orderBy("avg_weight"))
        ranked = weighted.withColumn("weight_percentile_rank", rank)
        passing = F.col("weight_percentile_rank") <= limits.bottom_share
        return ranked.filter(passing).drop("weight_percentile_rank")
    rows = ws.save(weighted, "weighted")
    values = rows.groupBy(*keys, "avg_weight").agg(F.count(F.lit(1)).alias("customers"))
    order = F.col("avg_weight").asc_nulls_first()
    summed = running_sums(values, keys, order, ["customers"], ws)
    cuts = ws.save(
        summed.filter(
            percent(F.col("before_customers"), F.col("all_customers")) <= limits.bottom_share
        )
        .groupBy(*keys)
        .agg(F.max("avg_weight").alias("_weight_cut")),
        "weight-cuts",
    )
    passing = F.col("avg_weight").isNull() | (F.col("avg_weight") <= F.col("_weight_cut"))
    return (
        lookup_join(rows, cuts, keys, "customerId", cuts.count(), opts)
        .filter(passing)
        .drop("_weight_cut")
    )
