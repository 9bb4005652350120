"""UPGRADE: frequent customers of big merchants whose importance is low."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.functions.rows import to_detections
from tillsight.operators.lookup import lookup_join
from tillsight.operators.pairs import PAIR, PairTable, pair_state
from tillsight.operators.ranking import (
    Cuts,
    average_weights,
    count_levels,
    lowest_weights,
    pair_cuts,
    top_levels,
)
from tillsight.settings import Clock, Options, Thresholds
from tillsight.sources.tables import normalize_importance, normalize_transactions
from tillsight.workspace import Workspace


def merchant_totals(txns: DataFrame, opts: Options) -> DataFrame:
    rows = normalize_transactions(txns, opts)
    return rows.groupBy("merchantId").agg(F.count(F.lit(1)).alias("total_txns"))


def eligible_merchants(txns: DataFrame, limits: Thresholds, opts: Options) -> DataFrame:
    totals = merchant_totals(txns, opts).filter(F.col("merchantId").isNotNull())
    return totals.filter(F.col("total_txns") >= limits.min_merchant_txns).select("merchantId")


def eligible_transactions(
    txns: DataFrame, limits: Thresholds, opts: Options, ws: Workspace
) -> DataFrame:
    """Rows of eligible merchants; the merchant list is written and counted before the join."""
    merchants = ws.save(eligible_merchants(txns, limits, opts), "eligible")
    rows = normalize_transactions(txns, opts)
    return lookup_join(
        rows, merchants, ["merchantId"], "customerId", merchants.count(), opts, "left_semi"
    )


def pair_counts(txns: DataFrame, opts: Options) -> DataFrame:
    counts = pair_state(txns, opts, patterns=("upgrade",))
    return counts.withColumnRenamed("n", "txn_count")


def pair_weights(importance: DataFrame, opts: Options) -> DataFrame:
    """Average weight per pair from a raw importance table."""
    return average_weights(normalize_importance(importance, opts))


def top_customers_ranked(
    pairs: PairTable, limits: Thresholds, opts: Options, ws: Workspace
) -> DataFrame:
    """Customers in the top share by row count, with the rounded rank."""
    keys = [*pairs.scope, "merchantId"]
    top = ws.save(
        top_levels(count_levels(pairs.df, keys), keys, limits).drop("customers"), "top-levels"
    )
    rows = pairs.df.select(*keys, "customerId", "n")
    return lookup_join(rows, top, [*keys, "n"], "customerId", top.count(), opts)


def top_customers(pairs: PairTable, cuts: Cuts, opts: Options) -> DataFrame:
    """The same customers without the rank: one comparison against their merchant's cut."""
    keys = [*pairs.scope, "merchantId"]
    rows = pairs.df.filter(F.col("customerId").isNotNull()).select(*keys, "customerId", "n")
    joined = lookup_join(rows, cuts.df, keys, "customerId", cuts.rows, opts)
    return joined.filter(F.col("n") >= F.col("cut")).select(*keys, "customerId")


def weighted_top_customers(
    pairs: PairTable, weights: DataFrame, limits: Thresholds, opts: Options, ws: Workspace
) -> tuple[DataFrame, Cuts]:
    """Top customers that have importance rows, with their average weight.

    Few cuts are few merchants: then importance is cut down to these before it is averaged, as the
    optimizer moves the semi-join below the aggregate and its shuffle.
    """
    keys = [*pairs.scope, "merchantId"]
    cuts = pair_cuts(pairs, keys, limits, opts, ws)
    if cuts.rows <= opts.broadcast_rows:
        merchants = F.broadcast(cuts.df.select("merchantId").distinct())
        weights = weights.join(merchants, "merchantId", "left_semi")
    return top_customers(pairs, cuts, opts).join(weights, list(PAIR)), cuts


def upgrade(
    pairs: PairTable,
    weights: DataFrame,
    limits: Thresholds,
    clock: Clock,
    opts: Options,
    ws: Workspace,
) -> DataFrame:
    keys = [*pairs.scope, "merchantId"]
    weighted, cuts = weighted_top_customers(pairs, weights, limits, opts, ws)
    low = lowest_weights(weighted, keys, cuts.largest, limits, opts, ws)
    return to_detections(low, "upgrade", clock, scope=pairs.scope)
