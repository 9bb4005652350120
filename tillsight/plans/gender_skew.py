"""DEI-NEEDED: merchants with many identifiable women among their customers, yet more men."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.functions.ids import letter_code, letter_of, strip_ends
from tillsight.functions.rows import to_detections
from tillsight.operators.pairs import PAIR, PairTable, by_stripped_ids
from tillsight.settings import Clock, Options, Thresholds
from tillsight.sources.tables import normalize_transactions


def one_letter() -> Column:
    """Exactly one distinct non-null letter: min and max skip nulls, and are null if all are."""
    return F.col("code_lo") == F.col("code_hi")


def clear_customers(
    txns: DataFrame, opts: Options, scope: tuple[str, ...] = ()
) -> DataFrame:
    """(merchant, customer, letter code) of pairs with one gender, straight from transactions.

    Grouping by pair with min and max replaces the distinct count, the join back to the rows
    and the distinct triple: one shuffle instead of three.
    """
    rows = normalize_transactions(txns, opts, scope)
    if opts.id_style != "clean":
        rows = rows.withColumns({c: strip_ends(c) for c in PAIR})
    letters = (
        rows.filter(F.col("merchantId").isNotNull() & F.col("customerId").isNotNull())
        .groupBy(*scope, *PAIR)
        .agg(
            F.min(letter_code(F.col("gender"))).alias("code_lo"),
            F.max(letter_code(F.col("gender"))).alias("code_hi"),
        )
    )
    return letters.filter(one_letter()).select(*scope, *PAIR, F.col("code_lo").alias("code"))


def letter_counts(clear: DataFrame, keys: list[str]) -> DataFrame:
    """Customers of either letter per merchant, 0 where there is none."""
    return clear.groupBy(*keys).agg(
        F.count_if(F.col("code") == ord("F")).cast("int").alias("F"),
        F.count_if(F.col("code") == ord("M")).cast("int").alias("M"),
    )


def is_skewed(limits: Thresholds) -> Column:
    return (F.col("F") > limits.min_female) & (F.col("F") < F.col("M"))


def gender_distribution(clear: DataFrame, merchants: DataFrame) -> DataFrame:
    """Customers per letter of the first merchant by id, as a spot check of a detection."""
    first = merchants.select("merchantId").orderBy("merchantId").limit(1)
    rows = clear.join(F.broadcast(first), "merchantId", "left_semi")  # one row
    counts = rows.groupBy("code").agg(F.count(F.lit(1)).alias("customers"))
    return counts.select(letter_of(F.col("code")).alias("gender"), "customers")


def skewed_merchants(
    clear: DataFrame, limits: Thresholds, clock: Clock, scope: tuple[str, ...] = ()
) -> DataFrame:
    """Detections from customers of one clear gender."""
    skewed = letter_counts(clear, [*scope, "merchantId"]).filter(is_skewed(limits))
    return to_detections(skewed, "gender_skew", clock, customer=F.lit(""), scope=scope)


def gender_skew(pairs: PairTable, limits: Thresholds, clock: Clock, opts: Options) -> DataFrame:
    clear = by_stripped_ids(pairs, opts).filter(one_letter()).withColumnRenamed("code_lo", "code")
    return skewed_merchants(clear, limits, clock, pairs.scope)
