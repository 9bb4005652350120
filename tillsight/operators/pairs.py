"""Pair state: the one aggregate that all three rules read.

One row per (merchant, customer), with counts, amount sum and the lowest and highest gender
letter as code points. Every column merges by sum, min or max, so the same frame serves a whole table, one
chunk, or a stream's running history, and its size follows the number of pairs, not of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillsight.functions.ids import is_quoted, letter_code, strip_ends
from tillsight.settings import PATTERNS, Options
from tillsight.sources.tables import normalize_transactions
from tillsight.workspace import Workspace

PAIR = ("merchantId", "customerId")


def _uneven(odd: str = "odd", amount: str = "amount", n: str = "n_amount") -> Column:
    """Amounts that the exact sum does not hold; a sum lost to overflow counts as one."""
    lost = F.col(amount).isNull() & (F.col(n) > F.col(odd))
    return F.col(odd) + lost.cast("long")


# How each column of the state merges.
MERGE = {
    "n": lambda c: F.sum(c),
    "n_amount": lambda c: F.sum(c),
    "odd": lambda c: F.sum(_uneven()),
    "total": lambda c: F.sum(c),
    "amount": lambda c: F.try_sum(c),
    "code_lo": lambda c: F.min(c),
    "code_hi": lambda c: F.max(c),
}
# Amounts of more units than this are not summed exactly.
LARGEST_UNITS = 2.0**53


def pair_aggregates(opts: Options, patterns: tuple[str, ...] = PATTERNS) -> list[Column]:
    """What the patterns need of normalised transactions; all incremental, also on streams.

    With an amount scale, amounts that are whole numbers of the smallest unit are summed as such.
    `odd` counts the others (finer, very large, infinite or NaN); a pair that has any, or whose exact
    sum overflows, is judged by `total`, the sum of doubles over all its amounts.
    """
    found = [F.count(F.lit(1)).alias("n")]
    if "child" in patterns:
        amount = F.col("amount")
        found.append(F.count(amount).alias("n_amount"))
        if opts.amount_scale is None:
            found.append(F.sum(amount).alias("amount"))
        else:
            unit = F.lit(float(10**opts.amount_scale))
            units = F.rint(amount * unit)
            # NaN compares as larger than any bound, so it is not whole either.
            whole = (F.abs(units) <= LARGEST_UNITS) & (units / unit == amount)
            found += [
                F.try_sum(F.when(whole, units).cast("long")).alias("amount"),
                F.count_if(~whole).alias("odd"),
                F.sum(amount).alias("total"),
            ]
    if "gender_skew" in patterns:
        code = letter_code(F.col("gender"))
        found += [F.min(code).alias("code_lo"), F.max(code).alias("code_hi")]
    return found


def pair_state(
    txns: DataFrame,
    opts: Options,
    scope: tuple[str, ...] = (),
    patterns: tuple[str, ...] = PATTERNS,
) -> DataFrame:
    """Aggregate raw transactions to pairs, within each value of the scope columns.

    Map-side partial aggregation collapses a hot pair before the shuffle.
    """
    rows = normalize_transactions(txns, opts, scope)
    return rows.groupBy(*scope, *PAIR).agg(*pair_aggregates(opts, patterns))


def merge_pairs(pairs: DataFrame, keys: list[Column]) -> DataFrame:
    """Merge pair rows that share new keys."""
    return pairs.groupBy(*keys).agg(
        *[merge(F.col(c)).alias(c) for c, merge in MERGE.items() if c in pairs.columns]
    )


@dataclass(frozen=True)
class PairTable:
    """Written pair state.

    `stray_ids` tells whether any id lacks its quotes, `rows` counts the pairs and `txns` the
    transactions behind them.
    """

    df: DataFrame
    stray_ids: bool
    rows: int
    txns: int
    scope: tuple[str, ...] = ()


def pair_facts() -> list[Column]:
    """Aggregates that yield the facts of a PairTable."""
    stray = F.count_if(~(is_quoted("merchantId") & is_quoted("customerId")))
    return [stray.alias("stray"), F.count(F.lit(1)).alias("rows"), F.sum("n").alias("txns")]


def known_pairs(df: DataFrame, facts: dict, scope: tuple[str, ...] = ()) -> PairTable:
    stray, rows, txns = (facts.get(k) or 0 for k in ("stray", "rows", "txns"))
    return PairTable(df, stray > 0, rows, txns, scope)


def save_pairs(pairs: DataFrame, ws: Workspace, scope: tuple[str, ...] = ()) -> PairTable:
    """Write the pair state, and learn its facts in the same job."""
    seen = Observation()
    df = ws.save(pairs.observe(seen, *pair_facts()), "pairs")
    return known_pairs(df, seen.get, scope)


def by_stripped_ids(pairs: PairTable, opts: Options) -> DataFrame:
    """Pairs under the ids that the gender rule reports, null ids dropped.

    Stripping is positional. Among quoted ids it maps different ids to different results, so
    nothing has to be regrouped; with irregular ids two pairs may meet, and they are merged.
    """
    known = pairs.df.filter(F.col("merchantId").isNotNull() & F.col("customerId").isNotNull())
    if opts.id_style == "clean":
        return known
    stripped = known.withColumns({c: strip_ends(c) for c in PAIR})
    if not pairs.stray_ids:
        return stripped
    return merge_pairs(stripped, [F.col(c) for c in (*pairs.scope, *PAIR)])


def _exact() -> Column:
    return _uneven() == 0


def average_amount(opts: Options) -> Column:
    if opts.amount_scale is None:
        return F.try_divide(F.col("amount"), F.col("n_amount"))
    units = F.try_divide(F.col("amount").cast("double"), F.col("n_amount"))
    plain = F.try_divide(F.col("total"), F.col("n_amount"))
    return F.when(_exact(), units / F.lit(float(10**opts.amount_scale))).otherwise(plain)


def average_below(limit: float, opts: Options) -> Column:
    """`average amount < limit`, without rounding where the sum is exact."""
    if opts.amount_scale is None:
        return average_amount(opts) < F.lit(float(limit))
    units = Decimal(str(limit)).scaleb(opts.amount_scale)
    units = F.lit(int(units)) if units == int(units) else F.lit(units)
    # Multiplied up, so that nothing is divided; without amounts the sum is null and never below.
    exact = F.col("amount") < units * F.col("n_amount")
    plain = F.try_divide(F.col("total"), F.col("n_amount")) < F.lit(float(limit))
    return F.when(_exact(), exact).otherwise(plain)
