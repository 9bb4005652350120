"""Joining a large frame with a small table on a key that may be hot, and dealing what rows become evenly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.settings import Options

# Rows that one task makes where rows are multiplied.
TASK_ROWS = 500_000


def tasks_for(rows: int | None) -> int:
    """Tasks that share so many rows."""
    return max(1, -(-(rows or 0) // TASK_ROWS))


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    spread_by: str,
    small_rows: int,
    opts: Options,
    how: str = "inner",
    tasks: int | None = None,
) -> DataFrame:
    """Equi-join in which one key may hold a large part of `big`.

    `small_rows` is the counted size of `small`, or a proven bound on it. Up to the broadcast bound the big side is not
    shuffled at all. Beyond it both sides are shuffled on (keys, salt): each key's rows in `big`
    are spread over `salts` tasks by the hash of `spread_by`, and `small` is repeated per salt. With `tasks` the
    big side is dealt to so many in any case, by the keys and `spread_by`.
    """
    if small_rows <= opts.broadcast_rows:
        big = big if tasks is None else big.repartition(tasks, *keys, spread_by)
        return big.join(F.broadcast(small), keys, how)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(opts.salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(opts.salts - 1))))
    on = [*keys, "_salt"]
    if tasks is not None:
        salted, copies = salted.repartition(tasks, *on), copies.repartition(tasks, *on)
    return salted.join(copies, on, how).drop("_salt")
