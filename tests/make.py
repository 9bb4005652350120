"""Small hand-made inputs."""

from tillsight.schemas import IMPORTANCE, TRANSACTIONS
from tillsight.settings import Clock, Thresholds

CLOCK = Clock("2025-07-15 23:55:06", "2025-07-15 23:58:46")
# Large enough never to fire, so that a test can switch on one rule.
OFF = dict(min_merchant_txns=10**9, min_pair_txns=10**9, min_female=10**9)


def limits(**changed) -> Thresholds:
    return Thresholds(**{**OFF, **changed})


def txn(customer, merchant, amount=10.0, gender="'F'", times=1):
    return [(customer, merchant, "'es_food'", amount, gender)] * times


def transactions(spark, *groups):
    return spark.createDataFrame([row for group in groups for row in group], TRANSACTIONS)


def importance(spark, *rows):
    """Rows (customer, merchant, weight) or (customer, merchant, weight, type)."""
    full = [row if len(row) == 4 else (*row, "'es_food'") for row in rows]
    return spark.createDataFrame(full, IMPORTANCE)


def keys(df):
    """Detected (customer, merchant) pairs, sorted."""
    rows = df.select("customerName", "merchantId").collect()
    return sorted((r[0], r[1]) for r in rows)
