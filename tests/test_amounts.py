"""CHILD for every kind of amount, and importance cut down before it is averaged."""

import pytest
from make import CLOCK, limits, transactions, txn
from pyspark.sql import functions as F

from tillsight import Options
from tillsight.operators.pairs import merge_pairs, pair_state
from tillsight.plans.child import child
from tillsight.plans.cumulative import cumulative
from tillsight.verify.queries import QUERIES

NAN, INF = float("nan"), float("inf")
AMOUNTS = {
    "fine": [22.996, 22.996], "nan": [NAN, 1.0], "infinite": [INF, 1.0], "lowest": [-INF, 1.0],
    "large": [9e16, 9e16], "mixed": [22.99, 23.005], "above": [23.0, 23.001], "cents": [22.99, 23.0],
    "edge": [23.0, 23.0], "none": [None, None], "negative": [-9e15, -9e15], "sum": [9e15] * 1100,
}
EXPECTED = ["cents", "fine", "lowest", "mixed", "negative"]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def found(pairs, opts):
    rows = child(pairs, limits(min_pair_txns=2), CLOCK, opts).select("customerName").collect()
    return sorted(r[0] for r in rows)


@pytest.mark.parametrize("scale", [None, 0, 2, 3])
def test_child_is_right_for_every_amount(spark, ansi, scale):
    opts = Options(amount_scale=scale)
    rows = transactions(spark, *[txn(k, "'M'", a) for k, amounts in AMOUNTS.items() for a in amounts])
    assert found(pair_state(rows, opts), opts) == EXPECTED
    parts = pair_state(rows.withColumn("part", F.col("amount").isNull() | (F.col("amount") > 22.995)), opts, ("part",))
    assert found(merge_pairs(parts, [F.col("merchantId"), F.col("customerId")]), opts) == EXPECTED


def test_the_same_over_chunks(spark, ws):
    opts = Options(amount_scale=2)
    rows = transactions(spark, *[txn(k, "'M'", a) for k, amounts in AMOUNTS.items() for a in amounts[:2]])
    chunked = rows.withColumn("chunk_id", (F.monotonically_increasing_id() % 2).cast("long"))
    got = cumulative(chunked, None, limits(min_pair_txns=2), CLOCK, opts, ws, ("child",))
    last = got.groupBy("customerName").agg(F.max("chunk_id").alias("c")).where("c = 1").collect()
    assert sorted(r[0] for r in last) == EXPECTED


def test_importance_is_pruned_below_its_average(spark):
    plan = QUERIES["upgrade"](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    average = plan.index("functions=[avg(")
    assert "LeftSemi" in plan[average:]
