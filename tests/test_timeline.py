"""Order statistics over time, first times within a bound, and that no customer is repeated per touch."""

import random

import pytest
from make import CLOCK
from pyspark.sql import functions as F

from tillsight import Options, Thresholds
from tillsight.operators.ranking import percent
from tillsight.operators.timeline import Bounds, highest_place, value_over_time
from tillsight.plans.cumulative import SPAN, cumulative, version_intervals
from tillsight.schemas import DETECTION_KEYS
from tillsight.workspace import Workspace


@pytest.mark.parametrize("share", [0.0, 0.1, 0.25, 0.33335, 1.0, 2.0, -1.0])
def test_highest_places(spark, share):
    totals = spark.range(0, 60).withColumnRenamed("id", "t")
    of = [(percent, share), (lambda b, t: F.round(percent(b, t), 4), (int(share * 10_000) + 0.5) / 10_000)]
    for rank, about in of:
        every = totals.select("t", F.explode(F.sequence(F.lit(0), F.lit(60))).alias("p")).filter("p < t")
        every = every.filter(rank(F.col("p"), F.col("t")) <= share).groupBy("t").agg(F.max("p").alias("p"))
        found = totals.select("t", highest_place(share, rank, about)(F.col("t")).alias("p")).filter("p is not null")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, every.collect()))


def test_values_over_time(spark, ws):
    draw = random.Random(3)
    there, changes, asked, expected = {}, [], [], []
    for time in range(60):
        for _ in range(4):
            group, code = draw.choice(["a", None]), draw.randrange(600)
            there.setdefault(group, []).append(code)
            changes.append((group, time, code, 1))
        if time % 3 == 2 and there.get("a"):
            changes.append(("a", time, there["a"].pop(0), -1))
        if "a" in there and time % 2:
            asked.append(("a", time))
            expected.append(("a", time, sorted(there["a"])[len(there["a"]) // 3]))
    found = value_over_time(
        spark.createDataFrame(changes, "g string, t long, code long, change int"),
        spark.createDataFrame([("a", -1), *asked], "g string, t long"),
        ["g"], "t", 600, lambda total: F.when(total > 0, F.floor(total / 3)), ws,
    )
    assert sorted(map(tuple, found.select("g", "t", "code").collect())) == expected


@pytest.mark.parametrize("opts", [Options(), Options(broadcast_rows=0, salts=3)])
def test_first_and_all_times_within_bounds(spark, ws, opts):
    draw = random.Random(4)
    bounds = {("a", t): draw.randrange(100 if t % 700 else 200) for t in draw.sample(range(5000), 900)}
    rows = [("a", f"c{k}", draw.randrange(220), draw.randrange(5000)) for k in range(80)] + [("b", "c", 0, 0)]
    table = spark.createDataFrame([(*k, v) for k, v in bounds.items()], "g string, _time long, bound long")
    known = Bounds(table, ["g"], len(bounds), 5000, opts, ws)
    frame = spark.createDataFrame(rows, "g string, customerId string, code long, _from long")
    every = {(c, t) for g, c, code, start in rows for (h, t), bound in bounds.items() if g == h and t >= start and bound >= code}
    assert {(r.customerId, r._time) for r in known.all_met(frame).collect()} == every
    first = {c: min(t for d, t in every if d == c) for c, _ in every}
    assert {r.customerId: r._time for r in known.met(frame).collect()} == first
    assert 10 < len(first) < 81


def test_first_firings_write_no_row_per_touch(spark):
    """400 customers and 150 chunks that touch the one merchant: what is written grows with their rows."""
    saved = {}

    class Counted(Workspace):
        def save(self, df, name):
            found = super().save(df, name)
            saved[name] = max(saved.get(name, 0), found.count())
            return found

    limits = Thresholds(5, top_share=1.0, bottom_share=0.5, min_pair_txns=10**9, min_female=10**9)
    txns = spark.range(600).selectExpr(
        "id div 4 chunk_id", "concat(\"'c\", id % 400, \"'\") customer", "\"'m'\" merchant", "'t' category", "1.0D amount", "'F' gender"
    )
    weights = spark.range(400).selectExpr("concat(\"'c\", id, \"'\") Source", "\"'m'\" Target", "cast(id % 97 as double) Weight", "'t' typeTrans")
    held = cumulative(txns, weights, limits, CLOCK, Options(), None, ("upgrade",)).select("chunk_id", *DETECTION_KEYS).collect()
    first = {}
    for r in sorted(held, key=lambda r: r[0]):
        first.setdefault(tuple(r[1:]), r[0])
    for firings in (1, 2):
        ws = Counted(spark)
        found = version_intervals(txns, weights, limits, CLOCK, Options(), ws, ("upgrade",), firings)
        rows = ws.save(found.select(*SPAN, *DETECTION_KEYS), "found").collect()
        got = {}
        for r in sorted(rows, key=lambda r: r[0]):
            got.setdefault(tuple(r[2:]), r[0])
        assert got == first
    assert max(saved.values()) <= 1_200 < len(held), saved


@pytest.mark.parametrize("opts", [Options(), Options(broadcast_rows=0, salts=8)])
def test_rows_of_every_chunk_are_dealt_by_their_number(spark, monkeypatch, opts):
    """One merchant whose few customers fire, with rare touches, too: no task makes much more than its share."""
    monkeypatch.setattr("tillsight.operators.lookup.TASK_ROWS", 300)
    limits = Thresholds(5, top_share=1.0, bottom_share=0.5, max_avg_amount=5, min_pair_txns=3, min_female=10**9)
    txns = spark.range(1600).selectExpr(
        "(id div 4) * (1 + id div 800) chunk_id", "concat(\"'c\", id % 40, \"'\") customer", "\"'m'\" merchant", "'t' category", "1.0D amount", "'F' gender"
    )
    weights = spark.range(40).selectExpr("concat(\"'c\", id, \"'\") Source", "\"'m'\" Target", "cast(id as double) Weight", "'t' typeTrans")
    for pattern in ("upgrade", "child"):
        found = cumulative(txns, weights, limits, CLOCK, opts, None, (pattern,))
        made = [r[1] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(made) > 10_000 and max(made) < 2_500, made
