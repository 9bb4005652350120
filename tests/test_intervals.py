"""Cumulative rules as intervals, over a thousand chunks."""

import random

import pytest
from make import CLOCK

from tillsight import Options, Thresholds, detect
from tillsight.operators.dedup import held_once
from tillsight.plans.cumulative import SPAN, cumulative_intervals
from tillsight.schemas import DETECTION_KEYS

CHUNKS = 1_000
LIMITS = Thresholds(300, top_share=0.3, bottom_share=0.4, max_avg_amount=20, min_pair_txns=4, min_female=2)
OPTS = [Options(amount_scale=2), Options(broadcast_rows=0, window_rows=0, salts=3)]


@pytest.fixture(scope="module")
def data(spark):
    draw = random.Random(12)
    rows = []
    for k in range(CHUNKS):
        if k % 10 == 7:
            continue  # chunks without rows
        for _ in range(4):
            # Some merchants are touched by every chunk, some seldom.
            m = draw.choice([0, 0, 0, 1, 1, 2 + k % 30])
            c = int(draw.expovariate(0.08)) % 60
            rows.append((k, f"'C{c}'", f"'M{m}'", "'t'", draw.randrange(1, 6000) / 100, f"'{draw.choice('FFM') if c % 9 == 0 else 'FM'[c % 2]}'"))
    schema = "chunk_id long, customer string, merchant string, category string, amount double, gender string"
    weights = [(f"'C{c}'", f"'M{m}'", ((c * 7 + m) % 11) / 3, "'t'") for c in range(60) for m in range(4) if c % 8]
    return (
        spark.createDataFrame(rows, schema).repartition(3).cache(),
        spark.createDataFrame(weights, "Source string, Target string, Weight double, typeTrans string").cache(),
    )


@pytest.mark.parametrize("opts", OPTS)
def test_intervals_hold_what_each_chunk_reports(spark, ws, data, opts):
    txns, weights = data
    found = [r.asDict() for r in cumulative_intervals(txns, weights, LIMITS, CLOCK, opts, ws).collect()]
    assert {r["patternId"] for r in found} == {"PatId1", "PatId2", "PatId3"}
    assert all(0 <= r["first_chunk"] <= r["last_chunk"] < CHUNKS for r in found)
    # far fewer rows than chunks times detections, and none that overlap
    chunks = sum(r["last_chunk"] - r["first_chunk"] + 1 for r in found)
    assert chunks > 4 * len(found)
    held = {}
    for r in found:
        key = tuple(r[k] for k in DETECTION_KEYS)
        for k in range(r["first_chunk"], r["last_chunk"] + 1):
            assert k not in held.setdefault(key, set())
            held[key].add(k)
    for k in (0, 77, 300, 500, 997, 999):
        now = detect(txns.filter(f"chunk_id <= {k}"), weights, LIMITS, CLOCK, opts, ws)
        assert {tuple(r) for r in now.select(*DETECTION_KEYS).collect()} == {key for key, at in held.items() if k in at}, k


def test_held_once(spark):
    rows = [(1, 1, "a"), (5, 5, "b"), (7, 7, "b"), (2, 3, "c"), (4, 4, None)]
    df = spark.createDataFrame(rows, "first_chunk long, last_chunk long, k string")
    assert sorted((r.first_chunk, r.k) for r in held_once(df, *SPAN, ["k"]).collect()) == [(1, "a"), (4, None)]
