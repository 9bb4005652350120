"""From two CSV paths to detection files."""

import os

from make import CLOCK

from tillsight import Options, Thresholds, detect
from tillsight.jobs import run_batch, run_stream
from tillsight.schemas import DETECTION_COLUMNS, DETECTION_KEYS
from tillsight.settings import PATTERNS
from tillsight.sources.samples import event_importance
from tillsight.streaming.live import LiveConfig
from tillsight.verify.landing import land
from tillsight.verify.queries import chunked_events

SF = "/root/testdata/sf0.001"
LIMITS = Thresholds(150, max_avg_amount=35, min_pair_txns=6, min_female=2)
OPTS = Options(amount_scale=2)


def sizes(spark, files):
    rows = spark.read.option("header", True).csv(files)
    return [r["count"] for r in rows.groupBy("file_id").count().orderBy("file_id").collect()]


def test_batch_and_stream_end_to_end(spark, ws):
    chunks = ws.save(chunked_events(spark, SF, ws, 400), "chunks")
    weights = event_importance(spark, SF)
    txns, importance = ws.path("txns"), ws.path("importance")
    land(chunks, txns)
    weights.write.option("header", True).csv(importance)
    files = run_batch(spark, txns, importance, ws.path("out"), LIMITS, OPTS, clock=CLOCK)
    expected = {tuple(r) for r in detect(chunks, weights, LIMITS, CLOCK, OPTS).select(*DETECTION_COLUMNS).collect()}
    rows = spark.read.option("header", True).csv(files).fillna("", DETECTION_COLUMNS)
    assert {tuple(r) for r in rows.select(*DETECTION_COLUMNS).collect()} == expected
    assert sizes(spark, files) == [50] * (len(expected) // 50) + ([len(expected) % 50] if len(expected) % 50 else [])
    config = LiveConfig(LIMITS, OPTS, patterns=PATTERNS, at_end=())
    live = run_stream(spark, txns, importance, ws.path("live"), config)
    rows = spark.read.option("header", True).csv(live).fillna("", DETECTION_COLUMNS)
    keys = [tuple(r) for r in rows.select(*DETECTION_KEYS).collect()]
    assert len(keys) == len(set(keys)) and {e[2:] for e in expected} <= set(keys)
    assert all(n == 50 for n in sizes(spark, live)[:-1])


def test_a_workspace_can_be_removed(spark, ws):
    ws.save(spark.range(3), "some")
    assert os.path.isdir(ws.root)
    ws.remove()
    assert not os.path.exists(ws.root)
