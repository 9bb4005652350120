"""Chunks that come together are evaluated together, with the results of one after another."""

import pytest
from make import OFF
from pyspark.sql import functions as F
from test_arrivals import NO_WEIGHTS
from test_stream import COLUMNS, LIMITS, OPTS, clock, detector, emitted, feed, file_sizes  # noqa: F401

from tillsight import Clock, Options, Thresholds, detect
from tillsight.operators.batches import write_files
from tillsight.operators.ordering import number_placed, place_in_order
from tillsight.plans.cumulative import cumulative
from tillsight.schemas import DETECTION_KEYS
from tillsight.settings import PATTERNS
from tillsight.sources.tables import stream_transactions
from tillsight.streaming.live import LiveConfig, LiveDetector
from tillsight.verify.landing import land

ROWS = "customer string, merchant string, category string, amount double, gender string, chunk_id long, row_offset long, source_file string"


def backlog(spark, ws):
    return stream_transactions(spark, ws.path("landing"), COLUMNS, 10)


def rows_of(live):
    return sorted(map(str, live.emitted().drop("seq", "file_id").collect()))


def test_a_backlog_is_one_step_of_the_state(spark, ws, feed):  # noqa: F811
    chunks, weights, first = feed
    land(chunks, ws.path("landing"))
    live = detector(spark, weights, ws)
    live.run(backlog(spark, ws))
    assert live._pair_store().segments() == [(0, 0, 6)]
    assert emitted(live) == first
    progress = live.progress().filter("step % 2 = 0").orderBy("step").collect()
    assert [r["step"] for r in progress] == [0, 2, 4, 6]
    assert [r["detections"] for r in progress] == [list(first.values()).count(k) for k in range(4)]
    assert progress[-1]["total_rows"] == chunks.count()
    rest = len(first) % 7
    assert file_sizes(live) == [7] * (len(first) // 7) + ([rest] if rest else [])
    stamps = {(r["step"], r["YStartTime"], r["detectionTime"]) for r in live.emitted().collect()}
    assert all(t == (t[0], f"start {t[0] // 2}", f"seen {t[0] // 2}") for t in stamps)
    by_seq = [r["step"] for r in live.emitted().orderBy("seq").collect()]
    assert by_seq == sorted(by_seq)


@pytest.mark.parametrize("rows", [1, 600, 10**6])
def test_state_before_and_bounds(spark, ws, feed, rows):  # noqa: F811
    chunks, weights, first = feed
    land(chunks.filter("chunk_id < 1"), ws.path("landing"))
    detector(spark, weights, ws).run(backlog(spark, ws))
    land(chunks.filter("chunk_id >= 1"), ws.path("landing"), reverse=True)
    live = detector(spark, weights, ws, at_once=rows)
    live.run(backlog(spark, ws))
    assert emitted(live) == first
    assert live.progress().agg(F.max("total_rows")).first()[0] == chunks.count()


def test_every_chunk_without_emit_once(spark, ws, feed):  # noqa: F811
    chunks, weights, _ = feed
    land(chunks.filter("chunk_id < 1"), ws.path("landing"))
    detector(spark, weights, ws, emit_once=False).run(backlog(spark, ws))
    land(chunks.filter("chunk_id >= 1"), ws.path("landing"))
    live = detector(spark, weights, ws, emit_once=False)
    live.run(backlog(spark, ws))
    got = sorted(tuple(r) for r in live.emitted().selectExpr("step div 2", *DETECTION_KEYS).collect())
    every = cumulative(chunks, weights, LIMITS, Clock("", ""), OPTS)
    assert got == sorted(tuple(r) for r in every.select("chunk_id", *DETECTION_KEYS).collect())


def test_chunk_scope_of_a_backlog(spark, ws, feed):  # noqa: F811
    chunks, weights, _ = feed
    land(chunks, ws.path("landing"))
    lim = Thresholds(30, max_avg_amount=40, min_pair_txns=2, min_female=1)
    config = LiveConfig(lim, OPTS, scope="chunk", patterns=PATTERNS, at_end=(), emit_once=False, file_rows=7)
    live = LiveDetector(spark, weights, ws.path("live"), config, clock=clock)
    live.run(backlog(spark, ws))
    got = sorted(tuple(r) for r in live.emitted().selectExpr("step div 2", *DETECTION_KEYS).collect())
    batch = detect(chunks, weights, lim, Clock("", ""), OPTS, scope=("chunk_id",))
    assert got == sorted(tuple(r) for r in batch.select("chunk_id", *DETECTION_KEYS).collect())


def test_late_rows_a_failed_step_and_new_weights(spark, ws):
    """What is late, a version of the weights and a step that was not completed, as one chunk after another."""

    def weights(lowest):
        rows = [(f"'c{k}'", "'m'", 0.1 if k == lowest else 5.0 + k, "'t'") for k in range(4)]
        return spark.createDataFrame(rows, NO_WEIGHTS)

    def chunk(k, place, customers=range(4)):
        rows = [(f"'c{i}'", "'m'", "'t'", 1.0, "'F'", k, place, f"{k}-{place}") for i in customers for _ in range(3)]
        return spark.createDataFrame(rows, ROWS)

    def live(folder, at_once):
        limits = Thresholds(**{**OFF, "min_merchant_txns": 5, "top_share": 1.0, "bottom_share": 0.2, "min_pair_txns": 7, "max_avg_amount": 50})
        config = LiveConfig(limits, Options(amount_scale=2), patterns=("upgrade", "child"), at_end=(), at_once=at_once)
        return LiveDetector(spark, weights(0), ws.path(folder), config, lambda k: Clock(f"{k}", ""))

    found = []
    for folder, at_once in (("one", 1), ("more", 100)):
        first = live(folder, at_once)
        first.process_chunks(chunk(0, 0), 0)
        first.process_chunks(chunk(0, 5, [2, 7]), 1)  # late
        first.refresh(weights(1))
        batch = chunk(2, 20, [0, 3]).unionByName(chunk(1, 10, [1])).unionByName(chunk(3, 30, [2]))
        first.process_chunks(batch, 2)
        before = rows_of(first)
        # the micro-batch fails before it is told done, and comes again to another detector
        for name in first._progress.folder.names():
            if "steps-0-0" not in name:
                first._progress.folder.remove(name)
        again = live(folder, 20 if at_once > 1 else 1)
        again.process_chunks(batch, 2)
        assert rows_of(again) == before
        assert again.progress().agg(F.max("total_rows")).first()[0] == 30
        found.append(before)
    assert found[0] == found[1] and len(found[0]) == 3


def test_numbers_within_keys_that_share_a_slice(spark, ws):
    rows = spark.range(40).select((F.col("id") % 4).alias("k"), "id").coalesce(1)
    numbered = number_placed(ws.save(place_in_order(rows, ["k", "id"]), "placed"), ["k"])
    assert all(r["seq"] == r["id"] // 4 + 1 for r in numbered.collect())


def test_many_files_are_dealt_to_many_tasks(spark, ws):
    rows = spark.range(1, 401).selectExpr("cast(id as string) customerName", "id seq", "(id - 1) div 2 file_id")
    write_files(rows, ws.path("files"), ["customerName"], 200)
    parts = spark.read.option("header", True).csv(ws.path("files")).select("file_id", "_metadata.file_name").collect()
    assert len({r[0] for r in parts}) == 200 and len({r[1][:10] for r in parts}) > 1
