"""The live detector: equal to batch, emitted once, exact files, safe to restart and repeat."""

import os

import pytest
from make import OFF
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tillsight import Clock, Options, Thresholds, Workspace, detect
from tillsight.operators.pairs import pair_state
from tillsight.plans.cumulative import cumulative
from tillsight.schemas import DETECTION_COLUMNS, DETECTION_KEYS
from tillsight.settings import PATTERNS
from tillsight.sources.tables import stream_transactions
from tillsight.streaming.live import LiveConfig, LiveDetector
from tillsight.verify.landing import land

SF = "/root/testdata/sf0.001"
OPTS = Options(amount_scale=2)
LIMITS = Thresholds(150, max_avg_amount=35, min_pair_txns=6, min_female=2)
COLUMNS = ["chunk_id", "customer", "merchant", "category", "amount", "gender"]
CHUNKS = 4


@pytest.fixture(scope="module")
def feed(spark):
    """sf0.001 events in four chunks, the importance table, and each chunk's expected keys."""
    from tillsight.sources.samples import event_importance
    from tillsight.verify.queries import chunked_events

    ws = Workspace(spark)
    rows = spark.read.parquet(f"{SF}/events.parquet").count()
    chunks = ws.save(chunked_events(spark, SF, ws, -(-rows // CHUNKS)), "chunks")
    weights = ws.save(event_importance(spark, SF), "weights")
    fired = cumulative(chunks, weights, LIMITS, Clock("", ""), OPTS)
    first = {}
    for r in fired.orderBy("chunk_id").collect():
        first.setdefault(tuple(r[k] for k in DETECTION_KEYS), r["chunk_id"])
    return chunks, weights, first


def clock(batch_id):
    return Clock(f"start {batch_id}", f"seen {batch_id}")


def detector(spark, weights, ws, clock=clock, **config):
    config = {"patterns": PATTERNS, "at_end": (), "file_rows": 7, **config}
    return LiveDetector(
        spark, weights, ws.path("live"), LiveConfig(LIMITS, OPTS, **config), clock=clock
    )


def stream(spark, ws):
    return stream_transactions(spark, ws.path("landing"), COLUMNS)


def emitted(live):
    rows = live.emitted().collect()
    keys = [tuple(r[k] for k in DETECTION_KEYS) for r in rows]
    assert len(keys) == len(set(keys))
    assert sorted(r["seq"] for r in rows) == list(range(1, len(rows) + 1))
    return {k: r["step"] // 2 for k, r in zip(keys, rows)}


def file_sizes(live):
    if not os.path.isdir(live.files()):
        return []
    sizes = {}
    for name in os.listdir(live.files()):
        if name.startswith("file_id="):
            parts = [p for p in os.listdir(f"{live.files()}/{name}") if p.endswith(".csv")]
            assert len(parts) == 1
            with open(f"{live.files()}/{name}/{parts[0]}") as f:
                sizes[int(name[8:])] = len(f.read().splitlines()) - 1
    return [sizes[i] for i in range(len(sizes))]


def test_straight_run(spark, ws, feed):
    chunks, weights, first = feed
    assert len(first) > 20 and len(set(first.values())) > 2
    land(chunks, ws.path("landing"))
    live = detector(spark, weights, ws)
    live.start(stream(spark, ws), availableNow=True).awaitTermination()
    assert emitted(live) == first
    assert file_sizes(live) == [7] * (len(first) // 7)
    live.finish()
    rest = len(first) % 7
    assert file_sizes(live) == [7] * (len(first) // 7) + ([rest] if rest else [])
    rows = [r for r in live.progress().orderBy("step").collect() if r["step"] % 2 == 0]
    assert [r["total_rows"] for r in rows][-1] == chunks.count()
    assert rows[-1]["total_detections"] == len(first)
    # what is in force after the last chunk was emitted at some time, and equals batch
    now = detect(chunks, weights, LIMITS, Clock("", ""), OPTS)
    current = {tuple(r) for r in now.select(*DETECTION_KEYS).collect()}
    assert current <= set(first)
    # stamped with the clock of its micro-batch; files in sequence order
    stamps = {(r["step"], r["YStartTime"], r["detectionTime"]) for r in live.emitted().collect()}
    assert all(t == (t[0], f"start {t[0] // 2}", f"seen {t[0] // 2}") for t in stamps)
    table = live.emitted().orderBy("seq").select("merchantId", "file_id").collect()
    files = spark.read.option("header", True).csv(live.files())
    assert files.columns == [*DETECTION_COLUMNS, "file_id"]
    got = {}
    for r in files.collect():
        got.setdefault(r["file_id"], []).append(r["merchantId"])
    expected = {}
    for r in table:
        expected.setdefault(r["file_id"], []).append(r["merchantId"])
    assert got == expected


def test_restart_and_part_file(spark, ws, feed):
    chunks, weights, first = feed
    land(chunks.filter("chunk_id < 2"), ws.path("landing"))
    early = {k: c for k, c in first.items() if c < 2}
    live = detector(spark, weights, ws)
    live.run(stream(spark, ws))
    assert emitted(live) == early
    assert sum(file_sizes(live)) == len(early)
    for k in (2, 3):
        one = chunks.filter(F.col("chunk_id") == k)
        one.coalesce(1).write.mode("append").option("header", True).csv(ws.path("landing"))
    again = detector(spark, weights, ws)
    again.run(stream(spark, ws))
    assert emitted(again) == first
    rest = len(first) % 7
    assert file_sizes(again) == [7] * (len(first) // 7) + ([rest] if rest else [])


def test_failure_resumes(spark, ws, feed):
    chunks, weights, first = feed
    land(chunks, ws.path("landing"))

    def failing(batch_id):
        if batch_id == 2:
            raise RuntimeError("poison")
        return clock(batch_id)

    live = detector(spark, weights, ws, clock=failing)
    with pytest.raises(StreamingQueryException):
        live.start(stream(spark, ws), availableNow=True).awaitTermination()
    assert emitted(live) == {k: c for k, c in first.items() if c < 2}
    live = detector(spark, weights, ws)
    live.run(stream(spark, ws))
    assert emitted(live) == first


def test_child_at_the_end(spark, ws, feed):
    chunks, weights, first = feed
    land(chunks, ws.path("landing"))
    live = detector(spark, weights, ws, patterns=("upgrade", "gender_skew"), at_end=("child",))
    live.run(stream(spark, ws))
    live.finish()  # closing twice changes nothing
    found = emitted(live)
    child = detect(chunks, weights, LIMITS, Clock("", ""), OPTS, patterns=("child",))
    expected = {k: c for k, c in first.items() if k[0] != "PatId2"}
    expected |= {tuple(r): CHUNKS - 1 for r in child.select(*DETECTION_KEYS).collect()}
    assert found == expected
    last = live.emitted().filter("patternId = 'PatId2'").select("step").distinct().collect()
    assert [r["step"] for r in last] == [2 * (CHUNKS - 1) + 1]


def test_chunk_scope(spark, ws, feed):
    chunks, weights, _ = feed
    land(chunks, ws.path("landing"))
    lim = Thresholds(30, max_avg_amount=40, min_pair_txns=2, min_female=1)
    config = LiveConfig(
        lim, OPTS, scope="chunk", patterns=PATTERNS, at_end=(), emit_once=False, file_rows=7
    )
    live = LiveDetector(spark, weights, ws.path("live"), config, clock=clock)
    live.run(stream(spark, ws))
    got = sorted(tuple(r) for r in live.emitted().selectExpr("step div 2", *DETECTION_KEYS).collect())
    batch = detect(chunks, weights, lim, Clock("", ""), OPTS, scope=("chunk_id",))
    assert got == sorted(tuple(r) for r in batch.select("chunk_id", *DETECTION_KEYS).collect())
    assert len(got) > len({g[1:] for g in got})
    last = live.progress().orderBy("step").collect()[-1]
    assert last["total_rows"] == chunks.count() and last["total_detections"] == len(got)


def states(spark, *histories):
    """Pair state after each step, from (customer, gender) rows of one merchant."""
    for rows in histories:
        txns = spark.createDataFrame(
            [(c, "'M'", "'t'", 1.0, g) for c, g in rows],
            "customer string, merchant string, category string, amount double, gender string",
        )
        yield pair_state(txns, OPTS)


def test_repeated_batch_and_returning_detection(spark, ws):
    f = [("'f1'", "'F'"), ("'f2'", "'F'")]
    m = [("'m1'", "'M'"), ("'m2'", "'M'"), ("'m3'", "'M'")]
    more_f = [("'f3'", "'F'"), ("'f4'", "'F'")]
    more_m = [("'m4'", "'M'"), ("'m5'", "'M'")]
    lim = Thresholds(**{**OFF, "min_female": 1})
    config = LiveConfig(lim, OPTS, patterns=("gender_skew",), at_end=())
    live = LiveDetector(
        spark, spark.createDataFrame([], "Source string, Target string, Weight double, typeTrans string"),
        ws.path("live"), config, clock=clock,
    )
    steps = list(states(spark, f + m, f + m + more_f, f + m + more_f + more_m))
    live.process(steps[0], 0)
    live.finish()
    live.process(steps[0], 0)
    live.process(steps[1], 1)  # women are no longer fewer
    live.process(steps[2], 2)  # fewer again
    live.process(steps[2], 2)
    rows = live.emitted().collect()
    assert [(r["merchantId"], r["step"], r["seq"]) for r in rows] == [("M", 0, 1)]
    assert [r["total_rows"] for r in live.progress().filter("step % 2 = 0").orderBy("step").collect()] == [5, 7, 9]


def test_polling_trigger(spark, ws, feed):
    chunks, weights, first = feed
    land(chunks.filter("chunk_id < 1"), ws.path("landing"))
    live = detector(spark, weights, ws)
    query = live.start(stream(spark, ws), processingTime="0.5 seconds")
    try:
        query.processAllAvailable()
        assert emitted(live) == {k: c for k, c in first.items() if c < 1}
        one = chunks.filter("chunk_id = 1").coalesce(1)
        one.write.mode("append").option("header", True).csv(ws.path("landing"))
        query.processAllAvailable()
        assert emitted(live) == {k: c for k, c in first.items() if c < 2}
    finally:
        query.stop()


def test_configurations_are_checked():
    with pytest.raises(ValueError):
        LiveConfig(LIMITS, scope="window")
    with pytest.raises(ValueError):
        LiveConfig(LIMITS, scope="chunk")
    with pytest.raises(ValueError):
        LiveConfig(LIMITS, patterns=("other",))


def test_chunks_are_taken_in_order_of_their_numbers(spark, ws, feed):
    chunks, weights, first = feed
    for k in (3, 1):  # early chunks wait
        land(chunks.filter(F.col("chunk_id") == k), ws.path("landing"))
    live = detector(spark, weights, ws)
    live.start(stream(spark, ws), availableNow=True).awaitTermination()
    assert emitted(live) == {} and live.waiting() == [1, 3]
    land(chunks.filter("chunk_id = 0"), ws.path("landing"))
    live = detector(spark, weights, ws)
    live.start(stream(spark, ws), availableNow=True).awaitTermination()
    assert emitted(live) == {k: c for k, c in first.items() if c < 2} and live.waiting() == [3]
    land(chunks.filter("chunk_id = 1"), ws.path("landing"))  # came before
    land(chunks.filter("chunk_id = 2"), ws.path("landing"))
    live.run(stream(spark, ws))
    assert emitted(live) == first and live.waiting() == []
    assert live.progress().agg(F.max("total_rows")).first()[0] == chunks.count()


def test_rules_only_at_the_end(spark, ws, feed):
    chunks, weights, _ = feed
    land(chunks, ws.path("landing"))
    live = detector(spark, weights, ws, patterns=(), at_end=("child",))
    live.run(stream(spark, ws))
    found = {r["patternId"] for r in live.emitted().collect()}
    assert found == {"PatId2"}
