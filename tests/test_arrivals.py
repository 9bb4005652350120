"""Chunks told by file names, in several files, early, late, and repeated; and the tables kept in levels."""

import json
import os
import re

import pytest
from make import OFF
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight import Clock, Options, Thresholds
from tillsight.operators.levels import BUCKET, Journal, LevelStore
from tillsight.sources.tables import row_offset, stream_named_chunks, stream_transactions
from tillsight.streaming.live import LiveConfig, LiveDetector

COLUMNS = ["customer", "merchant", "category", "amount", "gender"]
NO_WEIGHTS = "Source string, Target string, Weight double, typeTrans string"
LIMITS = Thresholds(**{**OFF, "min_pair_txns": 3, "max_avg_amount": 50})


def put(folder, name, rows, chunk=None):
    """A chunk file of (customer, merchant) rows."""
    os.makedirs(folder, exist_ok=True)
    head = (["chunk_id"] if chunk is not None else []) + COLUMNS
    with open(f"{folder}/{name}", "w") as f:
        f.write(",".join(head) + "\n")
        for c, m in rows:
            f.write(",".join(([str(chunk)] if chunk is not None else []) + [f"'{c}'", f"'{m}'", "'t'", "1.0", "'F'"]) + "\n")


def detector(spark, ws, **config):
    config = {"patterns": ("child",), "at_end": (), **config}
    settings = LiveConfig(LIMITS, Options(amount_scale=2), **config)
    return LiveDetector(spark, spark.createDataFrame([], NO_WEIGHTS), ws.path("live"), settings, lambda k: Clock(f"{k}", ""))


def consume(live, spark, ws, files_per_batch=1):
    live.start(stream_named_chunks(spark, ws.path("in"), COLUMNS, 10, files_per_batch), availableNow=True).awaitTermination()
    return live


def fired(live):
    return sorted((r.customerName.strip("'"), r.merchantId.strip("'"), r.step) for r in live.emitted().collect())


def statuses(live):
    return sorted((r.chunk_id, r.source_file, r.rows, r.status) for r in live.arrivals().collect())


def total_rows(live):
    return live.progress().agg(F.max("total_rows")).first()[0]


A, B = [("a", "m")] * 2, [("b", "m")] * 2
FILL = [(f"x{k}", "n") for k in range(20)]


def test_row_offsets(spark):
    names = ["chunk_0.csv", "chunk_20000.csv", "chunk_x.csv", "chunk_5.csv.tmp", "achunk_5.csv", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(row_offset(F.col("n"))).collect()] == [0, 20000, None, None, None, None]


def test_named_files_run_in_order_of_rows(spark, ws):
    folder = ws.path("in")
    put(folder, "chunk_20.csv", A[:1] + FILL[:3])  # the last chunk, short
    put(folder, "chunk_14.csv", A[:1] + B[:1] + FILL[:4])  # second part of chunk 1
    put(folder, "other_0.csv", A * 50)
    live = consume(detector(spark, ws, chunk_rows=10), spark, ws)
    assert live.waiting() == [1, 2] and fired(live) == []
    assert live.gaps() == [(0, 10), (1, 4)]
    put(folder, "chunk_0.csv", A[:1] + B + FILL[:7])
    live = consume(detector(spark, ws, chunk_rows=10), spark, ws)
    assert live.waiting() == [1, 2] and live.gaps() == [(1, 4)] and total_rows(live) == 10
    put(folder, "chunk_10.csv", B[:1] + FILL[:3])
    live = consume(detector(spark, ws, chunk_rows=10), spark, ws)
    second = [("b", "m", 2)] + [(f"x{k}", "n", 2) for k in range(3)]
    assert fired(live) == second and live.waiting() == [2] and live.gaps() == []
    live.finish()
    assert fired(live) == [("a", "m", 4), *second]
    assert total_rows(live) == 24
    assert {s for *_, s in statuses(live)} == {"evaluated"}
    # the rest of the last chunk is late, and one file comes again under its name
    put(folder, "chunk_24.csv", A[:1] + FILL[10:15])
    put(f"{folder}/again", "chunk_10.csv", B[:1] + FILL[:3])
    live = detector(spark, ws, chunk_rows=10)
    again = stream_named_chunks(spark, f"{folder}{{,/again}}", COLUMNS, 10)
    live.start(again, availableNow=True).awaitTermination()
    live.finish()
    assert total_rows(live) == 30
    assert sorted(s for *_, s in statuses(live))[-2:] == ["late", "repeated"]


@pytest.mark.parametrize("per_batch", [1, 2])
def test_chunk_in_two_files_loses_no_row(spark, ws, per_batch):
    """Without a known chunk size, the second file is late at worst, and is counted."""
    folder = ws.path("in")
    put(folder, "one.csv", A + FILL[:6], 0)
    put(folder, "two.csv", A[:1] + B + FILL[6:9], 0)
    columns = ["chunk_id", *COLUMNS]
    live = detector(spark, ws)
    live.run(stream_transactions(spark, folder, columns, per_batch))
    assert total_rows(live) == 14
    assert ("a", "m") in {f[:2] for f in fired(live)}
    put(folder, "three.csv", B[:1] + FILL[:2], 1)
    put(folder, "one-again.csv", A + FILL[:6], 0)
    live = detector(spark, ws)
    live.run(stream_transactions(spark, folder, columns, per_batch))
    assert total_rows(live) == 17
    assert {f[:2] for f in fired(live)} == {("a", "m"), ("b", "m")}
    assert [s for *_, s in statuses(live)].count("repeated") == 1


def test_a_repeated_batch_counts_once(spark, ws):
    folder = ws.path("in")
    put(folder, "chunk_0.csv", A + FILL[:8])
    put(folder, "chunk_10.csv", A[:1] + FILL[8:17])
    live = detector(spark, ws, chunk_rows=10)
    schema = "customer string, merchant string, category string, amount double, gender string, chunk_id long, row_offset long, source_file string"
    rows = [(f"'{c}'", f"'{m}'", "'t'", 1.0, "'F'", k, 10 * k, f"chunk_{10 * k}.csv") for k, part in ((0, A + FILL[:8]), (1, A[:1] + FILL[8:17])) for c, m in part]
    batch = spark.createDataFrame(rows, schema)
    live.process_chunks(batch.filter("chunk_id = 0"), 0)
    live.process_chunks(batch, 1)  # chunk 0 comes again
    again = detector(spark, ws, chunk_rows=10)
    again.process_chunks(batch, 1)
    assert total_rows(again) == 20 and fired(again) == [("a", "m", 2)]
    assert [s for *_, s in statuses(again)].count("repeated") == 1


def test_only_touched_buckets_are_read_and_written(spark, ws):
    live = detector(spark, ws, chunk_rows=10, buckets=50)
    schema = "customer string, merchant string, category string, amount double, gender string, chunk_id long, row_offset long, source_file string"

    def chunk(k, merchants):
        rows = [(f"'c{i}'", f"'m{i % merchants}'", "'t'", 1.0, "'F'", k, 10 * k, f"{k}") for i in range(10)]
        live.process_chunks(spark.createDataFrame(rows, schema), k)

    opened = []
    read = live._pair_store(None).read
    live._pairs.read = lambda before=None, buckets=None: opened.append(buckets) or read(before, buckets)
    chunk(0, 10)
    chunk(1, 1)
    assert len(opened[0]) > 1 and len(opened[1]) == 1
    folders = os.listdir(ws.path("live/pairs/level=0/steps=2-2"))
    assert [f for f in folders if f.startswith("bucket=")] == [f"bucket={opened[1][0]}"]
    state = read(None, opened[1])
    names = {r[0] for r in state.select("bucket").collect()}
    assert names == set(opened[1])
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+", plan), plan


def test_a_refreshed_importance_counts_from_the_next_chunk(spark, ws):
    """Each step reads the newest version; a repeated one reads what it had read."""

    def weights(lowest):
        rows = [(f"'c{k}'", "'m'", 0.1 if k == lowest else 5.0 + k, "'t'") for k in range(4)]
        return spark.createDataFrame(rows, NO_WEIGHTS)

    def chunk(k):
        schema = "customer string, merchant string, category string, amount double, gender string, chunk_id long, row_offset long, source_file string"
        rows = [(f"'c{i}'", "'m'", "'t'", 1.0, "'F'", k, 10 * k, f"{k}") for i in range(4) for _ in range(3)]
        return spark.createDataFrame(rows, schema)

    def live():
        limits = Thresholds(**{**OFF, "min_merchant_txns": 5, "top_share": 1.0, "bottom_share": 0.2})
        settings = LiveConfig(limits, Options(amount_scale=2), patterns=("upgrade",), at_end=())
        return LiveDetector(spark, weights(0), ws.path("live"), settings, lambda k: Clock(f"{k}", ""))

    one = live()
    one.process_chunks(chunk(0), 0)
    assert one.refresh(weights(1)) == 1
    one.process_chunks(chunk(1), 1)
    assert fired(one) == [("c0", "m", 0), ("c1", "m", 2)]
    assert one.refresh(weights(2)) == 2
    # the last micro-batch is done again, by this detector's successor, and nothing of it changes
    again = live()
    again._progress.folder.remove(again._progress._name((0, 2, 2)))
    again.process_chunks(chunk(1), 1)
    assert fired(again) == [("c0", "m", 0), ("c1", "m", 2)]
    again.refresh(weights(3))
    again.process_chunks(chunk(2), 2)
    assert fired(again) == [("c0", "m", 0), ("c1", "m", 2), ("c3", "m", 4)]


def test_levels_keep_few_segments(spark, ws):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("n", T.LongType()), T.StructField(BUCKET, T.IntegerType())])
    merge = lambda df: df.groupBy("k", BUCKET).agg(F.sum("n").alias("n"))
    store = LevelStore(spark, ws.path("t"), schema, merge, buckets=True, fan=2)
    for step in range(21):
        rows = spark.createDataFrame([(step % 3, 1, step % 2), (7, 1, 1)], schema)
        found = store.append(rows, step, [F.count(F.lit(1)).alias("rows")])
        assert found["rows"] == 2
    assert store.segments() == [(4, 0, 15), (2, 16, 19), (0, 20, 20)]
    folders = [f"t/{d}/{s}" for d in os.listdir(ws.path("t")) if d.startswith("level=") for s in os.listdir(ws.path(f"t/{d}"))]
    known = {s for f in os.listdir(ws.path("t/manifest")) if f.endswith("json") for s in map(tuple, json.loads(store.folder.text(f"manifest/{f}")))}
    assert {f"t/{store._name(s)}" for s in known} == set(folders)  # those of the steps that are kept, no others
    assert len([f for f in os.listdir(ws.path("t/manifest")) if f.endswith("json")]) == 8
    assert {(r.k, r[BUCKET]): r.n for r in store.read().collect()}[(7, 1)] == 21
    # a step done again replaces what it and later ones had added
    store.append(spark.createDataFrame([(7, 5, 1)], schema), 19)
    assert store.last_step() == 19
    assert {(r.k, r[BUCKET]): r.n for r in LevelStore(spark, ws.path("t"), schema, merge, True).read().collect()}[(7, 1)] == 24
    assert LevelStore(spark, ws.path("none"), schema).read().collect() == []


def test_journal(spark, ws):
    schema = T.StructType([T.StructField("step", T.LongType()), T.StructField("x", T.StringType())])
    journal = Journal(spark, ws.path("j"), schema, fan=3)
    assert journal.last() is None and journal.read().collect() == []
    for step in range(0, 40, 2):
        journal.append([{"step": step, "x": f"é{step}"}], step)
    assert len(journal.segments()) <= 6
    assert sorted(r.step for r in journal.read().collect()) == list(range(0, 40, 2))
    assert journal.last()["x"] == "é38" and journal.last(5)["step"] == 4 and journal.last(0) is None
    journal.append([{"step": 7, "x": "new"}], 7)
    assert [r.step for r in journal.read().orderBy("step").collect()] == [0, 2, 4, 6, 7]
    assert json.loads(journal.folder.text(journal._name(journal.segments()[-1])).splitlines()[-1])["x"] == "new"
