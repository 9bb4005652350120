"""Sequence numbers, running sums, chunks and exact files."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tillsight.operators.batches import in_files, write_files
from tillsight.operators.chunks import assign_chunks, stream_progress, write_chunks
from tillsight.verify.landing import land
from tillsight.operators.ordering import global_sequence, running_sums
from tillsight.schemas import DETECTION_COLUMNS


def test_global_sequence(spark, ws):
    values = random.Random(3).sample(range(10**6), 5000)
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    got = {r["v"]: r["seq"] for r in global_sequence(df, ["v"], ws).collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(values))}


def test_sequence_of_nothing(spark, ws):
    assert global_sequence(spark.createDataFrame([], "v long"), ["v"], ws).collect() == []


def test_sequence_crosses_partitions(spark, ws):
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in plain}
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        numbered = global_sequence(spark.range(3000).toDF("v"), [F.desc("v")], ws)
        assert numbered.filter(F.col("seq") != 3000 - F.col("v")).count() == 0
        assert numbered.count() == 3000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_running_sums_of_a_hot_group(spark, ws):
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in plain}
    rng = random.Random(4)
    rows = [("hot" if i % 3 else f"g{i % 5}", i, rng.randrange(9)) for i in range(3000)]
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        df = spark.createDataFrame(rows, "g string, i long, c long")
        summed = running_sums(df, ["g"], F.col("i").asc(), ["c"], ws)
        got = {(r["g"], r["i"]): (r["before_c"], r["all_c"]) for r in summed.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    totals, sums = {}, {}
    for g, i, c in rows:
        sums[g, i] = totals.get(g, 0)
        totals[g] = sums[g, i] + c
    assert got == {k: (s, totals[k[0]]) for k, s in sums.items()}


def test_chunks_are_consecutive(spark, ws):
    df = spark.range(25).toDF("v").repartition(4)
    rows = assign_chunks(df, ["v"], ws, 10).collect()
    assert {r["v"]: r["chunk_id"] for r in rows} == {v: v // 10 for v in range(25)}


@pytest.mark.parametrize("rows", [0, 49, 50, 51, 115])
def test_files_hold_exactly_fifty(spark, ws, rows):
    df = spark.range(rows).selectExpr(
        *[f"cast(id as string) AS {c}" for c in DETECTION_COLUMNS], "id"
    )
    held = in_files(df, ["id"], ws)
    sizes = {r["file_id"]: r["count"] for r in held.groupBy("file_id").count().collect()}
    assert sizes == {i: 50 for i in range(rows // 50)}
    flushed = in_files(df, ["id"], ws, flush=True)
    sizes = [r["count"] for r in flushed.groupBy("file_id").count().orderBy("file_id").collect()]
    assert sizes == [50] * (rows // 50) + ([rows % 50] if rows % 50 else [])
    assert flushed.filter(F.col("seq") != F.col("id") + 1).count() == 0


def test_written_files(spark, ws):
    df = spark.range(115).selectExpr(
        "'2025-07-15 23:55:06' AS YStartTime",
        "'2025-07-15 23:55:07' AS detectionTime",
        "'PatId3' AS patternId",
        "'DEI-NEEDED' AS actionType",
        "'' AS customerName",
        "concat('M', id) AS merchantId",
        "id",
    )
    path = ws.path("files")
    write_files(in_files(df, ["id"], ws, flush=True), path, DETECTION_COLUMNS)
    parts = {}
    for i in range(3):
        names = [n for n in os.listdir(f"{path}/file_id={i}") if n.endswith(".csv")]
        assert len(names) == 1
        with open(f"{path}/file_id={i}/{names[0]}") as f:
            parts[i] = f.read().splitlines()
    assert [len(p) for p in parts.values()] == [51, 51, 16]
    assert all(p[0] == ",".join(DETECTION_COLUMNS) for p in parts.values())
    lines = parts[0][1:] + parts[1][1:] + parts[2][1:]
    head = "2025-07-15 23:55:06,2025-07-15 23:55:07,PatId3,DEI-NEEDED,,M"
    assert lines == [f"{head}{i}" for i in range(115)]


def test_chunk_files(spark, ws):
    df = spark.range(25).selectExpr("id AS v", "id div 10 AS chunk_id")
    write_chunks(df, ws.path("chunks"), "v")
    for k, size in enumerate([10, 10, 5]):
        folder = ws.path(f"chunks/chunk_id={k}")
        names = [n for n in os.listdir(folder) if n.endswith(".csv")]
        assert len(names) == 1
        with open(f"{folder}/{names[0]}") as f:
            assert f.read().split() == ["v", *(str(10 * k + i) for i in range(size))]
    assert land(df, ws.path("landing")) == 3
    names = [n for n in os.listdir(ws.path("landing")) if n.endswith(".csv")]
    assert len(names) == 3


def test_progress(spark, ws):
    txns = spark.range(25).selectExpr("id div 10 AS chunk_id")
    found = spark.createDataFrame([(0,), (2,), (2,)], "chunk_id long")
    rows = stream_progress(txns, found, ws).orderBy("chunk_id").collect()
    assert [tuple(r) for r in rows] == [(0, 10, 1, 10, 1), (1, 10, 0, 20, 1), (2, 5, 2, 25, 3)]
