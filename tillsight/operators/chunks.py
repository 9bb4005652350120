"""Consecutive fixed-size chunks of an ordered table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.operators.ordering import global_sequence, running_sums
from tillsight.settings import CHUNK_ROWS
from tillsight.workspace import Workspace


def assign_chunks(
    df: DataFrame, order: list[Column | str], ws: Workspace, size: int = CHUNK_ROWS
) -> DataFrame:
    """Add `seq` (1-based) and `chunk_id` (0-based) in the given total order."""
    numbered = global_sequence(df, order, ws)
    return numbered.withColumn("chunk_id", F.floor((F.col("seq") - 1) / size).cast("long"))


def stream_progress(txns: DataFrame, detections: DataFrame, ws: Workspace) -> DataFrame:
    """Rows and detections per chunk, with running totals over the chunks so far."""
    rows = txns.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("txns"))
    found = detections.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("detections"))
    per_chunk = rows.join(found, "chunk_id", "left").fillna(0, ["detections"])
    values = ["txns", "detections"]
    summed = running_sums(per_chunk, [], F.col("chunk_id").asc(), values, ws)
    totals = [(F.col(f"before_{v}") + F.col(v)).alias(f"total_{v}") for v in values]
    return summed.select("chunk_id", *values, *totals)


def write_chunks(chunked: DataFrame, path: str, order: str = "seq") -> None:
    """Every chunk as one CSV file below `chunk_id=<k>`, rows in order, all in one job."""
    (
        chunked.repartition("chunk_id")
        .sortWithinPartitions("chunk_id", order)
        .write.partitionBy("chunk_id")
        .option("header", True)
        .option("emptyValue", "")
        .csv(path)
    )
