"""Detections in files of exactly 50 rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.operators.ordering import global_sequence
from tillsight.workspace import Workspace

# Fixed value: rows per detection file.
FILE_ROWS = 50
# Files that one task writes, as their number counts there and not their few bytes.
TASK_FILES = 64


def file_of(seq: Column, size: int = FILE_ROWS) -> Column:
    """0-based file number of a 1-based sequence number."""
    return F.floor((seq - 1) / size).cast("long")


def in_files(
    detections: DataFrame,
    order: list[Column | str],
    ws: Workspace,
    flush: bool = False,
    size: int = FILE_ROWS,
) -> DataFrame:
    """Add `seq` and `file_id` first in, first out; without flush a part-filled file is held."""
    numbered = global_sequence(detections, order, ws)
    numbered = numbered.withColumn("file_id", file_of(F.col("seq"), size))
    if flush:
        return numbered
    rows = numbered.count()
    return numbered.filter(F.col("seq") <= rows - rows % size)


def write_files(numbered: DataFrame, path: str, columns: list[str], files: int = 1) -> None:
    """One CSV file per `file_id`, below `file_id=<i>`; a file written again is replaced. `files` is about
    their number, by which they are dealt to tasks."""
    (
        numbered.select(*columns, "file_id", "seq")
        .repartition(files // TASK_FILES + 1, "file_id")
        .sortWithinPartitions("file_id", "seq")
        .drop("seq")
        .write.partitionBy("file_id")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("emptyValue", "")
        .option("nullValue", "")
        .csv(path)
    )
