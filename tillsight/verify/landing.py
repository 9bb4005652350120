"""A replay helper: chunk files as a producer would land them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def land(chunked: DataFrame, path: str, reverse: bool = False) -> int:
    """Append the chunks to a landing folder in one job, each whole in one file.

    Files follow the chunks in their names, or with `reverse` the other way round; a stream with
    chunk numbers needs no order among them. Returns the number of chunks.
    """
    chunks = chunked.select("chunk_id").distinct().count()
    order = F.desc("chunk_id") if reverse else F.asc("chunk_id")
    rows = chunked.repartitionByRange(max(chunks, 1), order)
    rows.write.mode("append").option("header", True).option("emptyValue", "").csv(path)
    return chunks


def land_named(spark: SparkSession, rows: DataFrame, path: str, size: int) -> None:
    """Rows with a 1-based `seq` as files `chunk_<first row>.csv` of at most `size` rows, `seq` not in them."""
    first = (F.col("seq") - 1) - F.pmod(F.col("seq") - 1, F.lit(size))
    draft = f"{path}-draft"
    (
        rows.withColumn("_first", first)
        .repartition("_first")
        .sortWithinPartitions("_first", "seq")
        .drop("seq")
        .write.partitionBy("_first")
        .mode("overwrite")
        .option("header", True)
        .option("emptyValue", "")
        .csv(draft)
    )
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    store = path_of(draft).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path_of(path))
    for folder in store.listStatus(path_of(draft)):
        name = folder.getPath().getName()
        if name.startswith("_first="):
            for file in store.listStatus(folder.getPath()):
                if file.getPath().getName().endswith(".csv"):
                    store.rename(file.getPath(), path_of(f"{path}/chunk_{name.removeprefix('_first=')}.csv"))
