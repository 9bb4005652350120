"""Batch and streaming readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.functions.ids import gender_letter, unquote
from tillsight.schemas import IMPORTANCE, TRANSACTIONS
from tillsight.settings import CHUNK_ROWS, Options


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, matched by column name; all columns text, no inference pass."""
    return spark.read.option("header", True).csv(path)


def typed(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Give the declared columns their types (bad values become null); others pass through."""
    missing = [f.name for f in declared if f.name not in df.columns]
    if missing:
        raise ValueError(f"input lacks the columns {missing}")
    return df.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in declared})


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return typed(read_csv(spark, path), TRANSACTIONS)


def read_importance(spark: SparkSession, path: str) -> DataFrame:
    return typed(read_csv(spark, path), IMPORTANCE)


def register(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Load several CSV datasets and expose each as a temporary view of its name."""
    frames = {name: read_csv(spark, path) for name, path in paths.items()}
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames


def stream_transactions(
    spark: SparkSession, folder: str, columns: list[str], files_per_batch: int = 1
) -> DataFrame:
    """Chunk files of a folder as a stream, oldest first, `files_per_batch` to a micro-batch.

    `columns` is the header of the chunk files, in file order. A `chunk_id` among them orders the
    stream; then each row also tells the file it came in.
    """
    stream = _file_stream(spark, folder, columns, files_per_batch)
    if "chunk_id" in columns:
        source = F.col("_metadata.file_name").alias("source_file")
        stream = stream.select("*", source).withColumn("chunk_id", F.col("chunk_id").cast("long"))
    return typed(stream, TRANSACTIONS)


def _file_stream(
    spark: SparkSession, folder: str, columns: list[str], files_per_batch: int, names: str = "*"
) -> DataFrame:
    raw = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.readStream.schema(raw)
        .option("header", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", names)
        .csv(folder)
    )


def row_offset(file_name: Column) -> Column:
    """The number of the first row in the name of a chunk file, `chunk_<row>.csv`; null for other names."""
    digits = F.regexp_extract(file_name, r"^chunk_(\d+)\.csv$", 1)
    return F.when(digits != "", digits.try_cast("long"))


def stream_named_chunks(
    spark: SparkSession, folder: str, columns: list[str], chunk_rows: int = CHUNK_ROWS, files_per_batch: int = 1
) -> DataFrame:
    """Files `chunk_<row>.csv` of a folder as a stream ordered by the row numbers in their names.

    A file holds rows of one chunk, from the row in its name on; a chunk may come in several files. Files
    of other names are not read.
    """
    name = F.col("_metadata.file_name")
    place = row_offset(name)
    stream = _file_stream(spark, folder, columns, files_per_batch, "chunk_*.csv").select(
        "*",
        F.floor(place / chunk_rows).cast("long").alias("chunk_id"),
        place.alias("row_offset"),
        name.alias("source_file"),
    )
    return typed(stream, TRANSACTIONS)


def normalize_transactions(txns: DataFrame, opts: Options, scope: tuple[str, ...] = ()) -> DataFrame:
    """Uniform names for what the rules read; `gender` becomes one letter."""
    clean = opts.id_style == "clean"
    ident = unquote if clean else F.col
    letter = F.substring(unquote("gender"), 1, 1) if clean else gender_letter("gender")
    return txns.select(
        *scope,
        ident("customer").alias("customerId"),
        ident("merchant").alias("merchantId"),
        F.col("category").alias("transactionType"),
        F.col("amount").try_cast("double").alias("amount"),
        letter.alias("gender"),
    )


def normalize_importance(importance: DataFrame, opts: Options) -> DataFrame:
    ident = unquote if opts.id_style == "clean" else F.col
    return importance.select(
        ident("Source").alias("customerId"),
        ident("Target").alias("merchantId"),
        F.col("Weight").try_cast("double").alias("weight"),
        F.col("typeTrans").alias("transactionType"),
    )
