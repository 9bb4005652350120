"""From two input paths to detection files, in one call or with spark-submit.

    spark-submit tillsight/jobs.py batch  TRANSACTIONS IMPORTANCE OUT
    spark-submit tillsight/jobs.py stream CHUNK_FOLDER IMPORTANCE OUT

Files hold exactly 50 detections, the last one the rest, and lie below `file_id=<i>` in order.
"""

from __future__ import annotations

import argparse
import re
from dataclasses import replace

from pyspark.sql import SparkSession

from tillsight.functions.times import read_clock
from tillsight.operators.batches import in_files, write_files
from tillsight.operators.levels import Folder
from tillsight.plans.detect import detect
from tillsight.schemas import DETECTION_COLUMNS
from tillsight.session import builder
from tillsight.settings import CHUNK_ROWS, PATTERNS, Clock, Options, Thresholds
from tillsight.sources.tables import (
    read_csv,
    read_importance,
    read_transactions,
    stream_named_chunks,
    stream_transactions,
)
from tillsight.streaming.live import LiveConfig, LiveDetector
from tillsight.workspace import Workspace

# Of one evaluation any total order will do; this one is reproducible.
ORDER = ["patternId", "merchantId", "customerName"]


def run_batch(
    spark: SparkSession,
    transactions: str,
    importance: str,
    out: str,
    limits: Thresholds = Thresholds(),
    opts: Options = Options(),
    patterns: tuple[str, ...] = PATTERNS,
    clock: Clock | None = None,
) -> str:
    """All rules over a transaction file; the folder of the detection files."""
    ws = Workspace(spark)
    start = read_clock()
    txns, weights = read_transactions(spark, transactions), read_importance(spark, importance)
    clock = clock or Clock(start, read_clock())
    found = ws.save(detect(txns, weights, limits, clock, opts, ws, patterns), "found")
    files = f"{out.rstrip('/')}/files"
    write_files(in_files(found, ORDER, ws, flush=True), files, DETECTION_COLUMNS)
    ws.remove()
    return files


def run_stream(
    spark: SparkSession,
    folder: str,
    importance: str,
    out: str,
    config: LiveConfig | None = None,
    columns: list[str] | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> str:
    """All chunk files of a folder in order, to the end; the folder of the detection files.

    Chunks are told by a column `chunk_id`, or else by files named `chunk_<first row>.csv`. `columns` is
    the header of the chunk files; by default that of a file that is there."""
    columns = columns or read_csv(spark, folder).columns
    config = config or LiveConfig(Thresholds())
    named = any(re.fullmatch(r"chunk_\d+\.csv", name) for name in Folder(spark, folder).names())
    if named and "chunk_id" not in columns:
        config = replace(config, chunk_rows=config.chunk_rows or chunk_rows)
        stream = stream_named_chunks(spark, folder, columns, config.chunk_rows)
    else:
        stream = stream_transactions(spark, folder, columns)
    live = LiveDetector(spark, read_importance(spark, importance), out, config)
    live.run(stream)
    return live.files()


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("mode", choices=["batch", "stream"])
    parser.add_argument("transactions")
    parser.add_argument("importance")
    parser.add_argument("out")
    args = parser.parse_args()
    spark = builder().getOrCreate()
    run = run_batch if args.mode == "batch" else run_stream
    print(run(spark, args.transactions, args.importance, args.out))
    spark.stop()


if __name__ == "__main__":
    main()
