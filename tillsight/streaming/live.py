"""Detection on a stream of chunks with Structured Streaming.

A stream with chunk numbers is evaluated chunk by chunk in the order of these numbers, whatever order
its files come in: each micro-batch stores the pair state of the files it brings and notes them
(`arrivals`), and then every chunk that is next in line and whole is evaluated. Chunks that are whole together, as
when a backlog is read, are evaluated together: each still on what came up to it, but in one plan over
intervals of chunks (`plans.cumulative`). A stream without numbers goes by micro-batches, with a streaming
aggregate as its running state. In chunk scope each chunk is evaluated alone.

The running state of a numbered stream is a table in levels (`operators.levels`), bucketed by merchant. A
chunk adds what it changes; then only the buckets it touched are read and evaluated, as no rule fires
anew for a merchant without new rows. What was emitted is kept in the same way, by the same buckets.

Everything a micro-batch writes is keyed by its id or its chunk and overwritten if it is repeated, and it
reads only what earlier ones wrote. So results are the same after any restart.

    arrived/batch=<b>       pair state of the files of a micro-batch
    arrivals                a line per file: chunk, source, rows
    pairs                   running pair state of a numbered stream
    state/slot=<0|1>        without numbers: the newest snapshot and the one before
    emitted                 detections with their step; step = 2 * chunk id (or batch id), odd steps hold
                            what is added when a run is closed
    progress                rows and detections so far by step; makes the step's detections visible
    weights/version=<v>     average importance per pair, from the static table as it was published
    versions, used          lines that tell the versions published, and the one each step read
    files/file_id=<i>       CSV files of exactly 50 detections
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillsight.functions.ids import strip_ends
from tillsight.functions.times import read_clock
from tillsight.operators.batches import FILE_ROWS, file_of, write_files
from tillsight.operators.dedup import keep_first, not_seen
from tillsight.operators.levels import BUCKET, Journal, LevelStore
from tillsight.operators.ordering import number_placed, place_in_order
from tillsight.operators.pairs import (
    PAIR,
    PairTable,
    known_pairs,
    merge_pairs,
    pair_aggregates,
    pair_facts,
    pair_state,
    save_pairs,
)
from tillsight.plans.cumulative import SCOPE, history_of, intervals_of
from tillsight.plans.detect import detect_on_pairs
from tillsight.plans.upgrade import pair_weights
from tillsight.schemas import DETECTION_COLUMNS, DETECTIONS, TRANSACTIONS
from tillsight.settings import PATTERNS, Clock, Options, Thresholds
from tillsight.sources.tables import normalize_transactions
from tillsight.streaming.arrivals import CHUNK, PLACE, SOURCE, Arrival, Arrivals, notes_of
from tillsight.workspace import Workspace

STEP = T.StructField("step", T.LongType())
BUCKETED = T.StructField(BUCKET, T.IntegerType())
EMITTED = T.StructType([*DETECTIONS.fields, T.StructField("_at", T.LongType()), STEP, BUCKETED])
PROGRESS = T.StructType(
    [
        T.StructField("total_rows", T.LongType()),
        T.StructField("detections", T.LongType()),
        T.StructField("total_detections", T.LongType()),
        STEP,
        T.StructField("batch", T.LongType()),
    ]
)
VERSION = T.StructType([T.StructField("version", T.LongType())])
USED = T.StructType([STEP, T.StructField("version", T.LongType())])
# Buckets told by the bits of one long.
MASK_BITS = 62
# Within a micro-batch any total order will do; this one is reproducible.
ORDER = ["patternId", "merchantId", "customerName"]


@dataclass(frozen=True)
class LiveConfig:
    """What a stream evaluates.

    scope         "cumulative": everything seen so far; "chunk": each micro-batch alone.
    patterns      rules evaluated in every micro-batch.
    at_end        rules evaluated once, on everything, when the run is closed.
    emit_once     drop detections whose key was emitted before.
    chunk_rows    rows of a whole chunk; unknown, a chunk is whole with the first file that comes for it.
    buckets       parts of the running state and of what was emitted, by merchant.
    at_once       rows of chunks that are evaluated together, more if the first of them has more.
    """

    limits: Thresholds
    opts: Options = field(default_factory=Options)
    scope: str = "cumulative"
    patterns: tuple[str, ...] = ("upgrade", "gender_skew")
    at_end: tuple[str, ...] = ("child",)
    emit_once: bool = True
    file_rows: int = FILE_ROWS
    chunk_rows: int | None = None
    buckets: int = 16
    at_once: int = 5_000_000

    def __post_init__(self):
        if self.scope not in ("cumulative", "chunk"):
            raise ValueError(f"scope must be 'cumulative' or 'chunk', not {self.scope!r}")
        if self.scope == "chunk" and self.at_end:
            raise ValueError("at_end rules need the cumulative scope")
        if not set(self.patterns) | set(self.at_end) <= set(PATTERNS):
            raise ValueError(f"patterns must be some of {PATTERNS}")


@dataclass(frozen=True)
class Totals:
    rows: int
    detections: int
    repeated: bool


class LiveDetector:
    """One detection stream and its output folder, which must be shared by all executors."""

    def __init__(
        self,
        spark: SparkSession,
        importance: DataFrame,
        out: str,
        config: LiveConfig,
        clock: Callable[[int], Clock] | None = None,
    ):
        self.spark = spark
        self.importance = importance
        self.out = out.rstrip("/")
        self.config = config
        self.clock = clock
        self._last: tuple[int, Totals] | None = None
        self._published = False
        self._versions = Journal(spark, f"{self.out}/versions", VERSION, "version")
        self._used = Journal(spark, f"{self.out}/used", USED)
        self._emitted = LevelStore(spark, f"{self.out}/emitted", EMITTED, buckets=True, spread=False)
        self._progress = Journal(spark, f"{self.out}/progress", PROGRESS)
        self._arrived_schema: T.StructType | None = None
        self._pairs: LevelStore | None = None
        self.arrived = Arrivals(spark, f"{self.out}/arrivals", config.chunk_rows)

    # Tables of the output folder

    def _empty(self, schema: T.StructType) -> DataFrame:
        return self.spark.createDataFrame([], schema).coalesce(1)

    def emitted(self, after: int = 0) -> DataFrame:
        """Detections with a sequence number above `after`, with sequence, file and step."""
        known = self.progress().filter(F.col("total_detections") > after)
        known = known.select("step", (F.col("total_detections") - F.col("detections")).alias("_base"))
        placed = self._emitted.read().drop(BUCKET).join(known, "step")
        seq = F.col("seq") + F.col("_base")
        return (
            number_placed(placed, ["step"])
            .withColumn("seq", seq)
            .drop("_base")
            .filter(F.col("seq") > after)
            .withColumn("file_id", file_of(F.col("seq"), self.config.file_rows))
        )

    def progress(self) -> DataFrame:
        return self._progress.read()

    def files(self) -> str:
        return f"{self.out}/files"

    # One micro-batch

    def _workspace(self, step: int) -> Workspace:
        return Workspace(self.spark, f"{self.out}/work/slot={step % 4}")

    def _state_path(self, batch_id: int) -> str:
        return f"{self.out}/state/slot={batch_id % 2}"

    def _state(self, batch_id: int) -> PairTable:
        df = self.spark.read.parquet(self._state_path(batch_id))
        return known_pairs(df, df.agg(*pair_facts()).first().asDict())

    def _snapshot(self, batch: DataFrame, batch_id: int, ws: Workspace) -> PairTable:
        if self.config.scope == "chunk":
            return save_pairs(pair_state(batch, self.config.opts), ws)
        seen = Observation()
        path = self._state_path(batch_id)
        batch.observe(seen, *pair_facts()).write.mode("overwrite").parquet(path)
        return known_pairs(self.spark.read.schema(batch.schema).parquet(path), seen.get)

    def _detect(
        self, pairs: PairTable, step: int, start: str, patterns: tuple[str, ...], ws: Workspace
    ) -> DataFrame:
        clock = self.clock(step // 2) if self.clock else Clock(start, read_clock())
        if not patterns:
            return self._empty(DETECTIONS)
        limits, opts = self.config.limits, self.config.opts
        weights = self._pair_weights(step) if "upgrade" in patterns else None
        return detect_on_pairs(pairs, weights, limits, clock, opts, ws, patterns)

    def refresh(self, importance: DataFrame) -> int:
        """Publish a new version of the importance table, which later steps read; its number.

        Average weights are computed here, once for all steps."""
        version = (self._versions.last_step() if self._versions.segments() else -1) + 1
        weights = pair_weights(importance, self.config.opts)
        weights.write.mode("overwrite").parquet(self._weights_path(version))
        self._versions.append([{"version": version}], version)
        self._published = True
        return version

    def _weights_path(self, version: int) -> str:
        return f"{self.out}/weights/version={version}"

    def _pair_weights(self, step: int, last: int | None = None) -> DataFrame:
        """Average weights of the version this step reads, and all up to `last`: the newest one, or the same as
        before if the step is repeated."""
        known = self._used.last(step + 1)
        if known and known["step"] == step:
            version = known["version"]
        else:
            if not self._published:
                self.refresh(self.importance)
            version = self._versions.last_step()
            steps = range(step, (last or step) + 1, 2)
            self._used.append([{"step": s, "version": version} for s in steps], step, last)
        schema = pair_weights(self.importance, self.config.opts).schema
        return self.spark.read.schema(schema).parquet(self._weights_path(version))

    def _start_time(self) -> str:
        return "" if self.clock else read_clock()

    def _totals(self, step: int) -> Totals:
        """Totals over earlier steps, and whether this step was completed before.

        Right after a batch of this detector they are known; otherwise they are read.
        """
        if self._last and self._last[0] == step - 2:
            return self._last[1]
        row = self._progress.last(step)
        last = self._progress.last_step()
        return Totals(
            row["total_rows"] if row else 0, row["total_detections"] if row else 0, last is not None and last >= step
        )

    def _drop_files(self, first: int) -> None:
        """Empty the files from a number on, which a withdrawn close had filled."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.files())
        store = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        number = first
        while store.exists(jvm.org.apache.hadoop.fs.Path(folder, f"file_id={number}")):
            store.delete(jvm.org.apache.hadoop.fs.Path(folder, f"file_id={number}"), True)
            number += 1

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch body; safe to repeat for the same batch id."""
        start = self._start_time()
        step = 2 * batch_id
        totals = self._totals(step)
        if totals.repeated:
            # What closing the run may have added after this batch is withdrawn by adding this step anew.
            self._drop_files(totals.detections // self.config.file_rows)
        ws = self._workspace(step)
        pairs = self._snapshot(batch, batch_id, ws)
        found = self._detect(pairs, step, start, self.config.patterns, ws)
        rows = pairs.txns + (totals.rows if self.config.scope == "chunk" else 0)
        self._emit(found, step, totals, rows, batch_id)

    # Chunks in order

    def _done(self) -> int:
        """The last chunk evaluated, -1 before the first."""
        last = self._last[0] if self._last else self._progress.last_step()
        return -1 if last is None else last // 2

    def _last_batch(self) -> int:
        row = self._progress.last()
        return row["batch"] if row else -1

    def waiting(self) -> list[int]:
        """Chunks that have come, in part or whole, and wait."""
        return sorted(self.arrived.waiting)

    def gaps(self) -> list[tuple[int, int | None]]:
        """Chunks that keep later ones waiting, with the rows they lack, as far as that is known."""
        return self.arrived.gaps(self._done())

    def arrivals(self) -> DataFrame:
        """Every file that came: chunk, source, rows, micro-batch, and what became of it."""
        return self.arrived.table(self.progress(), self._done())

    def process_chunks(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch body for a stream with chunk numbers; safe to repeat for a batch id."""
        start = self._start_time()
        done = self._done()
        self.arrived.load(batch_id, self._last_batch(), done)
        path = f"{self.out}/arrived/batch={batch_id}"
        scope = tuple(c for c in (CHUNK, SOURCE, PLACE) if c in batch.columns)
        seen = Observation()
        pairs = pair_state(batch, self.config.opts, scope)
        stray = F.count_if(F.col(CHUNK).isNull()).alias("stray")
        pairs.observe(seen, stray).write.mode("overwrite").parquet(path)
        if seen.get.get("stray"):
            raise ValueError(f"micro-batch {batch_id} has rows without a chunk number")
        self._arrived_schema = pairs.schema
        notes = notes_of(self.spark.read.schema(pairs.schema).parquet(path), batch_id)
        self.arrived.add(notes, batch_id, done)
        while self.arrived.whole(done + 1):
            first, done = done + 1, self.arrived.last_whole(done + 1, self.config.at_once)
            if first == done:
                self._evaluate(done, 2 * done, batch_id, start, self.config.patterns)
            else:
                self._evaluate_together(first, done, batch_id, start)
            start = self._start_time()

    def _rows_of(self, files: list[Arrival]) -> DataFrame | None:
        """Pair state of some files, a row per file and pair."""
        found = None
        for batch in sorted({f.batch for f in files}):
            reader = self.spark.read if self._arrived_schema is None else self.spark.read.schema(self._arrived_schema)
            part = reader.parquet(f"{self.out}/arrived/batch={batch}")
            mine = [f for f in files if f.batch == batch]
            picked = F.lit(False)
            for file in mine:
                one = F.col(CHUNK) == file.chunk
                picked = picked | (one & F.col(SOURCE).eqNullSafe(F.lit(file.source)) if SOURCE in part.columns else one)
            part = part.filter(picked).drop(CHUNK, SOURCE, PLACE)
            found = part if found is None else found.unionByName(part)
        return found

    def _rows_by_chunk(self, files: list[tuple[int, Arrival]]) -> DataFrame:
        """Pair state of some files by the chunks they count in, in one scan of what has arrived."""
        batches = sorted({f.batch for _, f in files})
        reader = self.spark.read if self._arrived_schema is None else self.spark.read.schema(self._arrived_schema)
        rows = reader.option("basePath", f"{self.out}/arrived").parquet(*[f"{self.out}/arrived/batch={b}" for b in batches])
        named = SOURCE in rows.columns
        wanted = {(f.batch, f.chunk, f.source if named else None, to) for to, f in files}
        wanted = self.spark.createDataFrame(sorted(wanted, key=str), "_batch long, _chunk long, _source string, _to long")
        chunks = {f.chunk for _, f in files}
        rows = rows.filter(F.col(CHUNK).between(min(chunks), max(chunks)))
        same = (F.col("batch") == F.col("_batch")) & (F.col(CHUNK) == F.col("_chunk"))
        same = same & F.col(SOURCE).eqNullSafe(F.col("_source")) if named else same
        # A row per file, a few of the journal of arrivals.
        found = rows.join(F.broadcast(wanted), same).drop(CHUNK, "batch", SOURCE, PLACE, "_batch", "_chunk", "_source")
        found = found.withColumnRenamed("_to", CHUNK)
        return merge_pairs(found, [F.col(c) for c in (CHUNK, *PAIR)])

    def _bucket(self, merchant: Column) -> Column:
        """Merchants that a rule may take for one, by their stripped names, are in one bucket."""
        return F.pmod(F.xxhash64(merchant), F.lit(self.config.buckets)).cast("int").alias(BUCKET)

    def _state_bucket(self) -> Column:
        clean = self.config.opts.id_style == "clean"
        return self._bucket(F.col("merchantId") if clean else strip_ends("merchantId"))

    def _found_bucket(self) -> Column:
        stripped = (F.col("patternId") == "PatId3") | F.lit(self.config.opts.id_style == "clean")
        return self._bucket(F.when(stripped, F.col("merchantId")).otherwise(strip_ends("merchantId")))

    def _pair_store(self, schema: T.StructType | None = None) -> LevelStore:
        if self._pairs is None:
            if schema is None:
                schema = pair_state(self._empty(TRANSACTIONS), self.config.opts).schema
            merged = [F.col(c) for c in (*PAIR, BUCKET)]
            self._pairs = LevelStore(
                self.spark,
                f"{self.out}/pairs",
                T.StructType([*schema.fields, BUCKETED]),
                lambda df: merge_pairs(df, merged),
                buckets=True,
            )
        return self._pairs

    def _add_pairs(self, new: DataFrame, step: int, first: int | None = None) -> list[int]:
        """Add what has changed to the running state; the buckets it touches."""
        store = self._pair_store(new.schema)
        masks = [
            F.bit_or(
                F.when(
                    (F.col(BUCKET) >= low) & (F.col(BUCKET) < low + MASK_BITS),
                    F.expr(f"shiftleft(1L, {BUCKET} - {low})"),
                ).otherwise(0)
            ).alias(f"mask_{low}")
            for low in range(0, self.config.buckets, MASK_BITS)
        ]
        seen = store.append(new.withColumn(BUCKET, self._state_bucket()), step, masks, first)
        bits = [(low, seen.get(f"mask_{low}") or 0) for low in range(0, self.config.buckets, MASK_BITS)]
        return [low + k for low, mask in bits for k in range(MASK_BITS) if mask >> k & 1]

    def _evaluate(self, chunk: int | None, step: int, batch_id: int, start: str, patterns: tuple[str, ...]) -> None:
        """Add a chunk and what was late to the state, and evaluate what they touch.

        Without a chunk only late rows are added, and all that rules of the end may report is evaluated."""
        totals = self._totals(step)
        ws = self._workspace(step)
        files, late = self.arrived.take(chunk)
        rows = totals.rows + sum(f.rows for f in files + late)
        buckets = None
        if self.config.scope == "chunk":
            new = self._rows_of(files)
            pairs = save_pairs(merge_pairs(new, [F.col(c) for c in PAIR]) if len(files) > 1 else new, ws) if files else None
        else:
            if files or late:
                new = self._rows_of(files + late)
                if len(files) + len(late) > 1:
                    new = merge_pairs(new, [F.col(c) for c in PAIR])
                buckets = self._add_pairs(new, step)
            everything = chunk is None or not self.config.emit_once
            state = self._pair_store().read(buckets=None if everything else buckets)
            pairs = save_pairs(state.drop(BUCKET), ws)
        found = self._empty(DETECTIONS) if pairs is None else self._detect(pairs, step, start, patterns, ws)
        self._emit(found, step, totals, rows, batch_id, flush=chunk is None, buckets=None if chunk is None else buckets)

    def _evaluate_together(self, first: int, last: int, batch_id: int, start: str) -> None:
        """Evaluate chunks that are whole, each on what came up to it, with the results of one after another.

        What is late counts from the first of them. The state before them stands as a chunk of its own; what
        holds there is reported, as far as it is new, in the first chunk that touches its bucket."""
        config, step, end = self.config, 2 * first, 2 * last
        totals = self._totals(step)
        ws = self._workspace(step)
        files, late, counted = [], [], {}
        for chunk in range(first, last + 1):
            mine, more = self.arrived.take(chunk)
            files += [(chunk, f) for f in mine]
            late += [(chunk, f) for f in more]
            counted[chunk] = sum(f.rows for f in mine + more)
        patterns = config.patterns
        clock = Clock("", "") if self.clock else Clock(start, read_clock())
        weights = self._pair_weights(step, end) if "upgrade" in patterns else None
        buckets = None
        if config.scope == "chunk":
            new = save_pairs(self._rows_by_chunk(files), ws, SCOPE)
            if patterns:
                found = detect_on_pairs(new, weights, config.limits, clock, config.opts, ws, patterns)
        else:
            new = ws.save(self._rows_by_chunk(files + late), "new")
            buckets = self._add_pairs(merge_pairs(new.drop(CHUNK), [F.col(c) for c in PAIR]), end, step)
            buckets = buckets if config.emit_once else None
            if patterns:
                before = self._pair_store().read(step, buckets).drop(BUCKET).withColumn(CHUNK, F.lit(first - 1).cast("long"))
                history = history_of(new.unionByName(before.select(*new.columns)), ws)
                # Where the first interval is that of the state before, which may be dropped, the second counts.
                firings = 2 if config.emit_once else None
                held = intervals_of(history, weights, config.limits, clock, config.opts, ws, patterns, firings)
                found = self._reported(held, new, first)
        if not patterns:
            found = self._empty(DETECTIONS).withColumn(CHUNK, F.lit(None).cast("long"))
        elif self.clock:
            clocks = [(chunk, self.clock(chunk)) for chunk in counted]
            times = [(chunk, c.start, c.detected) for chunk, c in clocks]
            times = self.spark.createDataFrame(times, f"{CHUNK} long, YStartTime string, detectionTime string")
            # A row per chunk of these.
            found = found.drop("YStartTime", "detectionTime").join(F.broadcast(times), CHUNK)
        if config.emit_once:
            found = keep_first(found.select(CHUNK, *DETECTION_COLUMNS), CHUNK)
            found = not_seen(found, self._emitted.read(step, buckets))
        found = found.select(*DETECTION_COLUMNS, (F.col(CHUNK) * 2).cast("long").alias("step"))
        placed = place_in_order(found, ["step", *ORDER]).select(*DETECTION_COLUMNS, "_at", "step")
        self._emitted.append(placed.withColumn(BUCKET, self._found_bucket()), end, first=step)
        added = self._emitted.read().filter(F.col("step").between(step, end))
        added = dict(added.groupBy("step").agg(F.count(F.lit(1))).collect())
        rows, total, lines = totals.rows, totals.detections, []
        for chunk, read in counted.items():
            rows, total = rows + read, total + added.get(2 * chunk, 0)
            lines.append(dict(zip(PROGRESS.fieldNames(), (rows, added.get(2 * chunk, 0), total, 2 * chunk, batch_id))))
        self._progress.append(lines, step, end)
        self._fill_files(totals.detections, total, end)
        self._last = (end, Totals(rows, total, False))

    def _reported(self, held: DataFrame, new: DataFrame, first: int) -> DataFrame:
        """Intervals as the chunks that report them: every one, or with emit-once the one they begin in."""
        if not self.config.emit_once:
            begin = F.greatest("first_chunk", F.lit(first))
            held = held.filter(F.col("last_chunk") >= first)
            return held.withColumn(CHUNK, F.explode(F.sequence(begin, "last_chunk"))).drop("first_chunk", "last_chunk")
        # At most a row per bucket.
        touched = new.groupBy(self._state_bucket()).agg(F.min(CHUNK).alias("_touched"))
        held = held.withColumn(BUCKET, self._found_bucket()).join(F.broadcast(touched), BUCKET)
        held = held.withColumn(CHUNK, F.greatest("first_chunk", "_touched"))
        return held.filter(F.col(CHUNK) <= F.col("last_chunk")).drop(BUCKET, "_touched", "first_chunk", "last_chunk")

    def _emit(
        self,
        found: DataFrame,
        step: int,
        totals: Totals,
        rows: int,
        batch_id: int,
        flush: bool = False,
        buckets: list[int] | None = None,
    ) -> None:
        """Store new detections in order, tell their number, write the files they fill.

        Detections can only repeat earlier ones of the same buckets. Spark repeats the whole batch if any
        part of this fails.
        """
        if self.config.emit_once:
            found = not_seen(found, self._emitted.read(step, buckets))
        placed = place_in_order(found.select(*DETECTION_COLUMNS), ORDER).withColumn("step", F.lit(step).cast("long"))
        placed = placed.withColumn(BUCKET, self._found_bucket())
        new = self._emitted.append(placed, step, [F.count(F.lit(1)).alias("rows")]).get("rows") or 0
        total = totals.detections + new
        self._progress.append([dict(zip(PROGRESS.fieldNames(), (rows, new, total, step, batch_id)))], step)
        self._fill_files(totals.detections, total, step, flush)
        self._last = (step, Totals(rows, total, False))

    def _fill_files(self, before: int, total: int, step: int, flush: bool = False) -> None:
        """Write the files that detections up to a step fill."""
        size = self.config.file_rows
        first_open = before // size
        end = total // size + (1 if flush and total % size else 0)
        if end > first_open:
            due = self.emitted(first_open * size).filter(
                (F.col("step") <= step) & (F.col("file_id") < end)
            )
            write_files(due, self.files(), DETECTION_COLUMNS, end - first_open)

    # Running

    def start(self, stream: DataFrame, **trigger) -> StreamingQuery:
        """Start on a stream of transactions; `trigger` as for DataStreamWriter.trigger."""
        opts = self.config.opts
        mode, process = "append", self.process
        if "chunk_id" in stream.columns:
            process = self.process_chunks
        elif self.config.scope == "cumulative":
            stream = normalize_transactions(stream, opts).groupBy(*PAIR).agg(*pair_aggregates(opts))
            mode = "complete"
        return (
            stream.writeStream.outputMode(mode)
            .foreachBatch(process)
            .option("checkpointLocation", f"{self.out}/checkpoint")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def finish(self) -> None:
        """Close a run: rules for the end of the stream, then the last, part-filled file.

        Call it when the query has ended. A later run on the same folder goes on after it and
        completes the part-filled file.
        """
        numbered = self.arrived.store.last_step()
        if numbered is not None:
            self.arrived.load(numbered + 1, self._last_batch(), self._done())
            nxt = self._done() + 1
            if self.arrived.short_last(nxt):
                self._evaluate(nxt, 2 * nxt, numbered, self._start_time(), self.config.patterns)
        last = self._progress.last_step()
        if last is None:
            return
        batch_id = last // 2
        step = 2 * batch_id + 1
        if numbered is not None:
            again = self.arrived.late and self.config.scope != "chunk"
            patterns = tuple(p for p in PATTERNS if p in self.config.at_end or (again and p in self.config.patterns))
            if self.config.scope != "chunk" and patterns:
                self._evaluate(None, step, numbered, self._start_time(), patterns)
            else:
                late = self.arrived.take(None)[1]
                totals = self._totals(step)
                rows = totals.rows + sum(f.rows for f in late)
                self._emit(self._empty(DETECTIONS), step, totals, rows, numbered, flush=True)
            return
        totals = self._totals(step)
        ws = self._workspace(step)
        found = self._empty(DETECTIONS)
        if self.config.at_end:
            start = self._start_time()
            state = self._state(batch_id)
            found = self._detect(state, step, start, self.config.at_end, ws)
        self._emit(found, step, totals, totals.rows, batch_id, flush=True)

    def run(self, stream: DataFrame) -> None:
        """Consume what is there, in order, and close."""
        self.start(stream, availableNow=True).awaitTermination()
        self.finish()

    def final_state(self) -> PairTable:
        """Pair state after the last micro-batch."""
        if self.arrived.store.last_step() is None:
            return self._state(self._progress.last_step() // 2)
        state = self._pair_store().read().drop(BUCKET)
        return known_pairs(state, state.agg(*pair_facts()).first().asDict())
