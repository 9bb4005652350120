"""Which files have come for which chunk, and which chunks are whole.

Every file of a stream with chunk numbers is noted with its rows. A file is known again by its place, the
row offset in its name, or else by the digest of its content: a file that comes twice counts once. With a
known chunk size a chunk is whole when its files hold that many rows; else with the first file, or files of
one micro-batch, that come for it. What comes for a chunk after it was evaluated is late: its rows join
the running state at the next evaluation, so none is lost.

    evaluated  counted in its chunk        waiting   for rows of its chunk, or for an earlier chunk
    late       counted after its chunk     repeated  came before, not counted
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.operators.levels import Journal

CHUNK, SOURCE, PLACE = "chunk_id", "source_file", "row_offset"
ARRIVAL = T.StructType(
    [
        T.StructField("batch", T.LongType()),
        T.StructField(CHUNK, T.LongType()),
        T.StructField(SOURCE, T.StringType()),
        T.StructField("identity", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Arrival:
    batch: int
    chunk: int
    source: str | None
    identity: str
    rows: int


def notes_of(pairs: DataFrame, batch: int) -> list[Arrival]:
    """One note per file of a micro-batch, from its pair state: a few rows."""
    keys = [c for c in (CHUNK, SOURCE, PLACE) if c in pairs.columns]
    content = [c for c in pairs.columns if c not in keys]
    digest = F.sum(F.xxhash64(*content).cast("decimal(38,0)")).cast("string")
    rows = pairs.groupBy(*keys).agg(F.sum("n").alias("rows"), digest.alias("identity"))
    found = []
    for row in rows.collect():
        place = row[PLACE] if PLACE in keys else None
        source = row[SOURCE] if SOURCE in keys else None
        found.append(Arrival(batch, row[CHUNK], source, row["identity"] if place is None else f"at {place}", row["rows"]))
    return sorted(found, key=lambda a: (a.chunk, a.identity, a.source or ""))


class Arrivals:
    """The notes of all files, and what is still to be evaluated."""

    def __init__(self, spark: SparkSession, root: str, chunk_rows: int | None):
        self.spark, self.chunk_rows = spark, chunk_rows
        self.store = Journal(spark, root, ARRIVAL, "batch")
        self.waiting: dict[int, list[Arrival]] = {}
        self.late: list[Arrival] = []
        self._loaded = False
        self._last_batch = -1  # the last one that anything was evaluated in, when notes were loaded

    def load(self, before: int, last_batch: int, done: int) -> None:
        """Take up what earlier micro-batches left; `last_batch` is the last one that evaluated anything."""
        if self._loaded:
            return
        self._loaded = True
        self._last_batch = last_batch
        if self.store.last(before) is None:
            return
        known = self.store.read(before)
        for row in known.filter(F.col(CHUNK) > done).orderBy("batch", CHUNK, "identity").collect():
            self._wait(Arrival(*row))
        after = known.filter((F.col(CHUNK) <= done) & (F.col("batch") > self._last_batch))
        for row in after.orderBy("batch", CHUNK, "identity").collect():
            self._if_new(Arrival(*row))

    def _wait(self, note: Arrival) -> None:
        files = self.waiting.setdefault(note.chunk, [])
        if all(f.identity != note.identity for f in files):
            files.append(note)

    def _if_new(self, note: Arrival) -> None:
        """Keep a late file unless it came before."""
        if any((f.chunk, f.identity) == (note.chunk, note.identity) for f in self.late):
            return
        same = (F.col(CHUNK) == note.chunk) & (F.col("identity") == note.identity)
        if self.store.read(note.batch).filter(same).limit(1).count() == 0:
            self.late.append(note)

    def add(self, notes: list[Arrival], batch: int, done: int) -> None:
        names = ARRIVAL.fieldNames()
        self.store.append([dict(zip(names, (n.batch, n.chunk, n.source, n.identity, n.rows))) for n in notes], batch)
        for note in notes:
            if note.chunk > done:
                self._wait(note)
            elif batch > self._last_batch:
                # Otherwise the micro-batch is repeated, and what it evaluated has counted the file.
                self._if_new(note)

    def whole(self, chunk: int) -> bool:
        files = self.waiting.get(chunk)
        if not files:
            return False
        return self.chunk_rows is None or sum(f.rows for f in files) >= self.chunk_rows

    def last_whole(self, chunk: int, rows: int) -> int:
        """The last of the chunks that are whole from a whole one on without a gap, of so many rows in all."""
        left = rows - sum(f.rows for f in self.waiting[chunk] + self.late)
        while self.whole(chunk + 1):
            left -= sum(f.rows for f in self.waiting[chunk + 1])
            if left < 0:
                break
            chunk += 1
        return chunk

    def short_last(self, chunk: int) -> bool:
        """Whether a chunk has come in part and none after it has."""
        return chunk in self.waiting and chunk == max(self.waiting)

    def take(self, chunk: int | None) -> tuple[list[Arrival], list[Arrival]]:
        """Files of a chunk to be evaluated, and all late ones."""
        files, late = self.waiting.pop(chunk, []), self.late
        self.late = []
        return files, late

    def gaps(self, done: int) -> list[tuple[int, int | None]]:
        """Chunks that keep later ones waiting, with the rows they lack, as far as that is known."""
        found = []
        for chunk in range(done + 1, max(self.waiting, default=done)):
            if not self.whole(chunk):
                have = sum(f.rows for f in self.waiting.get(chunk, []))
                found.append((chunk, None if self.chunk_rows is None else self.chunk_rows - have))
        return found

    def table(self, evaluated: DataFrame, done: int) -> DataFrame:
        """All files with their status."""
        notes = self.store.read()
        first = F.row_number().over(Window.partitionBy(CHUNK, "identity").orderBy("batch", SOURCE))
        chunks = evaluated.filter(F.col("step") % 2 == 0).select(
            (F.col("step") / 2).cast("long").alias(CHUNK), F.col("batch").alias("_batch")
        )
        status = (
            F.when(F.col("_copy") > 1, "repeated")
            .when(F.col(CHUNK) > done, "waiting")
            .when(F.col("batch") > F.col("_batch"), "late")
            .otherwise("evaluated")
        )
        placed = notes.withColumn("_copy", first).join(chunks, CHUNK, "left")
        return placed.select(CHUNK, SOURCE, "rows", "batch", status.alias("status"))
