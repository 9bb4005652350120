"""A table that grows step by step, kept in levels of segments.

Each step adds one segment. When a level has `fan` of them they are merged into one of the next level,
so n steps leave about fan * log(n) segments, and a row is written log(n) times at most. With buckets a
segment is partitioned by them, and a reader that names buckets opens no other files.

Which segments make up the table after a step is told by that step's manifest, a small file published by
rename when all else is written. A step that is repeated starts from the manifest before it and overwrites
what it had written, so a table never holds half a step. Manifests and segments that only older steps
knew are removed later, `KEPT` steps behind.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAN = 4
# Steps whose manifests are kept; a reader that began before so many steps may lose its files.
KEPT = 8
BUCKET = "bucket"

Segment = tuple[int, int, int]  # level, first and last step


class Folder:
    """Small files in any file system that Spark knows."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.root = root
        self.store = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._path(f"{self.root}/{name}")

    def names(self, name: str = "") -> list[str]:
        folder = self.path(name) if name else self._path(self.root)
        if not self.store.exists(folder):
            return []
        return [status.getPath().getName() for status in self.store.listStatus(folder)]

    def publish(self, name: str, text: str) -> None:
        """Write a file under another name, then rename it."""
        draft, final = self.path(f"_draft-{name.replace('/', '-')}"), self.path(name)
        out = self.store.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.store.mkdirs(final.getParent())
        self.store.delete(final, False)
        if not self.store.rename(draft, final):
            raise OSError(f"{draft} cannot be renamed to {final}")

    def text(self, name: str) -> str:
        stream = self.store.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self.store.delete(self.path(name), True)


class LevelStore:
    """One such table. `merge` combines the rows of several segments; by default they are kept as they are.
    With `spread` a step's rows are dealt by bucket before they are written, as they are when merged."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        merge: Callable[[DataFrame], DataFrame] | None = None,
        buckets: bool = False,
        fan: int = FAN,
        spread: bool = True,
    ):
        self.spark, self.root, self.schema, self.spread = spark, root, schema, spread
        self.merge, self.buckets, self.fan = merge, buckets, fan
        self.folder = Folder(spark, root)
        self._known: tuple[int, list[Segment]] | None = None

    # Manifests

    def _steps(self) -> list[int]:
        names = self.folder.names("manifest")
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def segments(self, before: int | None = None) -> list[Segment]:
        """Segments after the last step, or after the last one before a given step."""
        if self._known and before is not None and self._known[0] < before:
            return self._known[1]
        steps = [s for s in self._steps() if before is None or s < before]
        if not steps:
            return []
        return [tuple(s) for s in json.loads(self.folder.text(f"manifest/{steps[-1]}.json"))]

    def last_step(self) -> int | None:
        steps = self._steps()
        return steps[-1] if steps else None

    # Segments

    @staticmethod
    def _name(segment: Segment) -> str:
        level, first, last = segment
        return f"level={level}/steps={first}-{last}"

    def _write(self, df: DataFrame, segment: Segment, metrics: list[Column] | None = None) -> dict:
        if self.buckets and (self.spread or segment[0]):
            # One file per bucket, more where a bucket is large: adaptive execution splits those.
            df = df.hint("rebalance", BUCKET)
        seen = Observation()
        # Above any exchange, as adaptive execution drops what lies below an empty one.
        df = df.observe(seen, *metrics) if metrics else df
        out = df.write.mode("overwrite")
        (out.partitionBy(BUCKET) if self.buckets else out).parquet(f"{self.root}/{self._name(segment)}")
        return seen.get if metrics else {}

    def _read(self, segments: list[Segment], buckets: list[int] | None = None) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], self.schema)
        # One scan over all segments; what their folders' names say besides the bucket is dropped.
        reader = self.spark.read.schema(self.schema).option("basePath", self.root)
        df = reader.parquet(*[f"{self.root}/{self._name(s)}" for s in segments]).select(*self.schema.fieldNames())
        return df if buckets is None else df.filter(F.col(BUCKET).isin(buckets))

    def read(self, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """All rows, merged; of the named buckets only, and of the steps before one."""
        segments = self.segments(before)
        df = self._read(segments, buckets)
        return self.merge(df) if self.merge and len(segments) > 1 else df

    def append(self, df: DataFrame, step: int, metrics: list[Column] | None = None, first: int | None = None) -> dict:
        """Add a step's rows, or those of all steps from `first` on, as one segment; done again for the same
        step it replaces them, and withdraws later steps.

        Returns the metrics, aggregates of the rows."""
        first = step if first is None else first
        segments = list(self.segments(first))
        for later in self._steps():
            if later >= first:
                self.folder.remove(f"manifest/{later}.json")
        found = self._write(df, (0, first, step), metrics)
        segments.append((0, first, step))
        made = [segments[-1]]
        level = 0
        while True:
            full = [s for s in segments if s[0] == level]
            if len(full) < self.fan:
                break
            merged = (level + 1, full[0][1], full[-1][2])
            rows = self._read(full)
            self._write(self.merge(rows) if self.merge else rows.hint("rebalance"), merged)
            segments = [merged if s == full[0] else s for s in segments if s == full[0] or s not in full]
            made.append(merged)
            level += 1
        self.folder.publish(f"manifest/{step}.json", json.dumps(segments))
        self._known = (step, segments)
        for passing in made:
            if passing not in segments:
                self.folder.remove(self._name(passing))
        self._tidy()
        return found

    def _tidy(self) -> None:
        """Remove manifests beyond the kept ones, and what only they named."""
        steps = self._steps()
        old, kept = steps[:-KEPT], steps[-KEPT:]
        if not old:
            return
        needed = {tuple(s) for step in kept for s in json.loads(self.folder.text(f"manifest/{step}.json"))}
        for step in old:
            for segment in json.loads(self.folder.text(f"manifest/{step}.json")):
                if tuple(segment) not in needed:
                    self.folder.remove(self._name(tuple(segment)))
            self.folder.remove(f"manifest/{step}.json")


class Journal:
    """A few rows per step, as JSON lines in segments that are merged level by level like those above.

    The driver writes them without a job: they tell what steps did, not the data. A segment within another
    is one that could not be removed after a merge, and does not count."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, step: str = "step", fan: int = FAN):
        self.spark, self.root, self.schema, self.step, self.fan = spark, root, schema, step, fan
        self.folder = Folder(spark, root)

    @staticmethod
    def _name(segment: Segment) -> str:
        level, first, last = segment
        return f"level-{level}-steps-{first}-{last}.jsonl"

    def segments(self) -> list[Segment]:
        found = []
        for name in self.folder.names():
            if name.endswith(".jsonl") and name.startswith("level-"):
                _, level, _, first, last = name.removesuffix(".jsonl").split("-")
                found.append((int(level), int(first), int(last)))
        outer = [s for s in found if not any(o[0] > s[0] and o[1] <= s[1] and s[2] <= o[2] for o in found)]
        return sorted(outer, key=lambda s: s[1])

    def _rows(self, segment: Segment) -> list[dict]:
        return [json.loads(line) for line in self.folder.text(self._name(segment)).splitlines()]

    def _put(self, segment: Segment, rows: list[dict]) -> None:
        self.folder.publish(self._name(segment), "".join(json.dumps(row) + "\n" for row in rows))

    def last_step(self) -> int | None:
        segments = self.segments()
        return segments[-1][2] if segments else None

    def last(self, before: int | None = None) -> dict | None:
        """The last row of the last step, or of the last one before a given step."""
        for segment in reversed(self.segments()):
            rows = [r for r in self._rows(segment) if before is None or r[self.step] < before]
            if rows:
                return rows[-1]
        return None

    def read(self, before: int | None = None) -> DataFrame:
        paths = [f"{self.root}/{self._name(s)}" for s in self.segments()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).json(paths)
        return rows if before is None else rows.filter(F.col(self.step) < before)

    def append(self, rows: list[dict], step: int, last: int | None = None) -> None:
        """Add a step's rows, or those of all steps up to `last`; done again for the same step it replaces
        them, and withdraws later steps."""
        segments = self.segments()
        for segment in [s for s in segments if s[2] >= step]:
            kept = [r for r in self._rows(segment) if r[self.step] < step]
            segments.remove(segment)
            if kept:
                shorter = (segment[0], segment[1], kept[-1][self.step])
                self._put(shorter, kept)
                segments.append(shorter)
            self.folder.remove(self._name(segment))
        segments.append((0, step, step if last is None else last))
        self._put(segments[-1], rows)
        level = 0
        while True:
            full = [s for s in segments if s[0] == level]
            if len(full) < self.fan:
                return
            merged = (level + 1, full[0][1], full[-1][2])
            self._put(merged, [row for s in full for row in self._rows(s)])
            for segment in full:
                self.folder.remove(self._name(segment))
            segments = [s for s in segments if s not in full] + [merged]
            level += 1
