"""WARC archives: a writer that stores equal payloads once, and a reader that salvages.

Writing. Payloads are compared by their SHA-1. The page with the smallest id of those with one
payload is the response, the others become revisits of it; payloads below `min_revisit_bytes` are
always responses. Each task writes archives of gzip members, one per record, under names of its own
attempt, and a manifest row per archive; only what the manifest lists is read, so a repeated task
leaves no double.

Reading. Archives are cut into byte ranges that tasks read by themselves; a range owns the records
that start in it. A record counts once its member decompresses, its length and end are right and its
digests match. After a failed check the reader looks for the next valid member (or version line in
plain archives), goes on there, and logs the bytes between as a quarantined gap. Plain archives are
not split, as a payload may hold a version line.

Defined cases: a null payload is empty; a null id is written as `none` and read back as null, and is
the response only of a payload that no page with an id has; of rows that repeat the smallest id each
is a response; a null URL leaves its header out. Columns other than the three named are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm.text import map_arrow
from tillsight.workspace import Workspace

VERSION_LINE = b"WARC/1.1\r\n"
MAGIC = b"\x1f\x8b\x08"
DATE = b"2024-01-01T00:00:00Z"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 20
HEADER_GUESS = 64 << 10
NAME = "urn:page:"


@dataclass(frozen=True)
class Limits:
    """Sizes of archives and ranges, and what no header or record exceeds."""

    archive_bytes: int = 256 << 20
    range_bytes: int = 32 << 20
    header_bytes: int = 64 << 20
    record_bytes: int = 4 << 30  # no row of Spark holds as much


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def located(spark: SparkSession, path: str) -> str:
    """A path with its scheme and host, as Spark would resolve it."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    whole = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return "file://" + whole[5:] if whole.startswith("file:/") and not whole.startswith("file://") else whole


def _name(page) -> str:
    return f"<{NAME}{'none' if page is None else page}>"


def record_bytes(page, url: str | None, payload: bytes, original) -> bytes:
    """One record, not compressed; a revisit if `original` is an id."""
    revisit = original is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        ("WARC-Type", b"revisit" if revisit else b"response"),
        ("WARC-Record-ID", _name(page).encode()),
        ("WARC-Date", DATE),
        ("Content-Type", b"application/http; msgtype=response"),
        ("WARC-Payload-Digest", b"sha1:" + sha1_base32(payload).encode()),
        ("WARC-Block-Digest", b"sha1:" + sha1_base32(block).encode()),
    ]
    if url is not None:
        clean = "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)
        lines.insert(2, ("WARC-Target-URI", clean.encode()))
    if revisit:
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(original).encode())]
    lines.append(("Content-Length", b"%d" % len(block)))
    head = VERSION_LINE + b"".join(k.encode() + b": " + v + b"\r\n" for k, v in lines)
    return head + b"\r\n" + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame,
    root: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_revisit_bytes: int = 0,
    limits: Limits = Limits(),
    compress: bool = True,
) -> DataFrame:
    """Write all rows as records below `root`; the manifest (path, size, records) of the archives.

    Only digests that occur twice are joined back. The join is left to adaptive execution, which
    splits a hot digest: the other side has one row for it."""
    spark = pages.sparkSession
    root = located(spark, root)
    store, base = fs.FileSystem.from_uri(root)
    store.create_dir(base, recursive=True)
    rows = pages.select(
        F.col(f"`{key}`").alias("page"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    # A null id is the smallest only if there is no other.
    equal = rows.where(F.octet_length("payload") >= min_revisit_bytes).groupBy("digest")
    originals = equal.agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    original = F.when(F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first")), F.col("first"))
    joined = rows.join(originals.drop("n"), "digest", "left").select("page", "url", "payload", original.alias("original"))

    def run(batches):
        target, folder = fs.FileSystem.from_uri(root)
        out = path = None
        written = records = 0
        done = []

        def close():
            out.close()
            done.append({"path": path, "size": written, "records": records})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None or written >= limits.archive_bytes:
                    if out is not None:
                        close()
                    written = records = 0
                    path = f"{folder}/{uuid.uuid4().hex}.warc" + (".gz" if compress else "")
                    out = target.open_output_stream(path, compression=None)
                data = record_bytes(row["page"], row["url"], row["payload"], row["original"])
                if compress:
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = packer.compress(data) + packer.flush()
                out.write(data)
                written += len(data)
                records += 1
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist(
            done, pa.schema([("path", pa.string()), ("size", pa.int64()), ("records", pa.int64())])
        )

    found = map_arrow(joined, run, "path string, size long, records long")
    scheme = root[: root.index(base)] if base in root else "file://"
    return found.withColumn("path", F.concat(F.lit(scheme), F.col("path")))


FIELDS = pa.schema(
    [
        ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("kind", pa.string()),
        ("reason", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()),
        ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()), ("payload", pa.binary()),
    ]
)
FIELD_DDL = (
    "path string, offset long, length long, kind string, reason string, record_type string, "
    "record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes long"
)


class Broken(Exception):
    """A record that fails a check."""


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def _length(headers: dict[str, str]) -> int:
    text = headers.get("content-length", "")
    if not (text.isascii() and text.isdigit()):
        raise Broken("content length")
    return int(text)


def parsed(head: bytes, block: bytes) -> dict:
    """The fields of a record whose digests match."""
    headers = _headers(head)
    kind = headers.get("warc-type")
    if not kind:
        raise Broken("no record type")
    _check(headers.get("warc-block-digest"), block, "block digest")
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not headers.get("content-type", "").startswith("application/http") or not gap:
        http, payload = b"", block
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "revisit":
        stated = _headers(http).get("content-length", "")
        size = int(stated) if stated.isascii() and stated.isdigit() else None
    else:
        _check(headers.get("warc-payload-digest"), payload, "payload digest")
        size, digest = len(payload), sha1_base32(payload)
    return {
        "record_type": kind, "record_id": headers.get("warc-record-id"), "target_uri": headers.get("warc-target-uri"),
        "refers_to": headers.get("warc-refers-to"), "payload_digest": digest, "payload_bytes": size, "payload": payload,
    }


def _check(stated: str | None, data: bytes, what: str) -> None:
    if stated and stated.lower().startswith("sha1:") and stated[5:].upper() != sha1_base32(data):
        raise Broken(what)


def split_record(data: bytes, at: int = 0) -> tuple[bytes, bytes, int]:
    """Head, block and length of the record that starts at a place of `data`."""
    if not data.startswith(b"WARC/1.", at):
        raise Broken("version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Broken("header")
    head = data[at:end]
    start, size = end + 4, _length(_headers(head))
    block = data[start : start + size]
    if len(block) < size or data[start + size : start + size + 4] != b"\r\n\r\n":
        raise Broken("record end")
    return head, block, start + size + 4 - at


class Archive:
    """Records of one archive by place."""

    def __init__(self, file, size: int, packed: bool, limits: Limits):
        self.file, self.size, self.packed, self.limits = file, size, packed, limits

    def member(self, at: int) -> tuple[bytes, int]:
        """The whole record that starts at a place, and how many bytes of the archive it takes."""
        return self._gzip(at) if self.packed else self._plain(at)

    def _gzip(self, at: int) -> tuple[bytes, int]:
        if self.file.read_at(3, at) != MAGIC:
            raise Broken("member start")
        unpack, parts, made, place = zlib.decompressobj(31), [], 0, at
        while not unpack.eof:
            raw = self.file.read_at(min(CHUNK, self.size - place), place) if place < self.size else b""
            if not raw:
                raise Broken("member cut off")
            try:
                parts.append(unpack.decompress(raw))
            except zlib.error:
                raise Broken("member does not decompress") from None
            if not made and parts[0] and not b"WARC/1.".startswith(parts[0][:7]):
                raise Broken("version line")
            made += len(parts[-1])
            if made > self.limits.record_bytes:
                raise Broken("record too long")
            place += len(raw)
        return b"".join(parts), place - len(unpack.unused_data) - at

    def _plain(self, at: int) -> tuple[bytes, int]:
        reach = HEADER_GUESS
        while True:
            head = self.file.read_at(min(reach, self.size - at), at)
            if not head.startswith(b"WARC/1."):
                raise Broken("version line")
            end = head.find(b"\r\n\r\n")
            if end >= 0 or reach >= min(self.limits.header_bytes, self.size - at):
                break
            reach *= 8
        if end < 0:
            raise Broken("header")
        size = end + 8 + _length(_headers(head[:end]))
        if size > self.limits.record_bytes or at + size > self.size:
            raise Broken("record cut off")
        return self.file.read_at(size, at), size

    def next_valid(self, at: int) -> int:
        """The first place at or after `at` where a whole record starts, else the end."""
        mark = MAGIC if self.packed else b"WARC/1."
        place = at
        while place < self.size:
            window = self.file.read_at(min(CHUNK + len(mark) - 1, self.size - place), place)
            found = window.find(mark)
            while found >= 0:
                try:
                    data, _ = self.member(place + found)
                    split_record(data)
                    return place + found
                except Broken:
                    found = window.find(mark, found + 1)
            place += CHUNK
        return self.size

    @staticmethod
    def _rest_of_member(at: int, data: bytes, place: int):
        """Records after the first one of a member. They are where the member is and take no further bytes
        of the archive; what is broken among them is a gap of no bytes."""
        while place < len(data):
            try:
                head, block, taken = split_record(data, place)
                yield {"offset": at, "length": 0, "kind": "record", **parsed(head, block)}
                place += taken
            except Broken as why:
                yield {"offset": at, "length": 0, "kind": "gap", "reason": f"{why} inside a member, at {place}"}
                place = data.find(b"WARC/1.", place + 1)
                if place < 0:
                    return

    def records(self, start: int, end: int):
        """Records that start in the range, and the gaps that begin at 0 or after one of these.

        What lies before the first record of a later range belongs to an earlier one."""
        at, after_record = (0, False) if start == 0 else (self.next_valid(start), False)
        while at < min(end, self.size):
            try:
                data, used = self.member(at)
                head, block, taken = split_record(data)
                yield {"offset": at, "length": used, "kind": "record", **parsed(head, block)}
                yield from self._rest_of_member(at, data, taken)
                at, after_record = at + used, True
            except Broken as why:
                after = self.next_valid(at + 1)
                yield {"offset": at, "length": after - at, "kind": "gap", "reason": str(why)}
                at, after_record = after, False
        if after_record and at < self.size:
            try:
                split_record(self.member(at)[0])
            except Broken as why:
                after = self.next_valid(at + 1)
                yield {"offset": at, "length": after - at, "kind": "gap", "reason": str(why)}


def read_archives(archives: DataFrame, limits: Limits = Limits(), payload: bool = False) -> DataFrame:
    """Records and quarantined gaps of archives, given as rows of `path` and `size`.

    `kind` tells records from gaps; a gap has a reason. `payload=False` leaves payloads in the tasks.
    """
    spark = archives.sparkSession
    packed = F.col("path").endswith(".gz")
    last = F.greatest(F.col("size") - 1, F.lit(0))
    step = F.when(packed, F.lit(limits.range_bytes)).otherwise(F.greatest(F.col("size"), F.lit(1)))
    ranges = archives.where("size > 0").select(
        "path", "size", F.explode(F.sequence(F.lit(0).cast("long"), last, step.cast("long"))).alias("start"), step.alias("step")
    )
    # One task per range or so: ranges are many bytes in few rows, which sizes of rows do not show.
    total = archives.agg(F.coalesce(F.sum(F.ceil(F.col("size") / limits.range_bytes)), F.lit(0))).first()[0]
    ranges = ranges.repartition(max(1, min(int(total), 100_000), spark.sparkContext.defaultParallelism))
    names = [f.name for f in FIELDS if payload or f.name != "payload"]
    schema = FIELD_DDL + (", payload binary" if payload else "")
    kept = pa.schema([FIELDS.field(n) for n in names])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                source, path = fs.FileSystem.from_uri(row["path"])
                with source.open_input_file(path) as file:
                    archive = Archive(file, row["size"], row["path"].endswith(".gz"), limits)
                    rows, held = [], 0
                    for record in archive.records(row["start"], row["start"] + row["step"]):
                        record["path"] = row["path"]
                        held += len(record.get("payload") or b"") if payload else 64
                        rows.append({n: record.get(n) for n in names})
                        if held > 8 << 20 or len(rows) >= 4096:
                            yield pa.RecordBatch.from_pylist(rows, kept)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, kept)

    return map_arrow(ranges, run, schema)


def page_of(name):
    """The page id in a record's name, null for `none`."""
    text = F.regexp_extract(name, f"^<{NAME}(-?[0-9]+)>$", 1)
    return F.when(text != "", text.cast("long"))


def round_trip(pages: DataFrame, ws: Workspace | None = None, **options) -> DataFrame:
    """Write all pages, read the archives back, and return one row per page record."""
    ws = ws or Workspace(pages.sparkSession)
    manifest = ws.save(write_archives(pages, ws.path("archives"), **options), "manifest")
    records = read_archives(manifest).where("kind = 'record'")
    return records.select(
        page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )
