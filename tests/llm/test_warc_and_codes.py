"""Archives with damage, and nearest neighbours against brute force."""

import base64
import hashlib
import math
import os

import numpy as np
import pytest

from tillsight.llm import rotated_codes, warc


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


PAGES = [(k, f"http://h{k}.example/\r\nx é", h, "z") for k, h in enumerate(["<p>é", None, "", "<p>é", "b" * 5000, "<p>é", "WARC/1.1\r\n\r\nWARC/1.1\r\n"])]
SCHEMA = "page_id long, url string, html string, digest string"


def test_round_trip_names_one_response_per_payload(spark, ws):
    pages = spark.createDataFrame([*PAGES, (8, None, "<p>é", "z"), (4, "u", "b" * 5000, "z"), (None, "u", "<p>é", "z"), (None, "u", "alone", "z")], SCHEMA)
    got = warc.round_trip(pages, ws).collect()
    assert len(got) == pages.count()
    html = {p[0]: (p[2] or "").encode() for p in PAGES} | {8: "<p>é".encode()}
    for r in got:
        if r.page_id is not None:
            data = html[r.page_id]
            least = min(k for k, v in html.items() if v == data)
            assert (r.payload_bytes, r.payload_digest) == (len(data), digest(data))
            expected = ("response", None) if r.page_id == least else ("revisit", least)
            assert (r.record_type, r.refers_to) == expected
    assert sorted((r.record_type, r.refers_to is None) for r in got if r.page_id is None) == [("response", True), ("revisit", False)]
    assert warc.round_trip(pages.limit(0)).collect() == []
    few = warc.round_trip(pages, min_revisit_bytes=100).collect()
    assert {r.page_id for r in few if r.record_type == "revisit"} == set()


@pytest.mark.parametrize("compress", [True, False])
def test_reader_salvages_what_is_whole(spark, ws, compress):
    pages = spark.createDataFrame([(k, "u", f"payload {k} " * 40, "z") for k in range(30)], SCHEMA).coalesce(1)
    manifest = ws.save(warc.write_archives(pages, ws.path("w"), compress=compress), "m")
    path = manifest.first().path.removeprefix("file://")
    limits = warc.Limits(range_bytes=700)
    whole = warc.read_archives(manifest, limits, payload=True).orderBy("offset").collect()
    assert [r.kind for r in whole] == ["record"] * 30
    assert all(bytes(r.payload).startswith(b"payload") for r in whole)
    with open(path, "rb") as f:
        data = bytearray(f.read())
    hurt = [whole[k] for k in (3, 4, 11, 29)]
    for r in hurt[:3]:
        data[r.offset + r.length // 2] ^= 0x55
    junk = whole[20].offset
    data[junk:junk] = b"\x1f\x8b\x08 WARC/1.1 junk"
    data = data[:-20]
    bad = os.path.join(os.path.dirname(path), "bad.warc" + (".gz" if compress else ""))
    with open(bad, "wb") as f:
        f.write(data)
    files = spark.createDataFrame([(bad, len(data))], "path string, size long")
    for bytes_ in (300, 1 << 20):
        rows = warc.read_archives(files, warc.Limits(range_bytes=bytes_)).orderBy("offset").collect()
        names = {r.record_id for r in rows if r.kind == "record"}
        assert names == {r.record_id for r in whole} - {r.record_id for r in hurt}
        gaps = [r for r in rows if r.kind == "gap"]
        assert all(r.reason for r in gaps)
        assert sum(r.length for r in rows) == len(data)  # every byte is in a record or in a gap
        assert len(gaps) in (4, 5)


def test_members_of_several_records(spark, ws):
    """All records of a member are read, and what is broken among them is a gap."""
    import gzip

    url = "http://h/" + "x" * 100_000  # a header longer than the first guess
    records = [warc.record_bytes(k, url if k == 2 else "u", f"payload {k}".encode() * 20, None) for k in range(6)]
    broken = records[4].replace(b"payload 4", b"payload 9", 1)
    for name, data in (
        ("m.warc.gz", gzip.compress(b"".join(records[:3])) + gzip.compress(b"".join([records[3], broken, records[5]]))),
        ("p.warc", b"".join([*records[:4], broken, records[5]])),
    ):
        path = ws.path(name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(data)
        rows = warc.read_archives(spark.createDataFrame([(path, len(data))], "path string, size long"), payload=True).collect()
        read = [r for r in rows if r.kind == "record"]
        assert [r.record_id for r in read] == [f"<urn:page:{k}>" for k in (0, 1, 2, 3, 5)]
        assert all(bytes(r.payload).decode() == f"payload {r.record_id[10:-1]}" * 20 for r in read)
        assert [bool(r.reason) for r in rows if r.kind == "gap"] == [True]
        assert sum(r.length for r in rows) == len(data)


def test_empty_archive(spark):
    none = spark.createDataFrame([], "path string, size long")
    assert warc.read_archives(none).collect() == []


def by_hand(vectors, queries, k):
    out = {}
    for q, v in queries.items():
        near = sorted((math.dist(v, w), i) for i, w in vectors if i != q)
        out[q] = near[:k]
    return out


def test_neighbours_against_brute_force(spark):
    draw = np.random.default_rng(5)
    base = draw.standard_normal((700, 16))
    base[300:400] = base[300]  # ties
    rows = [(int(i), [float(x) for x in v], "s") for i, v in enumerate(base)]
    rows += [(9001, None, "s"), (9002, [0.0] * 16, "s"), (9003, [float("nan")] * 16, "s"), (9004, [None] * 16, "s"), (9005, [1.0] * 3, "s"), (None, [1.0] * 16, "s"), (5, rows[5][1], "s")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    usable = [(i, v) for i, v, _ in rows if i is not None and i < 9000]
    queries = {i: v for i, v in usable if i % 100 == 0}
    got = rotated_codes.search(vectors, vectors.where("vec_id % 100 = 0")).collect()
    expected = by_hand(usable, queries, 10)
    hits = 0
    for q, near in expected.items():
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert [m[2] for m in mine] == sorted(m[2] for m in mine)
        assert all(m[2] == pytest.approx(math.dist(queries[q], base[m[1]]), rel=1e-12) for m in mine)
        hits += len({m[1] for m in mine} & {i for _, i in near})
    assert hits >= 0.95 * 10 * len(expected)
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 300] == list(range(301, 311))
    assert rotated_codes.search(vectors.limit(0), vectors.limit(0)).collect() == []
    few = vectors.where("vec_id in (0, 1, 2)")
    assert len(rotated_codes.search(few, few.where("vec_id = 0")).collect()) == 2


def test_vectors_of_several_lengths_and_shared_ids(spark):
    draw = np.random.default_rng(7)
    rows = [(k, [float(x) for x in draw.standard_normal(2)]) for k in range(300)] + [(1000, [1.0, 2.0, 3.0]), (1001, [1.0, 2.0, 4.0])]
    rows += [(100, [5.0, 5.0]), (200, rows[200][1]), (200, rows[200][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = rotated_codes.search(vectors, vectors.where("vec_id % 100 = 0"), k=5).collect()
    expected = []
    for at, (q, v) in enumerate(rows):
        if q % 100 == 0:
            near = sorted((math.dist(v, w), i) for n, (i, w) in enumerate(rows) if n != at and len(w) == len(v))[:5]
            expected += [(q, rank, i, round(d, 9)) for rank, (d, i) in enumerate(near, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == sorted(expected)


def test_bounds_hold(spark):
    draw = np.random.default_rng(6)
    v = draw.standard_normal((2000, 64))
    q = draw.standard_normal((20, 64))
    rotation, _ = np.linalg.qr(draw.standard_normal((64, 64)))
    centre = v.mean(axis=0)
    lower, upper = rotated_codes.bounds(*rotated_codes.encode(v, centre, rotation), q, centre, rotation)
    true = ((v[:, None] - q[None]) ** 2).sum(axis=2)
    assert ((lower <= true) & (true <= upper)).mean() > 0.98
    assert abs(((lower + upper) / 2 - true).mean()) < 1  # no bias
