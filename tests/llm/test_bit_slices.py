"""Top-k of the bit-sliced index against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.llm import bit_slices


def by_hand(rows, k, scale=64):
    """Answers of each row whose id is divisible by 20, as sorted lists by id."""
    known = [
        (i, [math.floor(scale * x) for x in v])
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = {}
    for at, (q, v) in enumerate(known):
        if q % 20 == 0:
            near = [(-sum(a * b for a, b in zip(v, w)), i) for n, (i, w) in enumerate(known) if n != at and len(v) == len(w)]
            out.setdefault(q, []).append([(i, -s) for s, i in sorted(near)[:k]])
    return out


def answers(df):
    """The same of a result in which an id is asked for once or its rows are alike."""
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(a) for q, a in out.items()}


@pytest.mark.parametrize("block_rows", [64, 100, 8192])
def test_against_brute_force(spark, block_rows):
    draw = np.random.default_rng(11)
    base = draw.standard_normal((400, 7)) * draw.choice([0.01, 1, 300], (400, 1))
    base[100:180] = base[100]  # a group of equal vectors
    rows = [(int(i), [float(x) for x in v], "x", 1) for i, v in enumerate(base)]
    rows += [(-20, [0.0] * 7, "x", 1), (9001, None, "x", 1), (9020, [float("nan")] * 7, "x", 1), (9040, [None] * 7, "x", 1)]
    rows += [(9060, [1.0, math.inf] + [0.0] * 5, "x", 1), (None, [1.0] * 7, "x", 1), (9080, [2.0, -3.0], "x", 1), (9081, [-1.0, 5.0], "x", 1)]
    rows += [(9100, [], "x", 1), (9101, [], "x", 1), (40, rows[40][1], "x", 1), (57, rows[57][1], "x", 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, place int")
    got = answers(bit_slices.search(vectors, F.col("vec_id") % 20 == 0, k=9, block_rows=block_rows))
    expected = by_hand(rows, 9)
    assert set(got) == set(expected)
    for q, lists in expected.items():
        both = sorted((rank, i, s) for one in lists for rank, (i, s) in enumerate(one, 1))
        assert got[q] == both, q


def test_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    asked = F.col("vec_id") % 20 == 0
    assert bit_slices.search(spark.createDataFrame([], schema), asked).collect() == []
    alone = spark.createDataFrame([(0, [1.0])], schema)
    assert bit_slices.search(alone, asked).collect() == []
    same = spark.createDataFrame([(k, [0.5]) for k in range(5)], schema)
    found = bit_slices.search(same, asked, k=3).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(1, 1024), (2, 1024), (3, 1024)]
    huge = spark.createDataFrame([(0, [1e30]), (1, [1.0]), (2, [3.0])], schema)
    assert bit_slices.search(huge, asked).collect() == []


def test_sums_of_slices():
    draw = np.random.default_rng(3)
    values = draw.integers(-1000, 50, (130, 5))
    least, widths, slices = bit_slices.slices_of(values)
    block = bit_slices.Block(np.arange(130), np.arange(130), least, widths, slices)
    for query in draw.integers(-300, 300, (20, 5)):
        rows, scores = block.top(query, -1, 130)
        assert dict(zip(rows.tolist(), scores.tolist())) == dict(enumerate((values @ query).tolist()))
