"""The conversation trie against brute force, with components split on Spark and in numpy."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tillsight.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, c int"


def by_hand(rows):
    turns = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        made[c] = turns.get(base, [])[:h] + own[h:]
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
            if d:
                children[tuple(seq[: d - 1])].add(tuple(seq[:d]))
        ends[tuple(seq)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        own = (len(who) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += own
    return sorted(
        (min(who), len(node), min(members[node[:-1]]) if node else -1, len(who), len(children[node]), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, who in members.items()
    )


def rows_of(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def fixture():
    draw = np.random.default_rng(8)
    rows = []
    for c in range(-12, 150):
        if c % 7 == 3:
            continue  # bases and others that are absent
        for t in range(draw.integers(1, 12)):
            rows.append((c, int(t), ["user", "assistant"][t % 2], f"é{draw.integers(0, 3)}" * int(draw.integers(0, 4))))
    rows += [(200, t, "user", f"long {t % 4}") for t in range(90)]  # one long conversation and its copies
    rows += [(c, t, "user", f"long {t % 4}") for c in (205, 210, 5000000000) for t in range(90)]
    rows += [(300, None, None, None), (300, 1, "user", None), (300, 1, None, "tie"), (300, 1, None, "tie"), (301, 2, "", "")]
    rows += [(None, 0, "user", "x"), (None, 0, "user", "x")]
    return [(*r, "z", 1) for r in rows]


@pytest.mark.parametrize("local_weight", [20, 300, 4096])
def test_against_brute_force(spark, ws, local_weight):
    rows = fixture()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert rows_of(prefix_trie.trie(df, ws, local_weight)) == by_hand(rows)


def test_small_tables(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []
    # 6 takes more turns than it has from a base that is absent, so it has none
    one = [(6, 0, "user", "a", "z", 1)]
    assert zlib.crc32(b"6") % 9 >= 1
    assert rows_of(prefix_trie.trie(spark.createDataFrame(one, SCHEMA))) == by_hand(one)


def test_end_digests_stream_over_pieces(spark):
    ids = [-5, 3, 4095, 4096, 10**12, 7] + list(range(20_000, 30_000))
    df = spark.createDataFrame([(1, 2, c) for c in ids] + [(1, 3, 8)], "conv_id long, depth long, c long").repartition(4)
    got = {(r.conv_id, r.depth): r.ends_sha256 for r in prefix_trie.end_digests(df).collect()}
    text = ",".join(map(str, sorted(ids)))
    assert got == {(1, 2): hashlib.sha256(text.encode()).hexdigest(), (1, 3): hashlib.sha256(b"8").hexdigest()}
