"""All physical strategies against rules written directly in SQL, on random skewed input."""

import random

import duckdb
import pandas as pd
import pytest
from compare import spark_rows, sql_rows
from make import CLOCK, limits

from tillsight import Options, Workspace, detect
from tillsight.operators.dedup import emit_once, keep_first, occurs_once
from tillsight.plans.cumulative import cumulative
from tillsight.schemas import DETECTION_KEYS, IMPORTANCE
from tillsight.verify import oracle
from tillsight.verify.queries import CLOCK as SQL_CLOCK

LIMITS = limits(min_merchant_txns=60, min_pair_txns=3, max_avg_amount=20, min_female=4)
STRATEGIES = [
    Options(amount_scale=2),
    Options(amount_scale=2, window_rows=0, broadcast_rows=0, salts=4),
    Options(amount_scale=2, window_rows=0, salts=1),
]


def random_rows(seed: int, irregular: bool):
    """One merchant holds a third of the rows, one pair a tenth; some ids and values are null."""
    rng = random.Random(seed)
    txns = []
    for i in range(900):
        merchant = "'hot'" if i % 3 == 0 else f"'m{rng.randrange(6)}'"
        customer = "'big'" if i % 30 == 0 else f"'c{rng.randrange(60)}'"
        if rng.random() < 0.02:
            customer = None
        if rng.random() < 0.02:
            merchant = None
        if irregular and rng.random() < 0.1:
            customer = rng.choice([f"xc{rng.randrange(60)}y", f"\"c{rng.randrange(60)}\""])
        home = (hash(customer) + seed) % 3 if customer is None else sum(map(ord, customer)) % 3
        gender = ["'F'", "'M'", "'M'"][home]
        if rng.random() < 0.03:
            gender = rng.choice([None, "'E'", "'U'", "'F'"])
        amount = None if rng.random() < 0.05 else rng.randrange(100, 5000) / 100
        txns.append((customer, merchant, "'t'", amount, gender, i // 90))
    weights = [
        (f"'c{c}'", m, None if rng.random() < 0.1 else float(rng.randrange(8)), "'t'")
        for c in range(60)
        for m in ["'hot'"] + [f"'m{k}'" for k in range(6)]
        for _ in range(rng.randrange(3))
    ]
    return txns, weights


@pytest.fixture(scope="module", params=[(1, False), (2, True)], ids=["regular", "irregular"])
def data(request, spark):
    txns, weights = random_rows(*request.param)
    schema = (
        "customer string, merchant string, category string, amount double, gender string, "
        "chunk_id long"
    )
    con = duckdb.connect()
    names = ["customer", "merchant", "category", "amount", "gender", "chunk_id"]
    con.register("raw_txn", pd.DataFrame(txns, columns=names).convert_dtypes())
    names = ["customerId", "merchantId", "weight", "transactionType"]
    con.register("raw_imp", pd.DataFrame(weights, columns=names).convert_dtypes())
    return spark.createDataFrame(txns, schema), spark.createDataFrame(weights, IMPORTANCE), con


def sql(body: str, history: bool = False) -> str:
    seen = "SELECT * FROM raw_txn"
    if history:
        seen = (
            "SELECT r.* EXCLUDE (chunk_id), k.chunk_id FROM raw_txn r "
            "JOIN (SELECT DISTINCT chunk_id FROM raw_txn) k ON r.chunk_id <= k.chunk_id"
        )
    return f"WITH txn AS ({seen}), imp AS (SELECT * FROM raw_imp) {body}"


@pytest.mark.parametrize("opts", STRATEGIES)
def test_table_scope(data, opts):
    txns, weights, con = data
    found = detect(txns, weights, LIMITS, SQL_CLOCK, opts)
    expected = sql_rows(con, sql(oracle.everything(LIMITS)))
    assert len(expected[1]) > 20
    assert spark_rows(found) == expected


def test_double_sums(data):
    txns, weights, con = data
    found = detect(txns, weights, LIMITS, SQL_CLOCK, Options())
    assert spark_rows(found) == sql_rows(con, sql(oracle.everything(LIMITS)))


@pytest.mark.parametrize("opts", STRATEGIES[:2])
def test_chunk_scope(data, opts):
    txns, weights, con = data
    lim = limits(min_merchant_txns=10, min_pair_txns=2, max_avg_amount=25, min_female=1)
    found = detect(txns, weights, lim, SQL_CLOCK, opts, scope=("chunk_id",))
    expected = sql_rows(con, sql(oracle.everything(lim, "chunk_id, ")))
    assert len(expected[1]) > 20
    assert spark_rows(found) == expected


@pytest.mark.parametrize("opts", STRATEGIES[:2])
def test_cumulative_scope(data, opts):
    txns, weights, con = data
    found = cumulative(txns, weights, LIMITS, SQL_CLOCK, opts)
    expected = sql_rows(con, sql(oracle.everything(LIMITS, "chunk_id, "), history=True))
    assert len(expected[1]) > 50
    assert spark_rows(found) == expected


def test_last_chunk_equals_table(data, spark):
    txns, weights, _ = data
    opts = STRATEGIES[0]
    fired = cumulative(txns, weights, LIMITS, CLOCK, opts)
    last = fired.filter("chunk_id = 9").drop("chunk_id")
    assert spark_rows(last) == spark_rows(detect(txns, weights, LIMITS, CLOCK, opts))


def test_gaps_in_chunk_ids(data):
    # chunks in which a pair, or a whole merchant, has no rows keep its state
    txns, weights, con = data
    sparse = txns.filter("chunk_id IN (0, 3, 4, 8)")
    fired = cumulative(sparse, weights, LIMITS, SQL_CLOCK, STRATEGIES[0])
    body = oracle.everything(LIMITS, "chunk_id, ")
    text = sql(body, history=True).replace("raw_txn", "some_txn")
    con.execute("CREATE OR REPLACE VIEW some_txn AS SELECT * FROM raw_txn WHERE chunk_id IN (0, 3, 4, 8)")
    kept = fired.filter("chunk_id IN (0, 3, 4, 8)")
    assert spark_rows(kept) == sql_rows(con, text)


def test_emit_once_agrees_with_first_and_once(data, ws: Workspace):
    txns, weights, _ = data
    fired = ws.save(
        cumulative(txns, weights, LIMITS, CLOCK, STRATEGIES[0]).select("chunk_id", *DETECTION_KEYS),
        "fired",
    )
    rows = [tuple(r) for r in fired.collect()]
    first = {}
    for r in sorted(rows, key=lambda r: r[0]):
        first.setdefault(r[1:], r[0])
    expected = sorted((c, *k) for k, c in first.items() if None not in k)
    for found in (emit_once(fired), keep_first(fired)):
        got = [tuple(r) for r in found.collect()]
        assert len(got) == len(first)
        assert sorted(g for g in got if None not in g) == expected
    single = [r for r in rows if sum(r[1:] == s[1:] for s in rows) == 1]
    assert set(single) == {tuple(r) for r in occurs_once(fired).collect()}
    assert len(first) < len(rows)
