"""Shapes of physical plans that must hold at any scale."""

import re

import pytest

from tillsight import Options, Workspace
from tillsight.operators.dedup import emit_once, keep_first, not_seen
from tillsight.operators.lookup import lookup_join
from tillsight.operators.pairs import pair_state, save_pairs
from tillsight.operators.ranking import count_levels, top_levels
from tillsight.plans.child import child
from tillsight.plans.gender_skew import clear_customers, gender_skew, letter_counts
from tillsight.plans.upgrade import top_customers_ranked
from tillsight.schemas import DETECTION_KEYS
from tillsight.verify.queries import CLOCK, LINES, QUERIES

SF = "/root/testdata/sf0.001"
OPTS = Options(amount_scale=2)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(text: str, operator: str) -> int:
    return len(re.findall(rf"(?<![A-Za-z]){operator}\b", text))


@pytest.fixture(scope="module")
def raw(spark):
    """Transactions as one parquet table with columns nothing needs."""
    from tillsight.sources.samples import lineitem_transactions

    ws = Workspace(spark)
    return ws.save(lineitem_transactions(spark, SF).selectExpr("*", "1 AS step", "'x' AS zip"), "raw")


def test_pair_state_is_one_scan_one_shuffle(raw):
    text = plan(pair_state(raw, OPTS))
    assert count(text, "FileScan") == 1 and count(text, "Exchange") == 1
    assert count(text, "HashAggregate") == 2 and "SortAggregate" not in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"customer", "merchant", "amount", "gender"}


def test_child_does_not_shuffle_pair_state(raw, ws):
    pairs = save_pairs(pair_state(raw, OPTS), ws)
    text = plan(child(pairs.df, LINES, CLOCK, OPTS))
    assert "Exchange" not in text and "PushedFilters" in text
    assert "GreaterThanOrEqual(n,4)" in text


def test_gender_rule_shuffles_counts_only(raw, ws):
    pairs = save_pairs(pair_state(raw, OPTS), ws)
    assert not pairs.stray_ids
    text = plan(gender_skew(pairs, LINES, CLOCK, OPTS))
    # partial counts per merchant come before the only exchange
    assert count(text, "Exchange") == 1
    assert re.search(r"Exchange hashpartitioning\(merchantId#\d+, \d+\).*\n.*partial_count", text)


def test_gender_from_rows_is_two_shuffles(raw):
    text = plan(letter_counts(clear_customers(raw, OPTS), ["merchantId"]))
    assert count(text, "Exchange") == 2 and "SortAggregate" not in text
    assert count(text, "FileScan") == 1 and "Join" not in text


def test_ranking_window_sees_levels_not_customers(raw, ws):
    pairs = save_pairs(pair_state(raw, OPTS), ws)
    text = plan(top_levels(count_levels(pairs.df, ["merchantId"]), ["merchantId"], LINES))
    window = text.index("Window")
    assert text.index("HashAggregate", window) > window
    assert "partial_count" in text[window:]
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"merchantId", "n"}


def test_counted_lookup_is_not_shuffled(raw, ws):
    pairs = save_pairs(pair_state(raw, OPTS), ws)
    text = plan(top_customers_ranked(pairs, LINES, OPTS, ws))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_large_lookup_is_salted(raw, ws, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = ws.save(raw.select("merchant").distinct(), "small")
        opts = Options(broadcast_rows=0, salts=5)
        joined = lookup_join(raw, small, ["merchant"], "customer", small.count(), opts)
        text = plan(joined)
        assert "Broadcast" not in text
        assert len(re.findall(r"hashpartitioning\(merchant#\d+, _salt#\d+", text)) == 2
        assert joined.count() == raw.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_emit_once_is_an_equi_join(spark, ws):
    fired = ws.save(
        spark.range(10).selectExpr("id AS chunk_id", *[f"'a' AS {k}" for k in DETECTION_KEYS]), "f"
    )
    for df in (emit_once(fired), not_seen(fired, fired), keep_first(fired)):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text and "SortAggregate" not in text


@pytest.mark.parametrize("name", [k for k in QUERIES if not k.startswith(("stream_", "cumul"))])
def test_no_python_and_no_cross_joins(spark, name, monkeypatch):
    seen = []
    save = Workspace.save

    def watch(self, df, label):
        seen.append(plan(df))
        return save(self, df, label)

    monkeypatch.setattr(Workspace, "save", watch)
    seen.append(plan(QUERIES[name](spark, SF)))
    for text in seen:
        for bad in ("Python", "Pandas", "ArrowEval", "Cartesian", "NestedLoop", "ObjectHashAggregate"):
            assert bad not in text, (name, bad)
