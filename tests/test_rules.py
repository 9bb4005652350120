"""Edge cases of the three rules on hand-made input."""

import pytest
from make import CLOCK, importance, keys, limits, transactions, txn

from tillsight import Options, Workspace, detect
from tillsight.operators.pairs import pair_state, save_pairs
from tillsight.plans.upgrade import top_customers_ranked
from tillsight.schemas import DETECTION_COLUMNS

WAYS = {
    "default": Options(),
    "sliced, salted, decimal": Options(
        window_rows=0, broadcast_rows=0, salts=3, amount_scale=2
    ),
}


@pytest.fixture(params=WAYS.values(), ids=WAYS.keys())
def opts(request):
    return request.param


def run(spark, rows, lim, weights=None, opts=Options(), patterns=("upgrade",)):
    txns = transactions(spark, *rows)
    weights = weights if weights is not None else importance(spark)
    return detect(txns, weights, lim, CLOCK, opts, patterns=patterns)


# UPGRADE


def test_merchant_size_cut(spark, opts):
    rows = [txn("'A'", "'M1'", times=49), txn("'A'", "'M2'", times=50)]
    weights = importance(spark, ("'A'", "'M1'", 1.0), ("'A'", "'M2'", 1.0))
    found = run(spark, rows, limits(min_merchant_txns=50), weights, opts)
    assert keys(found) == [("'A'", "'M2'")]


def test_all_tied_are_top(spark, opts):
    rows = [txn(f"'C{i}'", "'M'", times=2) for i in range(20)]
    weights = importance(spark, *[(f"'C{i}'", "'M'", float(i)) for i in range(20)])
    found = run(spark, rows, limits(min_merchant_txns=40), weights, opts)
    # 20 candidates: ranks 0/19 and 1/19 are within 0.1, 2/19 is not
    assert keys(found) == [("'C0'", "'M'"), ("'C1'", "'M'")]


def test_tied_weights_share_a_rank(spark, opts):
    rows = [txn(f"'C{i}'", "'M'") for i in range(11)]
    weights = importance(spark, *[(f"'C{i}'", "'M'", 1.0 if i < 5 else 2.0) for i in range(11)])
    found = run(spark, rows, limits(min_merchant_txns=1), weights, opts)
    assert [c for c, _ in keys(found)] == [f"'C{i}'" for i in range(5)]


def test_only_candidate_is_flagged(spark, opts):
    rows = [txn("'A'", "'M'", times=9), txn("'B'", "'M'")]
    found = run(spark, rows, limits(min_merchant_txns=1), importance(spark, ("'A'", "'M'", 99.0)), opts)
    assert keys(found) == [("'A'", "'M'")]


def test_null_average_ranks_first(spark, opts):
    rows = [txn(f"'C{i:02d}'", "'M'") for i in range(11)]
    weights = [(f"'C{i:02d}'", "'M'", None if i == 7 else float(i)) for i in range(11)]
    found = run(spark, rows, limits(min_merchant_txns=1), importance(spark, *weights), opts)
    # 11 candidates: null has rank 0, C00 rank 1/10
    assert [c for c, _ in keys(found)] == ["'C00'", "'C07'"]


def test_mostly_null_averages(spark, opts):
    rows = [txn(f"'C{i}'", "'M'") for i in range(6)]
    weights = [(f"'C{i}'", "'M'", None if i < 5 else 1.0) for i in range(6)]
    found = run(spark, rows, limits(min_merchant_txns=1), importance(spark, *weights), opts)
    assert [c for c, _ in keys(found)] == [f"'C{i}'" for i in range(5)]


def test_without_importance_not_ranked(spark, opts):
    rows = [txn(f"'C{i:02d}'", "'M'") for i in range(30)]
    weights = [(f"'C{i:02d}'", "'M'", float(i)) for i in range(10, 20)]
    found = run(spark, rows, limits(min_merchant_txns=1), importance(spark, *weights), opts)
    # ten candidates only: the lowest has rank 0, the next 1/9
    assert keys(found) == [("'C10'", "'M'")]


def test_weights_are_averaged_over_types(spark, opts):
    rows = [txn(f"'C{i}'", "'M'") for i in range(3)]
    weights = importance(
        spark,
        ("'C0'", "'M'", 2.0, "'a'"),
        ("'C0'", "'M'", 4.0, "'b'"),
        ("'C1'", "'M'", 2.5, "'a'"),
        ("'C2'", "'M'", 9.0, "'a'"),
    )
    assert keys(run(spark, rows, limits(min_merchant_txns=1), weights, opts)) == [("'C1'", "'M'")]


def test_txn_rank_is_rounded_before_the_cut(spark):
    # 2,010 customers with distinct counts: the 202nd has rank 201/2009 = 0.10005
    spread = spark.range(2010).selectExpr(
        "concat(\"'C\", id, \"'\") AS customer",
        "\"'M'\" AS merchant",
        "\"'t'\" AS category",
        "1D AS amount",
        "\"'F'\" AS gender",
        "explode(sequence(0L, id)) AS copy",
    )
    for opts in WAYS.values():
        ws = Workspace(spark)
        pairs = save_pairs(pair_state(spread, opts), ws)
        top = top_customers_ranked(pairs, limits(min_merchant_txns=1), opts, ws)
        counts = [r["n"] for r in top.select("n").collect()]
        assert len(counts) == 202 and min(counts) == 2010 - 201


def test_weight_rank_is_not_rounded(spark, opts):
    # 2,010 candidates: 200/2009 = 0.0996 passes, 201/2009 = 0.10005 does not
    ids = spark.range(2010)
    customer = "concat(\"'C\", id, \"'\")"
    txns = ids.selectExpr(
        f"{customer} AS customer", "\"'M'\" AS merchant", "'' AS category", "1D AS amount",
        "\"'F'\" AS gender",
    )
    weights = ids.selectExpr(
        f"{customer} AS Source", "\"'M'\" AS Target", "double(id) AS Weight", "'' AS typeTrans"
    )
    found = detect(txns, weights, limits(min_merchant_txns=1), CLOCK, opts, patterns=("upgrade",))
    assert found.count() == 201


def test_null_customer_counts_in_the_rank_only(spark, opts):
    # 11 groups with the null one: rank 1/10 passes for the second customer
    rows = [txn(None, "'M'", times=20)] + [txn(f"'C{i}'", "'M'", times=10 - i) for i in range(10)]
    weights = importance(spark, *[(f"'C{i}'", "'M'", 1.0) for i in range(10)])
    found = run(spark, rows, limits(min_merchant_txns=1), weights, opts)
    assert keys(found) == [("'C0'", "'M'")]


def test_unparsable_weight_is_null(spark):
    rows = [txn("'A'", "'M'")]
    weights = spark.createDataFrame(
        [("'A'", "'M'", "high", "t")], "Source string, Target string, Weight string, typeTrans string"
    )
    assert keys(run(spark, rows, limits(min_merchant_txns=1), weights)) == [("'A'", "'M'")]


# CHILD


def test_child_limits(spark, opts):
    rows = [
        txn("'exactly 23'", "'M'", 23.0, times=80),
        txn("'79 rows'", "'M'", 1.0, times=79),
        txn("'80 rows'", "'M'", 1.0, times=80),
        txn("'null amounts'", "'M'", None, times=60) + txn("'null amounts'", "'M'", 22.99, times=20),
        txn("'only nulls'", "'M'", None, times=80),
        txn(None, None, 1.0, times=80),
    ]
    found = run(spark, rows, limits(min_pair_txns=80), opts=opts, patterns=("child",))
    got = {(r[0], r[1]) for r in found.select("customerName", "merchantId").collect()}
    assert got == {("'80 rows'", "'M'"), ("'null amounts'", "'M'"), (None, None)}


def test_decimal_average_is_exact(spark):
    # 0.1 added many times as double drifts; the average of these is exactly 0.1
    rows = [txn("'A'", "'M'", 0.1, times=1000)]
    lim = limits(min_pair_txns=80, max_avg_amount=0.1)
    exact = run(spark, rows, lim, opts=Options(amount_scale=2), patterns=("child",))
    assert keys(exact) == []


# DEI-NEEDED


def shop(merchant, women, men, others=()):
    rows = [txn(f"'F{i}'", merchant, gender="'F'") for i in range(women)]
    rows += [txn(f"'M{i}'", merchant, gender="'M'") for i in range(men)]
    rows += [txn(f"'X{i}'", merchant, gender=g) for i, g in enumerate(others)]
    return rows


def skewed(spark, rows, min_female=100, opts=Options()):
    return keys(run(spark, rows, limits(min_female=min_female), opts=opts, patterns=("gender_skew",)))


def test_more_than_a_hundred_women(spark, opts):
    rows = shop("'M100'", 100, 200) + shop("'M101'", 101, 102)
    assert skewed(spark, rows, opts=opts) == [("", "M101")]


def test_women_not_fewer(spark):
    rows = shop("'even'", 5, 5) + shop("'women'", 6, 5) + shop("'no men'", 6, 0) + shop("'men'", 3, 4)
    assert skewed(spark, rows, 2) == [("", "men")]


def test_mixed_gender_is_dropped_per_merchant(spark, opts):
    mixed = [txn("'Z'", "'A'", gender="'F'"), txn("'Z'", "'A'", gender="'M'"), txn("'Z'", "'B'", gender="'M'")]
    rows = shop("'A'", 3, 3) + shop("'B'", 3, 3) + mixed
    assert skewed(spark, rows, 2, opts) == [("", "B")]


def test_null_and_other_genders(spark, opts):
    rows = shop("'A'", 3, 3, ["'E'", "'U'", None]) + shop("'B'", 3, 3)
    rows += [txn("'N'", "'B'", gender="'M'"), txn("'N'", "'B'", gender=None)]
    assert skewed(spark, rows, 2, opts) == [("", "B")]


def test_positional_and_clean_stripping(spark):
    rows = shop("C12", 3, 4)
    assert skewed(spark, rows, 2) == [("", "1")]
    assert skewed(spark, rows, 2, Options(id_style="clean")) == [("", "C12")]


def test_irregular_ids_may_meet(spark, opts):
    # 'A' and xAx are two customers to CHILD but one to the gender rule, and a mixed one
    rows = shop("'M'", 3, 3)
    rows += [txn("'A'", "'M'", gender="'M'"), txn("xAx", "'M'", gender="'F'")]
    assert skewed(spark, rows, 2, opts) == []
    rows += [txn("'B'", "'M'", gender="'M'"), txn("xBx", "'M'", gender="'M'")]
    assert skewed(spark, rows, 2, opts) == [("", "M")]


def test_clean_style_everywhere(spark):
    rows = [txn("'A'", "'M'", 1.0, times=3), txn("A", "M", 1.0, times=3)]
    found = run(spark, rows, limits(min_pair_txns=6), opts=Options(id_style="clean"), patterns=("child",))
    assert keys(found) == [("A", "M")]


# Result table


def test_empty_input(spark, opts):
    found = run(spark, [], limits(), opts=opts, patterns=("upgrade", "child", "gender_skew"))
    assert found.columns == DETECTION_COLUMNS and found.collect() == []
    assert {f.dataType.simpleString() for f in found.schema} == {"string"}


def test_clock_and_labels(spark):
    rows = shop("'M'", 3, 4)
    lim = limits(min_merchant_txns=1, min_pair_txns=1, min_female=2)
    weights = importance(spark, ("'F0'", "'M'", 1.0))
    found = run(spark, rows, lim, weights, patterns=("upgrade", "child", "gender_skew"))
    got = {tuple(r) for r in found.select(*DETECTION_COLUMNS[:4]).distinct().collect()}
    assert got == {
        (CLOCK.start, CLOCK.detected, "PatId1", "UPGRADE"),
        (CLOCK.start, CLOCK.detected, "PatId2", "CHILD"),
        (CLOCK.start, CLOCK.detected, "PatId3", "DEI-NEEDED"),
    }


def test_unknown_pattern(spark):
    with pytest.raises(ValueError):
        run(spark, [], limits(), patterns=("downgrade",))
