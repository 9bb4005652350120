"""Readers, writers' format and India time."""

import datetime as dt

import pytest
from make import CLOCK, keys, limits
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillsight import Workspace, detect
from tillsight.functions.ids import gender_letter, letter_code, letter_of, strip_ends, unquote
from tillsight.functions.times import ist_now, ist_text, read_clock
from tillsight.sources.tables import (
    read_csv,
    read_importance,
    read_transactions,
    register,
    stream_transactions,
)
from tillsight.workspace import shared_root

CSV = """step,customer,age,gender,merchant,category,amount,fraud
0,'C1','4','M','M1','es_food',4.55,0
0,'C2','2','F','M1','es_food',bad,0
1,'C1','4','M','M1','es_food',,1
"""


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "transactions.csv"
    path.write_text(CSV)
    return str(path)


def test_transactions_by_name(spark, csv):
    df = read_transactions(spark, csv)
    assert df.columns == CSV.splitlines()[0].split(",")
    assert dict(df.dtypes)["amount"] == "double"
    rows = [tuple(r) for r in df.select("customer", "merchant", "gender", "amount").collect()]
    assert rows == [
        ("'C1'", "'M1'", "'M'", 4.55),
        ("'C2'", "'M1'", "'F'", None),
        ("'C1'", "'M1'", "'M'", None),
    ]


def test_importance(spark, tmp_path):
    path = tmp_path / "importance.csv"
    path.write_text("Source,Target,Weight,typeTrans\n'C1','M1',1.5,'es_food'\n'C1','M1',x,'es_food'\n")
    rows = [tuple(r) for r in read_importance(spark, str(path)).collect()]
    assert rows == [("'C1'", "'M1'", 1.5, "'es_food'"), ("'C1'", "'M1'", None, "'es_food'")]


def test_missing_columns_and_paths(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="customer"):
        read_transactions(spark, str(path))
    with pytest.raises(AnalysisException):
        read_csv(spark, str(tmp_path / "nowhere.csv"))


def test_register(spark, csv):
    frames = register(spark, {"card_txns": csv, "again": csv})
    assert set(frames) == {"card_txns", "again"}
    assert spark.sql("SELECT count(*) FROM card_txns").first()[0] == 3


def test_csv_end_to_end(spark, csv, tmp_path):
    path = tmp_path / "importance.csv"
    path.write_text("Source,Target,Weight,typeTrans\n'C1','M1',1.5,'es_food'\n")
    found = detect(
        read_transactions(spark, csv),
        read_importance(spark, str(path)),
        limits(min_merchant_txns=3),
        CLOCK,
    )
    assert keys(found) == [("'C1'", "'M1'")]


def test_stream_schema(spark, csv, tmp_path):
    header = CSV.splitlines()[0].split(",")
    stream = stream_transactions(spark, str(tmp_path), header)
    assert stream.isStreaming and dict(stream.dtypes)["amount"] == "double"


def test_id_functions(spark):
    df = spark.createDataFrame([("'C1'",), ("C12",), ("''",), ("'",), ("",), (None,)], "c string")
    got = [tuple(r) for r in df.select(strip_ends("c"), unquote("c")).collect()]
    assert got == [("C1", "C1"), ("1", "C12"), ("", ""), ("", ""), ("", ""), (None, None)]


def test_letters_survive_their_code(spark):
    df = spark.createDataFrame([("'F'",), ("'é'",), ("'😀'",), ("''",), ("'",), (None,)], "g string")
    letter = gender_letter("g")
    rows = df.select(letter.alias("a"), letter_of(letter_code(letter)).alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows] == ["F", "é", "😀", "'", "", None]


def test_ist_text_in_any_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 18:31:02.9' AS t")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert df.select(ist_text(F.col("t"))).first()[0] == "2024-01-02 00:01:02"
            shown = spark.range(1).select(ist_now()).first()[0]
            now = dt.datetime.now(dt.timezone.utc) + dt.timedelta(minutes=330)
            assert abs(dt.datetime.fromisoformat(shown) - now.replace(tzinfo=None)) < dt.timedelta(seconds=30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(read_clock()) == 19


def test_workspace_is_below_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_root(spark) == named.rstrip("/")
    a, b = Workspace(spark), Workspace(spark)
    assert a.root != b.root
    assert a.save(spark.range(3).toDF("v"), "t").count() == 3
