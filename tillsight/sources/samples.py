"""The provided test tables seen as transactions and customer importance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(prefix: str, c: str):
    return F.concat(F.lit("'" + prefix), F.col(c).cast("string"), F.lit("'"))


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers buying from supplier nations; no hint, so join strategy follows table sizes."""
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    digit, line = F.col("o_custkey") % 10, F.col("l_linenumber")
    gender = (
        F.when((digit == 0) & (line == 2), "U")
        .when((digit == 1) & (line == 3), "U")
        .when(digit == 9, "E")
        .when(digit == 4, "U")
        .when(digit.isin(0, 3, 5, 8), "F")
        .otherwise("M")
    )
    return rows.select(
        quoted("C", "o_custkey").alias("customer"),
        quoted("M", "s_nationkey").alias("merchant"),
        quoted("es_", "l_returnflag").alias("category"),
        F.col("l_extendedprice").alias("amount"),
        F.concat(F.lit("'"), gender, F.lit("'")).alias("gender"),
        F.col("l_quantity").alias("qty"),
        F.col("l_discount").alias("discount"),
    )


def lineitem_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        lineitem_transactions(spark, sf_dir)
        .filter(F.col("category") != "'es_N'")
        .select(
            F.col("customer").alias("Source"),
            F.col("merchant").alias("Target"),
            F.col("qty").alias("Weight"),
            F.col("category").alias("typeTrans"),
        )
    )


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an ordered transaction log: users are customers, event types merchants."""
    digit = F.col("user_id") % 10
    gender = (
        F.when(digit == 9, "E")
        .when((digit == 4) & (F.col("event_id") % 3 == 0), "U")
        .when(digit.isin(0, 3, 5, 8), "F")
        .otherwise("M")
    )
    return table(spark, sf_dir, "events").select(
        "ts",
        "event_id",
        quoted("C", "user_id").alias("customer"),
        quoted("M", "event_type").alias("merchant"),
        quoted("es_", "event_type").alias("category"),
        F.col("value").alias("amount"),
        F.concat(F.lit("'"), gender, F.lit("'")).alias("gender"),
    )


def event_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("user_id") % 6 != 0)
        .select("user_id", "event_type")
        .distinct()
        .select(
            quoted("C", "user_id").alias("Source"),
            quoted("M", "event_type").alias("Target"),
            ((F.col("user_id") * 7 + F.length("event_type") * 13) % 50 + 1)
            .cast("double")
            .alias("Weight"),
            quoted("es_", "event_type").alias("typeTrans"),
        )
    )
