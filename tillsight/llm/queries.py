"""One query for each operator, over its whole table, with the SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tillsight.llm import (
    bit_slices,
    bpe,
    collocations,
    host_rules,
    jaccard_join,
    licenses,
    mixing,
    pii,
    prefix_trie,
    rotated_codes,
    secret_scan,
    toxicity,
    warc,
)
from tillsight.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op7_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encoded_digests(table(spark, sf, "documents"), path)


@query
def op2_host_rules(spark: SparkSession, sf: str) -> DataFrame:
    return host_rules.judge(table(spark, sf, "documents")).select(
        "doc_id",
        *host_rules.COUNTS[:5],
        "base_failed",
        "kept",
        F.round("shrunk_rate", 6).alias("shrunk_rate"),
    )


@query
def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.trained(docs, table(spark, sf, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "sentences",
    )


@query
def op4_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf, "documents"))


@query
def op8_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents"))


@query
def op1_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages"))


@query
def op3_rotated_codes(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    return rotated_codes.search(vectors, vectors.where("vec_id % 100 = 0"))


@query
def op9_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf, "documents"))


# Target shares of expected tokens by domain.
SHARES = {"high": 0.97, "low": 0.03}


@query
def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    labels = mixing.quality_domains(table(spark, sf, "labels"))
    return mixing.rates(table(spark, sf, "documents"), labels, SHARES)


# Any string; a deployment takes its own from its secret store.
SURROGATE_KEY = "surrogates-of-the-test-tables"


@query
def op6_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return pii.replace(docs, SURROGATE_KEY, count="n_entities")


@query
def op13_bit_slices(spark: SparkSession, sf: str) -> DataFrame:
    return bit_slices.search(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op12_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


@query
def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf, "conversations"))
