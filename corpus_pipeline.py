"""Documents made ready for training, in five stages.

Each stage reads what its predecessor wrote and works on all of it; `run` does so from end to end.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import bpe, jaccard_join, mixing, pii, toxicity
from tillsight.llm.queries import SHARES, SURROGATE_KEY, table
from tillsight.workspace import Workspace

# A tokenizer's rank file; SQL cannot express the stages, so each is tested against brute force.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or of sentence scores stays below the threshold."""
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_mild(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id."""
    return jaccard_join.one_of_each(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates in place of personal data; n_chars follows the new text."""
    new = pii.replace(docs, SURROGATE_KEY)
    return new.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the rates say that meet the domains' shares."""
    return mixing.mixed(docs, mixing.quality_domains(table(spark, sf_dir, "labels")), SHARES)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and the digest of what they decode to."""
    return bpe.encoded_and_checked(docs.select("doc_id", "source", "lang", "text"), RANKS)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("pii", replace_personal_data),
    ("mixing", mix),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = ws.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
