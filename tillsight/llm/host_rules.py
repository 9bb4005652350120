"""Host-level quality rules.

Every document is measured once; each rule's failures are then summed by host. A host's failure rate
is shrunk towards all hosts by a beta prior whose two parameters are fitted to the hosts' own rates
(method of moments, less the binomial noise), so a host with three pages is not judged like one with
a million. The verdict on the host is joined back to its documents.

A document goes if it fails a base rule or one of the document rules, or if its host's shrunk rate
of failing documents is above `max_host_rate`. Null texts are empty, and fail for their length. A
null host is a host of its own. Repeated rows count as often as they occur. Columns other than the
key, the text and the host are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.text import blocks, coded, map_arrow, slices, total, words
from tillsight.workspace import Workspace

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
LINE_END = 10
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


@dataclass(frozen=True)
class HostRules:
    """Limits of the rules. All but the first two may be changed without changing the base."""

    min_words: int = 50
    max_repeat_pct: int = 50
    max_symbols_per_word: float = 0.1
    max_dup_line_rate: float = 0.5
    min_mean_word: float = 2.0
    max_mean_word: float = 12.0
    max_host_rate: float = 0.7
    max_prior_rows: float = 1e6


def measure(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The counts of each text of a block, one row per text."""
    n = len(offsets) - 1
    array, starts, bounds = words(buf, offsets)
    code, _ = coded(array)
    out = np.zeros((n, len(COUNTS)), dtype=np.int64)
    out[:, 0] = np.diff(bounds)
    points = (buf & 0xC0) != 0x80
    spaces = np.isin(buf, np.frombuffer(b"\t\n\x0b\x0c\r ", np.uint8))
    out[:, 1] = total(points & ~spaces, offsets)
    out[:, 2] = total(SYMBOLS[buf], offsets)
    lines = _duplicate_lines(buf, offsets, starts)
    out[:, 3], out[:, 5] = lines
    out[:, 4] = _repeat_words(code, bounds)
    return out


def _duplicate_lines(buf, offsets, word_starts) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier one of their text, and all lines with a word."""
    n = len(offsets) - 1
    line_at = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(buf == LINE_END) + 1]))
    line_at = line_at[line_at < len(buf)]
    if len(line_at) == 0:
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    has_word = np.diff(np.searchsorted(word_starts, np.append(line_at, len(buf)))) > 0
    keep = buf != LINE_END
    rank = np.concatenate([[0], np.cumsum(keep)])
    code, _ = coded(slices(buf[keep], rank[np.append(line_at, len(buf))]))
    row = np.searchsorted(offsets, line_at, side="right") - 1
    row, code = row[has_word], code[has_word]
    lines = np.bincount(row, minlength=n)
    distinct = np.unique(row * (code.max(initial=0) + 1) + code)
    return lines - np.bincount(distinct // (code.max(initial=0) + 1), minlength=n), lines


def _repeat_words(code: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words in three-word windows that a text has twice or more."""
    n = len(bounds) - 1
    if len(code) < 3:
        return np.zeros(n, np.int64)
    row = np.repeat(np.arange(n), np.diff(bounds))
    pair, _ = pd.factorize(code[:-1] * (code.max() + 1) + code[1:])
    triple, _ = pd.factorize(pair[:-1] * (code.max() + 1) + code[2:])
    inside = np.flatnonzero(row[:-2] == row[2:])
    key, names = pd.factorize(triple[inside] * n + row[inside])
    again = inside[np.bincount(key, minlength=len(names))[key] > 1]
    marked = np.zeros(len(code), dtype=bool)
    for shift in range(3):
        marked[again + shift] = True
    return total(marked, bounds)


def document_counts(docs: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """The key as `key`, the host as `host` and the counts of every row."""
    source = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").alias("text")
    )
    schema = source.drop("text").schema
    for name in COUNTS:
        schema = schema.add(name, "long")

    def run(batches):
        for batch in batches:
            for lo, hi, buf, offsets in blocks(batch.column("text")):
                counts = measure(buf, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, hi - lo) for c in ("key", "host")]
                    + [pa.array(counts[:, k]) for k in range(len(COUNTS))],
                    schema.names,
                )

    return map_arrow(source, run, schema)


def with_failures(counts: DataFrame, rules: HostRules) -> DataFrame:
    """Counts with one boolean per rule, `base_failed`, and `failed` for any rule."""
    n = F.col("n_words")
    short = n < rules.min_words
    repetitive = 100 * F.col("n_repeat_words") > rules.max_repeat_pct * n
    flags = {
        "fails_length": short,
        "fails_repetition": repetitive,
        "fails_symbols": F.col("n_symbols") > rules.max_symbols_per_word * n,
        "fails_lines": F.col("n_dup_lines") > rules.max_dup_line_rate * F.col("n_lines"),
        "fails_word_length": (F.col("word_chars") < rules.min_mean_word * n)
        | (F.col("word_chars") > rules.max_mean_word * n),
        "base_failed": short | repetitive,
    }
    flagged = counts.withColumns(flags)
    failed = F.lit(False)
    for name in flags:
        failed = failed | F.col(name)
    return flagged.withColumn("failed", failed)


def host_rates(flagged: DataFrame, rules: HostRules) -> DataFrame:
    """Per host: rows, failures of each rule, raw and shrunk rate, and the verdict.

    The prior needs three sums over hosts, made in one aggregate and joined as one row.
    """
    names = [c for c in flagged.columns if c.startswith("fails_")]
    hosts = flagged.groupBy("host").agg(
        F.count(F.lit(1)).alias("host_rows"),
        F.sum(F.col("failed").cast("long")).alias("host_failed"),
        *[F.sum(F.col(c).cast("long")).alias(c) for c in names],
    )
    rate = F.col("host_failed") / F.col("host_rows")
    rated = hosts.withColumn("host_rate", rate)
    prior = rated.agg(
        F.avg("host_rate").alias("m"),
        F.var_pop("host_rate").alias("v"),
        F.avg(1 / F.col("host_rows")).alias("per_row"),
    )
    m, noise = F.col("m"), F.col("m") * (1 - F.col("m")) * F.col("per_row")
    true_variance = F.greatest(F.col("v") - noise, F.lit(0.0))
    # With no variance beyond the noise, all hosts are alike and the prior decides.
    strength = F.when(true_variance > 0, m * (1 - m) / F.nullif(true_variance, F.lit(0.0)) - 1)
    strength = F.least(F.coalesce(strength, F.lit(rules.max_prior_rows)), F.lit(rules.max_prior_rows))
    prior = prior.select(
        F.coalesce(m, F.lit(0.0)).alias("prior_rate"),
        F.greatest(strength, F.lit(1.0)).alias("prior_rows"),
    )
    shrunk = (F.col("host_failed") + F.col("prior_rate") * F.col("prior_rows")) / (
        F.col("host_rows") + F.col("prior_rows")
    )
    return (
        rated.crossJoin(F.broadcast(prior))  # one row
        .withColumn("shrunk_rate", shrunk)
        .withColumn("host_rejected", F.col("shrunk_rate") > rules.max_host_rate)
    )


def judge(
    docs: DataFrame,
    rules: HostRules = HostRules(),
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    ws: Workspace | None = None,
) -> DataFrame:
    """Counts, failures, host rates and `kept` of every row, under the key's own name.

    Counts are written once, as both the hosts' sums and the join read them. The join is left to
    adaptive execution: one row per host against documents, so a hot host is split."""
    ws = ws or Workspace(docs.sparkSession)
    flagged = with_failures(ws.save(document_counts(docs, key, text, host), "counts"), rules)
    rates = host_rates(flagged, rules)
    rates = rates.select(
        F.col("host").alias("host_of"), "host_rows", "host_rate", "shrunk_rate", "host_rejected"
    )
    # A key without nulls lets the join stay an equality join; the null host has a key of its own.
    def join_key(c: str):
        return F.concat(F.when(F.col(c).isNull(), "n").otherwise("h"), F.coalesce(F.col(c).cast("string"), F.lit("")))

    joined = flagged.withColumn("host_key", join_key("host")).join(
        rates.withColumn("host_key", join_key("host_of")), "host_key", "left"
    )
    kept = ~F.col("base_failed") & ~F.col("failed") & ~F.coalesce(F.col("host_rejected"), F.lit(False))
    return joined.withColumn("kept", kept).drop("host_key", "host_of").withColumnRenamed("key", key)
