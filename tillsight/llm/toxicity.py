"""Toxicity by multiple-instance learning.

Only whole documents are labelled. A sentence has probability sigmoid(bias + weights of its words),
and a document is toxic if any sentence is: 1 - prod(1 - p), the noisy-or. Weights are fitted to the
documents' labels through that formula, with an L1 penalty, so blame settles on the sentences that
tell toxic documents from others; those sentences are then located by their code points. A score is
evidence against the background: what the bias alone gives a sentence is left out of the product, so a
document does not score by its length.

Training reads a bounded sample of labelled rows (`TrainingBounds`), the only step that does not
read everything. Scoring reads every whole text. Words are runs of letters and digits, A-Z in lower
case; sentences end at `.`, `!`, `?` or a line end. A null or empty text, or one without words, has
no sentence and scores 0. Repeated rows are scored one by one. Rows of `labels` with a null id or
label are not used; with no usable labels, or labels of one kind only, every score is that of a
document without evidence, 0.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.text import LOWER, blocks, coded, map_arrow, ragged, words

SEPARATOR = np.ones(256, dtype=bool)
SEPARATOR[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = False
SEPARATOR[128:] = False
SENTENCE_END = np.zeros(256, dtype=bool)
SENTENCE_END[list(b".!?\n")] = True
SPANS = T.ArrayType(
    T.StructType().add("start", "integer").add("end", "integer").add("score", "double")
)


PENALTY = 1e-3
PREFIXES = range(4, 9)


@dataclass(frozen=True)
class TrainingBounds:
    """What training may read, and how large the model may be: so many documents of either label, each of
    so many bytes at most; so many features, the most telling ones, each found in so many documents of the
    sample at least. Nothing is bounded in scoring."""

    per_label: int = 3_000
    text_bytes: int = 20_000
    words: int = 600
    min_docs: int = 5


@dataclass(frozen=True)
class Model:
    weights: dict[bytes, float]
    bias: float


def features(word: bytes) -> list[bytes]:
    """The word, and its first bytes, marked as such: inflected forms share their beginnings."""
    return [word] + [b"^" + word[:k] for k in PREFIXES if len(word) > k]


def sentences(buf: np.ndarray, offsets: np.ndarray):
    """Words of a block with their code, the sentence each is in, and the rows of sentences.

    Only sentences with a word count. Returns (codes, dictionary, sentence of each word, row of each
    sentence, word bounds, word starts)."""
    array, starts, bounds = words(LOWER[buf], offsets, SEPARATOR)
    code, names = coded(array)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    ends = np.cumsum(SENTENCE_END[buf])[starts] if len(starts) else np.zeros(0, np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (ends[1:] != ends[:-1]) | (row[1:] != row[:-1])
    sentence = np.cumsum(new) - 1
    return code, names, sentence, row[new], bounds, starts


def held_out(key: str):
    """Rows that training never sees: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, bounds: TrainingBounds, key: str, text: str):
    """Label and text of the sample: those of either label whose hashed ids are smallest."""
    usable = labels.select(F.col(f"`{key}`").alias("k"), F.col("toxic").cast("int").alias("label")).where(
        F.col("k").isNotNull() & F.col("label").isin(0, 1) & ~held_out("k")
    )
    picked = [
        usable.where(F.col("label") == y).distinct().orderBy(F.xxhash64("k"), "k").limit(bounds.per_label)
        for y in (0, 1)
    ]
    short = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("text")).where(
        F.octet_length("text") <= bounds.text_bytes
    )
    # At most 2 * per_label rows, so the broadcast is bounded.
    joined = short.join(F.broadcast(picked[0].union(picked[1])), "k")
    joined = joined.groupBy("k", "label").agg(F.min("text").alias("text"))  # one text where an id repeats
    return joined.select("label", "text").distinct()  # copies would count as evidence


def fit(rows: pa.Table, bounds: TrainingBounds, steps: int = 150) -> Model:
    """Weights of the most telling words, by noisy-or likelihood with Adam.

    Weights are evidence, so none is negative; the L1 penalty leaves none to words that only keep
    company with telling ones."""
    label = rows.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
    if len(label) == 0 or label.min() == label.max():
        return Model({}, -9.0)
    text = rows.schema.get_field_index("text")
    docs_with, toxic_with = _document_counts(rows, text, label)
    # Keep the features whose documents differ most from the labels' share, by squared deviation.
    share = label.mean()
    spread = max(share * (1 - share), 1e-9)
    ranked = sorted(
        (-((toxic_with.get(f, 0) - n * share) ** 2) / (n * spread), f) for f, n in docs_with.items() if n >= bounds.min_docs
    )
    chosen = [f for _, f in ranked[: bounds.words]]
    place = {f: k for k, f in enumerate(chosen)}
    doc_of, sentences_before = 0, 0
    sentence_docs, pairs = [], []
    for lo, hi, buf, offsets in _training_blocks(rows, text):
        code, dictionary, sentence, row, _, _ = sentences(buf, offsets)
        own = [[place[f] for f in features(w) if f in place] for w in dictionary.to_pylist()]
        size = np.array([len(f) for f in own], np.int64)
        flat = np.array([k for f in own for k in f], np.int64)
        at = np.concatenate([[0], np.cumsum(size)])
        used = np.flatnonzero(size[code] > 0) if len(code) else np.zeros(0, np.int64)
        where, word = sentence[used], code[used]
        entry = np.repeat(where + sentences_before, size[word]) * len(chosen) + flat[ragged(at[word], size[word])]
        pairs.append(np.unique(entry))
        sentence_docs.append(row + doc_of)
        doc_of += hi - lo
        sentences_before += len(row)
    pair, sentence_doc = np.concatenate(pairs), np.concatenate(sentence_docs)
    if not len(pair):
        return Model({}, -9.0)
    word, sentence = pair % len(chosen), pair // len(chosen)
    # Sentences without a chosen word all have the bias alone: they are counted, not listed.
    active, sentence = np.unique(sentence, return_inverse=True)
    blank = np.bincount(sentence_doc, minlength=len(label)).astype(float)
    sentence_doc = sentence_doc[active]
    blank -= np.bincount(sentence_doc, minlength=len(label))

    def descend(theta: np.ndarray, free: np.ndarray, penalty: float) -> np.ndarray:
        """Adam over the free parameters; weights stay at or above 0."""
        mean, square = np.zeros_like(theta), np.zeros_like(theta)
        for t in range(1, steps + 1):
            z = np.bincount(sentence, weights=theta[word], minlength=len(active)) + theta[-1]
            none = np.bincount(sentence_doc, weights=np.logaddexp(0, z), minlength=len(label))
            none += blank * np.logaddexp(0, theta[-1])
            pull = np.where(label == 1, -1 / np.expm1(np.clip(none, 1e-9, 500)), 1.0)
            slope = pull[sentence_doc] / (1 + np.exp(-np.clip(z, -500, 500)))
            grad = np.append(
                np.bincount(word, weights=slope[sentence], minlength=len(chosen)),
                slope.sum() + (pull * blank).sum() / (1 + np.exp(-theta[-1])),
            ) / len(label)
            grad[:-1] += penalty
            mean = 0.9 * mean + 0.1 * grad
            square = 0.99 * square + 0.01 * grad**2
            move = 0.1 * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
            theta = np.where(free, theta - move, theta)
            theta[:-1] = np.maximum(theta[:-1], 0)
        return theta

    # First choose the words under the penalty, then fit those chosen without it.
    everything = np.ones(len(chosen) + 1, dtype=bool)
    theta = descend(np.append(np.zeros(len(chosen)), -6.0), everything, PENALTY)
    theta[:-1] *= theta[:-1] > 0.5
    theta = descend(theta, np.append(theta[:-1] > 0, True), 0.0)
    return Model({f: float(w) for f, w in zip(chosen, theta) if w > 1e-3}, float(theta[-1]))


def _training_blocks(rows: pa.Table, text: int):
    for batch in rows.to_batches():
        yield from blocks(batch.column(text), 1 << 20)


def _document_counts(rows: pa.Table, text: int, label: np.ndarray) -> tuple[Counter, Counter]:
    """In how many documents, and in how many toxic ones, each feature occurs."""
    docs_with, toxic_with, doc_of = Counter(), Counter(), 0
    for lo, hi, buf, offsets in _training_blocks(rows, text):
        code, dictionary, _, _, bounds, _ = sentences(buf, offsets)
        own = [features(w) for w in dictionary.to_pylist()]
        for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            found = {f for c in np.unique(code[a:b]).tolist() for f in own[c]}
            docs_with.update(found)
            if label[doc_of + k]:
                toxic_with.update(found)
        doc_of += hi - lo
    return docs_with, toxic_with


def score_block(model: Model, buf: np.ndarray, offsets: np.ndarray):
    """Score of each text, and its sentences of probability one half or more."""
    n = len(offsets) - 1
    code, names, sentence, row, _, starts = sentences(buf, offsets)
    shared = [(k, {w[1:]: v for w, v in model.weights.items() if w[0] == 94 and len(w) == k + 1}) for k in PREFIXES]
    weight = np.array([model.weights.get(w, 0.0) for w in names.to_pylist()], dtype=float)
    for k, known in shared:
        if known:
            weight += [known.get(w[:k], 0.0) if len(w) > k else 0.0 for w in names.to_pylist()]
    blank = np.logaddexp(0, model.bias)
    none = np.zeros(n)
    telling = np.flatnonzero(weight[code] != 0) if len(code) else np.zeros(0, np.int64)
    spans: list[list[dict]] = [[] for _ in range(n)]
    if len(telling):
        # A word counts once in a sentence, as in training.
        pair = np.unique(sentence[telling] * len(weight) + code[telling])
        active, at = np.unique(pair // len(weight), return_inverse=True)
        z = np.bincount(at, weights=weight[pair % len(weight)]) + model.bias
        none += np.bincount(row[active], weights=np.logaddexp(0, z) - blank, minlength=n)
        points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
        stops = np.flatnonzero(SENTENCE_END[buf])
        first_word = np.searchsorted(sentence, active)
        for s, logit in zip(range(len(active)), z.tolist()):
            if logit >= 0:
                r = int(row[active[s]])
                word_at = starts[first_word[s]]
                k = int(np.searchsorted(stops, word_at))
                begin = max(int(stops[k - 1]) + 1 if k else 0, int(offsets[r]))
                end = min(int(stops[k]) + 1 if k < len(stops) else len(buf), int(offsets[r + 1]))
                base = points[offsets[r]]
                spans[r].append(
                    {"start": int(points[begin] - base), "end": int(points[end] - base), "score": float(1 / (1 + np.exp(-logit)))}
                )
    return -np.expm1(-none), spans


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key, `score` and the offending `sentences` (code points) of every row."""
    source = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`"))
    schema = source.select(F.col(f"`{key}`")).schema.add("score", "double").add("sentences", SPANS)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        for batch in batches:
            for lo, hi, buf, offsets in blocks(batch.column(1)):
                scores, spans = score_block(model, buf, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(scores), pa.array(spans, kind)], schema.names
                )

    return map_arrow(source, run, schema)


def trained(
    docs: DataFrame,
    labels: DataFrame,
    bounds: TrainingBounds = TrainingBounds(),
    key: str = "doc_id",
    text: str = "text",
) -> Model:
    return fit(training_rows(docs, labels, bounds, key, text).toArrow(), bounds)


def keep_mild(
    docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text"
) -> DataFrame:
    """The rows that score below the threshold, all columns as they are."""

    def run(batches):
        for batch in batches:
            for lo, hi, buf, offsets in blocks(batch.column(text)):
                scores, _ = score_block(model, buf, offsets)
                part = batch.slice(lo, hi - lo)
                yield part.filter(pa.array(scores < threshold))

    return map_arrow(docs, run, docs.schema)
