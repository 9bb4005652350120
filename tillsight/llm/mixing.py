"""Mixing by soft membership.

A classifier trained on labelled rows gives every document a probability for each domain. A
document's rate says how often it is to be seen in training. Rates are chosen so that the expected
tokens of each domain, sum of tokens * posterior * rate, meet target shares, by least squares on
relative residuals with nonnegative rates, kept near 1 by a small ridge. Projected gradient steps are taken in the metric of
token counts, where a document's step depends only on its posterior and the domains' residuals; so a
rate is one expression over the posteriors, each step is one distributed sum of as many numbers as
there are domains, and nothing but these sums reaches the driver.

The total is the largest for which no domain is repeated on average, so the scarcest domain has rate
1 and others less. A share asked of a domain without tokens is spread over the others. Whole rates
are realised by copies; the rest by a hash of the text. Steps go on until the targets are met; if they
are not after `Descent.steps`, a warning names the largest residual, and `Plan.met` is false.

Training reads a bounded sample (`SampleBounds`), of which features alone reach the driver; any number
of domains takes part. Everything else reads all rows. A null or empty
text has no tokens: it gets a posterior and a rate like others and moves no total. Repeated rows are
decided alike. Labels with a null id or domain are not used; without labels of two domains every
document has the domains' prior. Columns keep their names and values.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.host_rules import measure
from tillsight.llm.text import blocks, map_arrow
from tillsight.workspace import Workspace


@dataclass(frozen=True)
class SampleBounds:
    """What training may read: so many documents of each domain, fewer if there are very many domains,
    but one at least; each of so many bytes at most."""

    per_domain: int = 3_000
    rows: int = 192_000
    text_bytes: int = 20_000


@dataclass(frozen=True)
class Descent:
    ridge: float = 1e-4
    steps: int = 90
    tolerance: float = 5e-3


@dataclass(frozen=True)
class Classifier:
    """Softmax over standardised features; `weights` has a row per domain, the constant last."""

    domains: tuple[str, ...]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def posteriors(self, features: np.ndarray) -> np.ndarray:
        x = np.column_stack([(features - self.mean) / self.scale, np.ones(len(features))])
        z = x @ self.weights.T
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each text of a block, and what the classifier sees of it."""
    counts = measure(buf, offsets).astype(float)
    n, chars, symbols, dup_lines, repeats, lines = counts.T
    some, row = np.maximum(n, 1), np.diff(offsets)
    share = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets]) / np.maximum(row, 1)
    digits, upper = share((buf >= 48) & (buf <= 57)), share((buf >= 65) & (buf <= 90))
    bars = share(buf == 124)
    columns = [
        np.log1p(n), chars / some, np.minimum(symbols / some, 3), np.minimum(bars * 10, 3), dup_lines / np.maximum(lines, 1),
        repeats / some, np.log1p(lines), digits * 10, upper * 10, (symbols > 0.1 * some) * 1.0, (repeats > 0.3 * some) * 1.0,
    ]
    return n.astype(np.int64), np.column_stack(columns)


FEATURES = [f"f{k}" for k in range(11)]


def fit(domain: np.ndarray, x: np.ndarray) -> Classifier:
    """Multinomial logistic regression by gradient descent with momentum, ridge 1e-3."""
    names = tuple(sorted(set(domain)))
    mean = x.mean(axis=0) if len(x) else np.zeros(len(FEATURES))
    scale = np.maximum(x.std(axis=0), 1e-6) if len(x) else np.ones(len(FEATURES))
    weights = np.zeros((max(len(names), 1), len(FEATURES) + 1))
    if len(names) > 1:
        z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
        want = np.searchsorted(np.array(names, dtype=object), domain)
        speed = np.zeros_like(weights)
        for _ in range(400):
            p = np.exp(z @ weights.T - (z @ weights.T).max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(z)), want] -= 1
            speed = 0.9 * speed - 0.2 * (p.T @ z / len(z) + 1e-3 * weights)
            weights = weights + speed
    return Classifier(names or ("all",), mean, scale, weights)


def trained(docs: DataFrame, labels: DataFrame, key: str, text: str, bounds: SampleBounds) -> Classifier:
    """Fit on the rows of each domain whose hashed ids are smallest; `labels` has key and `domain`."""
    usable = labels.select(F.col(f"`{key}`").alias("k"), F.col("domain").cast("string").alias("domain"))
    usable = usable.where("k is not null and domain is not null").distinct()
    domains = usable.agg(F.count_distinct("domain")).first()[0]
    each = min(bounds.per_domain, max(bounds.rows // max(domains, 1), 1))
    place = F.row_number().over(Window.partitionBy("domain").orderBy(F.xxhash64("k"), "k"))
    picked = usable.withColumn("place", place).where(F.col("place") <= each).drop("place")
    short = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("text"))
    short = short.where(F.octet_length("text") <= bounds.text_bytes)
    # At most `rows` ids, or one for each domain, so the broadcast is bounded; and one text per id and
    # label, so what is joined stays bounded where ids repeat.
    texts = short.join(F.broadcast(picked), "k").groupBy("k", "domain").agg(F.min("text").alias("text"))

    def run(batches):
        for batch in batches:
            for lo, hi, buf, offsets in blocks(batch.column("text")):
                x = features(buf, offsets)[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("domain").slice(lo, hi - lo), *(pa.array(np.ascontiguousarray(c)) for c in x.T)],
                    ["domain", *FEATURES],
                )

    rows = map_arrow(texts.select("domain", "text"), run, "domain string, " + ", ".join(f"{f} double" for f in FEATURES)).toArrow()
    order = np.lexsort([rows.column(f).to_numpy() for f in FEATURES])
    x = np.column_stack([rows.column(f).to_numpy() for f in FEATURES])[order]
    return fit(np.array(rows.column("domain").to_pylist(), dtype=object)[order], x)


def memberships(docs: DataFrame, model: Classifier, key: str, text: str) -> DataFrame:
    """The key as `key`, tokens and one posterior column p0, p1, … per domain."""
    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = source.select("key").schema.add("tokens", "long").add("draw", "double")
    names = [f"p{k}" for k in range(len(model.domains))]
    for name in names:
        schema = schema.add(name, "double")

    def run(batches):
        for batch in batches:
            for lo, hi, buf, offsets in blocks(batch.column(1)):
                tokens, x = features(buf, offsets)
                p = model.posteriors(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(tokens), pa.array(draws(buf, offsets))]
                    + [pa.array(np.ascontiguousarray(p[:, k])) for k in range(len(names))],
                    schema.names,
                )

    return map_arrow(source, run, schema)


def draws(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A number from 0 to 1 for each text, the same for equal texts."""
    view = memoryview(np.ascontiguousarray(buf))
    at = offsets.tolist()
    return np.array([xxhash.xxh3_64_intdigest(view[a:b], seed=7) / 2**64 for a, b in zip(at[:-1], at[1:], strict=True)])


@dataclass(frozen=True)
class Plan:
    """Steps taken: scaled residuals of all domains, with the step size and the ridge."""

    step: float
    ridge: float
    residuals: tuple[tuple[float, ...], ...]
    totals: tuple[float, ...]
    targets: tuple[float, ...]
    met: bool = False

    def rates(self, p: np.ndarray) -> np.ndarray:
        x = np.ones(len(p))
        for r in self.residuals:
            x = np.maximum((1 - self.step * self.ridge) * x - self.step * (p @ np.array(r)) + self.step * self.ridge, 0)
        return x


def _sums(members: DataFrame, k: int, size: int, made: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sums over all rows of `size` numbers that `made` gives for tokens and posteriors of some rows."""
    names = [f"p{i}" for i in range(k)]

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            p = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
            total += made(batch.column("tokens").to_numpy(zero_copy_only=False).astype(float), p)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["at", "value"])

    parts = map_arrow(members.select("tokens", *names), run, "at long, value double")
    # As many rows as sums, however many rows were summed.
    rows = parts.groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size)
    out[rows.column("at").to_numpy()] = rows.column("value").to_numpy()
    return out


def solve(members: DataFrame, shares: list[float], descent: Descent) -> Plan:
    """Projected gradient over all rows; `members` is a written table with tokens and posteriors."""
    k = len(shares)
    first = _sums(
        members, k, 1 + k + k * k,
        lambda t, p: np.concatenate([[t.sum()], t @ p, ((p * t[:, None]).T @ p).ravel()]),
    )
    total = first[0]
    if total == 0:
        return Plan(1.0, descent.ridge, (), (0.0,) * k, (0.0,) * k, True)
    have = first[1 : 1 + k] / total
    want = np.where(have > 0, np.array(shares, float), 0)
    want = want / want.sum() if want.sum() > 0 else have
    asked = want > 0
    target = want * (have[asked] / want[asked]).min()
    gram = first[1 + k :].reshape(k, k) / total
    # Residuals count in proportion to what a domain has, so a scarce one is met as fast as others.
    scale = np.where(have > 0, have, 1.0)
    step = 1 / (np.linalg.eigvalsh(gram / np.sqrt(np.outer(scale, scale))).max() + descent.ridge)
    residuals: list[tuple[float, ...]] = []
    now = have
    while True:
        residual = now - target
        met = bool((np.abs(residual) <= descent.tolerance * np.maximum(target, 1e-9)).all())
        if met or len(residuals) == descent.steps:
            break
        residuals.append(tuple((residual / scale).tolist()))
        plan = Plan(step, descent.ridge, tuple(residuals), (), ())
        now = _sums(members, k, k, lambda t, p: (t * plan.rates(p)) @ p) / total
    if not met:
        worst = np.abs(now - target).max()
        warnings.warn(f"shares are not met after {descent.steps} steps: off by up to {worst:.2g} of all tokens", stacklevel=2)
    return Plan(step, descent.ridge, tuple(residuals), tuple(now.tolist()), tuple(target.tolist()), met)


def copies(rates: np.ndarray, draw: np.ndarray) -> np.ndarray:
    whole = np.floor(rates)
    return (whole + (draw < rates - whole)).astype(np.int64)


def fitted(
    docs: DataFrame, labels: DataFrame, shares: dict[str, float], key: str, text: str,
    bounds: SampleBounds, descent: Descent, ws: Workspace,
) -> tuple[Classifier, Plan, DataFrame]:
    model = trained(docs, labels, key, text, bounds)
    members = ws.save(memberships(docs, model, key, text), "memberships")
    return model, solve(members, [shares.get(d, 0.0) for d in model.domains], descent), members


def rates(
    docs: DataFrame, labels: DataFrame, shares: dict[str, float], key: str = "doc_id", text: str = "text",
    bounds: SampleBounds = SampleBounds(), descent: Descent = Descent(), ws: Workspace | None = None,
) -> DataFrame:
    """Per row the key, tokens, posterior of each domain, rate and copies."""
    ws = ws or Workspace(docs.sparkSession)
    model, plan, members = fitted(docs, labels, shares, key, text, bounds, descent, ws)
    names = [f"p{k}" for k in range(len(model.domains))]
    kept = ["key", "tokens", *names]

    def run(batches):
        for batch in batches:
            p = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
            x = plan.rates(p)
            times = copies(x, batch.column("draw").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(x), pa.array(times)], [*kept, "rate", "copies"]
            )

    rated = map_arrow(members, run, members.select(*kept).schema.add("rate", "double").add("copies", "long"))
    return rated.select(
        F.col("key").alias(key), "tokens", *[F.col(n).alias(f"p_{d}") for n, d in zip(names, model.domains)], "rate", "copies"
    )


def mixed(
    docs: DataFrame, labels: DataFrame, shares: dict[str, float], key: str = "doc_id", text: str = "text",
    bounds: SampleBounds = SampleBounds(), descent: Descent = Descent(), ws: Workspace | None = None,
) -> DataFrame:
    """The rows as often as their rates say, all columns as they are.

    Rates follow from posteriors and the plan, so they are made in the pass that reads the texts:
    nothing is joined or shuffled."""
    ws = ws or Workspace(docs.sparkSession)
    model, plan, _ = fitted(docs, labels, shares, key, text, bounds, descent, ws)

    def run(batches):
        for batch in batches:
            for lo, hi, buf, offsets in blocks(batch.column(text)):
                x = plan.rates(model.posteriors(features(buf, offsets)[1]))
                times = copies(x, draws(buf, offsets))
                yield batch.take(pa.array(np.repeat(np.arange(lo, hi), times)))

    return map_arrow(docs, run, docs.schema)


def quality_domains(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Domains from the labelled table: prose that was marked good, and the rest."""
    domain = F.when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return labels.select(F.col(f"`{key}`"), domain.alias("domain"))
