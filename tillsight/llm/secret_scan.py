"""Secret scans with corpus-wide ownership frequency.

Candidates of every text are found by pattern, with their places. The digest of each candidate's
value is then counted over the corpus: in how many repositories and by how many owners it occurs.
A value that several owners hold is a copied example; one that few hold and that looks random is
taken for a live credential of its owner.

Only built-in functions run. Places come from the text between the matches: `split` and
`regexp_extract_all` walk the same matches, so running sums of both lengths give code points, made
by a window over one document's matches, however many there are.

A null text is empty. Repeated rows are scanned one by one. A null owner or repository does not
count as one, so a value held by nobody has 0 owners. Only the columns named are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.workspace import Workspace


def either_case(words: str) -> str:
    """A pattern with every ASCII letter in either case, and no other letter."""
    return "".join(f"[{c.upper()}{c}]" if c.isascii() and c.isalpha() else c for c in words)


KEYWORDS = either_case("(password|passwd|secret|token|api_?key)")
# Kinds in the order in which spans of one start are listed.
PATTERNS = {
    "assign": KEYWORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]{14,}",
    "hex": "[0-9a-f]{16,}",
}
GATES = {"assign": KEYWORDS, "access": "AKIA[A-Z0-9]{14}", "hex": "[0-9a-f]{16}"}
MIN_VALUE = 12
OWNED = "owned"


@dataclass(frozen=True)
class Ownership:
    """A value is an example if it has at least `example_owners` owners, or is in at least `example_repos`
    repositories, whoever owns them. Others look live from `live_length` characters, `live_distinct`
    different ones, and at least one digit and letter."""

    example_owners: int = 3
    example_repos: int = 25
    live_length: int = 16
    live_distinct: int = 8


def matches(text: Column, pattern: str, gate: str) -> Column:
    """Per match its text and the length of what lies before it since the last match."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.zip_with(
        F.slice(gaps, 1, F.size(hits)), hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit"))
    )
    return F.when(text.rlike(gate), both)


def candidates(rows: DataFrame) -> DataFrame:
    """One row per match, with start, end and value; matches that are too short are gone."""
    parts = []
    for order, kind in enumerate(PATTERNS):
        part = rows.select(
            "row", "repo", "owner", F.lit(kind).alias("kind"), F.lit(order).alias("kind_order"),
            F.posexplode(kind).alias("at", "match"),
        )
        parts.append(part)
    found = parts[0].unionByName(parts[1]).unionByName(parts[2])
    size = F.length("match.hit")
    so_far = Window.partitionBy("row", "kind").orderBy("at")
    end = F.sum(F.col("match.gap") + size).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    placed = found.withColumn("end", end).withColumn("start", F.col("end") - size)
    value = F.when(
        F.col("kind") == "assign", F.regexp_extract("match.hit", PATTERNS["assign"], 2)
    ).otherwise(F.col("match.hit"))
    return (
        placed.withColumn("value", value)
        .where((F.col("kind") != "assign") | (F.length("value") >= MIN_VALUE))
        .withColumn("digest", F.sha2("value", 256))
        .drop("match", "at")
    )


def ownership(found: DataFrame, rule: Ownership) -> DataFrame:
    """Per digest: repositories, owners, and whether it is an example.

    Distinct pairs are made first, with partial sums on the map side, so a value copied into a third
    of all documents is one row per owner before it is counted."""
    owners = found.select("digest", "owner").distinct()
    repos = found.select("digest", "repo").distinct().groupBy("digest").agg(F.count("repo").alias("n_repos"))
    owners = owners.groupBy("digest").agg(F.count("owner").alias("n_owners"))
    joined = owners.join(repos, "digest")
    widely = (F.col("n_owners") >= rule.example_owners) | (F.col("n_repos") >= rule.example_repos)
    return joined.withColumn("is_example", widely)


def looks_live(value: Column, rule: Ownership) -> Column:
    distinct = F.size(F.array_distinct(F.split(value, "")))
    return (
        (F.length(value) >= rule.live_length)
        & (distinct >= rule.live_distinct)
        & value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
    )


def _joined(column: str, keep: Column) -> Column:
    """Spans of a row by start, then kind, as kind:start:end."""
    span = F.when(keep, F.struct("start", "kind_order", "kind", "end"))
    text = F.transform(
        F.array_sort(F.collect_list(span)),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(text, ",").alias(column)


def scan(
    docs: DataFrame,
    rule: Ownership = Ownership(),
    key: str = "doc_id",
    text: str = "text",
    repo: str = "doc_id",
    owner: str = "source",
    ws: Workspace | None = None,
) -> DataFrame:
    """Per row the key, counts of each kind, the digest of the base spans, all spans, the numbers of
    owner-specific and of widely copied values, and the most owners and repositories of any of them.

    Matches are written once without the texts; that also fixes the row numbers they are joined by.
    """
    ws = ws or Workspace(docs.sparkSession)
    whole = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{repo}`").cast("string").alias("repo"),
        F.col(f"`{owner}`").cast("string").alias("owner"),
        F.col(f"`{text}`").alias("text"),
    ).select(
        F.monotonically_increasing_id().alias("row"), "key", "repo", "owner",
        *[matches(whole, PATTERNS[k], GATES[k]).alias(k) for k in PATTERNS],
    )
    rows = ws.save(rows, "matches")
    hit = F.col("assign").isNotNull() | F.col("access").isNotNull() | F.col("hex").isNotNull()
    found = ws.save(candidates(rows.where(hit)), "candidates")
    verdict = ownership(found, rule)
    judged = found.join(verdict, "digest")
    owned = ~F.col("is_example") & looks_live(F.col("value"), rule)
    owned_spans = judged.where(owned).select(
        "row", F.lit(OWNED).alias("kind"), F.lit(len(PATTERNS)).alias("kind_order"),
        (F.col("end") - F.length("value")).alias("start"), "end", F.lit(False).alias("base"), "is_example", "n_owners", "n_repos",
    ).distinct()
    base = judged.select("row", "kind", "kind_order", "start", "end", F.lit(True).alias("base"), "is_example", "n_owners", "n_repos")
    spans = base.unionByName(owned_spans)
    counted = lambda c: F.count(F.when(c, 1))
    by_row = spans.groupBy("row").agg(
        *[counted(F.col("kind") == k).alias(f"n_{k}") for k in PATTERNS],
        _joined("base_spans", F.col("base")),
        _joined("spans", F.lit(True)),
        counted(~F.col("base")).alias("n_owned"),
        counted(F.col("base") & F.col("is_example")).alias("n_copied"),
        F.max("n_owners").alias("max_owners"),
        F.max("n_repos").alias("max_repos"),
    )
    counts = [f"n_{k}" for k in PATTERNS] + ["n_owned", "n_copied", "max_owners", "max_repos"]
    return (
        rows.select("row", "key")
        .join(by_row, "row", "left")
        .select(
            F.col("key").alias(key),
            *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
            F.sha2(F.coalesce(F.col("base_spans"), F.lit("")), 256).alias("base_sha256"),
            F.coalesce(F.col("spans"), F.lit("")).alias("spans"),
        )
    )
