"""Phrases whose words keep company, mined with weighted acyclic automata.

Each block of text is a shard: its phrases of one to `max_words` words are counted and sorted, and built
into machines (`automata`), one per language and prefix of the first word, that give each phrase its
count. Machines are dealt by ranges of their prefix and sorted; within a range those of one prefix are
united and their weights summed as the rows go by, so a task holds one prefix and a batch of rows. What is frequent is read
off; every part of a frequent phrase is at least as frequent, so the parts' counts are looked up there, by
language and phrase. Of all ways to cut a phrase in two the weakest counts.

A machine is further split by the second word into one slot per `SLOT_BYTES` of text, and into more where
its prefix makes up much of a bounded sample; that only deals the work and changes no count.

Text is lower-cased in A-Z and cut into pieces at `[.,;:!?\\x0A-\\x0D]`, these into words at spaces and tabs.
A null language is `und`; null and empty texts have no words; a repeated row counts again. Only the text
and the language are read, whatever the other columns are called. An empty table has no phrases.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillsight.llm.automata import Level, Machines, build, levels_of, summed, union
from tillsight.llm.text import LOWER, blocks, coded, map_arrow, ragged, slices, tiles, words
from tillsight.workspace import Workspace

NO_LANG = "und"
SPACE_ONLY = np.zeros(256, dtype=bool)
SPACE_ONLY[32] = True
# Bytes of text in a shard, and arcs that are united at a time.
BLOCK = 2 << 20
UNITED_ARCS = 1 << 17
# The sample that tells which prefixes are common: texts, and characters of each. A prefix gets a slot for
# each such share of the sample's words, up to so many slots.
SAMPLE_TEXTS = 256
SAMPLE_CHARS = 20_000
SLOT_SHARE = 1 / 1024
MOST_SLOTS = 1024
BREAKS = np.zeros(256, dtype=bool)
BREAKS[[10, 11, 12, 13, *b".,;:!?"]] = True
SEPARATORS = BREAKS.copy()
SEPARATORS[[9, 32]] = True
# Machines of other words are dealt by so many bytes of the first one, and by the second word into one
# slot for so many bytes of text.
PREFIX_BYTES = 3
SLOT_BYTES = 4 << 30
MACHINES = "lang string, prefix binary, slot int, arcs int, states int, labels binary, weights binary, targets binary, degrees binary"
NAMES = ["lang", "prefix", "slot", "arcs", "states", "labels", "weights", "targets", "degrees"]
KEY = ["lang", "prefix", "slot"]


@dataclass(frozen=True)
class Mining:
    """Phrases of up to `max_words` words found `min_count` times or more; a phrase goes if a longer one
    holds it at least `covered_pct` percent of the times; the `top` best of each language are reported."""

    max_words: int = 3
    min_count: int = 10
    covered_pct: int = 50
    top: int = 2_000


def packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Runs of whole numbers as byte strings, each run in the least width of 1, 2, 4 or 8 that holds it."""
    run = np.repeat(np.arange(len(counts)), counts)
    top = np.zeros(len(counts), dtype=np.int64)
    np.maximum.at(top, run, values)
    width = np.select([top < 1 << 8, top < 1 << 16, top < 1 << 32], [1, 2, 4], 8)
    ends = np.concatenate([[0], np.cumsum(width * counts)])
    out = np.zeros(int(ends[-1]), dtype=np.uint8)
    wide = width[run]
    for w in (1, 2, 4, 8):
        mine = np.flatnonzero(width == w)
        if len(mine):
            out[ragged(ends[mine], counts[mine] * w)] = values[wide == w].astype(f"<u{w}").view(np.uint8)
    return slices(out, ends)


def unpacked(array: pa.Array, counts: np.ndarray) -> np.ndarray:
    """The numbers of such runs."""
    raw, ends = tiles(array)
    width = np.diff(ends) // np.maximum(counts, 1)
    out = np.zeros(int(counts.sum()), dtype=np.int64)
    wide = np.repeat(width, counts)
    for w in (1, 2, 4, 8):
        mine = np.flatnonzero(width == w)
        if len(mine):
            out[wide == w] = raw[ragged(ends[mine], counts[mine] * w)].view(f"<u{w}").astype(np.int64)
    return out


def to_rows(lang, prefix, slot, machines: Machines, dictionary: pa.Array) -> pa.RecordBatch:
    """Machines as rows; words, which hold no space, instead of codes."""
    spelt = dictionary.take(pa.array(machines.labels, pa.int64()))
    ends = np.concatenate([[0], np.cumsum(machines.arcs)]).astype(np.int32)
    labels = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), spelt), pa.scalar(b" ", pa.binary()))
    degrees = np.diff(machines.firsts)
    between = np.cumsum(machines.states)[:-1] - 1  # from one machine's last entry to the next one's first
    degrees = np.delete(degrees, between)
    return pa.RecordBatch.from_arrays(
        [
            lang,
            prefix,
            pa.array(slot, pa.int32()),
            pa.array(machines.arcs, pa.int32()),
            pa.array(machines.states - 1, pa.int32()),
            labels,
            packed(machines.weights, machines.arcs),
            packed(machines.targets, machines.arcs),
            packed(degrees, machines.states - 1),
        ],
        NAMES,
    )


def from_rows(table: pa.RecordBatch) -> tuple[Machines, pa.Array]:
    """Machines of rows, and the words that their labels stand for."""
    arcs = table.column("arcs").to_numpy().astype(np.int64)
    text, ends = tiles(table.column("labels"))
    spelt, _, _ = words(text, ends, SPACE_ONLY)
    codes, dictionary = sorted_codes(spelt)
    weights, targets = (unpacked(table.column(c), arcs) for c in ("weights", "targets"))
    states = table.column("states").to_numpy().astype(np.int64)
    degrees = unpacked(table.column("degrees"), states)
    owner = np.repeat(np.arange(len(states)), states)
    begins = np.cumsum(degrees) - degrees - (np.cumsum(arcs) - arcs)[owner]
    firsts = np.zeros(int((states + 1).sum()), dtype=np.int64)
    start = np.cumsum(states + 1) - (states + 1)
    firsts[start[owner] + np.arange(len(owner)) - (np.cumsum(states) - states)[owner]] = begins
    firsts[start + states] = arcs
    return Machines(codes, weights, targets, arcs, firsts, states + 1), dictionary


def sorted_codes(array: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of byte strings in byte order, and the strings."""
    codes, dictionary = coded(array)
    if len(codes) == 0:
        return codes, dictionary
    order = pc.sort_indices(dictionary).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return rank[codes], dictionary.take(pa.array(order))


def prefix_slots(docs: DataFrame, text: str) -> dict[bytes, int]:
    """Slots of prefixes that are common in a bounded sample; others have one."""
    sample = docs.select(F.substring(F.col(f"`{text}`"), 1, SAMPLE_CHARS).alias("t")).limit(SAMPLE_TEXTS).toArrow()
    counts: dict[bytes, int] = {}
    for _, _, buf, offsets in blocks(sample.column("t")):
        array, _, _ = words(LOWER[buf], offsets, SEPARATORS)
        for entry in pc.value_counts(pc.binary_slice(array, 0, PREFIX_BYTES)).to_pylist():
            counts[entry["values"]] = counts.get(entry["values"], 0) + entry["counts"]
    total = sum(counts.values())
    slots = {p: min(-int(-n // (SLOT_SHARE * total)), MOST_SLOTS) for p, n in counts.items()}
    return {p: n for p, n in slots.items() if n > 1}


def shard(buf: np.ndarray, offsets: np.ndarray, langs: pa.Array, max_words: int, common: dict[bytes, int], slots: int = 1):
    """Machines of a block of texts, as rows; None if there is no word."""
    total_slots = MOST_SLOTS * slots
    buf = LOWER[buf]
    array, starts, bounds = words(buf, offsets, SEPARATORS)
    if len(starts) == 0:
        return None
    codes, dictionary = sorted_codes(array)
    size = len(dictionary)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    lang_of, lang_names = coded(langs)
    piece = np.cumsum(BREAKS[buf])[starts]
    run = np.zeros(len(codes), dtype=np.int64)
    run[1:] = np.cumsum((piece[1:] != piece[:-1]) | (row[1:] != row[:-1]))
    spell = dictionary.to_pylist()
    slot_of = np.array([zlib.crc32(w) for w in spell])
    prefix_of, prefixes = coded(pc.binary_slice(dictionary, 0, PREFIX_BYTES))
    slots_of = slots * np.array([common.get(p, 1) for p in prefixes.to_pylist()])[prefix_of]

    def starting(length):
        """Places where a phrase of so many words starts."""
        if length > len(run):
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(run[length - 1 :] == run[: len(run) - length + 1])

    # Single words are counted in slot 0; in the other slots they only lead on.
    two = starting(2)
    machine = (lang_of[row] * len(prefixes) + prefix_of[codes]) * total_slots
    keyed = machine[two] + slot_of[codes[two + 1]] % slots_of[codes[two]]
    keys, _, place = summed(np.concatenate([machine, keyed]), np.zeros(len(machine) + len(two), np.int64))
    found, counts, place = summed(
        place * size + np.concatenate([codes, codes[two]]),
        np.concatenate([np.ones(len(codes), np.int64), np.zeros(len(two), np.int64)]),
    )
    levels, at, place = [Level(found // size, found % size, counts)], two, place[len(codes) :]
    for length in range(2, max_words + 1):
        found, counts, place = summed(place * size + codes[at + length - 1], np.ones(len(at), np.int64))
        levels.append(Level(found // size, found % size, counts))
        if length < max_words:
            longer = starting(length + 1)
            place, at = place[np.searchsorted(at, longer)], longer
    lang, prefix = np.divmod(keys // total_slots, len(prefixes))
    return to_rows(
        lang_names.take(pa.array(lang)), prefixes.take(pa.array(prefix)), keys % total_slots, build(levels, len(keys)), dictionary
    )


def shard_machines(docs: DataFrame, mining: Mining, text: str, lang: str) -> DataFrame:
    """Count machines of every shard."""
    common = prefix_slots(docs, text)
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text}`").alias("text")
    ).where("text is not null")
    slots = 1 + (rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // SLOT_BYTES

    def run(batches):
        for batch in batches:
            langs = batch.column("lang")
            for lo, hi, buf, offsets in blocks(batch.column("text"), BLOCK):
                made = shard(buf, offsets, langs.slice(lo, hi - lo), mining.max_words, common, slots)
                if made is not None:
                    yield made
                    made = None
                    pa.default_memory_pool().release_unused()

    return map_arrow(rows, run, MACHINES)


def _new_keys(table: pa.RecordBatch) -> np.ndarray:
    """Whether a row's machine is another than that of the row before."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for name in KEY:
        column = table.column(name)
        new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return new


def united(table: pa.RecordBatch):
    """Machines of sorted rows, one per key: first rows, levels, dictionary."""
    machines, dictionary = from_rows(table)
    new = _new_keys(table)
    return np.flatnonzero(new), union(levels_of(machines), np.cumsum(new) - 1, len(dictionary)), dictionary


def bounded(table: pa.RecordBatch):
    """Parts of at most `UNITED_ARCS` arcs, or of one row."""
    ends = np.cumsum(table.column("arcs").to_numpy().astype(np.int64))
    lo = 0
    while lo < table.num_rows:
        before = ends[lo - 1] if lo else 0
        hi = max(int(np.searchsorted(ends, before + UNITED_ARCS, side="right")), lo + 1)
        yield table.slice(lo, hi - lo)
        lo = hi


def merged(table: pa.RecordBatch) -> pa.RecordBatch:
    """The same with one row per key."""
    heads, levels, dictionary = united(table)
    return to_rows(*(table.column(c).take(pa.array(heads)) for c in KEY), build(levels, len(heads)), dictionary)


def phrases(table: pa.RecordBatch, least: int):
    """Phrases found `least` times or more: lang, number of words, phrase, count; and all words of a lang."""
    heads, levels, dictionary = united(table)
    lang = table.column("lang").take(pa.array(heads))

    def batch(langs, n_words, spelt, counts):
        return pa.RecordBatch.from_arrays(
            [langs, pa.array(np.full(len(counts), n_words), pa.int32()), pc.cast(spelt, pa.string()), pa.array(counts)],
            ["lang", "n_words", "phrase", "n"],
        )

    of_lang, names = coded(lang)
    total = np.zeros(len(names), dtype=np.int64)
    np.add.at(total, of_lang[levels[0].parents], levels[0].weights)
    yield batch(names, 0, pa.array([""] * len(names)), total)
    for k, level in enumerate(levels):
        often = np.flatnonzero(level.weights >= least)
        node, spelt = often, []
        for above in levels[k::-1]:
            spelt.append(dictionary.take(pa.array(above.labels[node])))
            node = above.parents[node]
        joined = pc.binary_join_element_wise(*spelt[::-1], pa.scalar(b" ", pa.binary()))
        yield batch(lang.take(pa.array(node)), k + 1, joined, level.weights[often])


def frequent_phrases(machines: DataFrame, least: int) -> DataFrame:
    """Unite machines by ranges of their prefixes: (lang, n_words, phrase, n) of the frequent ones, and rows
    of 0 words that add up to all words of a language."""

    def run(batches):
        held = None
        for batch in (part for whole in batches for part in bounded(whole)):
            if held is not None:
                batch = pa.Table.from_batches([held.cast(batch.schema), batch]).combine_chunks().to_batches()[0]
            if batch.num_rows == 0:
                continue
            # The last prefix may go on in the next batch, so its machine is held back.
            last = int(np.flatnonzero(_new_keys(batch))[-1])
            if last:
                yield from phrases(batch.slice(0, last), least)
            held = merged(batch.slice(last))
            pa.default_memory_pool().release_unused()
        if held is not None:
            yield from phrases(held, least)

    sorted_ = machines.repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    return map_arrow(sorted_, run, "lang string, n_words int, phrase string, n long")


def parts_of(phrase: Column, n_words: Column, longest: int) -> Column:
    """All shorter phrases of consecutive words that a phrase holds."""
    split = F.split(phrase, " ")
    return F.flatten(
        F.array(
            *[
                F.transform(
                    F.filter(F.sequence(F.lit(1), F.lit(longest)), lambda s: (s <= n_words - size + 1) & (n_words > size)),
                    lambda s: F.array_join(F.slice(split, s, size), " "),
                )
                for size in range(2, max(longest, 3))
            ]
        )
    )


def collocations(
    docs: DataFrame, mining: Mining = Mining(), text: str = "text", lang: str = "lang", ws: Workspace | None = None
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    ws = ws or Workspace(docs.sparkSession)
    machines = ws.save(shard_machines(docs, mining, text, lang), "machines")
    known = ws.save(frequent_phrases(machines, mining.min_count), "frequent")
    sizes = known.where("n_words = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    counts = known.where("n_words > 0").select("lang", "phrase", F.col("n").alias("f"))
    candidates = known.where("n_words > 1").withColumnRenamed("n", "a")
    split = F.split("phrase", " ")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1))).withColumns(
        {
            "first": F.array_join(F.slice(split, 1, F.col("cut")), " "),
            "rest": F.array_join(F.slice(split, F.col("cut") + 1, F.col("n_words")), " "),
        }
    )
    for part, name in (("first", "l"), ("rest", "r")):
        looked = counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
        cuts = cuts.join(looked, ["lang", part])
    a, l, r = (f"cast({c} as decimal(19,0))" for c in "alr")
    scored = cuts.withColumn("score", F.expr(f"{a} * {a} * cast(1000000 as decimal(7,0)) div ({l} * {r})"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("weakest"))
    covers = (
        candidates.where("n_words > 2")
        .select("lang", F.col("a").alias("longer"), F.explode(parts_of(F.col("phrase"), F.col("n_words"), mining.max_words)).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    alone = weakest.join(covers, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * mining.covered_pct)
    )
    best = Window.partitionBy("lang").orderBy(F.desc("weakest.score"), F.desc("a"), "phrase")
    ranked = alone.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= mining.top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "weakest.l", "weakest.r", "n", "weakest.score"
    )
