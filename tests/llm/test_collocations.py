"""Collocations against brute force, and the machines that count phrases."""

import re
from collections import Counter

import numpy as np
import pytest

from tillsight.llm import automata, collocations
from tillsight.llm.collocations import Mining


def by_hand(docs, mining):
    counts, sizes = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, mining.max_words + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= mining.min_count}
    covered = Counter()
    for (lang, words), a in found.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = (lang, words[i : i + k])
                covered[part] = max(covered[part], a)
    rows = []
    for (lang, words), a in found.items():
        if (lang, words) in covered and 100 * covered[lang, words] >= mining.covered_pct * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        rows.append((lang, -score, -a, " ".join(words).encode(), l, r))
    out, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= mining.top:
            out.append((lang, rank[lang], phrase.decode(), -a, l, r, sizes[lang], -score))
    return out


def corpus():
    draw = np.random.default_rng(4)
    words = ["New", "york", "the", "of", "ÉTÉ", "été", "a", "日本", "x y", "end"]
    docs = []
    for k in range(300):
        chosen = draw.choice(words, draw.integers(0, 60), p=[0.05, 0.05, 0.4, 0.1, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05])
        ends = draw.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b"], len(chosen), p=[0.7, 0.05, 0.05, 0.1, 0.05, 0.025, 0.025])
        docs.append(("".join(w + e for w, e in zip(chosen, ends)), [None, "en", "de", "und"][k % 4]))
    docs += [(None, "en"), ("", None), ("...", "en"), ("one", "xx"), ("the the the the " * 2000, "en")] + [docs[7]] * 5
    return docs


@pytest.mark.parametrize("mining", [Mining(), Mining(4, 3, 80, 40), Mining(2, 2, 50, 1000)])
def test_against_brute_force(spark, ws, mining):
    docs = corpus()
    df = spark.createDataFrame([(t, l, "z", 1) for t, l in docs], "text string, lang string, phrase string, n int").repartition(5)
    got = [tuple(r) for r in collocations.collocations(df, mining, ws=ws).orderBy("lang", "rank").collect()]
    assert got == by_hand(docs, mining)
    assert len(got) > 20


def test_split_words_and_batches(spark, monkeypatch):
    """Very common words are split by the next word; machines of one prefix may come in many batches."""
    docs = corpus()
    df = spark.createDataFrame(docs, "text string, lang string").repartition(9)
    assert collocations.prefix_slots(df, "text")[b"the"] > 100
    rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = [tuple(r) for r in collocations.collocations(df).orderBy("lang", "rank").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    assert got == by_hand(docs, Mining())


def test_empty_table(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(none).collect() == []


def test_machines_keep_phrases_and_share_ends():
    draw = np.random.default_rng(9)
    top = np.sort(draw.choice(50 * 6, 80, replace=False))
    first = automata.Level(top // 6 // 10, top % 60, draw.integers(1, 3, 80))
    keys = np.sort(draw.choice(80 * 4, 120, replace=False))
    second = automata.Level(keys // 4, keys % 4, draw.integers(1, 3, 120))
    made = automata.build([first, second], 7)
    back = automata.levels_of(made)
    for a, b in zip([first, second], back, strict=True):
        assert all((x == y).all() for x, y in zip((a.parents, a.labels, a.weights), (b.parents, b.labels, b.weights)))
    # states besides the final and the first one of each machine are fewer than the phrases that go on
    assert made.states.sum() - 3 * 7 < len(np.unique(second.parents))
    twice = [automata.Level(np.concatenate([l.parents, l.parents + n]), np.tile(l.labels, 2), np.tile(l.weights, 2)) for l, n in ((first, 7), (second, 80))]
    both = automata.union(twice, np.tile(np.arange(7), 2), 60)
    assert (both[0].weights == 2 * first.weights).all() and (both[1].weights == 2 * second.weights).all()
    assert (both[1].labels == second.labels).all()
