"""Encoding, host rules, toxicity, mixing: against brute force, and the cases their docstrings name."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tillsight.llm import bpe, host_rules, mixing, toxicity
from tillsight.llm.queries import table

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tokenizer():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=400):
    parts = ["'", "'s", "'re", "'ll", "'v", " ", "  ", "\n", "\t", "a", "b", "é", "9", "²", "!", "''", "漢", "😀", "don", "́", "_", "ve", "\x85"]
    draw = random.Random(1)
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(n)]
    return [*texts, "", None, "a" * 3000, " " * 500, "ab" * 4000 + "'s", "x\x00y"]


def rows_of(spark, texts, extra="ids string"):
    return spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], f"doc_id long, text string, {extra}")


def test_encoding_equals_the_library_and_decodes_back(spark, tokenizer):
    texts = odd_texts()
    docs = rows_of(spark, texts)
    got = {r.doc_id: r for r in bpe.encoded_digests(docs, RANKS).collect()}
    for k, text in enumerate(texts):
        ids = tokenizer.encode_ordinary(text or "")
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    back = bpe.decode(bpe.encode(docs, RANKS).drop("piece_offsets"), RANKS).collect()
    assert all(bytes(r.decoded) == (texts[r.doc_id] or "").encode() for r in back)
    offsets = bpe.encode(docs, RANKS).where("doc_id = 0").first()
    assert len(offsets.piece_offsets) <= len(offsets.ids)
    assert bpe.encoded_digests(docs.limit(0), RANKS).collect() == []
    assert {r.doc_id: list(r.ids) for r in bpe.encoded_and_checked(docs, RANKS).collect()}[2] == tokenizer.encode_ordinary(texts[2])


def counts_by_hand(text):
    words = WORD.findall(text or "")
    triples = collections.Counter(zip(words, words[1:], words[2:]))
    marked = {i + k for i in range(len(words) - 2) if triples[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, again, len(marked)


def test_host_rules_count_as_by_hand(spark):
    texts = [*odd_texts(60), "a b c a b c", "x\nx\n\n x\nx", "é à\x0bé | # ü", "w " * 60]
    docs = spark.createDataFrame([(k, t, None if k % 7 == 0 else f"h{k % 3}", 1) for k, t in enumerate(texts)], "doc_id long, text string, source string, kept int")
    got = {r.doc_id: r for r in host_rules.judge(docs).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        n, chars, symbols, lines, repeats = counts_by_hand(text)
        row = got[k]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert row.base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert not (row.base_failed and row.kept)
    assert host_rules.judge(docs.limit(0)).collect() == []


def test_bad_hosts_are_rejected_and_small_ones_shrunk(spark):
    good, bad = " ".join(f"w{k}" for k in range(60)), "short"
    rows = [(good, f"g{k % 20}") for k in range(2000)] + [(bad, "worst")] * 400 + [(good, "worst")] * 4 + [(bad, "tiny"), (good, "tiny2")]
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, source string")
    got = host_rules.judge(docs).collect()
    assert all(not r.kept for r in got if r.host == "worst")
    assert all(r.kept for r in got if r.host.startswith("g") or r.host == "tiny2")
    rate = {r.host: r.shrunk_rate for r in got}
    assert rate["tiny"] < 1 and rate["worst"] > 0.9 > rate["tiny"]


def test_toxicity_learns_from_documents_and_finds_sentences(spark):
    draw = random.Random(3)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu") for b in ("ra", "se", "to", "vu", "za")]
    rows, labels = [], []
    for k in range(900):
        sentences = [" ".join(draw.choices(plain, k=8)) + "." for _ in range(6)]
        toxic = k % 4 == 0
        if toxic:
            sentences[k % 6] = sentences[k % 6].replace(" ", " " + draw.choice(["slimeball", "slimebag", "crook"]) + " ", 1)
        rows.append((k, " ".join(sentences), "x"))
        labels.append((k, int(toxic)))
    rows += [(2000, None, "x"), (2001, "", "x"), (2002, "...\n", "x"), (2003, "É ñ " * 50_000, "x"), (5, rows[5][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labelled = spark.createDataFrame([*labels, (None, 1), (7777, None)], "doc_id long, toxic int")
    model = toxicity.trained(docs, labelled)
    got = toxicity.score(docs, model).withColumn("out", toxicity.held_out("doc_id")).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        assert 0 <= r.score <= 1
        assert r.out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.doc_id < 900:
            assert (r.score >= 0.7) == (r.doc_id % 4 == 0)
            assert all(re.search("slime|crook", text[r.doc_id][s.start : s.end]) for s in r.sentences)
            assert bool(r.sentences) == (r.doc_id % 4 == 0)
    assert {r.doc_id: r.score for r in got}[2000] == 0
    none = toxicity.trained(docs, labelled.limit(0))
    assert max(r.score for r in toxicity.score(docs, none).collect()) < 0.7 or none.weights == {}
    kept = toxicity.keep_mild(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id < 900").count() == 676
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_toxicity_generalises_to_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.trained(docs, labels)
    got = toxicity.score(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), model)
    got = got.join(labels, "doc_id").where(toxicity.held_out("doc_id")).collect()
    right = np.mean([(r.score >= 0.7) == (r.toxic == 1) for r in got])
    assert right > 0.97
    assert not [r for r in got if r.toxic == 0 and r.score >= 0.9]


def test_rates_meet_the_shares(spark, ws):
    docs, labels = table(spark, SF, "documents"), mixing.quality_domains(table(spark, SF, "labels"))
    shares = {"high": 0.9, "low": 0.1}
    extra = docs.select("doc_id", "text", "lang").limit(1).selectExpr("null doc_id", "cast(null as string) text", "lang")
    docs = docs.select("doc_id", "text", "lang").union(extra).withColumnRenamed("lang", "rate")
    rows = mixing.rates(docs, labels, shares, ws=ws).toPandas()
    assert len(rows) == docs.count() and (rows.rate >= 0).all()
    totals = [(rows.tokens * rows[f"p_{d}"] * rows.rate).sum() for d in ("high", "low")]
    assert totals[0] / sum(totals) == pytest.approx(0.9, abs=0.01)
    assert (np.abs(rows.copies - rows.rate) < 1).all()
    # The same steps in numpy give the same rates.
    model, plan, members = mixing.fitted(docs, labels, shares, "doc_id", "text", mixing.SampleBounds(), mixing.Descent(), ws)
    some = members.toPandas()
    by_hand = plan.rates(some[["p0", "p1"]].to_numpy())
    assert np.allclose(sorted(by_hand), sorted(rows.rate))
    out = mixing.mixed(docs, labels, shares)
    assert out.columns == docs.columns and out.count() == rows.copies.sum()
    assert mixing.rates(docs.limit(0), labels, shares).count() == 0
    alone = mixing.rates(docs, labels.limit(0), shares).toPandas()
    assert (alone.copies == 1).all()


def test_copies_meet_the_shares_where_a_third_is_low(spark, ws):
    draw = random.Random(6)
    word = lambda: "".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 9)))
    high = [" ".join(word() for _ in range(60)) + "." for _ in range(3000)]
    low = [" ".join(draw.choice(["| #", "9|9", "$$ *", "<>", "BUY", word()]) for _ in range(32)) for _ in range(2000)]
    rows = [(k, t, "high" if k < 3000 else "low") for k, t in enumerate(high + low)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    shares = {"high": 0.97, "low": 0.03}
    got = mixing.rates(docs.drop("domain"), docs.drop("text"), shares, ws=ws).toPandas()
    have = (got.tokens * got.p_low).sum() / got.tokens.sum()
    assert 0.3 < have < 0.37 and got[got.doc_id >= 3000].rate.median() < 0.1
    for times in ("rate", "copies"):
        assert (got.tokens * got.p_low * got[times]).sum() / (got.tokens * got[times]).sum() == pytest.approx(0.03, abs=0.008), times
    assert (got.tokens * got.copies).sum() == pytest.approx((got.tokens * got.rate).sum(), rel=0.02)
    out = mixing.mixed(docs, docs.drop("text"), shares)
    assert out.count() == got.copies.sum() and out.where("domain = 'low'").count() > 50


def test_clean_documents_do_not_score_by_length(spark):
    draw = random.Random(9)
    clean = lambda n: " ".join(f"w{draw.randrange(40)} w{draw.randrange(40)}." for _ in range(n))
    texts = [clean(6) + (" you slimeball." if k % 4 == 0 and k % 20 else "") for k in range(800)]
    rows = pa.table({"label": [int(k % 4 == 0) for k in range(800)], "text": texts})  # one in five unexplained
    bounds = toxicity.TrainingBounds(words=1)
    long = "x y z.\n" * 100_000
    docs = spark.createDataFrame([(1, long), (2, long + "you slimeball."), (3, "x y z.")], "doc_id long, text string")
    for model, kept in ((toxicity.fit(rows, bounds), {1, 3}), (toxicity.fit(rows.slice(0, 0), bounds), {1, 2, 3})):
        got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
        assert got[1] == got[3] == 0 and (got[2] >= 0.7) == (2 not in kept)
        assert {r.doc_id for r in toxicity.keep_mild(docs, model).collect()} == kept
