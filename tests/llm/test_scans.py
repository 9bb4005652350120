"""Native scans, surrogates, the join and the pipeline."""

import collections
import hashlib
import random
import re
import unicodedata

import pytest

import corpus_pipeline
from tillsight.llm import jaccard_join, licenses, pii, secret_scan
from tillsight.llm.components import components
from tillsight.llm.queries import table

SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets_by_hand(text):
    text, out = text or "", []
    out += [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def test_secrets_against_brute_force(spark):
    draw = random.Random(2)
    parts = ["token", "Secret", "api_key", "apikey", "passwd", "=", ": ", '"', "'", "AKIA", "AKIA" + "Q" * 15, "abc", "0123456789abcdef", "é", " ", "\n", "abcdefghijkl", "ſecret=aaaaaaaaaaaaaa", "Z9-"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 25))) for _ in range(400)]
    texts += [None, "", "token=secret: abcdefghijklmnop", "0123456789abcdef" * 3000, texts[7]]
    docs = spark.createDataFrame([(k, t, f"o{k % 5}", "x") for k, t in enumerate(texts)], "doc_id long, text string, source string, spans string")
    docs = docs.union(docs.where("doc_id = 7"))
    got = secret_scan.scan(docs).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        spans = secrets_by_hand(texts[r.doc_id])
        kinds = collections.Counter(s.split(":")[0] for s in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("owned")] == spans
    assert secret_scan.scan(docs.limit(0)).collect() == []


def test_copied_secrets_are_told_from_owned_ones(spark):
    shared, own = "token=a1b2c3d4e5f6g7h8i9", "token=z9y8x7w6v5u4t3s2r1"
    rows = [(k, shared, f"o{k}") for k in range(4)] + [(9, f"é {own} {shared}", "o9"), (10, "token=aaaaaaaaaaaaaaaa1", None)]
    got = {r.doc_id: r for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0].n_copied == 1 and got[0].n_owned == 0
    assert got[9].spans == "assign:2:26,owned:8:26,assign:27:51" and got[9].n_owned == 1
    assert got[10].n_owned == 0


def licenses_by_hand(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


LINES = {
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "Released under the MIT License.": "mit",
    "SPDX-License-Identifier: GPL-3.0": "gpl-3.0",
    "GNU General Public License, version 2 or any later version": "gpl,gpl-2-or-later",
    "GNU Lesser General Public License version 2.1": "gpl,lgpl-2.1",
    "Creative Commons Attribution-ShareAlike 4.0 International": "cc-by-sa-4.0",
    "licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0",
    "All rights reserved. Copyright (c) 2020 X": "copyright,reserved",
    "BSD 3-Clause License": "bsd-3-clause",
    "nothing at all about it": "",
}


def test_secrets_of_many_repositories_are_examples(spark):
    """Copies in many documents of one source count as widely copied, too."""
    value = "Zx9Qw8Er7Ty6Ui5Op4"
    rows = [(k, f"token = {value}", "one") for k in range(25)] + [(100 + k, f"token = {value[::-1]}", "one") for k in range(24)]
    got = {r.doc_id: r for r in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert (got[0].n_copied, got[0].n_owned, got[0].max_owners, got[0].max_repos) == (1, 0, 1, 25)
    assert (got[100].n_copied, got[100].n_owned, got[100].max_owners, got[100].max_repos) == (0, 1, 1, 24)


def test_licenses(spark):
    draw = random.Random(4)
    parts = ["cc", "by", "CC BY", "general", "public", "license", "General Public License", " ", "-", ", ", "\n", "é", "all rights", "reserved", "x"]
    texts = [" ".join(draw.choices(parts, k=draw.randint(0, 14))) for _ in range(300)] + [None, "", "...", "CC\x00BY", "cc by " * 4000, *LINES]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, labels string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for k, text in enumerate(texts):
        r = got[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == licenses_by_hand(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        if text in LINES:
            assert r.labels == LINES[text], text
    assert 200 < len(licenses.rules()) == len({r[0] for r in licenses.rules()})
    assert licenses.scan(docs.limit(0)).collect() == []


NOTICES = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated": {"mit"},
    "The above copyright notice and this permission notice shall be included in all\n * copies or substantial portions of the Software.": {"mit"},
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license": {"bsl-1.0"},
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above": {"isc"},
    "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted.": {"0bsd"},
    "2. Altered source versions must be plainly marked as such, and must not be": {"zlib"},
    "The origin of this software must not be misrepresented; you must not claim": {"zlib"},
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided": {"bsd"},
    "Neither the name of the X Foundation nor the names of its contributors may be used to endorse or promote products derived from this software": {"bsd-3-clause"},
    "All advertising materials mentioning features or use of this software must display the following acknowledgement": {"bsd-4-clause"},
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS": {"apache-2.0"},
    "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": {"gpl", "gpl-3-or-later"},
    "GNU Lesser General Public License as published by the Free Software Foundation; version 2.1 of the License": {"gpl", "lgpl-2.1"},
    "GNU General Public License version 2 as published by the Free Software Foundation": {"gpl", "gpl-2"},
    "This is free and unencumbered software released into the public domain.": {"unlicense"},
    "The person has waived all copyright and related or neighboring rights": {"cc0-1.0"},
    "If a copy of the MPL was not distributed with this file": {"mpl-2.0"},
    "GPLv3": {"gpl-3"}, "(GPLv2+)": {"gpl-2"}, "LGPLv3 here": {"lgpl-3"}, "LGPLv2.1": {"lgpl-2.1"}, "gplv2 or later": {"gpl-2-or-later"},
    "AGPLv3": {"agpl-3"}, "MPLv2.0": {"mpl-2.0"}, "GPL3": {"gpl-3"}, "Apachev2": {"apache-2.0"},
}


def sample(phrase):
    words = [w.split("|")[0] for w in phrase.split(" ") if w[0] not in "![" and w != "..."]
    return " ".join(words)


def test_licenses_by_wording_and_joined_short_forms(spark):
    texts = [*NOTICES, *[sample(p) for _, _, p in licenses.NOTICES]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: set(filter(None, r.labels.split(","))) for r in licenses.scan(docs).collect()}
    for k, (text, labels) in enumerate(NOTICES.items()):
        assert got[k] == labels, (text, got[k])
    for k, (label, keyword, phrase) in enumerate(licenses.NOTICES, len(NOTICES)):
        assert keyword in sample(phrase).split(), phrase
        assert any(x == label or x.startswith(label + "-") for x in got[k]), (phrase, got[k])


def test_suppression_by_containment_and_priority(spark):
    found = spark.createDataFrame(
        [(1, 1, 2, "name", 10, 0), (1, 2, 1, "full", 20, 0), (1, 3, 1, "same", 20, 0), (1, 4, 0, "tag", 8, 4), (1, 5, 1, "cross", 30, 15), (2, 1, 2, "name", 10, 0)],
        "row long, rule int, priority int, label string, end long, start long",
    )
    kept = {(r.row, r.label) for r in licenses.suppressed(found).collect()}
    assert kept == {(1, "full"), (1, "tag"), (1, "cross"), (2, "name")}


PERSONAL = [
    (1, "Call Mr. John Smith at +1 (437) 555-0689. Smith said jo.81@Mail7.example.com, JO.81@mail7.example.com!", "a"),
    (2, "Mrs. Jane Smith, Frau Müller; card 4539 1488 0343 6467 ip 217.75.41.129, ssn 123-45-6789, DE89 3704 0044 0532 0130 00", "a"),
    (3, None, "a"), (4, "", "a"), (5, "nothing here 2024 and 12 345", "a"), (6, "4539148803436467 jo.81@mail7.example.com", "b"),
    (7, "г-н Mr. Иван Петров", "b"),
]


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def test_surrogates(spark):
    docs = spark.createDataFrame([*PERSONAL, PERSONAL[0]], "doc_id long, text string, hits string")
    rows = pii.replace(docs, "key", count="n").collect()
    assert len(rows) == 8
    got = {r.doc_id: r.text for r in rows}
    assert [r.text for r in rows if r.doc_id == 1][0] == [r.text for r in rows if r.doc_id == 1][1]
    assert got[3] is None and got[4] == "" and got[5] == PERSONAL[4][1]
    for secret in ("John", "Smith", "jo.81", "437", "0689", "Jane", "Müller", "4539 1488", "217.75", "123-45", "3704", "Петров"):
        assert not any(secret in (t or "") for t in got.values()), secret
    first = re.match(r"Call Mr\. (\w+) (\w+) at \+1 \(\d{3}\) \d{3}-\d{4}\. (\w+) said (\S+), (\S+)!", got[1])
    assert first and first[2] == first[3] and first[4].lower() == first[5].lower()
    second = re.match(r"Mrs\. (\w+) (\w+), Frau (\w+); card (\d{4} \d{4} \d{4} \d{4}) ip", got[2])
    assert second[2] == first[2] != second[3] and luhn(second[4])
    assert first[1] in pii.GIVEN["m"] and second[1] in pii.GIVEN["f"]
    assert got[6] == f"{second[4].replace(' ', '')} {first[5].lower()}"
    assert re.fullmatch(r"г-н Mr\. [А-Яа-я]+ [А-Яа-я]+", got[7])
    assert pii.replace(docs.limit(0), "key").collect() == []
    assert pii.replace(docs, "key").columns == docs.columns


def test_people_stay_apart_and_themselves(spark):
    """One surrogate per word of a name in the whole corpus, whatever else is a name there."""
    texts = [
        "Mr. Qadn Carl came. Qadn left, then Carl.", "MR SMITH? Mr. SMITH and Mrs. Smith: SMITH, Smith, smith.", "Dr. John or Mr. John Adam, John.",
        "Mr. Adam Bruno met Mr. Bruno Carl and Carl.", "Herr David Emil, David", "Frau Toni Emil, Toni", "Frau Anna-Lena O’Neil. Anna-Lena O’Neil, Anna",
    ]
    rows = [(k, t, "a", "b", "c") for k, t in enumerate(texts * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __news string, __digest string, own_0 string")
    out = pii.replace(docs, "key")
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert all(got[k] == got[k + len(texts)] for k in range(len(texts)))
    words = re.compile(r"[^\W\d_]+(?:[-’][^\W\d_]+)*")
    known, back = {}, {}
    for k, text in enumerate(texts):
        before, after = words.findall(text), words.findall(got[k])
        assert len(before) == len(after) and words.split(text) == words.split(got[k])
        for a, b in zip(before, after):
            if a != b:
                assert known.setdefault(a.lower(), b.lower()) == b.lower() and back.setdefault(b.lower(), a.lower()) == a.lower()
                assert a.isupper() == b.isupper() and a[0].isupper() == b[0].isupper()
    names = {"qadn", "carl", "smith", "john", "adam", "bruno", "david", "emil", "toni", "anna-lena", "o’neil"}
    assert set(known) == names and not names & set(back)
    assert got[1].endswith("smith.") and got[6].endswith(", Anna")
    # a given name has the gender of the titles it follows, here or elsewhere
    assert known["david"].title().startswith(tuple(pii.GIVEN["m"])) and known["toni"].title().startswith(tuple(pii.GIVEN["f"]))


def test_surrogates_stay_distinct(spark, ws):
    names = spark.createDataFrame([("given_m", f"Name{chr(97 + k % 26)}{chr(97 + k // 26)}") for k in range(300)] + [("ip", f"1.2.3.{k}") for k in range(100)], "kind string, norm string")
    rows = pii.surrogates(names, "key", ws).collect()
    assert len(rows) == 400 == len({(r.kind, r.surrogate) for r in rows})
    assert not {r.surrogate for r in rows} & {r.norm for r in rows}


FOREIGN = [
    "转自@小明.今天", "سلام@مثال.شبكة", "שלום@דוגמה.קום", "สมชาย@ตัวอย่าง.ไทย", "नाम@उदाहरण.भारत", "はなこ@カタカナ.みんな", "홍길동@보기.한국",
    "łőčş@żółw.pl", "ћђ@ї.укр", "ήώ@ά.ελ", "ⴰⴱ@ⵣ.com", "𠮷@𠮷.jp", "Åse.ŁOŠ@X.no", "١٢@٣.com", "_@-.com", "%@-.com", "İz@b.com",
]


def test_addresses_of_every_script_are_replaced(spark):
    docs = spark.createDataFrame([(k, f"({t}) {t}") for k, t in enumerate(FOREIGN)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.replace(docs, "key").collect()}
    assert len(got) == len(FOREIGN)
    for k, text in enumerate(FOREIGN):
        new = re.fullmatch(r"\((.*)\) (.*)", got[k])
        assert new and new[1] == new[2] != text, text
        assert new[1].endswith(text[text.rindex(".") :]), (text, new[1])
        if text not in ("_@-.com", "%@-.com"):
            local = text[: text.index("@")]
            changed = [(a, b) for a, b in zip(local, new[1], strict=False) if a.isalnum() and a != b]
            assert changed, (text, new[1])
            if len(new[1]) == len(text) and text[0] != "ⴰ":
                first = lambda c: unicodedata.name(c).split()[0]
                assert all(first(a) == first(b) or a.isdigit() for a, b in changed), (text, new[1])
    assert len({t.lower() for t in got.values()}) == len(FOREIGN)


def test_names_of_two_letters_find_a_surrogate(spark, ws):
    letters = "абвгдежзийклмнопрстуфхцчшщъыьэюя"
    names = spark.createDataFrame([("family", c.upper() + "я") for c in letters], "kind string, norm string")
    rows = pii.surrogates(names, "key", ws).collect()
    assert len({r.surrogate for r in rows}) == len(letters) and not {r.surrogate for r in rows} & {r.norm for r in rows}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def classes_by_hand(texts):
    sets = {k: shingles(t) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    keys = sorted(k for k in sets if sets[k])
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.fixture(scope="module")
def copies():
    draw = random.Random(8)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    base = [word() for _ in range(90)]
    texts = {1000 + k: " ".join(word() for _ in range(draw.randint(1, 60))) for k in range(60)}
    for k in range(70):  # near copies, each its own change
        text = list(base)
        text[draw.randrange(90)] = word()
        if k % 3 == 0:
            text += [word() for _ in range(draw.randint(0, 6))]
        texts[k + 5] = " ".join(text)
    for k in range(30):  # a common passage in different texts
        texts[200 + k] = " ".join([word() for _ in range(20)] + base[:40] + [word() for _ in range(20)])
    for k in range(25):  # a chain: each close to the next
        texts[300 + k] = " ".join(f"c{j}" for j in range(k * 3, k * 3 + 40))
    texts |= {400: None, 401: "", 402: " \n", 403: "One two", 404: "one TWO", 405: "one two three four five", 406: texts[5].upper(), 407: texts[5]}
    return texts


def test_classes_against_brute_force(spark, copies, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CELL", 4)
    docs = spark.createDataFrame([(k, t, 1) for k, t in copies.items()], "doc_id long, text string, n int").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.classes(docs).collect()}
    assert got == classes_by_hand(copies)


def test_one_document_of_each_class_stays(spark, copies):
    docs = spark.createDataFrame([(k, t, 1) for k, t in copies.items()], "doc_id long, text string, sid int")
    docs = docs.union(docs.where("doc_id in (5, 1003, 401)")).union(docs.limit(1).selectExpr("null", "'no id here'", "1"))
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    expected = sorted(k for k, (_, c) in classes_by_hand(copies).items() if k == c)
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == expected
    assert kept.where("doc_id is null").count() == 1
    assert jaccard_join.one_of_each(docs.limit(0)).collect() == []


def test_components_of_a_path_and_a_star(spark, ws):
    edges = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(1001, 1050)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), ws).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 1000 for k in range(1000, 1050)}


def test_pipeline_keeps_clean_documents(spark):
    docs = table(spark, SF, "documents")
    labels = {r.doc_id: r for r in table(spark, SF, "labels").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = corpus_pipeline.run(spark, SF).collect()
    ids = {r.doc_id for r in out}
    by_hand = classes_by_hand(texts)
    good = [k for k, r in labels.items() if r.quality == 1 and r.toxic == 0]
    firsts = [k for k in good if by_hand[k][1] == k]
    assert len([k for k in firsts if k in ids]) >= 0.97 * len(firsts)
    assert not [k for k in ids if by_hand[k][1] != k and by_hand[k][1] in ids]
    assert all(len(r.ids) == r.n_tokens for r in out)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "jaccard_join", "pii", "mixing", "bpe"]
