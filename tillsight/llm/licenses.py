"""Licence scans by ordered signature rules.

A text is reduced to its words: A-Z in lower case, everything but letters, digits and non-ASCII
characters dropped, each word between two spaces of its own so that phrases never share one. Rules
are regular expressions over words: names with their versions, SPDX tags, joined short forms (gplv3), and
the wording of notices and headers (`NOTICES`, `PUBLISHED`). A rule is tried only on texts that hold its keyword. Each rule
has a priority, lower first; a detection that lies within another one is dropped unless it has a
strictly lower priority number, and of equal intervals the first rule stays.

Three base phrases are counted besides, and their labels always stay. Only built-in functions run.
A null text is empty and has no words. Repeated rows are scanned one by one. Only the key and the
text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillsight.workspace import Workspace

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The base phrases with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

TAG, FULL, NAME, HINT = range(4)
CONFIDENCE = {TAG: 0.99, FULL: 0.9, NAME: 0.6, HINT: 0.3}

# Licence families: label, keyword, words of the name (| separates spellings), versions.
FAMILIES = [
    ("apache", "apache", "apache license|apache software license|apache", ["1.0", "1.1", "2.0"]),
    ("mit", "mit", "mit license|mit licence", []),
    ("x11", "x11", "x11 license", []),
    ("isc", "isc", "isc license|internet systems consortium license", []),
    ("zlib", "zlib", "zlib license|zlib libpng license", []),
    ("bsl", "boost", "boost software license", ["1.0"]),
    ("mpl", "mozilla", "mozilla public license", ["1.0", "1.1", "2.0"]),
    ("mpl", "mpl", "mpl", ["1.0", "1.1", "2.0"]),
    ("epl", "eclipse", "eclipse public license", ["1.0", "2.0"]),
    ("epl", "epl", "epl", ["1.0", "2.0"]),
    ("cddl", "cddl", "cddl", ["1.0", "1.1"]),
    ("cddl", "distribution", "common development and distribution license", ["1.0", "1.1"]),
    ("eupl", "eupl", "eupl", ["1.0", "1.1", "1.2"]),
    ("eupl", "european", "european union public licence", ["1.0", "1.1", "1.2"]),
    ("ofl", "ofl", "ofl|sil ofl", ["1.0", "1.1"]),
    ("ofl", "font", "sil open font license|open font license", ["1.0", "1.1"]),
    ("artistic", "artistic", "artistic license", ["1.0", "2.0"]),
    ("gpl", "gpl", "gpl|gnu gpl", ["1", "2", "2.0", "3", "3.0"]),
    ("gpl", "general", "gnu general public license|general public license", ["1", "2", "2.0", "3", "3.0"]),
    ("lgpl", "lgpl", "lgpl|gnu lgpl", ["2", "2.0", "2.1", "3", "3.0"]),
    ("lgpl", "lesser", "gnu lesser general public license|lesser general public license", ["2.1", "3", "3.0"]),
    ("lgpl", "library", "gnu library general public license|library general public license", ["2", "2.0"]),
    ("agpl", "agpl", "agpl|gnu agpl", ["1", "3", "3.0"]),
    ("agpl", "affero", "gnu affero general public license|affero general public license", ["1", "3", "3.0"]),
    ("bsd-2-clause", "bsd", "bsd 2 clause license|2 clause bsd license|simplified bsd license|bsd 2 clause", []),
    ("bsd-3-clause", "bsd", "bsd 3 clause license|3 clause bsd license|new bsd license|bsd 3 clause", []),
    ("bsd-4-clause", "bsd", "bsd 4 clause license|original bsd license|bsd 4 clause", []),
    ("bsd", "bsd", "bsd license", []),
    ("unlicense", "unlicense", "the unlicense|unlicense", []),
    ("wtfpl", "wtfpl", "wtfpl", ["1", "2"]),
    ("psf", "python", "python software foundation license|python license", ["2", "2.0"]),
    ("cc0", "cc0", "cc0", ["1.0"]),
    ("public-domain", "domain", "public domain dedication|dedicated to the public domain", []),
    ("odbl", "database", "open database license", ["1.0"]),
    ("gfdl", "documentation", "gnu free documentation license|free documentation license", ["1.1", "1.2", "1.3"]),
]
# Creative Commons: elements of the licence and the same in words.
CC_PARTS = {
    "by": "attribution",
    "by-sa": "attribution share ?alike",
    "by-nd": "attribution no ?derivatives|attribution no ?derivs",
    "by-nc": "attribution non ?commercial",
    "by-nc-sa": "attribution non ?commercial share ?alike",
    "by-nc-nd": "attribution non ?commercial no ?derivatives|attribution non ?commercial no ?derivs",
}
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
# The wording of licences: label, keyword, phrase. `...` stands for up to 40 words, [a] for a word that may be
# missing, a|b for either word, !a for no such word next.
NOTICES = [
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "substantial", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("x11", "consortium", "the name of the x consortium shall not be used in advertising"),
    ("bsl-1.0", "hereby", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("isc", "hereby", "permission to use copy modify and [or] distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("0bsd", "hereby", "permission to use copy modify and [or] distribute this software for any purpose with or without fee is hereby granted !provided"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("zlib", "altered", "altered source versions must be plainly marked as such"),
    ("zlib", "warranty", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-3-clause", "endorse", "neither the name|names of ... may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledgement|acknowledgment"),
    ("apache-2.0", "applicable", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "contributor", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("mpl-2.0", "mpl", "if a copy of the mpl was not distributed with this file"),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl", "accompanying", "the accompanying program is provided under the terms of this eclipse public license"),
    ("epl", "accompanying", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl", "subject", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("eupl", "eupl", "licensed under the eupl"),
    ("ofl", "font", "this font software is licensed under the sil open font license"),
    ("ofl", "font", "the font software may be modified altered or added to"),
    ("artistic-2.0", "permitted", "you are permitted to use the standard version and create and use modified versions for any purpose without restriction"),
    ("artistic-1.0", "package", "you may make and give away verbatim copies of the source form of the standard version of this package without restriction"),
    ("gpl", "redistribute", "this program is free software you can redistribute it and or modify it"),
    ("gpl", "warranty", "this program is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl", "redistribute", "this library is free software you can redistribute it and or modify it"),
    ("lgpl", "warranty", "this library is distributed in the hope that it will be useful but without any warranty"),
    ("agpl", "network", "if you modify the program your modified version must prominently offer all users interacting with it remotely through a computer network"),
    ("gfdl", "document", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "publish", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "fuck", "you just do what the fuck you want to"),
    ("psf", "psf", "this license agreement is between the python software foundation psf"),
    ("cc0-1.0", "waived", "has waived all copyright and related or neighboring rights"),
    ("odbl", "database", "this database is made available under the open database license"),
    ("public-domain", "dedicate", "dedicate any and all copyright interest in the software to the public domain"),
]
# "as published by the Free Software Foundation" puts other words between a name and its version.
PUBLISHED = {
    "gpl": ("gnu general public license", ["1", "2", "3"]),
    "lgpl": ("gnu lesser general public license|gnu library general public license", ["2", "2.1", "3"]),
    "agpl": ("gnu affero general public license", ["1", "3"]),
}
# Families whose short form is written in one word with the version.
JOINED = {"apache", "mpl", "epl", "gpl", "lgpl", "agpl", "gfdl", "cddl", "eupl"}
GRANT = "(?: licensed | released | distributed | available | published )(?: under )(?: the )?(?: terms )?(?: of )?(?: the )?"
VERSION = "(?: version | v )?"
RULE_SCHEMA = "rule int, priority int, label string, keyword string, pattern string"


def spaced(phrase: str) -> str:
    """Every word of a phrase between spaces of its own; `a ?b` may be one word or two."""
    parts = phrase.replace(" ?", "~").split(" ")
    return "".join(f"(?: {p.replace('~', '')} | {p.replace('~', '  ')} )" if "~" in p else f" {p} " for p in parts)


def spellings(names: str) -> str:
    return "(?:" + "|".join(spaced(n) for n in names.split("|")) + ")"


def wording(phrase: str) -> str:
    """Pattern of a notice."""
    parts = []
    for word in phrase.split(" "):
        if word == "...":
            parts.append("(?: [^ ]+ ){0,40}?")
        elif word[0] == "!":
            parts.append(f"(?! {word[1:]} )")
        elif word[0] == "[":
            parts.append(f"(?: {word[1:-1]} )?")
        else:
            parts.append("(?: " + " | ".join(word.split("|")) + " )" if "|" in word else f" {word} ")
    return "".join(parts)


def number(version: str) -> str:
    """Words of a version, also where v and the first number are one word."""
    first, *rest = version.split(".")
    return f"(?: {first} | v{first} )" + "".join(f" {r} " for r in rest)


def rules() -> list[tuple[int, int, str, str, str]]:
    """All rules in their order: number, priority, label, keyword, pattern."""
    made: list[tuple[int, str, str, str]] = []
    families = [*FAMILIES]
    for parts, words in CC_PARTS.items():
        short = "cc " + parts.replace("-", " ")
        families.append((f"cc-{parts}", "cc", short, CC_VERSIONS))
        families.append((f"cc-{parts}", "commons", "|".join(f"creative commons {w}" for w in words.split("|")), CC_VERSIONS))
    for label, keyword, names, versions in families:
        name = spellings(names)
        international = "(?: international | unported | generic )?(?: license )?"
        for version in versions:
            exact = f"{label}-{version}"
            later = number(version) + "(?: or )(?: any )?(?: later )"
            made.append((TAG, exact, "spdx", " spdx  license  identifier " + spaced(label.replace("-", " ")) + number(version)))
            made.append((FULL, f"{exact}-or-later", keyword, name + VERSION + later))
            made.append((FULL, exact, keyword, f"(?:{GRANT})?" + name + "(?: license )?" + VERSION + number(version) + international))
        if not versions:
            made.append((TAG, label, "spdx", " spdx  license  identifier " + spaced(label.replace("-", " "))))
        made.append((FULL if not versions else NAME, label, keyword, GRANT + name))
        made.append((NAME, label, keyword, name))
    made += [(FULL, label, keyword, wording(phrase)) for label, keyword, phrase in NOTICES]
    for label, (names, versions) in PUBLISHED.items():
        for version in versions:
            by = spellings(names) + wording("as published by the free software foundation [either] version") + number(version)
            made.append((FULL, f"{label}-{version}-or-later", "foundation", by + f"(?:{wording('of the license')})?" + wording("[or] at your option any later version")))
            made.append((FULL, f"{label}-{version}", "foundation", by))
            made.append((FULL, f"{label}-{version}", "foundation", spellings(names) + " version " + number(version) + wording("as published by the free software foundation")))
    for label, versions in sorted({(f[0], tuple(f[3])) for f in FAMILIES if f[0] in JOINED and f[1] in (f[0], "documentation")}):
        for version in versions:
            first, *rest = version.split(".")
            for keyword in (f"{label}v{first}", f"{label}{first}"):
                exact = f" {keyword} " + "".join(f" {r} " for r in rest)
                made.append((FULL, f"{label}-{version}-or-later", keyword, exact + wording("or [any] later")))
                made.append((FULL, f"{label}-{version}", keyword, exact))
            if len(rest) and rest == ["0"] and first not in versions:
                made += [(FULL, f"{label}-{version}", k, f" {k} ") for k in (f"{label}v{first}", f"{label}{first}")]
    made.append((HINT, "reserved", "reserved", spaced("all rights reserved")))
    made.append((HINT, "reserved", "droits", spaced("tous droits réservés")))
    made.append((HINT, "reserved", "rechte", spaced("alle rechte vorbehalten")))
    made.append((HINT, "reserved", "derechos", spaced("todos los derechos reservados")))
    made.append((HINT, "copyright", "copyright", " copyright (?: c )? (?:19|20)[0-9][0-9] "))
    made.sort(key=lambda r: r[0])  # stable: within a priority the order above
    return [(k, *r) for k, r in enumerate(made)]


def padded(text: Column) -> Column:
    """The words of a text, each between two spaces."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    words = F.btrim(F.regexp_replace(low, NOT_WORD, "  "))
    return F.concat(F.lit(" "), words, F.lit(" "))


def n_words(pad: Column) -> Column:
    spaces = F.length(pad) - F.length(F.replace(pad, F.lit(" ")))
    return F.when(pad == "  ", 0).otherwise(spaces / 2).cast("long")


def base_places(pad: Column, words: Column, phrase: str) -> dict[str, Column]:
    """How often a phrase occurs, and the word at which it first and last starts."""
    pattern, size = spaced(phrase), len(phrase.split(" "))
    gaps = F.when(F.contains(pad, F.lit(pattern)), F.split(pad, pattern, -1))
    in_gap = lambda gap: ((F.length(gap) - F.length(F.replace(gap, F.lit(" ")))) / 2).cast("long")
    return {
        "n": F.coalesce(F.size(gaps) - 1, F.lit(0)).cast("long"),
        "first": in_gap(F.element_at(gaps, 1)),
        "last": words - in_gap(F.element_at(gaps, -1)) - size,
    }


def detections(rows: DataFrame, spark: SparkSession) -> DataFrame:
    """Matches of all rules whose keyword a text holds: row, start, end, rule, priority, label."""
    table = spark.createDataFrame(rules(), RULE_SCHEMA)
    keywords = sorted({r[3] for r in rules()})
    present = F.filter(
        F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(F.col("pad"), F.concat(F.lit(" "), k, F.lit(" ")))
    )
    # The rules are a fixed list, so the broadcast is bounded.
    tried = rows.select("row", "pad", F.explode(present).alias("keyword")).join(F.broadcast(table), "keyword")
    hits = F.regexp_extract_all("pad", "pattern", F.lit(0))
    gaps = F.transform(F.split(F.col("pad"), F.col("pattern"), F.lit(-1)), F.length)
    both = F.when(
        F.rlike("pad", "pattern"),
        F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(g.alias("gap"), F.length(h).alias("size"))),
    )
    found = tried.select("row", "rule", "priority", "label", F.posexplode(both).alias("at", "match"))
    so_far = Window.partitionBy("row", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("match.gap") + F.col("match.size")).over(so_far)
    return found.select(
        "row", "rule", "priority", "label", end.alias("end"), (end - F.col("match.size")).alias("start")
    )


def suppressed(found: DataFrame) -> DataFrame:
    """Detections that no other one of their row suppresses.

    Within a row, ordered by start and then by falling end, a detection is contained in an earlier
    one if the largest end so far reaches its own; that maximum is kept for each priority apart."""
    order = [F.col("start"), F.col("end").desc(), F.col("priority"), F.col("rule")]
    before = Window.partitionBy("row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # A strictly better rule stays within a weaker one; containers of equal or better priority count.
    container = F.lit(None).cast("long")
    for priority in CONFIDENCE:
        reach = F.max(F.when(F.col("priority") == priority, F.col("end"))).over(before)
        container = F.when(F.col("priority") >= priority, F.greatest(container, reach)).otherwise(container)
    # Equal intervals of a weaker priority come later in the order; they are contained as well.
    kept = found.withColumn("container", container).where(
        F.col("container").isNull() | (F.col("container") < F.col("end"))
    )
    return kept.drop("container")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", ws: Workspace | None = None) -> DataFrame:
    """Per row the key, n_words, places of base phrases, labels, score and number of detections."""
    spark = docs.sparkSession
    ws = ws or Workspace(spark)
    keywords = sorted({r[3] for r in rules()})
    gate = " (?:" + "|".join(keywords) + ") "
    rows = docs.select(F.col(f"`{key}`").alias("key"), padded(F.col(f"`{text}`")).alias("pad"))
    rows = rows.withColumn("n_words", n_words(F.col("pad")))
    places = {p: base_places(F.col("pad"), F.col("n_words"), p) for p in BASE}
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "key", "n_words",
        sum((p["n"] for p in places.values()), F.lit(0)).cast("long").alias("n_base"),
        F.least(*[p["first"] for p in places.values()]).alias("first_word"),
        F.greatest(*[p["last"] for p in places.values()]).alias("last_word"),
        F.array_compact(F.array(*[F.when(places[p]["n"] > 0, F.lit(BASE[p])) for p in BASE])).alias("base"),
        F.when(F.rlike("pad", F.lit(gate)), F.col("pad")).alias("pad"),
    )
    # Written once: that fixes the row numbers, and only texts with a keyword are kept for the rules.
    rows = ws.save(rows, "words")
    kept = suppressed(detections(rows.where(F.col("pad").isNotNull()).select("row", "pad"), spark))
    confidence = F.element_at(F.create_map(*[F.lit(x) for kv in CONFIDENCE.items() for x in kv]), F.col("priority"))
    by_row = kept.groupBy("row").agg(
        F.collect_set("label").alias("found"), F.max(confidence).alias("confidence"), F.count(F.lit(1)).alias("n")
    )
    joined = rows.drop("pad").join(by_row, "row", "left")
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union(F.col("base"), F.coalesce(F.col("found"), none)))
    floor = F.when(F.col("n_base") > 0, CONFIDENCE[HINT]).otherwise(0.0)
    return joined.select(
        F.col("key").alias(key), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce("confidence", F.lit(0.0)), floor).alias("score"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_detections"),
    )
