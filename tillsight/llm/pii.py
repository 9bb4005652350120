"""Personal data replaced by surrogates.

Entities are found by pattern: e-mail addresses, IP addresses, bank account and social security
numbers, card and telephone numbers, and names after a title. Each is reduced to a canonical form
(lower case, digits only, one word of a name), so one entity has one surrogate however it is written,
in every document. A word of a name is one entity wherever it stands in a name; its gender is that of the
titles it follows as a given name in the whole corpus, and neutral where these differ. A surrogate follows from a secret key and keeps the type: letters stay letters of
the same script and case, digits digits, separators stay; card numbers keep their check digit, given
names the gender that the title tells, addresses their form. Letters of a script that is not listed
here become Latin ones; an address without a letter or digit to change, or one that still collides after
`LONGER` draws, gets a keyed prefix, and a name in such a case two syllables more.

Surrogates are made for the distinct entities of the whole corpus. One that equals another's, or any
entity that occurs, is drawn again for all but the smallest entity, until all differ; all words of names
are compared with each other, in small letters. What still collides after `ATTEMPTS` draws gets a keyed
suffix, at the cost of its form.

Texts are read twice: once for entities, once to be rebuilt from what lies between them. The second
pass joins replacements by the text's digest, and only texts with an entity go into the join. A name
found after a title is also replaced where it stands alone in the same text with a capital; all names at
once, so no surrogate is replaced again. Capitals are those of each occurrence. Only built-in functions
run. A null text stays null, an empty one empty. Repeated rows are rebuilt alike. Other columns stay
as they are, whatever their names.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillsight.llm.text import free_names
from tillsight.workspace import Workspace

MALE = ["Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Signor"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mademoiselle", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Doña", "Signora"]
NEUTRAL = ["Dr", "Prof", "Doctor", "Professor", "Dra"]
GIVEN = {
    "m": ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Marco", "Nils", "Oscar", "Paul"],
    "f": ["Anna", "Berta", "Clara", "Dora", "Elena", "Frida", "Greta", "Hanna", "Irene", "Julia", "Klara", "Lena", "Maria", "Nora", "Olga", "Paula"],
    "n": ["Alex", "Kim", "Robin", "Sascha", "Toni", "Uli", "Charlie", "Sam"],
}
SYLLABLES = ["ba", "de", "fi", "go", "lu", "ka", "me", "ni", "ro", "su", "ta", "ve", "wi", "zo", "ha", "le"]
# Scripts whose letters are replaced by letters of the same string.
SCRIPTS = [
    "abcdefghijklmnopqrstuvwxyz",
    "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœß",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "αβγδεζηθικλμνξοπρστυφχψω",
]


def _first_letters(script: str) -> str:
    """The first letters of a script, small ones where it has two cases."""
    named = (c for c in map(chr, range(0x250, 0x10000)) if unicodedata.name(c, "").startswith(script.upper() + " "))
    own = [c for c in named if unicodedata.category(c) in ("Ll", "Lo") and unicodedata.normalize("NFKC", c) == c]
    return "".join([c for c in own if c.lower() == c][:32])


# Letters for all others of a script, by the script's name.
OTHER_LETTERS = {
    "Latin": "ąăāćčďđęěēėğģħįīķłļľńňņőōŕřśšşţťůűųūŵŷźžż",
    "Cyrillic": SCRIPTS[2],
    "Greek": SCRIPTS[3],
    "Han": "".join(chr(0x4E00 + 163 * k) for k in range(128)),
    "Hangul": "".join(chr(0xAC00 + 87 * k) for k in range(128)),
} | {
    s: _first_letters(s)
    for s in (
        "Hiragana", "Katakana", "Bopomofo", "Arabic", "Hebrew", "Thai", "Devanagari", "Armenian", "Georgian", "Syriac", "Thaana",
        "Bengali", "Gurmukhi", "Gujarati", "Oriya", "Tamil", "Telugu", "Kannada", "Malayalam", "Sinhala", "Lao", "Tibetan",
        "Myanmar", "Ethiopic", "Khmer", "Mongolian",
    )
}
# Digits other than 0-9: ten of each kind.
ZEROS = [0x660, 0x6F0, 0x966, 0x9E6, 0xA66, 0xAE6, 0xB66, 0xBE6, 0xC66, 0xCE6, 0xD66, 0xE50, 0xED0, 0xF20, 0x1040, 0x17E0, 0x1810, 0xFF10]
OTHER_DIGITS = ["".join(chr(z + k) for k in range(10)) for z in ZEROS] + ["⁰¹²³⁴⁵⁶⁷⁸⁹"]
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
TITLES = "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))
NAME = rf"(?<![\p{{L}}])(?:{TITLES})\.? \p{{Lu}}[\p{{L}}'’-]+(?: \p{{Lu}}[\p{{L}}'’-]+)?"
PARTS = [
    r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]{1,64}@[\p{L}\p{M}\p{N}-]{1,63}(?:\.[\p{L}\p{M}\p{N}-]{1,63}){1,8}",
    rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])",
    r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    r"(?<![\p{L}\p{N}+])[0-9](?:[ -]?[0-9]){12,18}(?![\p{L}\p{N}])",
    r"(?<![\p{L}\p{N}])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![\p{L}\p{N}])",
    r"(?<![\p{L}\p{N}])\+[0-9]{8,15}(?![\p{L}\p{N}])",
    NAME,
]
PATTERN = "|".join(PARTS)
# What every entity holds, cheap to look for.
GATE = rf"@|[0-9][0-9 ().-]{{5,}}[0-9]|[A-Z]{{2}}[0-9]{{2}}|(?:{TITLES})\.? \p{{Lu}}"
ATTEMPTS = 24
LONGER = 4


def has_entity(text: Column) -> Column:
    return F.coalesce(text.rlike(GATE) & text.rlike(PATTERN), F.lit(False))


def kind_of(hit: Column) -> Column:
    digits = F.length(F.regexp_replace(hit, "[^0-9]", ""))
    return (
        F.when(F.contains(hit, F.lit("@")), "email")
        .when(hit.rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$"), "ip")
        .when(hit.rlike("^[A-Z]{2}[0-9]{2}"), "account")
        .when(hit.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "social")
        .when(hit.rlike(r"^\p{L}"), "name")
        .when((digits >= 13) & ~hit.startswith("+"), "card")
        .otherwise("phone")
    )


def canonical(kind: Column, hit: Column) -> Column:
    return (
        F.when(kind.isin("email", "account"), F.lower(F.replace(hit, F.lit(" "))))
        .when(kind == "ip", hit)
        .otherwise(F.regexp_replace(hit, "[^0-9+]", ""))
    )


def _name_words(hit: Column) -> Column:
    """Per word of a name after its title: kind and word. One word alone is a family name."""
    title = F.regexp_extract(hit, r"^([\p{L}]+)", 1)
    gender = F.when(title.isin(MALE), "m").when(title.isin(FEMALE), "f").otherwise("n")
    words = F.filter(F.split(F.regexp_replace(hit, r"^[\p{L}]+\.? ", ""), " "), lambda w: w != "")
    last = F.size(words) - 1
    return F.transform(
        words,
        lambda w, i: F.struct(
            F.when(i == last, F.lit("family")).otherwise(F.concat(F.lit("given_"), gender)).alias("kind"),
            F.lower(w).alias("norm"),
            w.alias("written"),
        ),
    )


NAMES = ["family", "given_m", "given_f", "given_n"]


def people(parts: DataFrame) -> DataFrame:
    """Distinct entities (kind, norm); a word of names has one kind in the whole corpus."""
    others = parts.where(~F.col("kind").isin(NAMES)).select("kind", "norm").distinct()
    has = {k: F.max((F.col("kind") == k).cast("int")).alias(k) for k in NAMES}
    words = parts.where(F.col("kind").isin(NAMES)).groupBy("norm").agg(*has.values())
    man, woman = F.col("given_m") == 1, F.col("given_f") == 1
    kind = (
        F.when(man & ~woman, "given_m")
        .when(woman & ~man, "given_f")
        .when(man | woman | (F.col("given_n") == 1), "given_n")
        .otherwise("family")
    )
    return others.union(words.select(kind.alias("kind"), "norm"))


def _stream(secret: str, attempt: int) -> Column:
    """Hex digits drawn for an entity: 128 of them from the key, the kind and the entity."""
    return F.sha2(F.concat_ws("|", F.lit(secret), F.col("kind"), F.lit(str(attempt)), F.col("norm")), 512)


def _draw(stream: Column, i: Column) -> Column:
    at = ((i * 3) % 125).cast("int") + 1
    return F.conv(F.substring(stream, at, 4), 16, 10).cast("int") + (i / 41).cast("int")


def _letters(char: Column, n: Column) -> Column:
    """A letter of the same script, a digit for a digit, and anything else as it is."""
    out = F.when(char.rlike("^[0-9]$"), (n % 10).cast("string"))
    one_of = lambda letters: F.substring(F.lit(letters), n % len(letters) + 1, F.lit(1))
    for k, letters in enumerate(SCRIPTS):
        out = out.when(F.contains(F.lit(letters), char), one_of(letters))
        if k == 0:
            out = out.when(char.rlike(r"^[\x00-\x7F]$"), char)
    for script, letters in OTHER_LETTERS.items():
        out = out.when(char.rlike(rf"^(?=\p{{L}})\p{{Is{script}}}$"), one_of(letters))
    for digits in OTHER_DIGITS:
        out = out.when(F.contains(F.lit(digits), char), one_of(digits))
    return out.when(char.rlike(r"^\p{L}$"), one_of(SCRIPTS[0])).when(char.rlike(r"^\p{N}$"), (n % 10).cast("string")).otherwise(char)


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _ascii(char: Column, n: Column) -> Column:
    """The same where nothing but ASCII can occur."""
    letters = SCRIPTS[0]
    a_letter = F.substring(F.lit(letters), n % len(letters) + 1, F.lit(1))
    return F.when(char.rlike("^[0-9]$"), (n % 10).cast("string")).when(F.contains(F.lit(letters), char), a_letter).otherwise(char)


def _mapped(norm: Column, stream: Column, keep, letters=_ascii) -> Column:
    return F.array_join(
        F.transform(_chars(norm), lambda c, i: F.when(keep(c, i), c).otherwise(letters(c, _draw(stream, i)))), ""
    )


def _luhn(digits: Column) -> Column:
    """Sum of a number's digits in the card sense, for numbers without their check digit."""
    size = F.length(digits)
    values = F.transform(
        _chars(digits),
        lambda c, i: F.when(
            (size - i) % 2 == 1, (c.cast("int") * 2) % 10 + (c.cast("int") * 2 / 10).cast("int")
        ).otherwise(c.cast("int")),
    )
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def _check_digit(body: Column) -> Column:
    return ((10 - _luhn(body) % 10) % 10).cast("string")


def draw(secret: str, attempt: int) -> Column:
    """The surrogate of (kind, norm) at an attempt, in canonical form."""
    kind, norm, stream = F.col("kind"), F.col("norm"), _stream(secret, attempt)
    domain_end = F.length(norm) - F.length(F.substring_index(norm, ".", -1))
    email = _mapped(norm, stream, lambda c, i: i >= domain_end, _letters)
    email = F.when((email == norm) | F.lit(attempt >= LONGER), F.concat(F.substring(stream, 1, 12), email)).otherwise(email)
    octets = F.transform(F.split(norm, r"\."), lambda o, i: (_draw(stream, i) % 254 + 1).cast("string"))
    body = F.substring(norm, F.lit(1), F.length(norm) - 1)
    new_body = _mapped(body, stream, lambda c, i: i < 1)
    was_valid = _check_digit(body) == F.substring(norm, -1, 1)
    last = F.when(was_valid, _check_digit(new_body)).otherwise((_draw(stream, F.lit(40)) % 10).cast("string"))
    phone = _mapped(norm, stream, lambda c, i: norm.startswith("+") & (i < 2))
    account = _mapped(norm, stream, lambda c, i: i < 2)

    def listed(names: list[str]) -> Column:
        return F.element_at(F.array(*[F.lit(n) for n in names]), _draw(stream, F.lit(0)) % len(names) + 1)

    def syllables(n: int, first: int) -> Column:
        return F.concat(
            F.lit(""),
            *[F.element_at(F.array(*[F.lit(x) for x in SYLLABLES]), _draw(stream, F.lit(first + k)) % len(SYLLABLES) + 1) for k in range(n)],
        )

    latin = norm.rlike(r"^[\p{IsLatin}'’-]+$")
    # Other scripts keep their last letter, which tells the gender, and the case of the first.
    size = F.length(norm)
    foreign = _mapped(F.lower(norm), stream, lambda c, i: i == size - 1, _letters)
    foreign = F.initcap(F.concat(syllables(2, 1), foreign) if attempt >= LONGER else foreign)
    longer = min(attempt, 6)
    given = {g: F.concat(listed(GIVEN[g]), syllables(longer, 1)) for g in GIVEN}
    family = F.initcap(syllables(3 + longer // 2, 8))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", F.array_join(octets, "."))
        .when(kind == "card", F.concat(new_body, last))
        .when(kind == "phone", phone)
        .when(kind == "account", account)
        .when(kind == "social", _mapped(norm, stream, lambda c, i: F.lit(False)))
        .when(~latin, foreign)
        .when(kind == "family", family)
        .when(kind == "given_m", given["m"])
        .when(kind == "given_f", given["f"])
        .otherwise(given["n"])
    )


def surrogates(entities: DataFrame, secret: str, ws: Workspace) -> DataFrame:
    """(kind, norm, surrogate) of distinct entities, no two surrogates equal, and none an entity, among
    all names or among entities of another kind. Of several that draw the same, the smallest keeps it."""
    name = F.col("kind").isin(NAMES)
    group = F.when(name, "name").otherwise(F.col("kind")).alias("group")

    def folded(column: str) -> Column:
        return F.when(name, F.lower(column)).otherwise(F.col(column)).alias("folded")

    waiting, accepted = entities, None
    taken = entities.select(group, folded("norm")).distinct()
    for attempt in range(ATTEMPTS + 1):
        new = draw(secret, attempt)
        if attempt == ATTEMPTS:
            new = F.concat(new, F.lit("-"), F.substring(_stream(secret, attempt), 1, 32))
        drawn = ws.save(waiting.withColumn("surrogate", new).select("*", group, folded("surrogate")), f"drawn-{attempt}")
        first = drawn.groupBy("group", "folded").agg(F.min(F.struct("norm", "kind", "surrogate")).alias("least"))
        free = first.join(taken, ["group", "folded"], "left_anti")
        if accepted is not None:
            free = free.join(accepted.select("group", "folded"), ["group", "folded"], "left_anti")
        won = ws.save(free.select("group", "folded", "least.kind", "least.norm", "least.surrogate"), f"won-{attempt}")
        accepted = won if accepted is None else accepted.union(won)
        waiting = drawn.select("kind", "norm").join(won.select("kind", "norm"), ["kind", "norm"], "left_anti")
        if waiting.limit(1).count() == 0:
            break
    return accepted.select("kind", "norm", "surrogate")


def _cased(written: Column, surrogate: Column) -> Column:
    """A name with the capitals of one occurrence."""
    shout = (F.upper(written) == written) & (F.length(written) > 1)
    return F.when(shout, F.upper(surrogate)).otherwise(surrogate)


def _formatted(hit: Column, kind: Column, surrogate: Column) -> Column:
    """A surrogate in the format of one occurrence: separators and capitals of the original."""
    chars = F.split(surrogate, "")
    digit = F.aggregate(
        _chars(hit),
        F.struct(F.lit(0).alias("i"), F.lit("").alias("out")),
        lambda a, c: F.when(
            c.rlike(r"^[0-9+]$"),
            F.struct((a["i"] + 1).alias("i"), F.concat(a["out"], F.get(chars, a["i"])).alias("out")),
        ).otherwise(F.struct(a["i"].alias("i"), F.concat(a["out"], c).alias("out"))),
        lambda a: a["out"],
    )
    # A surrogate that is longer has a prefix; the rest stands over the original's characters.
    more = F.greatest(F.length(surrogate) - F.length(hit), F.lit(0))
    over = lambda c, i: F.when(F.upper(c) == c, F.upper(F.get(chars, i + more))).otherwise(F.get(chars, i + more))
    cased = F.concat(F.substring(surrogate, F.lit(1), more), F.array_join(F.transform(_chars(hit), over), ""))
    spaced = F.aggregate(
        _chars(hit),
        F.struct(F.lit(0).alias("i"), F.lit("").alias("out")),
        lambda a, c: F.when(
            c == " ", F.struct(a["i"].alias("i"), F.concat(a["out"], c).alias("out"))
        ).otherwise(F.struct((a["i"] + 1).alias("i"), F.concat(a["out"], F.upper(F.get(chars, a["i"]))).alias("out"))),
        lambda a: a["out"],
    )
    return (
        F.when(kind == "email", cased).when(kind == "ip", surrogate).when(kind == "account", spaced).otherwise(digit)
    )


def replace(
    docs: DataFrame, secret: str, text: str = "text", ws: Workspace | None = None, count: str | None = None
) -> DataFrame:
    """The rows with surrogates in their texts; with `count`, also the number of entities as a column
    of that name."""
    ws = ws or Workspace(docs.sparkSession)
    body = F.col(f"`{text}`")
    found = docs.select(body.alias("t")).where(has_entity(F.col("t")))
    # Copies of a text are one row from here on.
    found = found.select(F.sha2("t", 256).alias("digest"), F.regexp_extract_all("t", F.lit(PATTERN), F.lit(0)).alias("hits"))
    found = ws.save(found.groupBy("digest").agg(F.first("hits").alias("hits")), "entities")
    hit = found.select("digest", F.posexplode("hits").alias("at", "hit")).withColumn("form", kind_of(F.col("hit")))
    plain = F.array(
        F.struct(F.col("form").alias("kind"), canonical(F.col("form"), F.col("hit")).alias("norm"), F.lit("").alias("written"))
    )
    # Both branches run for every row, so only names are split into words.
    words = F.when(F.col("form") == "name", _name_words(F.col("hit"))).otherwise(plain)
    parts = ws.save(hit.select("digest", "at", "hit", "form", F.posexplode(words).alias("word", "entity")), "parts")
    parts = parts.select("digest", "at", "hit", "form", "word", "entity.kind", "entity.norm", "entity.written")
    chosen = surrogates(ws.save(people(parts), "distinct"), secret, ws)
    # A word of a name has one surrogate, whatever it is in this name.
    group = F.when(F.col("kind").isin(NAMES), "name").otherwise(F.col("kind"))
    named = parts.withColumn("kind", group).join(chosen.withColumn("kind", group), ["kind", "norm"])
    cased = _cased(F.col("written"), F.col("surrogate"))
    new = F.when(F.col("form") != "name", _formatted(F.col("hit"), F.col("kind"), F.col("surrogate"))).otherwise(cased)
    title = F.regexp_extract("hit", r"^([\p{L}]+\.? )", 1)
    by_hit = named.withColumn("new", new).groupBy("digest", "at").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word", "new"))), lambda w: w["new"]), " ").alias("new"),
        F.first(F.when(F.col("form") == "name", title).otherwise("")).alias("title"),
        F.collect_list(F.when(F.col("form") == "name", F.struct("norm", "surrogate"))).alias("names"),
    )
    by_text = by_hit.groupBy("digest").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("at", "title", "new"))), lambda h: F.concat(h["title"], h["new"])
        ).alias("news"),
        F.array_distinct(F.flatten(F.collect_list("names"))).alias("names"),
    )
    news = ws.save(by_text, "replacements")
    hidden = free_names(docs.columns, 5)
    by_length = F.array_sort("names", lambda x, y: F.length(y["norm"]) - F.length(x["norm"]))
    quoted = F.transform(by_length, lambda n: F.concat(F.lit(r"\Q"), n["norm"], F.lit(r"\E")))
    news = news.select(
        F.col("digest").alias(hidden[0]),
        F.col("news").alias(hidden[1]),
        F.when(
            F.size("names") > 0,
            F.concat(F.lit(r"(?<![\p{L}])(?=\p{Lu})(?iu:"), F.array_join(quoted, "|"), F.lit(r")(?![\p{L}])")),
        ).alias(hidden[2]),
        F.map_from_entries(F.transform("names", lambda n: F.struct(n["norm"], n["surrogate"]))).alias(hidden[3]),
    )
    flagged = has_entity(body)
    rest = docs.where(~flagged)
    touched = docs.where(flagged).withColumn(hidden[0], F.sha2(body, 256)).join(news, hidden[0])

    def lone(gap: Column) -> Column:
        """Names that stand alone, all looked up in the original text."""
        found = F.regexp_extract_all(gap, F.col(hidden[2]), F.lit(0))
        put = F.transform(found, lambda m: F.coalesce(_cased(m, F.col(hidden[3])[F.lower(m)]), m))
        between = F.split(gap, F.col(hidden[2]), -1)
        mixed = F.flatten(F.zip_with(between, put, lambda g, n: F.array(g, F.coalesce(n, F.lit("")))))
        return F.when(F.col(hidden[2]).isNull(), gap).otherwise(F.array_join(mixed, ""))

    gaps = F.transform(F.split(body, PATTERN, -1), lone)
    rebuilt = F.array_join(
        F.flatten(F.zip_with(gaps, F.col(hidden[1]), lambda g, n: F.array(g, F.coalesce(n, F.lit(""))))), ""
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    swapped = [rebuilt.alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns]
    n = [] if count is None else [F.size(hidden[1]).cast("long").alias(count)]
    none = [] if count is None else [F.lit(0).cast("long").alias(count)]
    return touched.select(*swapped, *n).unionByName(rest.select(*columns, *none))
