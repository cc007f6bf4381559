"""Surrogates for personal data: keyed, type-consistent, distinct and coreferent replacements.

Entities are found by one pattern: e-mail and IPv4 addresses, telephone, card and US social
security numbers, IBANs, access keys, values of passwords and tokens, and names after a
title (Latin, Cyrillic or Greek). Each gets a replacement that depends on a
secret key, its type and its canonical form alone, so one entity has one
replacement in the whole corpus:

- character classes (of any script), separators and country codes stay; card numbers that pass the Luhn check still do; hex stays hex;
  addresses lie below a reserved domain; octets stay octets;
- names are replaced word by word by syllables of the word's own script, capitals kept; a further
  attempt has a syllable more, so there are always more names than entities. A word is one entity whatever
  its case, title and place ("Mr. John Smith", "Dr. John SMITH" and "Mr. John" agree): its ending is male or female
  if all titles before which it is a first name have that gender, in the whole corpus, else neither.
  Particles stay; an initial becomes another letter, the same for the same letter.

A further mention of a name that a text holds after a title ("Mr. John Smith came. Later Smith left.") is
replaced too, where the word stands alone with the same capitals; mentions are not counted as entities.

Collision check: the distinct entities of the corpus (counted map-side, so a hot
one is one row) are replaced, and a replacement that two entities share, or
that is itself an entity, is drawn again with a next attempt until none is left.
From attempt 2 a form grows by one character with each attempt (an IPv4 address moves to the
IPv6 documentation range instead), so it outgrows every entity and the space of forms outgrows their
number: the loop ends also where a shape is used up or cannot change.
The few entities with attempts above 0, or with another gender than their place says, are looked up while
the texts are rewritten: within the row if they are at most ``INLINE``, else by a join.

Native: texts are split and rebuilt by DataFrame expressions, where they lie.

Edge cases: a secret without a letter or digit (``********``) is a mask and no entity; a null text stays null, without entities; a text without entities stays as it is;
equal texts are rewritten alike; an empty table gives no rows. Extra columns pass through; a result
column whose name is taken gets a trailing ``_``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, free_names

KEY = "surrogates-1"
#: Entities with another attempt or gender that are looked up within the row at most.
INLINE = 500

#: Titles by gender. Fixed values.
TITLES = {
    "m": ["Mr", "Herr", "Señor", "Sr", "Monsieur", "Don", "господин", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Señorita", "Madame", "Mme", "Mademoiselle", "госпожа", "κυρία"],
    "n": ["Dr", "Prof"],
}
#: Syllables and endings (male, female, either) by script. Fixed values.
SYLLABLES = {
    "latin": ("bal ber bran cal car cor dal dan dor el fal fer gar gil hal har jon kal ker lan lor mar mel mor nal ner or pal per quin ral ren rol sal ser sol tal ter tor val ver wal wen".split(), ["o", "us", "an"], ["a", "ia", "elle"], ["er", "in", "is"]),
    "cyrillic": ("бал бер бор вал вер гал гор дан дор зал кал кор лан лор мал мер мор нал пал рад рен рол сав сол тал тер тор".split(), ["ов", "ин", "ен"], ["ова", "ина", "ена"], ["ко", "ич", "ян"]),
    "greek": ("αλ βαλ γαλ δαλ θαλ καλ κορ λαν λορ μαρ μελ νερ παλ περ ραλ σολ ταλ τερ φαλ χαρ".split(), ["ος", "ης", "ας"], ["α", "η", "ια"], ["ου", "ις", "ω"]),
}

#: Letters of scripts that do not lie in 128 code points: Han, Hangul, Hiragana, Katakana. Fixed values.
RANGES = [(0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0x3041, 0x3096), (0x30A1, 0x30FA)]

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_ACCESS = r"\bAKIA[0-9A-Z]{16}\b"
_SECRET = r"(?<=[=:\"']|[=:][ ]|[=:][ ][ ])(?<=(?i:password|passwd|pwd|secret|token|api_key|apikey)[\"']?[ ]{0,2}[=:][ ]{0,2}[\"']?)(?=[^\s\"',;=:]*[\p{L}\p{N}])[^\s\"',;=:]{6,}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_IP = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)"
_IBAN = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_CARD = r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])"
#: Groups of three; E.164; an area code and one long group; two-digit groups, after a country code or a 0.
_PHONE = (
    r"(?<![\w+])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}"
    r"|\+\d{8,15}|\+\d{1,3}[ .-]\(?\d{2,5}\)?[ .-]\d{5,8}|(?:\+\d{1,3}[ .-]\d{1,2}|0\d)(?:[ .-]\d{2}){4})(?!\d)"
)
#: A telephone number's country code (one and two digits: fixed values; else three) and the rest.
_CODE = r"^(\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}))?(.*)$"
_TITLE = "(?:" + "|".join(t for g in TITLES.values() for t in g) + r")\.?"
#: Particles before a family name. Fixed values.
PARTICLES = "al bin da de del della den der di du el ibn la le ten ter van vom von zu zum zur".split()
#: A name word ends before a possessive 's.
_NAME = r"\p{Lu}(?:\p{L}|-(?=\p{L})|['’](?!s(?!\p{L}))(?=\p{L}))+"
_INITIALS = r"(?:\p{Lu}\.)+"
_LESSER = rf"(?:(?:{_INITIALS}|{'|'.join(PARTICLES)}) ){{0,3}}"
_PERSON = rf"(?=\p{{L}})(?<!\p{{L}}){_TITLE} {_LESSER}{_NAME}(?: {_LESSER}{_NAME}){{0,2}}"
#: Kinds of a name word: a first name after a male or female title, any other. The entity is the word alone.
NAME_KINDS = ["name", "name-m", "name-f"]
#: Types in the order in which they claim a text.
TYPES = {"email": _EMAIL, "access_key": _ACCESS, "secret": _SECRET, "ip": _IP, "ssn": _SSN, "card": _CARD, "iban": _IBAN, "phone": _PHONE, "person": _PERSON}
#: Every type begins where no ASCII letter or digit stands before it: most places of a text fail at once.
PATTERN = "(?<![A-Za-z0-9])(?:" + "|".join(f"(?:{p})" for p in TYPES.values()) + ")"


def _let(value, body) -> F.Column:
    """``body(value)`` with the value computed once, and once in the plan."""
    return F.get(F.transform(F.array(value), body), 0)


def matches_of(text) -> F.Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), 0)


def type_of(match) -> F.Column:
    """Type of a match; a secret is told by not having the form of any other type."""
    kind = F.lit("secret")
    for name, pattern in reversed([x for x in TYPES.items() if x[0] != "secret"]):
        kind = F.when(match.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    return kind


def _canonical(kind, match) -> F.Column:
    phone = F.concat_ws(" ", F.nullif(F.regexp_extract(match, _CODE, 1), F.lit("")), F.regexp_replace(F.regexp_extract(match, _CODE, 2), r"\D", ""))
    return F.when(kind == "email", F.lower(match)).when(kind == "phone", phone).when(kind.isin("card", "iban"), F.regexp_replace(match, r"[ -]", "")).when(kind.isin(NAME_KINDS), F.lower(match)).otherwise(match)


def _identity(kind) -> F.Column:
    """The kind that makes up an entity with its canonical form."""
    return F.when(kind.isin(NAME_KINDS), F.lit(NAME_KINDS[0])).otherwise(kind)


def _digest(key: str, kind, canonical, attempt) -> F.Column:
    return F.sha2(F.concat_ws("\u0001", F.lit(key), _identity(kind), attempt.cast("string"), canonical).cast("binary"), 512)


def _at(digest, i, n: int) -> F.Column:
    """The i-th number below ``n`` that a digest gives."""
    return F.pmod(F.conv(F.substring(digest, (1 + F.pmod(i * 3, F.lit(125))).cast("int"), F.lit(4)), 16, 10).cast("int"), F.lit(n))


def _pick(values: list[str], digest, i) -> F.Column:
    return F.element_at(F.array(*map(F.lit, values)), _at(digest, i, len(values)) + 1)


def _char(point) -> F.Column:
    return F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")


def _beyond_ascii(c, digest, i) -> F.Column:
    """A character of the same script and case: of a large range as a whole, else of the letters of its kind among its 128 code points."""
    point, drawn = F.ascii(c), _at(digest, i, 65536)
    kinds = (r"\p{Lu}", r"\p{Ll}", r"\p{Nd}", r"[\p{L}&&[^\p{Lu}\p{Ll}]]", r"[\p{N}&&[^\p{Nd}]]")
    kind = F.coalesce(*(F.when(c.rlike(k), F.lit(k)) for k in kinds), F.lit("^$"))
    block = F.transform(F.sequence(F.lit(0), F.lit(127)), lambda j: _char(point - point % 128 + j))
    new = _let(kind, lambda k: _let(F.filter(block, lambda x: F.rlike(x, k)), lambda own: F.when(F.size(own) > 0, F.get(own, F.pmod(drawn, F.size(own))))))
    for first, last in RANGES:
        new = F.when(point.between(first, last), _char(first + F.pmod(drawn, F.lit(last - first + 1)))).otherwise(new)
    return F.coalesce(new, c)


def _longer(text, attempt) -> F.Column:
    """``text`` with one more character to fill for each attempt above 1."""
    return F.concat(text, F.repeat(F.when(text.rlike("[a-z]|[^ -~]"), F.lit("a")).otherwise(F.lit("0")), F.greatest(attempt - 1, F.lit(0))))


def _shaped(text, digest, any_script: bool = False) -> F.Column:
    """Digits for digits, letters for letters of the same case (and script), the rest as it is; hex texts stay hex."""
    hexed = text.rlike(r"^(?=.*\d)(?=.*[a-f])[0-9a-f]{8,}$")

    def one(c, i):
        lower = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), _at(digest, i, 26) + 1, F.lit(1))
        return (
            F.when(hexed, F.substring(F.lit("0123456789abcdef"), _at(digest, i, 16) + 1, F.lit(1)))
            .when(c.rlike("[0-9]"), _at(digest, i, 10).cast("string"))
            .when(c.rlike("[a-z]"), lower)
            .when(c.rlike("[A-Z]"), F.upper(lower))
            .otherwise(F.when(c.rlike(r"[^\x00-\x7F]"), _beyond_ascii(c, digest, i)).otherwise(c) if any_script else c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits) -> F.Column:
    """Luhn sum modulo 10 of a string of digits."""
    reversed_digits = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.element_at(F.array(*(F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), F.coalesce(c.cast("int"), F.lit(0)) + 1)))
    return F.pmod(F.aggregate(reversed_digits, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))), F.lit(10))


def _card(match, form, digest) -> F.Column:
    """Scheme digit and separators stay; the last digit keeps the Luhn check passed where it was."""
    drawn = F.concat(F.substring(match, 1, 1), F.substring(_shaped(match, digest), F.lit(2), F.length(match) - 2))
    digits = F.regexp_replace(drawn, r"[ -]", "")
    check = F.pmod(10 - _luhn(F.concat(digits, F.lit("0"))), F.lit(10)).cast("string")
    was_valid = _luhn(F.regexp_replace(form, r"[ -]", "")) == 0
    return F.concat(drawn, F.when(was_valid, check).otherwise(_at(digest, F.lit(40), 10).cast("string")))


def _email(match, digest, attempt, key: str) -> F.Column:
    local, domain = F.substring_index(match, "@", 1), F.lower(F.substring_index(match, "@", -1))
    owner = F.regexp_replace(domain, r"(?:\.example)?\.[a-z]+$", "")
    host = F.regexp_replace(_let(_digest(key, F.lit("domain"), domain, F.lit(0)), lambda d: _shaped(owner, d)), r"\.", "-")
    return F.concat(_shaped(_longer(local, attempt), digest), F.lit("@"), host, F.lit(".example."), F.substring_index(domain, ".", -1))


def _word(word, kind, attempt, digest) -> F.Column:
    """A name word of the same script, of three syllables and one more for each attempt above 0, with an ending by its kind (``NAME_KINDS``)."""

    def of(script: str) -> F.Column:
        syllables, male, female, either = SYLLABLES[script]
        more = F.transform(F.sequence(F.lit(1), F.greatest(attempt, F.lit(1))), lambda i: F.when(i <= attempt, _pick(syllables, digest, 9 + 2 * i)).otherwise(F.lit("")))
        body = F.concat(*(_pick(syllables, digest, F.lit(i)) for i in (0, 2, 4)), F.array_join(more, ""))
        return F.concat(body, F.when(kind == "name-m", _pick(male, digest, F.lit(9))).when(kind == "name-f", _pick(female, digest, F.lit(9))).otherwise(_pick(either, digest, F.lit(9))))

    name = F.when(word.rlike(r"\p{IsCyrillic}"), of("cyrillic")).when(word.rlike(r"\p{IsGreek}"), of("greek")).otherwise(of("latin"))
    return F.when((word == F.upper(word)) & (word != F.lower(word)), F.upper(name)).otherwise(F.concat(F.upper(F.substring(name, 1, 1)), F.substring(name, F.lit(2), F.length(name))))


def name_words(match) -> F.Column:
    """The words of a person's name after the title with their kinds: (kind, word). Kinds besides ``NAME_KINDS``: particle, initial."""
    title = F.regexp_replace(F.substring_index(match, " ", 1), r"\.$", "")
    first = F.when(title.isin(TITLES["m"]), "name-m").when(title.isin(TITLES["f"]), "name-f").otherwise("name")

    def of(words):
        names = F.filter(words, lambda w: ~w.isin(PARTICLES) & ~w.rlike(r"\.$"))
        given = F.when(F.size(names) > 1, F.get(names, F.lit(0)))
        kind = lambda w: F.when(w.isin(PARTICLES), "particle").when(w.rlike(r"\.$"), "initial").when(w == given, first).otherwise("name")
        return F.transform(words, lambda w: F.struct(kind(w).alias("kind"), w.alias("word")))

    return _let(F.split(F.regexp_replace(match, r"^\S+ ", ""), " "), of)


def entities_of(text) -> F.Column:
    """(kind, entity) of a text: matches in canonical form, names as words."""

    def one(m, kind):
        words = F.filter(name_words(m), lambda w: w["kind"].isin(NAME_KINDS))
        return F.when(kind == "person", F.transform(words, lambda w: F.struct(w["kind"].alias("kind"), F.lower(w["word"]).alias("entity")))).otherwise(F.array(F.struct(kind.alias("kind"), _canonical(kind, m).alias("entity"))))

    return F.flatten(F.transform(matches_of(text), lambda m: _let(type_of(m), lambda kind: one(m, kind))))


def _name(kind, word, code, key: str) -> F.Column:
    """Replacement of a word of a name; ``code`` as ``exceptions`` gives it."""

    def drawn(x):
        attempt = F.shiftright(x["code"], 2)
        of = F.when(x["code"] % 4 > 0, F.element_at(F.array(*map(F.lit, NAME_KINDS)), F.greatest(x["code"] % 4, F.lit(1)))).otherwise(x["kind"])
        return _let(_digest(key, F.lit(NAME_KINDS[0]), F.lower(x["word"]), attempt), lambda d: _word(x["word"], of, attempt, d))

    other = F.when(kind == "initial", _let(_digest(key, kind, word, F.lit(0)), lambda d: _shaped(word, d, any_script=True))).otherwise(word)
    return F.when(kind.isin(NAME_KINDS), _let(F.struct(kind.alias("kind"), word.alias("word"), code.alias("code")), drawn)).otherwise(other)


def surrogate(kind, entity, attempt, key: str = KEY, form=None) -> F.Column:
    """Replacement of an entity; ``form`` is the match whose format it takes (default: the canonical form)."""
    known = F.struct(kind.alias("kind"), entity.alias("entity"), attempt.alias("attempt"), (entity if form is None else form).alias("form"))
    return _let(known, lambda x: _let(_digest(key, x["kind"], x["entity"], x["attempt"]), lambda d: _surrogate(x["kind"], x["attempt"], x["form"], d, key)))


def _surrogate(kind, attempt, form, digest, key: str) -> F.Column:
    octets = F.concat_ws(".", *((1 + _at(digest, F.lit(i), 254)).cast("string") for i in (0, 2, 4, 6)))
    ipv6 = F.concat(F.lit("2001:db8:"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.substring(digest, i * 4 + 1, F.lit(4))), ":"))
    rest = F.regexp_extract(form, _CODE, 2)
    phone = F.concat(F.regexp_extract(form, _CODE, 1), _let(_shaped(_longer(F.regexp_replace(rest, r"\D", ""), attempt), digest), lambda fill: _refilled(rest, fill)))
    compact = _longer(F.regexp_replace(form, r"[ -]", ""), attempt)
    head = F.when(kind == "iban", 2).otherwise(4)
    headed = _let(compact, lambda c: F.concat(F.substring(c, F.lit(1), head), _shaped(F.substring(c, head + 1, F.lit(99)), digest)))
    return (
        F.when(kind == "email", _email(form, digest, attempt, key))
        .when(kind == "ip", F.when(attempt > 3, ipv6).otherwise(octets))
        .when(kind == "card", _let(_let(compact, lambda c: _card(c, form, digest)), lambda fill: _refilled(form, fill)))
        .when(kind == "phone", phone)
        .when(kind.isin("access_key", "iban"), _let(headed, lambda fill: _refilled(form, fill)))
        .when(kind.isin(NAME_KINDS), _word(form, kind, attempt, digest))
        .otherwise(_shaped(_longer(form, attempt), digest, any_script=True))
    )


def _refilled(form, fill) -> F.Column:
    """``form`` with its ASCII letters and digits replaced in order by the characters of ``fill``, and what is left of it."""
    slots = F.length(F.regexp_replace(form, r"[^0-9A-Za-z]", ""))
    seen = lambda i: F.length(F.regexp_replace(F.substring(form, F.lit(1), i + 1), r"[^0-9A-Za-z]", ""))
    filled = F.array_join(F.transform(F.split(form, ""), lambda c, i: F.when(c.rlike("[0-9A-Za-z]"), F.substring(fill, seen(i), F.lit(1))).otherwise(c)), "")
    return F.concat(filled, F.substring(fill, slots + 1, F.lit(9999)))


def exceptions(docs: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, entity, code) of the entities whose code is above 0: four times the attempt, and the
    place in ``NAME_KINDS`` (from 1) of a name word's kind in the whole corpus, where that is not ``kind``."""
    found = docs.select(F.explode(entities_of(F.col("text"))).alias("e")).select("e.kind", "e.entity")
    bit = F.coalesce(*(F.when(F.col("kind") == k, F.lit(1 << i)) for i, k in enumerate(NAME_KINDS)), F.lit(0))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # few bytes but much work for each: dealt over the cluster's usual number of tasks
    every = found.groupBy(_identity(F.col("kind")).alias("kind"), "entity").agg(F.bit_or(bit).alias("seen"))
    every = cut(every.repartition(tasks, "kind", "entity"))
    real = every.select(F.col("kind").alias("r_kind"), F.col("entity").alias("r_entity"))
    gender = F.col("seen").bitwiseAND(6)
    drawn_as = F.when(gender == 2, F.lit(NAME_KINDS[1])).when(gender == 4, F.lit(NAME_KINDS[2])).otherwise(F.col("kind"))
    state = every.withColumn("drawn_as", drawn_as).withColumn("attempt", F.lit(0))
    new = surrogate(F.col("drawn_as"), F.col("entity"), F.col("attempt"), key)
    while True:
        drawn = state.withColumn("new", new)
        drawn = drawn.withColumn("place", F.row_number().over(Window.partitionBy("kind", "new").orderBy("attempt", "entity")))
        taken = drawn.join(real, (F.col("kind") == F.col("r_kind")) & (_canonical(F.col("kind"), F.col("new")) == F.col("r_entity")), "left")
        state = cut(taken.select("kind", "entity", "seen", "drawn_as", "attempt", ((F.col("place") > 1) | F.col("r_kind").isNotNull()).alias("again")))
        if state.where("again").isEmpty():
            break
        state = state.withColumn("attempt", F.col("attempt") + F.col("again").cast("int")).drop("again")
    places = [F.when(F.col("seen").bitwiseAND(1 << i) > 0, F.lit(k)) for i, k in enumerate(NAME_KINDS)]
    kinds = F.when(F.col("seen") > 0, F.array_compact(F.array(*places))).otherwise(F.array("kind"))
    of = F.array_position(F.array(*map(F.lit, NAME_KINDS)), F.col("drawn_as")).cast("int")
    each = state.select(F.explode(kinds).alias("place"), "entity", "attempt", "drawn_as")
    code = F.col("attempt") * 4 + F.when(F.col("place") != F.col("drawn_as"), of).otherwise(F.lit(0))
    return each.select(F.col("place").alias("kind"), "entity", code.alias("code")).where("code > 0")


def _rebuilt(text, code_of, key: str) -> F.Column:
    """``text`` with each match and mention replaced; ``code_of(kind, entity)`` is a column."""
    named = lambda w: _name(w["kind"], w["word"], code_of(w["kind"], F.lower(w["word"])), key)

    def one(m, kind):
        title = F.concat(F.substring_index(m, " ", 1), F.lit(" "))
        words = F.transform(name_words(m), named)
        other = _let(_canonical(kind, m), lambda canonical: surrogate(kind, canonical, F.shiftright(code_of(kind, canonical), 2), key, form=m))
        return F.when(kind == "person", F.concat(title, F.array_join(words, " "))).otherwise(other)

    def joined(pieces, new):
        return F.array_join(F.flatten(F.transform(F.arrays_zip(pieces.alias("piece"), new.alias("new")), lambda x: F.array(x["piece"], F.coalesce(x["new"], F.lit(""))))), "")

    def mentions(piece, names, pattern):
        known = lambda w: F.get(F.filter(names, lambda n: n["word"] == w), 0)
        new = lambda found: F.transform(found, lambda w: _let(known(w), named))
        return F.when(F.rlike(piece, pattern), joined(F.split(piece, pattern, -1), new(F.regexp_extract_all(piece, pattern, F.lit(0))))).otherwise(piece)

    def whole(x):
        # longer words first, as one may begin with another
        pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join(F.reverse(F.array_sort(F.transform(x["names"], lambda n: n["word"]))), "|"), F.lit(r")(?![\p{L}\p{N}])"))
        told = lambda pieces: F.when(F.size(x["names"]) > 0, _let(pattern, lambda p: F.transform(pieces, lambda piece: mentions(piece, x["names"], p)))).otherwise(pieces)
        new = F.transform(x["found"], lambda m: _let(type_of(m), lambda kind: one(m, kind)))
        return joined(told(F.split(text, PATTERN, -1)), new)

    people = lambda found: F.filter(found, lambda m: m.rlike(f"^(?:{_PERSON})$"))
    names = lambda found: F.array_distinct(F.filter(F.flatten(F.transform(people(found), name_words)), lambda w: w["kind"].isin(NAME_KINDS)))
    return _let(_let(matches_of(text), lambda found: F.struct(found.alias("found"), names(found).alias("names"))), whole)


def replace_personal_data(docs: DataFrame, key: str = KEY, inline: int = INLINE) -> DataFrame:
    """``docs`` with ``text`` rewritten, and ``n_entities`` and ``entity_types``."""
    count, types, again = free_names(docs, "n_entities", "entity_types", "surrogate_codes")
    odd = exceptions(docs, key)
    n = odd.count()
    rows = docs
    if n <= inline:
        known = {f"{r[0]}\u0001{r[1]}": r[2] for r in odd.collect()}
        table = F.from_json(F.lit(json.dumps(known)), "map<string,int>")
        code_of = (lambda k, e: F.coalesce(F.element_at(table, F.concat_ws("\u0001", k, e)), F.lit(0))) if n else (lambda k, e: F.lit(0))
    else:
        rows, code_of = _with_codes(docs, odd, again)
    text = F.col("text")
    hit = text.rlike(PATTERN)
    rows = rows.withColumn(count, F.when(hit, F.size(matches_of(text)).cast("long")).otherwise(F.lit(0).cast("long")))
    rows = rows.withColumn(types, F.when(hit, F.array_join(F.array_sort(F.array_distinct(F.transform(matches_of(text), type_of))), ",")).otherwise(F.lit("")))
    new = F.when(F.col(count) > 0, _rebuilt(text, code_of, key)).otherwise(text)
    return rows.select(*(new.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns), count, types)


def _with_codes(docs: DataFrame, odd: DataFrame, name: str):
    """Documents with a map of the codes of their odd entities: found by a join on distinct texts, whatever the number."""
    body = docs.where(F.col("text").rlike(PATTERN)).select(F.md5(F.col("text").cast("binary")).alias("h"), F.explode(F.array_distinct(entities_of(F.col("text")))).alias("e"))
    each = body.select("h", F.col("e.kind").alias("b_kind"), F.col("e.entity").alias("b_entity")).distinct()
    met = each.join(odd, (F.col("b_kind") == F.col("kind")) & (F.col("b_entity") == F.col("entity")))
    maps = met.groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\u0001", "kind", "entity").alias("k"), F.col("code").alias("v")))).alias(name))
    rows = docs.join(maps.withColumnRenamed("h", name + "_h"), F.md5(F.col("text").cast("binary")) == F.col(name + "_h"), "left")
    return rows, lambda k, e: F.coalesce(F.element_at(F.col(name), F.concat_ws("\u0001", k, e)), F.lit(0))


def op6_surrogates(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace_personal_data(docs).select("doc_id", "n_entities", "entity_types", "text")
