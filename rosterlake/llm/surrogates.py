"""Keyed surrogates for personal data.

E-mail addresses, phone numbers, card numbers, IP addresses, social security numbers and IBANs are found
by patterns, whole names by the title before them. Every entity is replaced by one of the same type: each run of
digits or letters goes through a keyed permutation of all strings of its length and
script, so equal entities get equal surrogates in every document (coreference) and
different entities different ones; an IP address with leading zeros is the address without them. Names map word by word, given
names within lists of their gender, names off the lists letter by letter. An entity without a character to permute becomes a keyed number. The only step that could make two surrogates meet is the second try for an entity
that maps to itself, so all distinct entities are checked for collisions first, and a colliding key is changed; TRIES colliding keys are an error.

Null text stays null, empty text empty. Repeated rows get equal results. Other columns are kept;
`entities` is replaced.
"""

import hashlib
import hmac
import ipaddress
import re
import unicodedata
import warnings
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import functions as F

from .common import table

KEY_SETTING = "spark.rosterlake.surrogateKey"
TRIAL_KEY = "for trials only"
TRIES = 8


def surrogate_key(spark):
    """The secret key named in the session's settings. Without one, surrogates can be undone by anyone who reads this file."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        warnings.warn(f"{KEY_SETTING} is not set: surrogates are made with a public key, for trials only", stacklevel=2)
    return key or TRIAL_KEY

_DOMAIN = re.compile(r"[^\W_][\w\-]*(?:\.[\w\-]+)*\.[^\W\d_]{2,}")
_REACH = re.compile(r"[\w.\-]*")
_IBAN = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b")
# Stretches of the characters that numbers are made of; the patterns below look only there.
_STRETCH = re.compile(r"[+(0-9][0-9().+/ \-]*")
_NUMBER = regex.compile(
    r"(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|[01]?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|[01]?\d?\d)(?!\.?\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w-])\d{4}(?P<gap>[ -]?)\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}(?![\w-]))"
    # Numbers with their country: nine digits after +33 and +34, a prefix and a number after +49.
    r"|(?P<phone3>(?<![\w+])(?:\+|00)(?:33|34)(?:[ .-]?\(0\))?(?:[ .-]?\d){9}(?!\w))"
    r"|(?P<phone4>(?<![\w+])(?:\+|00)49[ .-]?(?:\(0\)[ .-]?)?(?:\(\d{2,5}\)|\d{2,5})[ ./-]{0,3}\d{3,9}(?:[ -]\d{1,6}){0,3}(?!\w))"
    # National numbers: 06 12 34 56 78, 612 34 56 78 and 91 123 45 67, 030 1234567.
    r"|(?P<phone5>(?<![\w+.-])0[1-9](?P<sep>[ .-])\d\d(?:(?P=sep)\d\d){3}(?!\w))"
    r"|(?P<phone6>(?<![\w+.-])(?:[679]\d\d[ .-]\d\d[ .-]\d\d[ .-]\d\d|[89]\d[ .-]\d{3}[ .-]\d\d[ .-]\d\d)(?![\w.-]*\d))"
    r"|(?P<phone7>(?<![\w+.-])(?:\(0[1-9]\d{1,3}\)|0[1-9]\d{1,3})(?:[ -]|[ ]?/[ ]?)\d{4,8}(?:-\d{1,4})?(?!\w))"
    r"|(?P<phone8>(?<![\w+.-])(?:\(0[1-9]\d{1,3}\)|0[1-9]\d{1,3})(?:[ -]|[ ]?/[ ]?)\d{2,4}(?:[ -]\d{2,4}){1,3}(?!\w))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\w))"
    r"|(?P<phone2>(?<![\w+])\+\d{8,14}(?!\w))"
    r"|(?P<phone9>(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{1,5}\)?){2,6}(?<=(?:\d\D{0,3}){8})(?!\w))"
)
_TITLE = re.compile(r"(?:Mrs?|Ms|Miss|Dr|Prof|Mme|Mlle|Frau|Herr|Señora?|Sra?|Monsieur|Madame)\b\.?\x20(?:(?:Dr|Prof)\b\.?\x20)*")
_PARTICLES = r"(?:(?:von|van|vom|zu|der|den|de|del|della|la|las|los|di|da|du|le|y)\x20){0,3}"
_PART = r"[\p{Lu}\p{Lt}\p{Lo}](?:[\w'’\-]*\w|\.)?"
_NAME = regex.compile(rf"{_PARTICLES}{_PART}(?:\x20{_PARTICLES}{_PART}){{0,3}}")

# Given names by gender, Latin script.
FEMALE = ("Anna", "Clara", "Emma", "Irene", "Julia", "Laura", "Marta", "Nora", "Paula", "Sofia")
MALE = ("Adrian", "Bruno", "David", "Felix", "Hugo", "Ivan", "Julian", "Lukas", "Martin", "Oscar")


def _number(key, *parts):
    digest = hmac.new(key.encode(), "\x1f".join(map(str, parts)).encode(), hashlib.sha256).digest()
    return int.from_bytes(digest[:16], "big")


def _permuted(values, base, key, kind):
    """A keyed permutation of all value strings of this length: rounds over two alternating halves."""
    values = list(values)
    if len(values) == 1:
        return [(values[0] + 1 + _number(key, kind, 1) % (base - 1)) % base if base > 1 else values[0]]
    half = len(values) // 2
    for turn in range(8):
        left, right = values[:half], values[half:]
        if turn % 2:
            shift = _number(key, kind, len(values), turn, left) % base ** len(right)
            values = left + _digits((_value(right, base) + shift) % base ** len(right), base, len(right))
        else:
            shift = _number(key, kind, len(values), turn, right) % base ** len(left)
            values = _digits((_value(left, base) + shift) % base ** len(left), base, len(left)) + right
    return values


def _value(digits, base):
    total = 0
    for digit in digits:
        total = total * base + digit
    return total


def _digits(value, base, length):
    out = []
    for _ in range(length):
        value, digit = divmod(value, base)
        out.append(digit)
    return out[::-1]


_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
              "".join(map(chr, range(0x430, 0x450))), "".join(map(chr, range(0x410, 0x430))),
              "".join(map(chr, range(0x3B1, 0x3CA))))


@lru_cache(maxsize=5000)
def _alphabet(char):
    """The alphabet of a letter or digit: a fixed one, or those of its script and category among its 128 code points."""
    fixed = next((a for a in _ALPHABETS if char in a), None)
    if fixed or not char.isalnum():
        return fixed
    kind = lambda c: (unicodedata.category(c), unicodedata.name(c, "").split(" ")[0])
    first = ord(char) & ~127
    return "".join(c for c in map(chr, range(first, first + 128))
                   if c.isalnum() and kind(c) == kind(char) and not any(c in a for a in _ALPHABETS))


def _formatted(text, key, kind):
    """Replaces the characters of each alphabet, all places of one alphabet together; others stay."""
    out = list(text)
    held = {_alphabet(c) for c in text} - {None}
    for alphabet in [*(a for a in _ALPHABETS if a in held), *sorted(held - set(_ALPHABETS))]:
        places = [i for i, c in enumerate(text) if c in alphabet]
        if places:
            shape = "".join("#" if c in alphabet else c for c in text)
            values = _permuted([alphabet.index(text[i]) for i in places], len(alphabet), key,
                               f"{kind}:{alphabet[0]}:{hashlib.sha256(shape.encode()).hexdigest()}")
            for i, value in zip(places, values):
                out[i] = alphabet[value]
            text = "".join(out)
    return "".join(out)


@lru_cache(maxsize=50000)
def surrogate(kind, entity, key):
    """The replacement of one entity; never the entity itself."""
    if kind == "name" and " " in entity:
        return " ".join(surrogate(kind, w, key) if not w[0].islower() else w for w in entity.split(" "))
    if kind == "ip":
        entity = ".".join(str(int(p)) for p in entity.split("."))
    tweak, tries = kind, 0
    # A permutation walked on until the value is valid is still a permutation of the valid values.
    replacement = entity
    while True:
        if kind == "email":
            local, domain = replacement.rsplit("@", 1)
            labels = domain.rsplit(".", 1)
            local = _formatted(local, key, tweak + labels[0] + labels[1])
            replacement = f"{local}@{_formatted(labels[0], key, tweak + labels[1])}.{labels[1]}"
        elif kind == "ip":
            number = int(ipaddress.IPv4Address(replacement))
            bits = _permuted([number >> 24 & 255, number >> 16 & 255, number >> 8 & 255, number & 255], 256, key, tweak)
            replacement = ".".join(map(str, bits))
        elif kind == "name":
            listed = next((names for names in (FEMALE, MALE) if replacement in names), None)
            if listed:
                step = 1 + _number(key, "name", listed[0]) % (len(listed) - 1)
                return listed[(listed.index(replacement) + step) % len(listed)]
            replacement = _formatted(replacement, key, tweak)
            if replacement in FEMALE or replacement in MALE:
                continue
        elif kind.startswith("phone") and entity.startswith("+"):
            country = regex.match(r"\+(?:\d{1,3}(?=[ .(-])|\d{2})", entity).group()
            replacement = country + _formatted(replacement[len(country):], key, tweak + country)
        elif kind.startswith("phone") and (trunk := regex.match(r"\(?0+", entity)):
            replacement = trunk.group() + _formatted(replacement[trunk.end():], key, tweak + trunk.group())
        elif kind == "iban":
            replacement = replacement[:2] + _formatted(replacement[2:], key, tweak + replacement[:2])
        else:
            replacement = _formatted(replacement, key, tweak)
        if replacement == entity:
            tries += 1
            if tries == TRIES:
                return f"{_number(key, kind, entity):x}"
            tweak += "'"
            continue
        return replacement


def entities_of(text):
    """Entities as (start, end, kind) from left to right; of overlapping ones the first, then the longest."""
    found, at = [], text.find("@")
    while at >= 0:
        # Only what stands before the sign since the last one, and the domain's characters after it, are read.
        domain = _DOMAIN.match(text, at + 1, _REACH.match(text, at + 1).end())
        start = at
        while domain and start and (text[start - 1].isalnum() or text[start - 1] in "_.%+-"):
            start -= 1
        if domain and start < at:
            found.append((start, domain.end(), "email"))
            at = domain.end() - 1
        at = text.find("@", at + 1)
    found += [(*m.span(), "iban") for m in _IBAN.finditer(text) if not text[max(m.start() - 1, 0):m.start()].isalnum()]
    for stretch in _STRETCH.finditer(text):
        if stretch.end() - stretch.start() >= 7:
            found += [(*m.span(), _kind(m))
                      for m in _NUMBER.finditer(text, stretch.start(), min(stretch.end() + 1, len(text)))]
    for title in _TITLE.finditer(text):
        name = _NAME.match(text, title.end())
        if name and not text[max(title.start() - 1, 0):title.start()].isalnum():
            found.append((*name.span(), "name"))
    chosen, last = [], 0
    for start, end, kind in sorted(found, key=lambda e: (e[0], -e[1], e[2])):
        if start >= last:
            chosen.append((start, end, kind))
            last = end
    return chosen


def _kind(match):
    return next(k for k, v in match.groupdict().items() if v is not None and k not in ("gap", "sep")).rstrip("23456789")


def replaced(text, key):
    """The text with surrogates, and its entities as (kind, start, end, entity, surrogate)."""
    parts, found, last = [], [], 0
    for start, end, kind in entities_of(text):
        new = surrogate(kind, text[start:end], key)
        parts += [text[last:start], new]
        found.append((kind, start, end, text[start:end], new))
        last = end
    return "".join([*parts, text[last:]]), found


ENTITIES = "array<struct<kind:string,start:int,end:int,entity:string,surrogate:string>>"


def with_surrogates(docs, key):
    """Replaces the text of every document and adds its entities."""
    docs = docs.drop("entities")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def build(batches):
        for batch in batches:
            batch = batch.copy()
            results = [(t, []) if t is None else replaced(t, key) for t in batch["text"]]
            batch["text"] = pd.Series([r[0] for r in results], dtype=object, index=batch.index)
            batch["entities"] = pd.Series([
                [dict(zip(("kind", "start", "end", "entity", "surrogate"), e)) for e in r[1]] for r in results
            ], dtype=object, index=batch.index)
            yield batch

    return docs.mapInPandas(build, f"{types}, entities {ENTITIES}")


def collisions(marked):
    """Surrogates that stand for several entities of their kind; empty if all are distinct."""
    address = F.regexp_replace("e.entity", r"(^|\.)0+(?=\d)", "$1")
    pairs = marked.select(F.explode("entities").alias("e")).select(
        "e.kind", F.when(F.col("e.kind") == "ip", address).otherwise(F.col("e.entity")).alias("entity"), "e.surrogate").distinct()
    return pairs.groupBy("kind", "surrogate").agg(F.count("*").alias("n")).where("n > 1")


def distinct_surrogates(docs, key, tries=TRIES):
    """As with_surrogates, under the first of the keys derived from `key` without a collision; an error if `tries` have one."""
    for attempt in range(tries):
        derived = f"{key}:{attempt}"
        if collisions(with_surrogates(docs.select("text"), derived)).isEmpty():
            return with_surrogates(docs, derived)
    raise ValueError(f"each of {tries} keys gives two entities one surrogate; set another key in {KEY_SETTING}")


def op10_surrogates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = distinct_surrogates(docs, surrogate_key(spark))
    return marked.select("doc_id", "text", F.size("entities").alias("n_entities"), F.to_json(F.transform(
        "entities", lambda e: F.struct(e["kind"].alias("kind"), e["start"].alias("start"), e["end"].alias("end"),
                                       e["surrogate"].alias("surrogate")))).alias("spans"))
