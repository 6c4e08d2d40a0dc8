"""Licence scans: TF-IDF cosine to licence templates, and inheritance by directory.

Templates are whole licence texts (license_texts/), their notices and SPDX ids, each a word vector. A file that names a
licence or a right is compared as a whole; each of its lines that does so is compared too, with the stretches of
WINDOWS words around such words in it, so that a notice inside a longer line counts. The best cosine of LEAST or
more is the file's own licence; a file whose whole text reaches WHOLE with a whole licence text is one. A file named like a licence
file speaks for its directory. A file without a licence of its own takes that of the nearest ancestor directory that has
one, found by joining its ancestor paths.

A stretch is weighed inside its row, and only one whose known words can reach LEAST is compared at all.

Null texts and texts without such lines have no own licence; null paths inherit nothing. Ties go to the first licence by
name. Rows are told apart by a number of their own, so equal paths, and null or shared ids, are files of their own. Extra columns are kept; license, similarity and inherited_from are replaced.
"""

import json
import math
import zlib
from collections import Counter
from functools import reduce
from operator import or_
from pathlib import Path

import regex
from pyspark.sql import functions as F

from .common import WORD, stored, table, words

LEAST = 0.6
WHOLE = 0.9
WINDOWS = (5, 8, 12, 18)
SLOTS = 8192

# The names of common licences.
NAMES = {
    "0BSD": ("BSD Zero Clause License",),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL version 3", "AGPLv3", "AGPL v3"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache Software License 2.0"),
    "Artistic-2.0": ("Artistic License 2.0",),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "BSD-style license", "BSD License"),
    "BSL-1.0": ("Boost Software License, Version 1.0",),
    "CC0-1.0": ("CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal", "CC0 1.0", "CC0"),
    "EPL-2.0": ("Eclipse Public License, Version 2.0", "Eclipse Public License v2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL version 2", "GPLv2", "GPL v2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL version 3", "GPLv3", "GPL v3"),
    "ISC": ("ISC License",),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU LGPL version 2.1", "LGPLv2.1", "LGPL v2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LGPL version 3", "LGPLv3", "LGPL v3"),
    "MIT": ("MIT License", "Expat License"),
    "MPL-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "Mozilla Public License, Version 2.0", "MPL 2.0"),
    "Unlicense": ("Unlicense",),
    "Zlib": ("zlib License",),
}
_CREATIVE = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
             "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
             "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
for _code, _name in _CREATIVE.items():
    for _version, _law in (("3.0", "Unported"), ("4.0", "International")):
        NAMES[f"CC-{_code}-{_version}"] = (
            f"CC {_code} {_version}", f"Creative Commons {_name} {_version}", f"Creative Commons {_name} {_version} {_law} License")

# How notices word a name or an id, and notices that name none.
FORMS = ("{}", "Licensed under the {}", "Licensed under {}", "Released under the {}", "Distributed under the terms of the {}",
         "This work is licensed under the {}", "This work is licensed under a {}", "License: {}")
IDS = ("SPDX-License-Identifier: {}", "License: {}", "{} License")
NOTICES = {
    "BSD-3-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted",),
    "CC0-1.0": ("This work is dedicated to the public domain under the CC0 1.0 Universal",),
    "MIT": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "Unlicense": ("This is free and unencumbered software released into the public domain",),
}
TEXTS = Path(__file__).with_name("license_texts")
HEADER = (r"(?im)^.*(?:licen[sc]e|copyright|permission is hereby|redistribution and use|public domain|spdx|creative commons"
          r"|gpl|\b(?:released|distributed|available|published) under|\bcc[ -]?(?:by|0)\b).*$")
# One of these is in every line that HEADER finds, so that most texts need no regular expression.
HINTS = ("licen", "copyright", "permission is hereby", "redistribution and use", "public domain", "spdx", "creative commons", "gpl",
         "released under", "distributed under", "available under", "published under", "ccby", "cc by", "cc-by", "cc0", "cc 0", "cc-0")
# The words of HEADER, around which stretches are taken.
ANCHORS = r"^(licen[sc]e.*|copyright|permission|redistribution|domain|spdx|commons|.?gpl.*|under|cc|cc0)$"
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice)(\.[a-z]+)?$"


def templates():
    """License, words and wholeness (is it a text of TEXTS?) of every template."""
    worded = [(p.stem, p.read_text(encoding="utf-8"), True) for p in sorted(TEXTS.glob("*.txt"))]
    for license, names in sorted(NAMES.items()):
        worded += [(license, form.format(name), False) for name in names for form in FORMS]
        worded += [(license, form.format(license), False) for form in IDS]
        worded += [(license, notice, False) for notice in NOTICES.get(license, ())]
    every = {(license, tuple(sorted(Counter(regex.findall(WORD, text.lower())).items())), whole) for license, text, whole in worded}
    # A single word is no notice, unless it is an id by itself.
    return sorted((license, counts, whole) for license, counts, whole in every
                  if sum(n for _, n in counts) > 1 or any("gpl" in w or w == "cc0" for w, _ in counts))


def _weighed(spark):
    """The templates' unit vectors as rows; the rarity of each word; that of unknown words."""
    every = templates()
    holders = {}
    for license, counts, _ in every:
        for word, _ in counts:
            holders.setdefault(word, set()).add(license)
    total = len({license for license, _, _ in every})
    rarity = {word: 1 + math.log(total / len(held)) for word, held in holders.items()}
    rows = []
    for number, (license, counts, whole) in enumerate(every):
        norm = math.sqrt(sum((n * rarity[w]) ** 2 for w, n in counts))
        rows += [(license, number, whole, w, n * rarity[w] / norm) for w, n in counts]
    return (spark.createDataFrame(rows, "license string, template int, whole boolean, word string, part double"),
            rarity, 1 + math.log(total))


def _let(value, body):
    """body(value), with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def _rated(tokens, rarity):
    """The tokens with their rarity, null for words of no template, looked up in a literal by their checksum."""
    slots = [[] for _ in range(SLOTS)]
    for word, value in sorted(rarity.items()):
        slots[zlib.crc32(word.encode()) % SLOTS].append({"w": word, "r": value})
    known = F.from_json(F.lit(json.dumps(slots)), "array<array<struct<w:string,r:double>>>")
    return F.transform(tokens, lambda w: F.struct(w.alias("w"), F.get(F.filter(
        F.get(known, (F.crc32(w.cast("binary")) % SLOTS).cast("int")), lambda k: k["w"] == w), 0)["r"].alias("r")))


def _vector(rated, rarest, alone):
    """The unit vector of a stretch's known words, and whether the known part is long enough for a cosine of LEAST.

    A stretch's cosine is at most the length of its known part, so the others need no comparison.
    """
    def counted(ordered):
        at = lambda i: F.get(ordered, i)
        firsts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda i: (i == 0) | (at(i)["w"] != at(i - 1)["w"]))
        return _let(firsts, lambda f: F.zip_with(
            f, F.concat(F.slice(f, 2, F.size(f)), F.array(F.size(ordered))), lambda start, end: F.struct(
                at(start)["w"].alias("word"), at(start)["r"].isNotNull().alias("known"),
                ((end - start) * F.coalesce(at(start)["r"], F.lit(rarest))).alias("weight"))))

    def scaled(vector):
        norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, v: a + v["weight"] * v["weight"]))
        return _let(norm, lambda n: F.transform(F.filter(vector, lambda v: v["known"]), lambda v: F.struct(
            v["word"].alias("word"), (v["weight"] / n).alias("part"))))

    known = _let(_let(F.array_sort(rated), counted), scaled)
    return _let(known, lambda k: F.struct(alone.alias("alone"), k.alias("vector"), (F.aggregate(
        k, F.lit(0.0), lambda a, v: a + v["part"] * v["part"]) >= (LEAST - 1e-6) ** 2).alias("near")))


def _stretches(rated):
    """The stretches of WINDOWS words that hold an anchor, if there are more words, and all words."""
    def of(size):
        starts = F.when(F.size(rated) > size, F.sequence(F.lit(0), F.size(rated) - size)).otherwise(
            F.array().cast("array<int>"))
        near = F.filter(starts, lambda at: F.exists(F.slice(rated, at + 1, size), lambda t: t["w"].rlike(ANCHORS)))
        return F.transform(near, lambda at: F.slice(rated, at + 1, size))
    return F.concat(F.array(rated), *[of(size) for size in WINDOWS])


def _units(rarity, rarest):
    """The stretches of a text that may be near a template: alone, vector."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), "(?i)licence", "license")
    hinted = F.exists(F.array(F.lower("text")), lambda t: reduce(or_, [F.contains(t, F.lit(h)) for h in HINTS]))
    lines = F.when(hinted, F.array_distinct(F.regexp_extract_all(text, F.lit(HEADER), F.lit(0))))

    def of(lines):
        parts = F.flatten(F.transform(lines, lambda line: _let(_rated(words(line), rarity), _stretches)))
        whole = F.array(_vector(_rated(words(text), rarity), rarest, F.lit(True)))
        return F.filter(F.concat(whole, F.transform(
            F.filter(parts, lambda p: F.size(p) > 0), lambda p: _vector(p, rarest, F.lit(False)))), lambda u: u["near"])

    return F.when(F.size(F.coalesce(lines, F.array().cast("array<string>"))) > 0, _let(lines, of))


def own_licenses(files, kept=()):
    """Best template of each row: row, the columns `kept`, license, similarity and alone, whether it is a licence text.

    `row` is a number of the row. Rows without a licence are there too.
    """
    vectors, rarity, rarest = _weighed(files.sparkSession)
    held = files.select("row", *kept, F.explode_outer(_units(rarity, rarest)).alias("u")).select(
        "row", *kept, "u.alone", "u.vector", F.sha2(F.to_json("u.vector"), 256).alias("unit"))
    held = stored(held)
    # Equal stretches are compared once; the templates are a fixed few thousand words.
    unlike = held.where("unit IS NOT NULL").groupBy("unit").agg(F.first("vector").alias("vector")).select(
        "unit", F.explode("vector").alias("v")).select("unit", F.col("v.word").alias("word"), F.col("v.part").alias("share"))
    dots = unlike.join(F.broadcast(vectors), "word").groupBy("unit", "license", "template", "whole").agg(
        F.round(F.sum(F.col("share") * F.col("part")), 6).alias("similarity")).where(F.col("similarity") >= LEAST)
    found = dots.groupBy("unit").agg(
        F.min(F.struct((-F.col("similarity")).alias("far"), "license")).alias("b"),
        F.max(F.col("whole") & (F.col("similarity") >= WHOLE)).alias("text"))
    best = stored(held.where("unit IS NOT NULL").select("row", "alone", "unit").join(found, "unit").groupBy("row").agg(
        F.min("b").alias("b"), F.max(F.col("alone") & F.col("text")).alias("alone")))
    rows = held.select("row", *kept).distinct()
    return rows.join(best, "row", "left").select(
        "row", *kept, F.col("b.license").alias("license"), (-F.col("b.far")).alias("similarity"),
        F.coalesce("alone", F.lit(False)).alias("alone"))


def scan(files):
    """Adds license, similarity and inherited_from to files with path and text."""
    base = files.drop("license", "similarity", "inherited_from")
    row = "_row"
    while row in [c.lower() for c in base.columns]:
        row = "_" + row
    # Numbers are given once: a second reading might deal the rows otherwise.
    numbered = stored(base.withColumn(row, F.monotonically_increasing_id()))
    own = stored(own_licenses(numbered.select(F.col(row).alias("row"), "path", "text"), ["path"]))
    judged = inherited(own).select(F.col("row").alias(row), "license", "similarity", "inherited_from")
    return numbered.join(judged, row).select(*base.columns, "license", "similarity", "inherited_from")


def inherited(own):
    """Rows with path, license and similarity, with the licence of the nearest directory where they have none."""
    parent = F.regexp_replace("path", "/?[^/]*$", "")
    named = own.withColumn("parent", parent)
    speaks = named.where(F.col("license").isNotNull() & F.col("path").rlike(LICENSE_FILE)).groupBy(
        F.col("parent").alias("folder")).agg(F.min("license").alias("heir_license"))
    # Directories are joined, not files, so a full directory is one row here.
    folders = named.where("license IS NULL AND path IS NOT NULL").select("parent").distinct()
    parts = F.split("parent", "/")
    ancestors = folders.select("parent", F.explode(F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("folder"))
    nearest = stored(ancestors.distinct().join(speaks, "folder").groupBy("parent").agg(
        F.max(F.struct(F.length("folder"), "folder", "heir_license")).alias("heir")))
    # Stored, so that its measured size plans the join; a full directory's files are split by adaptive execution.
    return named.join(nearest, "parent", "left").withColumn(
        "inherited_from", F.when(F.col("license").isNull(), F.col("heir.folder"))).withColumn(
        "license", F.coalesce("license", "heir.heir_license")).drop("heir", "parent")


def document_licenses(docs):
    """Documents as files source/lang/doc_id; one that is a licence text as a whole is source/lang/LICENSE."""
    files = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", "lang", "text")
    own = stored(own_licenses(files, ["doc_id", "source", "lang"]))
    named = own.withColumn("path", F.concat_ws(
        "/", "source", "lang", F.when(F.col("alone"), "LICENSE").otherwise(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    return inherited(named).select("doc_id", "license", "similarity", "inherited_from")


def op9_licenses(spark, sf_dir):
    return document_licenses(table(spark, sf_dir, "documents"))
