"""Secrets in texts: fixed patterns, and random strings by two character Markov models.

The patterns are assignments to secret-like names, access keys and long hexadecimal runs.
The method adds runs of MIN_RUN and more key characters whose log-likelihood ratio, under
a bigram model of random strings and one of ordinary identifiers, exceeds MARGIN per
character; of a run that does not, its pieces between / and =, then between all signs, are judged likewise. Both models are trained from labelled samples: identifiers are words,
alone and joined, of at most SAMPLE documents without their base matches, and rulers, random strings are keyed digests in the alphabets of
hexadecimal, base 64 and capitals, as many as documents in the sample.

The ratio alone decides, so random runs of letters or of digits only, such as card numbers, are reported too.

Spans are kind:start:end in code points, end exclusive. Null text counts as empty and has
no spans. Repeated rows get equal results; an empty table trains on digests alone. Columns named like
outputs are replaced.
"""

import json
import math

from pyspark.sql import functions as F

from .common import stored, table

MIN_RUN = 16
MARGIN = 0.25
SAMPLE = 2000
BLOCK = 64

# The patterns of the three base kinds, and their least lengths.
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
          r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
RUN = r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN
# Runs, and their pieces between the signs of paths and assignments and between all signs.
PIECES = (RUN, r"[A-Za-z0-9+_-]{%d,}" % MIN_RUN, r"[A-Za-z0-9]{%d,}" % MIN_RUN)
KINDS = ("assign", "access", "hex", "markov")
CLASSES = 67  # 26 + 26 + 10 characters, the signs + / _ = -


def _let(value, body):
    """body(value), with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def _spans(text, pattern, kind, keep):
    """Spans of all matches that pass keep(match): the pieces between matches give their places."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)

    def placed(both):
        steps, found = both["steps"], both["found"]
        count = F.size(found)
        blocks = F.transform(
            F.sequence(F.lit(0), F.ceil(count / BLOCK).cast("int")),
            lambda b: F.aggregate(F.slice(steps, b * BLOCK + 1, BLOCK), F.lit(0), lambda a, s: a + s["all"]))
        firsts = F.aggregate(blocks, F.array(F.lit(0)), lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + s)))

        def one(firsts):
            def span(match, i):
                block = F.floor(i / BLOCK).cast("int")
                before = F.aggregate(F.slice(steps, block * BLOCK + 1, i % BLOCK), F.get(firsts, block),
                                     lambda a, s: a + s["all"])
                start = before + F.get(steps, i)["piece"]
                return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                                (start + F.length(match)).alias("end"), match.alias("match"))
            return F.transform(found, span)

        return F.filter(_let(firsts, one), lambda s: keep(s["match"]))

    empty = F.array().cast("array<struct<start:int,kind:int,end:int,match:string>>")

    def joined(found):
        steps = F.zip_with(found, F.slice(pieces, 1, F.greatest(F.size(found), F.lit(1))), lambda m, p: F.struct(
            F.length(p).alias("piece"), (F.length(p) + F.coalesce(F.length(m), F.lit(0))).alias("all")))
        return F.when(F.size(found) == 0, empty).otherwise(
            _let(F.struct(found.alias("found"), steps.alias("steps")), placed))

    return _let(matches, joined)


def _class_of(char):
    """The number of a key character, 0 to CLASSES - 1."""
    code = F.ascii(char)
    return (F.when(code.between(97, 122), code - 97).when(code.between(65, 90), code - 39)
            .when(code.between(48, 57), code + 4).otherwise(F.greatest(F.lit(62), F.instr(F.lit("+/_=-"), char) + 61)))


def _bigrams(run):
    """Numbers of the pairs of neighbours; the run is split into characters once."""
    return _let(F.transform(F.split(run, ""), _class_of), lambda classes: F.transform(
        F.sequence(F.lit(0), F.size(classes) - 2), lambda i: F.get(classes, i) * CLASSES + F.get(classes, i + 1)))


def train(docs, sample=SAMPLE, smoothing=5.0):
    """Log ratio of random to ordinary for every pair of characters: CLASSES * CLASSES numbers."""
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = stored(docs.select("doc_id", "text").join(ids.distinct(), "doc_id"))
    plain = F.coalesce("text", F.lit(""))
    # Long runs with digits and long words are what the models are to judge, so they carry no label.
    for pattern in (ASSIGN, ACCESS, HEX, r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])" + RUN, PIECES[2]):
        plain = F.regexp_replace(plain, pattern, " ")
    found = F.regexp_extract_all(plain, F.lit("[A-Za-z][A-Za-z0-9]{1,39}"), F.lit(0))
    named = texts.select(F.posexplode(found).alias("at", "word")).groupBy("word").agg(F.count("*").alias("n"))
    ordinary = named.select(F.explode(F.array(
        "word", F.concat(F.lower("word"), F.lit("_"), F.lower("word")),
        F.concat("word", F.lit("-"), "word"), F.concat(F.lower("word"), F.initcap("word")))).alias("run"),
        F.lit(0).alias("label"))
    spark = docs.sparkSession
    digest = F.sha2(F.col("id").cast("string"), 256)
    random = spark.range(sample).select(F.explode(F.array(
        digest, F.regexp_replace(F.base64(F.unhex(digest)), "=", ""), F.upper(F.regexp_replace(F.base64(F.unhex(digest)), "[+/=]", "")),
        F.translate(F.base64(F.unhex(digest)), "+/=", "-_"))).alias("run"), F.lit(1).alias("label"))
    # Rulers are ordinary: signs repeated.
    rulers = spark.createDataFrame([(sign * 40, 0) for sign in "+/_=-"] * 200, "run string, label int")
    pairs = ordinary.unionByName(random).unionByName(rulers).where(F.length("run") >= 2).select(
        "label", F.explode(_bigrams(F.col("run"))).alias("pair"))
    # At most 2 * CLASSES * CLASSES counts come to the driver, whatever the table's size.
    counts = {(r["label"], r["pair"]): r["count"] for r in pairs.groupBy("label", "pair").count().collect()}
    models = []
    for label in (0, 1):
        table_ = [[counts.get((label, a * CLASSES + b), 0) for b in range(CLASSES)] for a in range(CLASSES)]
        alone = [0.5 + sum(row[b] for row in table_) for b in range(CLASSES)]
        alone = [n / sum(alone) for n in alone]
        # Rare pairs fall back on how often the second character occurs at all.
        models.append([(row[b] + smoothing * alone[b]) / (sum(row) + smoothing)
                       for row in table_ for b in range(CLASSES)])
    ratios = [math.log(random_ / ordinary_) for ordinary_, random_ in zip(*models)]
    return ratios


def find_secrets(docs, ratios, margin=MARGIN):
    """Adds the array `found` of spans by start and kind: start, kind, end and match."""
    text = F.coalesce("text", F.lit(""))
    model = F.from_json(F.lit(json.dumps(ratios)), "array<double>")

    def random(run):
        total = F.aggregate(_bigrams(run), F.lit(0.0), lambda a, p: a + F.get(model, p))
        return total / F.length(run) > margin

    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6
    every = F.lit(True)

    def judged(stretch, begin, patterns):
        """Random stretches of the first pattern, and within the others those of the next patterns."""
        def one(span):
            start = begin + span["start"]
            whole = F.array(F.struct(start.alias("start"), span["kind"].alias("kind"), (begin + span["end"]).alias("end"),
                                     span["match"].alias("match")))
            rest = judged(span["match"], start, patterns[1:]) if patterns[1:] else F.filter(whole, lambda s: F.lit(False))
            return F.when(random(span["match"]), whole).otherwise(rest)
        return F.flatten(F.transform(_spans(stretch, patterns[0], "markov", lambda m: every), one))

    # A piece lies inside a longer stretch, so pieces are sought only there and no lists of spans are compared.
    markov = judged(text, F.lit(0), PIECES)
    return docs.withColumn("found", F.array_sort(F.concat(
        _spans(text, ASSIGN, "assign", value), _spans(text, ACCESS, "access", lambda m: every),
        _spans(text, HEX, "hex", lambda m: every), markov)))


def _listed(spans):
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_secrets(docs, train(docs))
    number = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(_listed(F.filter("found", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"))
