"""Verdicts on URLs: path rules, and pattern rules indexed by their rarest literal token.

A path rule fits its host and subdomains if the path starts with its path; the longest
rule wins, an allow at equal length. Where none fits, pattern rules decide: each is fetched by one literal token, the
rarest of its tokens in the table's URLs, and only fetched rules run their regular
expression. A match blocks, and the first rule that matches is named; otherwise the verdict is allow.

Null and unparsable URLs have an empty host and path, no rule, and are allowed. Repeated
rows get equal verdicts. Other columns are kept; host, path, rule, verdict and
pattern are replaced.
"""

import pandas as pd
import regex
from pyspark.sql import functions as F

from .common import table

# Verdict, host, path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))

# Pattern, and the literal tokens that every URL with a match holds as whole tokens; optional forms are rules of their own.
PATTERNS = (
    (r"(^|[/.\-])cheap[-_]pill([./\-]|$)", ("cheap", "pill")),
    (r"(^|[/.\-])cheap[-_]pills([./\-]|$)", ("cheap", "pills")),
    (r"(^|[/.\-])cheappill([./\-]|$)", ("cheappill",)),
    (r"(^|[/.\-])cheappills([./\-]|$)", ("cheappills",)),
    (r"(^|[/.\-])spam[-_]farm([./\-]|$)", ("spam", "farm")),
    (r"//([^/]*[.\-])?casino[.\-]", ("casino",)),
    (r"//([^/]*[.\-])?porn[.\-]", ("porn",)),
    (r"//([^/]*[.\-])?adult[.\-]", ("adult",)),
    (r"//([^/]*[.\-])?betting[.\-]", ("betting",)),
    (r"/wp-login\.php", ("wp", "login")),
    (r"//ad\.[^/]+/", ("ad",)),
    (r"//ads\.[^/]+/", ("ads",)),
)

_TOKEN = regex.compile(r"[a-z0-9]+")


def _parts(url):
    rest = F.when(F.instr("url", "://") > 0, F.substring(url, F.instr("url", "://") + F.lit(3), F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def token_counts(urls, patterns):
    """How many URLs hold each literal token of the patterns; one row per token of the rules."""
    literals = sorted({t for _, tokens in patterns for t in tokens})
    held = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(
        F.lower(F.coalesce("url", F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)))).alias("token"))
    return {r["token"]: r["count"] for r in held.where(F.col("token").isin(literals)).groupBy("token").count().collect()}


def judge(urls, rules=RULES, patterns=PATTERNS):
    """Adds host, path, rule, verdict and pattern to rows with a url."""
    base = urls.drop("host", "path", "rule", "verdict", "pattern")
    host, path = _parts(F.col("url"))
    base = base.withColumn("host", host).withColumn("path", path)
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, domain, start in reversed(ranked):
        fits = ((F.col("host") == domain) | F.endswith("host", F.lit("." + domain))) & F.startswith("path", F.lit(start))
        rule = F.when(fits, F.lit(domain + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    base = base.withColumn("rule", rule).withColumn("verdict", verdict)
    counts = token_counts(urls, patterns)
    index = {}
    for number, (pattern, tokens) in enumerate(patterns):
        rarest = min(tokens, key=lambda t: (counts.get(t, 0), t))
        index.setdefault(rarest, []).append((number, pattern))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)

    def build(batches):
        compiled = {t: [(n, p, regex.compile(p)) for n, p in ps] for t, ps in index.items()}
        for batch in batches:
            hits = []
            for url in batch["url"]:
                url = (url or "").lower()
                candidates = sorted((c for t in set(_TOKEN.findall(url)) & compiled.keys() for c in compiled[t]), key=lambda c: c[0])
                hits.append(next((p for _, p, c in candidates if c.search(url)), None))
            batch["pattern"] = pd.Series(hits, dtype=object, index=batch.index)
            yield batch

    return base.mapInPandas(build, f"{types}, pattern string").withColumn(
        "verdict", F.coalesce("verdict", F.when(F.col("pattern").isNotNull(), "block").otherwise("allow")))


def op7_url_filter(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict")
