"""Near duplicates by order MinHash.

A text's words form k-mers, labelled by their occurrence. Each of SLOTS hash functions
takes the SAMPLED least labelled k-mers and keeps their order in the text; equal ordered
samples make candidates. A bucket compares its members with one hub. Those that differ from it meet again in smaller
buckets, by REFINED samples of the k-mers the hub lacks, and by length: a passage that unlike texts share brings them
together once, and what they share beyond it decides where they meet next. Members near the hub go on as well, to buckets
that hold one that is not, so that a link past the hub is found. The hub leaves, so this ends. Each round is linear in the
buckets' sizes and compares a pair once.
Candidates are verified by banded alignment of their words: similarity is one minus the
edit distance over the longer length. Links join into classes.

Texts are compared by their lower-case words. Null texts and texts without words are copies of
nothing. Equal texts are one node. Rows are told apart by a number of their own, so a doc_id may be null or shared by unlike
texts; a class is named by its least doc_id. Texts with fewer words than a k-mer have one k-mer, the whole text.
"""

import math
import re
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.session import work_folder

from .common import clustered, discarded, stored, table

SHINGLE = 5
SAMPLED = 2
SLOTS = 32
REFINED = 16
SIMILARITY = 0.8

KNOWN = 200000  # word hashes a task remembers
CELLS = 1 << 21  # of a table that is filled at once
BATCH = 512  # rows that a task takes at once
HUBS = 64  # hubs a task remembers

_WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(values):
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


with np.errstate(over="ignore"):
    _SEEDS = _mixed(np.arange(1, 257, dtype=np.uint64) * _MIX)


def _occurrences(values):
    """How often each value came before, place by place."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    first = np.r_[True, ranked[1:] != ranked[:-1]]
    starts = np.maximum.accumulate(np.where(first, np.arange(len(ranked)), 0))
    counts = np.empty(len(values), dtype=np.uint64)
    counts[order] = (np.arange(len(ranked)) - starts).astype(np.uint64)
    return counts


def _least(hashed, taken):
    """Places of the least `taken` hashes of each row. Few hashes are below a bound, and mostly they hold the least."""
    rows, n = hashed.shape
    if taken == n:
        return np.arange(n)
    expected = 8 * taken
    if n > 2 * expected:
        row, place = np.nonzero(hashed < np.uint64((1 << 64) // n * expected))
        starts = np.searchsorted(row, np.arange(rows + 1))
        if np.diff(starts).min() >= taken:
            order = np.lexsort((hashed[row, place], row))
            return place[order[starts[:-1, None] + np.arange(taken)]]
    return np.argpartition(hashed, taken - 1, axis=1)[:, :taken]


def _kmers(values, shingle=SHINGLE):
    """One hash per k-mer of a text's tokens."""
    width = min(shingle, len(values))
    kmers = np.zeros(len(values) - width + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            kmers = kmers * _MIX + values[i:len(values) - width + 1 + i]
        return _mixed(kmers)


def sketch(kmers, sampled=SAMPLED, slots=SLOTS):
    """The ordered samples of labelled k-mers, one hash per slot."""
    with np.errstate(over="ignore"):
        labelled = _mixed(kmers + _occurrences(kmers) * _MIX)
        taken = min(sampled, len(kmers))
        picks = np.empty((slots, taken), dtype=np.int64)
        step = max(1, CELLS // len(kmers))
        for slot in range(0, slots, step):
            # One multiplication reorders hashes that are mixed already.
            hashed = (labelled ^ _SEEDS[slot:min(slot + step, slots), None]) * _MIX
            picks[slot:slot + step] = _least(hashed, taken)
        picks.sort(axis=1)
        keys = np.arange(slots, dtype=np.uint64)
        for place in range(taken):
            keys = _mixed(keys * _MIX + kmers[picks[:, place]])
    return keys.astype(np.int64)


def _tokens(stored_tokens):
    return np.frombuffer(stored_tokens, dtype=np.int32).astype(np.uint64)


def _sketches(batches):
    known = {}
    for batch in batches:
        rows = []
        for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"]):
            found = _WORD.findall((text or "").lower())
            if found:
                whole = xxhash.xxh3_128_intdigest(" ".join(found))
                high, low = np.array([whole >> 64, whole & (1 << 64) - 1], dtype=np.uint64).astype(np.int64)
                if len(known) > KNOWN:
                    known.clear()
                for word in set(found).difference(known):
                    known[word] = xxhash.xxh3_64_intdigest(word) & 0xFFFFFFFF
                small = np.fromiter(map(known.__getitem__, found), dtype=np.uint32, count=len(found)).tobytes()
                rows.append((row, doc_id, high, low, sketch(_kmers(_tokens(small))), small))
            else:
                rows.append((row, doc_id, None, None, None, None))
        out = pd.DataFrame(rows, columns=["row", "doc_id", "high", "low", "keys", "tokens"])
        yield out.astype({"doc_id": "Int64", "high": "Int64", "low": "Int64"})


def _within(a, b, band):
    """Edit distance if it is at most band, else band + 1; only the band of the table is looked at."""
    if abs(len(a) - len(b)) > band:
        return band + 1
    if (2 * band + 1) * (len(a) + 1) <= CELLS:
        return _furthest(a, b, band)
    return _row_by_row(a, b, band)


def _furthest(a, b, band):
    """The distance by the furthest place that each diagonal of the band reaches with so many edits."""
    low, high = min(band, len(a)), min(band, len(b))
    padded = np.full(low + max(len(b), len(a) + high), -1, dtype=np.int64)
    padded[low:low + len(b)] = b
    equal = np.lib.stride_tricks.sliding_window_view(padded, len(a))[:low + high + 1] == a
    # Where the run of equal words from each place ends.
    ends = np.full((low + high + 1, len(a) + 1), len(a), dtype=np.int32)
    ends[:, :-1] = np.where(equal, len(a), np.arange(len(a)))
    ends = np.minimum.accumulate(ends[:, ::-1], axis=1)[:, ::-1]
    lanes = np.arange(low + high + 1)
    limit = np.minimum(len(a), len(b) - (lanes - low))
    goal = low + len(b) - len(a)
    places = np.full(low + high + 3, -2, dtype=np.int64)
    places[low + 1] = ends[low, 0]
    for edits in range(band + 1):
        if places[goal + 1] >= len(a):
            return edits
        reached = np.maximum(np.maximum(places[1:-1], places[2:]) + 1, places[:-2])
        reached = np.minimum(reached, limit)
        places[1:-1] = np.where(reached >= 0, ends[lanes, reached], -2)
    return band + 1


def _row_by_row(a, b, band):
    """The distance in memory of one row, for long texts with wide bands."""
    far = band + 1
    width = 2 * band + 1
    lanes = np.arange(width)
    padded = np.full(len(b) + 2 * width, -1, dtype=np.int64)
    padded[width:width + len(b)] = b
    row = np.where(lanes >= band, lanes - band, far)
    for i in range(1, len(a) + 1):
        column = i - band + lanes
        other = padded[width + i - band - 1:width + i + band]
        cost = row + (other != a[i - 1])
        cost[:-1] = np.minimum(cost[:-1], row[1:] + 1)
        cost = np.where(column == 0, i, cost)
        cost[(column < 0) | (column > len(b))] = far + width
        row = np.minimum.accumulate(cost - lanes) + lanes
        if row.min() > band:
            return far
    return int(min(row[len(b) - len(a) + band], far))


def similarity(a, b, least=SIMILARITY):
    """One minus edit distance over length, or 0 if it is below the least."""
    longest = max(len(a), len(b))
    allowed = int(longest * (1 - least) + 1e-9)
    short = min(len(a), len(b))
    if longest - short > allowed:
        return 0.0
    same = a[:short] == b[:short]
    head = short if same.all() else int(np.argmin(same))
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    same = a[len(a) - short:][::-1] == b[len(b) - short:][::-1]
    tail = short if same.all() else int(np.argmin(same))
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not len(a) or not len(b):
        return 1 - max(len(a), len(b)) / longest
    kinds, left = np.unique(a, return_counts=True)
    others, right = np.unique(b, return_counts=True)
    place = np.minimum(np.searchsorted(others, kinds), len(others) - 1)
    common = np.minimum(left, right[place])[others[place] == kinds].sum()
    if max(len(a), len(b)) - common > allowed:
        return 0.0
    a, b = a.astype(np.int64), b.astype(np.int64)
    band = 4
    while True:
        band = min(band, allowed)
        distance = _within(a, b, band)
        if distance <= band:
            return 1 - distance / longest
        if band == allowed:
            return 0.0
        band *= 4


def _refined(tokens, hub_kmers, near):
    """Keys of the buckets a member goes on to: samples of what the hub lacks, or of all if it lacks nothing, by length.

    Two bands of lengths each, so that lengths within SIMILARITY of one another share one. None for a near member
    that has nothing of its own.
    """
    kmers = _kmers(tokens)
    own = kmers[hub_kmers[np.minimum(np.searchsorted(hub_kmers, kmers), len(hub_kmers) - 1)] != kmers]
    if not len(own):
        if near:
            return None
        own = kmers
    keys = sketch(own, slots=REFINED).astype(np.uint64)
    band = int(math.log(len(tokens)) / math.log(1.0001 / SIMILARITY))
    with np.errstate(over="ignore"):
        both = _mixed(keys + np.array([[band], [band + 1]], dtype=np.uint64) * _MIX)
    return both.ravel().astype(np.int64)


def _verified(batches):
    hubs = {}
    for batch in batches:
        near, keys = [], []
        for hub, held, tokens in zip(batch["hub"], batch["hub_tokens"], batch["tokens"]):
            if hub not in hubs:
                if len(hubs) >= HUBS:
                    hubs.clear()
                hubs[hub] = np.frombuffer(held, dtype=np.int32), np.unique(_kmers(_tokens(held)))
            near.append(similarity(hubs[hub][0], np.frombuffer(tokens, dtype=np.int32)) >= SIMILARITY)
            keys.append(_refined(_tokens(tokens), hubs[hub][1], near[-1]))
        yield pd.DataFrame({"hub": batch["hub"], "node": batch["node"], "paths": batch["paths"], "near": near, "keys": keys})


def components(edges, folder):
    """Least node of each connected component: node and root, for nodes with a link."""
    both = stored(edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), folder)
    roots = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root"))
    roots = stored(roots, folder)
    while True:
        heard = both.join(roots, both.a == roots.node).groupBy(F.col("b").alias("node")).agg(
            F.min("root").alias("heard"))
        lower = stored(roots.join(heard, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "heard").alias("root")), folder)
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("further"))
        after = stored(lower.join(jump, "root").select("node", "old", F.col("further").alias("root")), folder)
        roots = after.select("node", "root")
        if after.where(F.col("root") != F.col("old")).isEmpty():
            return roots


def _links(base, nodes, folder):
    """Verified links between nodes: a and b, a below b."""
    tokens = base.select(F.col("row").alias("node"), "tokens")
    # A path stands for the hubs that a member has met on its way into a bucket.
    members = nodes.select(F.lit(0).cast("long").alias("path"), F.explode("keys").alias("key"), "node",
                           F.lit(False).alias("near"))
    rounds = []
    while True:
        buckets = members.groupBy("key").agg(
            F.min(F.when(~F.col("near"), F.col("node"))).alias("hub"), F.count(F.lit(1)).alias("size")
        ).where("size > 1 AND hub IS NOT NULL").select("key", "hub")
        pairs = stored(members.join(buckets, "key").where("node != hub").groupBy("hub", "node").agg(
            F.collect_set("path").alias("paths")), folder)
        if pairs.isEmpty():
            break
        # Tokens lie in buckets by row, so only pairs are shuffled: by hub, then with the hub's tokens by member. A hub
        # may have many members, a member has few hubs, so the comparisons are dealt evenly.
        hub_tokens = tokens.select(F.col("node").alias("hub"), F.col("tokens").alias("hub_tokens"))
        checked = stored(pairs.join(hub_tokens, "hub").join(tokens, "node").mapInPandas(
            _verified, "hub bigint, node bigint, paths array<bigint>, near boolean, keys array<bigint>"), folder, BATCH)
        rounds.append(checked)
        further = checked.select("hub", "node", "near", "keys", F.explode("paths").alias("path")).select(
            F.xxhash64("path", "hub").alias("path"), F.explode("keys").alias("key"), "node", "near")
        members = further.withColumn("key", F.xxhash64("path", "key"))
    found = [c.where("near").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
             for c in rounds]
    nothing = nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false")
    return stored(reduce(DataFrame.unionByName, found, nothing).distinct(), folder)


def _classes(numbered):
    """Rows with row, doc_id and text: row, doc_id, class_id, n_links and stays, whether the row is its class's first.

    What the work stores on its way is removed once the result is stored.
    """
    spark = numbered.sparkSession
    folder = work_folder(spark)
    sketched = numbered.mapInPandas(
        _sketches, "row bigint, doc_id bigint, high bigint, low bigint, keys array<bigint>, tokens binary")
    with clustered(sketched, "row", folder, BATCH) as base:
        result = _named(base, folder)
    discarded(spark, folder)
    return result


def _named(base, folder):
    """The classes of sketched rows, stored."""
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    nodes = stored(base.where(F.col("high").isNotNull()).groupBy("high", "low").agg(
        F.min("row").alias("node"), F.min_by("keys", "row").alias("keys"), F.min(first).alias("first")), folder)
    links = _links(base, nodes, folder)
    roots = components(links, folder)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(
        F.count("*").alias("n_links"))
    rooted = nodes.select("high", "low", "node", "first").join(roots, "node", "left").join(degree, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min("first").alias("named"))
    per_node = rooted.join(named, "root").select("high", "low", "named", "n_links")
    return stored(base.select("row", "doc_id", "high", "low").join(per_node, ["high", "low"], "left").select(
        "row", "doc_id", F.coalesce("named.doc_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("named.row") == F.col("row"), F.lit(True)).alias("stays")))


def near_duplicate_classes(docs):
    """One row per row: doc_id, class_id and n_links, the verified links of its text, enough to hold its class together."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return _classes(numbered).select("doc_id", "class_id", "n_links")


def one_of_each(docs):
    """Keeps one row of each class, that with the least doc_id, nulls last, and all texts without words."""
    row = "_row"
    while row in [c.lower() for c in docs.columns]:
        row = "_" + row
    # Numbers are given once: a second reading might deal the rows otherwise.
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    classes = _classes(numbered.select(F.col(row).alias("row"), "doc_id", "text"))
    # Stored, so that its size is known when the join is planned.
    gone = stored(classes.where(~F.col("stays")).select(F.col("row").alias(row)))
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


def op3_near_duplicates(spark, sf_dir):
    return near_duplicate_classes(table(spark, sf_dir, "documents"))
