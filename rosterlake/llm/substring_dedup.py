"""Repeated passages, by relative Lempel-Ziv parsing against indexed reference blocks.

A window is WINDOW consecutive words of a document; words covered by a window that also starts earlier in
the table go. Documents are held in packs: the pack's distinct words, and each document as their numbers.

1. Every window has an anchor, the leftmost GRAM words of it with the smallest hash, so equal windows have
   equal anchors. Of an anchor that occurs more than once, the first place in the table is known to all packs.
2. A reference block is CELL words of the document in which an anchor is first, with a margin. A stretch of
   a document whose anchors are all first in one block is parsed against it greedily: at each place the longest
   match, found in the block's sorted suffixes, is the next factor. Windows inside a factor are repeated. A
   repeated window can cross one factor boundary at most, as the second factor would else have been
   longer, so the windows at boundaries whose two factors have room for one are looked up as well.
3. A window that has a repeated anchor but is not in the anchor's first block can be equal only to windows
   that are likewise left over; they are compared by a 128-bit hash, and all but the first are repeated.

So a document meets only blocks that hold an anchor of it, each stretch one block, and nothing compares all
pairs. Words are compared by 64-bit hashes. Long documents are cut in no way.

Null and empty texts have no words. "Earlier" goes by doc_id, null last, then by place; rows with equal doc_ids
are documents of their own, in the order of the stored packs, so of repeated rows one keeps its
words. An empty table gives an empty result. Columns other than doc_id and text are not read.
"""

import hashlib
import zlib
from bisect import bisect_left
from collections import defaultdict
from itertools import compress

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import functions as F

from rosterlake.session import task_count

from .common import stored, table

WINDOW = 20
GRAM = 10
CELL = 256
PACK_WORDS = 1 << 21
PACK_DOCS = 1 << 20
LAST = np.iinfo(np.int64).max

PACKED = ("kind string, pack long, bucket int, doc_id string, row long, n_words long, data binary, ids binary, "
          "rows binary, places binary")
KNOWN = "of_pack long, grams binary, rows binary, places binary"
PIECES = "kind string, block_row long, cell long, turn long, row long, start long, first long, last long, words binary"
FOUND = "row long, turn long, starts array<long>, ends array<long>, left array<struct<high:long,low:long,start:long>>"
RESULT = "doc_id string, n_words long, n_removed long, kept_sha256 string"
PACKED_NAMES = [c.split()[0] for c in PACKED.split(", ")]


def _squeeze(values, kind):
    return zlib.compress(np.ascontiguousarray(values, dtype=kind).tobytes(), 1)


def _spread(data, kind):
    return np.frombuffer(zlib.decompress(data), dtype=kind)


def _mixed(x):
    """Stirs 64-bit hashes so that sums of them do not cancel."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(words, size, base):
    """A hash of each `size` consecutive word hashes."""
    total = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    for at in range(size):
        total = total * np.uint64(base) + words[at:at + len(total)]
    return _mixed(total)


def anchors(words, window=WINDOW, gram=GRAM):
    """For each window of the word hashes, the place of its anchor; and the hash of the gram at each place."""
    grams = rolled(words, gram, 0x9E3779B97F4A7C15)
    count = max(0, len(words) - window + 1)
    best, where = grams[:count].copy(), np.arange(count)
    for at in range(1, window - gram + 1):
        other = grams[at:at + count]
        less = other < best
        best[less] = other[less]
        where[less] = np.flatnonzero(less) + at
    return where, grams


def word_hashes(words):
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)


def _pack_anchors(hashes, lengths):
    """Places of all anchors in a pack's documents laid end to end, windows across documents left out."""
    where, grams = anchors(hashes)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    inside = doc[:len(where)] == doc[WINDOW - 1:][:len(where)]
    return np.unique(where[inside]), grams, doc


def _pack(buckets):
    edges = np.array([(i << 64) // buckets for i in range(buckets)], dtype=np.uint64)

    def frame(n, **values):
        empty = {"bucket": 0, "row": 0, "n_words": 0}
        return pd.DataFrame({c: values.get(c, empty.get(c)) for c in PACKED_NAMES}, index=range(n))

    class Pack:
        def __init__(self, number):
            self.number, self.vocabulary, self.docs, self.words = number, defaultdict(), [], 0
            self.vocabulary.default_factory = self.vocabulary.__len__

        def add(self, doc_id, text):
            words = (text or "").encode().split()
            numbers = np.fromiter(map(self.vocabulary.__getitem__, words), dtype=np.int64, count=len(words))
            self.docs.append((doc_id, numbers))
            self.words += len(words)

        def rows(self):
            if not self.docs:
                return
            hashes = word_hashes(self.vocabulary)
            kind = "<u2" if len(hashes) <= 1 << 16 else "<u4"
            lengths = np.array([len(n) for _, n in self.docs])
            row = (self.number << 22) + np.arange(len(self.docs))
            ids = np.array([LAST if i is None else int(i) for i, _ in self.docs], dtype=np.int64)
            yield frame(1, kind="words", pack=self.number, data=[zlib.compress(b" ".join(self.vocabulary), 1)])
            for at in range(0, len(self.docs), 1000):
                part = self.docs[at:at + 1000]
                yield frame(len(part), kind="doc", pack=self.number, doc_id=[i for i, _ in part],
                            row=row[at:at + 1000], n_words=lengths[at:at + 1000],
                            data=[_squeeze(n, kind) for _, n in part])
            place, grams, doc = _pack_anchors(hashes[np.concatenate([n for _, n in self.docs])], lengths)
            start = np.cumsum(lengths) - lengths
            gram, doc, at = grams[place], doc[place], place - start[doc[place]]
            order = np.lexsort((at, row[doc], ids[doc], gram))
            gram, doc, at = gram[order], doc[order], at[order]
            heads = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else order
            many = np.diff(np.concatenate([heads, [len(gram)]])) > 1
            gram, doc, at = gram[heads], doc[heads], np.where(many, ~at[heads], at[heads])
            cuts = np.searchsorted(gram, edges).tolist() + [len(gram)]
            for bucket, (s, e) in enumerate(zip(cuts, cuts[1:])):
                if e > s:
                    yield frame(1, kind="anchors", pack=self.number, bucket=bucket, data=[_squeeze(gram[s:e], "<u8")],
                                ids=[_squeeze(ids[doc[s:e]], "<i8")], rows=[_squeeze(row[doc[s:e]], "<i8")],
                                places=[_squeeze(at[s:e], "<i8")])

    def run(batches):
        pack = Pack(TaskContext.get().partitionId() << 16)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                pack.add(doc_id, text)
                if pack.words >= PACK_WORDS or len(pack.docs) >= PACK_DOCS:
                    yield from pack.rows()
                    pack = Pack(pack.number + 1)
        yield from pack.rows()
    return run


def _firsts(held):
    """Tells each pack the first places of those of its anchors that occur more than once."""
    parts = [[_spread(held[c][i], kind) for c, kind in (("data", "<u8"), ("ids", "<i8"), ("rows", "<i8"), (
        "places", "<i8"))] for i in held.index]
    pack = np.repeat(held["pack"].to_numpy(), [len(p[0]) for p in parts])
    gram, ids, rows, places = (np.concatenate([p[i] for p in parts]) for i in range(4))
    many, places = places < 0, np.where(places < 0, ~places, places)
    order = np.lexsort((places, rows, ids, gram))
    gram, rows, places, many, pack = gram[order], rows[order], places[order], many[order], pack[order]
    heads = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    sizes = np.diff(np.concatenate([heads, [len(gram)]]))
    repeated = np.repeat((sizes > 1) | np.logical_or.reduceat(many, heads), sizes)
    first = np.repeat(heads, sizes)[repeated]
    pack, gram = pack[repeated], gram[repeated]
    order = np.argsort(pack, kind="stable")
    pack, gram, first = pack[order], gram[order], first[order]
    edges = np.flatnonzero(np.concatenate([[True], pack[1:] != pack[:-1]])).tolist() if len(pack) else []
    return pd.DataFrame([(pack[s], _squeeze(gram[s:e], "<u8"), _squeeze(rows[first[s:e]], "<i8"),
                          _squeeze(places[first[s:e]], "<i8")) for s, e in zip(edges, [*edges[1:], len(pack)])],
                        columns=["of_pack", "grams", "rows", "places"])


def _opened(held):
    """A pack's distinct words, and its documents with their numbers in order of row."""
    words = b" ".join(zlib.decompress(d) for d in held["data"][held["kind"] == "words"]).split()
    docs = held[held["kind"] == "doc"].sort_values("row")
    kind = "<u2" if len(words) <= 1 << 16 else "<u4"
    return words, docs, [_spread(d, kind) for d in docs["data"]]


def _pieces(key, held, known):
    """Reference blocks that lie in a pack, and its stretches to be parsed against some block."""
    columns = [c.split()[0] for c in PIECES.split(", ")]
    words, docs, numbers = _opened(held)
    if not len(known) or not len(docs):
        return pd.DataFrame(columns=columns)
    hashes = word_hashes(words)[np.concatenate(numbers)]
    lengths = docs["n_words"].to_numpy()
    place, grams, doc = _pack_anchors(hashes, lengths)
    start = np.cumsum(lengths) - lengths
    gram, rows, places = (np.concatenate([_spread(d, kind) for d in known[c]]) for c, kind in (
        ("grams", "<u8"), ("rows", "<i8"), ("places", "<i8")))
    order = np.argsort(gram)
    gram, rows, places = gram[order], rows[order], places[order]
    at = np.minimum(np.searchsorted(gram, grams[place]), len(gram) - 1)
    repeated = np.flatnonzero(gram[at] == grams[place])
    turn, place, at = repeated, place[repeated], at[repeated]
    doc = doc[place]
    row, inside = docs["row"].to_numpy()[doc], place - start[doc]
    own = (rows[at] == row) & (places[at] == inside)
    big = hashes.astype(">u8")
    out = []

    first = np.unique(np.stack([doc[own], inside[own] // CELL], axis=1), axis=0) if own.any() else []
    for d, cell in first:
        begin, end = max(0, cell * CELL - WINDOW), min(lengths[d], (cell + 1) * CELL + WINDOW)
        out.append(("block", docs["row"].iat[d], cell, 0, 0, begin, 0, 0, big[start[d] + begin:start[d] + end].tobytes()))

    turn, place, doc, at = turn[~own], place[~own], doc[~own], at[~own]
    block, cell = rows[at], places[at] // CELL
    if len(turn):
        new = np.concatenate([[True], (turn[1:] != turn[:-1] + 1) | (doc[1:] != doc[:-1])
                              | (block[1:] != block[:-1]) | (cell[1:] != cell[:-1])])
        heads = np.flatnonzero(new)
        tails = np.concatenate([heads[1:], [len(turn)]]) - 1
        ids = [LAST if i is None else int(i) for i in docs["doc_id"]]
        own_rows = docs["row"].tolist()
        for h, t in zip(heads.tolist(), tails.tolist()):
            d = doc[h]
            low, high = start[d], start[d] + lengths[d]
            begin, end = max(low, place[h] - WINDOW + GRAM), min(high, place[t] + WINDOW)
            out.append(("stretch", block[h], cell[h], ids[d], own_rows[d], begin - low, place[h] - begin, place[t] - begin,
                        big[begin:end].tobytes()))
    return pd.DataFrame(out, columns=columns)


class Reference:
    """A block of words with its sorted suffixes."""

    def __init__(self, words):
        self.data = words
        self.words = np.frombuffer(words, dtype=">u8")
        self.order = sorted(range(len(self.words)), key=lambda i: words[8 * i:])
        self.suffixes = [words[8 * i:] for i in self.order]
        self.known = set(self.words.tolist())

    def longest(self, query, data, at, before=None):
        """Length of the longest match of query[at:], with its source before the given place if there is one."""
        if int(query[at]) not in self.known:
            return 0
        place = bisect_left(self.suffixes, data[8 * at:8 * (at + len(self.words))])
        best = 0
        for step, near in ((-1, place - 1), (1, place)):
            while 0 <= near < len(self.order):
                source = self.order[near]
                size = min(len(query) - at, len(self.words) - source)
                unlike = query[at:at + size] != self.words[source:source + size]
                size = int(unlike.argmax()) if unlike.any() else size
                if size <= best:
                    break
                if before is None or source < before:
                    best = size
                    break
                near += step
        return best

    def holds(self, data, before=None):
        """Whether the words occur, with their start before the given place if there is one."""
        near = bisect_left(self.suffixes, data)
        while near < len(self.suffixes) and self.suffixes[near].startswith(data):
            if before is None or self.order[near] < before:
                return True
            near += 1
        return False


def parse(reference, data, before=None, window=WINDOW):
    """Starts of the windows of a stretch that the block holds, by its factors and their boundaries.

    before: the stretch's own start in the block's words, if it is of the same document; sources then begin earlier
    than what they match.
    """
    query = np.frombuffer(data, dtype=">u8")
    limit = (lambda at: None) if before is None else (lambda at: before + at)
    starts, at, last = [], 0, None
    while at < len(query):
        size = reference.longest(query, data, at, limit(at))
        end = at + size
        starts.extend(range(at, end - window + 1))
        if last is not None and size and end - last >= window:
            starts.extend(s for s in range(max(last, at - window + 1), min(at - 1, end - window) + 1)
                          if reference.holds(data[8 * s:8 * (s + window)], limit(s)))
        last = at if size else None
        at = end if size else at + 1
    return np.array(sorted(starts), dtype=np.int64)


def _merged(starts, window=WINDOW):
    """Spans covered by windows that begin at the sorted starts."""
    if not len(starts):
        return [], []
    new = np.flatnonzero(np.concatenate([[True], np.diff(starts) > window]))
    ends = starts[np.concatenate([new[1:], [len(starts)]]) - 1] + window
    return starts[new].tolist(), ends.tolist()


def _left(words, found, low, high, start):
    """128-bit hashes and starts of the windows that were not found, of those with an anchor from low to high.

    The other windows at a stretch's ends have anchors of another stretch, which holds them as well.
    """
    if len(found) >= len(words) // 8 - WINDOW + 1:
        return []
    query = np.frombuffer(words, dtype=">u8").astype(np.uint64)
    where, _ = anchors(query)
    missing = (where >= low) & (where <= high)
    missing[found] = False
    missing = np.flatnonzero(missing)
    if not len(missing):
        return []
    one, two = (rolled(query, WINDOW, base).view(np.int64)[missing] for base in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
    return list(zip(one.tolist(), two.tolist(), (missing + start).tolist()))


def _parsed(batches):
    held, reference = None, None
    for batch in batches:
        out = []
        # turn is the document's doc_id as it counts in "earlier".
        for block_row, block_start, block, turn, row, start, low, high, words in zip(*(batch[c] for c in (
                "block_row", "block_start", "block", "turn", "row", "start", "first", "last", "words"))):
            if block is not held and block != held:
                held, reference = block, Reference(block)
            found = parse(reference, words, start - block_start if row == block_row else None)
            starts, ends = _merged(found + start)
            out.append((row, turn, starts, ends, _left(words, found, low, high, start)))
        yield pd.DataFrame(out, columns=["row", "turn", "starts", "ends", "left"])


def _cleaned(key, held, spans):
    words, docs, numbers = _opened(held)
    by_row = {row: part for row, part in spans.groupby("row")}
    out = []
    for doc_id, row, own in zip(docs["doc_id"], docs["row"], numbers):
        change = np.zeros(len(own) + 1, dtype=np.int64)
        if row in by_row:
            np.add.at(change, by_row[row]["span_start"].to_numpy(), 1)
            np.add.at(change, by_row[row]["span_end"].to_numpy(), -1)
        kept = np.cumsum(change[:-1]) == 0
        text = b" ".join(map(words.__getitem__, compress(own.tolist(), kept.tolist())))
        out.append((doc_id, len(own), int(len(own) - kept.sum()), hashlib.sha256(text).hexdigest()))
    return pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256"])


def repeated_spans(packs):
    """(row, pack, start, end) of repeated passages, in words; spans of a row may overlap."""
    known = packs.where("kind = 'anchors'").groupBy("bucket").applyInPandas(_firsts, KNOWN)
    pieces = stored(packs.where("kind <> 'anchors'").groupBy("pack").cogroup(
        known.groupBy("of_pack")).applyInPandas(_pieces, PIECES))
    blocks = pieces.where("kind = 'block'").select(
        "block_row", "cell", F.col("start").alias("block_start"), F.col("words").alias("block"))
    stretches = pieces.where("kind = 'stretch'").drop("kind")
    found = stored(stretches.join(blocks, ["block_row", "cell"]).select(
        "block_row", "block_start", "block", "turn", "row", "start", "first", "last", "words").mapInPandas(_parsed, FOUND))
    left = found.select("turn", "row", F.explode("left").alias("w")).select(
        "w.high", "w.low", F.struct("turn", "row", F.col("w.start").alias("start")).alias("place"))
    first = left.groupBy("high", "low").agg(F.min("place").alias("place"))
    later = left.join(first, ["high", "low", "place"], "left_anti").select(
        "place.row", F.col("place.start").alias("span_start"), (F.col("place.start") + WINDOW).alias("span_end"))
    inside = found.select("row", F.explode(F.arrays_zip("starts", "ends")).alias("s")).select(
        "row", F.col("s.starts").alias("span_start"), F.col("s.ends").alias("span_end"))
    return inside.unionByName(later).withColumn("of_pack", F.shiftright("row", 22))


def remove_repeated(docs):
    """One row per document: its words, those removed, and the digest of the rest."""
    buckets = 2 * task_count(docs.sparkSession)
    packs = stored(docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(_pack(buckets), PACKED))
    return packs.where("kind <> 'anchors'").groupBy("pack").cogroup(
        repeated_spans(packs).groupBy("of_pack")).applyInPandas(_cleaned, RESULT).withColumn(
            "doc_id", F.col("doc_id").cast("long"))


def op13_substring_dedup(spark, sf_dir):
    return remove_repeated(table(spark, sf_dir, "documents"))
