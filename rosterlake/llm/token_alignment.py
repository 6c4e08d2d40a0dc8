"""How the tokens of two tokenizers lie over the same bytes.

A text's tokens of either kind are rows of a token-byte incidence matrix. The product of the
first matrix with the transpose of the second has an entry for each pair of tokens that
share bytes, the overlap links. Offsets where tokens of both kinds end cut the text into
groups; the product of the token-group incidences has an entry for each pair in one group.
Both are multiplied row by row over matrices in compressed rows, in pieces of about a megabyte
of text that end where a group ends, so that memory does not grow with a text.

Pairs of ids are counted over the whole corpus. Texts are encoded once, in blocks: a block's links, each
naming a pair, stay in the shared folder together with its own pair counts, which are added up by pair,
and each block gets back the totals of its own pairs only. No table of all pairs goes to one place.

Texts that are null or empty, or whose joined token bytes differ from a space and the text, have no tokens: their
counts are zero and the digest is ''. Rows are judged one by one, so repeated ids and rows stay apart.
Ties for the highest count of an id all count as best. An empty table gives an empty result. Columns other than doc_id
and text are not read.
"""

import hashlib
import json
import zlib
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import functions as F

from .common import stored, table
from .sparse import incidence, membership, row_products, transpose

FOLDER = "/opt/tokenizers"
BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
BLOCK_LINKS = 1 << 23
PIECE_BYTES = 1 << 20
PAIRS_A_ROW = 1 << 15
LONG_TEXT = 200_000

# How the byte-level vocabulary cuts text into words before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

ENCODED = ("block long, doc_id string, n_a long, n_b long, n_groups long, n_links long, n_shared long, "
           "groups_sha256 string, links binary, pairs array<long>, counts array<long>")
RESULT = ("doc_id string, n_a long, n_b long, n_groups long, n_links long, n_shared long, n_best long, "
          "count_sum long, groups_sha256 string")
ENCODED_NAMES, RESULT_NAMES = ([c.split()[0] for c in names.split(", ")] for names in (ENCODED, RESULT))


def byte_letters():
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return {chr(b if b in plain else next(others)): b for b in range(256)}


def read_files(folder=FOLDER, byte_level=BYTE_LEVEL, pieces=PIECES):
    """Both vocabularies' files as bytes; the driver alone reads the path."""
    return Path(folder, byte_level).read_bytes(), Path(folder, pieces).read_bytes()


class Pair:
    """Both tokenizers, and what each id stands for."""

    def __init__(self, byte_level, pieces):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        held = json.loads(byte_level)
        special = {t["content"] for t in held["added_tokens"]}
        letters = byte_letters()
        # Ids follow the order of merges, so they serve as ranks; without special tokens their strings are plain text.
        self.id_of = {bytes(letters[c] for c in name): i for name, i in held["model"]["vocab"].items()
                      if name not in special}
        self.first = tiktoken.Encoding("byte_level", pat_str=WORDS, mergeable_ranks=self.id_of, special_tokens={})
        # The quicker encoder's patterns give up on very long runs of white space; such texts take the file's own.
        self.long = Tokenizer.from_buffer(byte_level)
        self.long.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.bytes_a = [b""] * (max(self.id_of.values()) + 1)
        for token, i in self.id_of.items():
            self.bytes_a[i] = token
        self.bytes_b = [
            bytes([int(name[3:5], 16)]) if self.second.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(map(self.second.id_to_piece, range(self.second.get_piece_size())))]
        self.lengths_a = np.array([len(t) for t in self.bytes_a])
        self.lengths_b = np.array([len(t) for t in self.bytes_b])
        # The digest's pieces: an id of either kind before another of its group, then as the last of it.
        self.parts = [f"{i}{sign}".encode() for n, signs in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;"))
                      for sign in signs for i in range(n)]

    def encode(self, text):
        """Ids of both kinds, none where either's bytes are not those of a space and the text."""
        if text:
            spaced = " " + text
            a = (self.first.encode_to_numpy(spaced) if len(text) < LONG_TEXT
                 else np.array(self.long.encode(spaced, add_special_tokens=False).ids)).astype(np.int64)
            b = self.second.encode(text)
            raw = spaced.encode()
            if b"".join(map(self.bytes_a.__getitem__, a.tolist())) == raw == b"".join(
                    map(self.bytes_b.__getitem__, b)):
                return a, np.array(b, dtype=np.int64)
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)


@lru_cache(maxsize=2)
def _loaded(files):
    return Pair(*files)


class Aligned:
    """The groups and links of a run of texts, token for token."""

    def __init__(self, pair, texts):
        """texts: ids of both kinds for each text."""
        self.a = np.concatenate([a for a, _ in texts]) if texts else np.zeros(0, dtype=np.int64)
        self.b = np.concatenate([b for _, b in texts]) if texts else np.zeros(0, dtype=np.int64)
        self.lengths_a, self.lengths_b = pair.lengths_a[self.a], pair.lengths_b[self.b]
        ends_a, ends_b = np.cumsum(self.lengths_a), np.cumsum(self.lengths_b)
        met = np.searchsorted(ends_b, ends_a)
        self.last_a = ends_b[np.minimum(met, len(ends_b) - 1)] == ends_a if len(ends_b) else met == -1
        self.last_b = np.zeros(len(self.b), dtype=bool)
        self.last_b[met[self.last_a]] = True
        self.group_ends = ends_a[self.last_a]
        self.group_a = np.cumsum(self.last_a) - self.last_a
        self.group_b = np.cumsum(self.last_b) - self.last_b
        self.text_a = np.repeat(np.arange(len(texts)), [len(a) for a, _ in texts])
        self.text_b = np.repeat(np.arange(len(texts)), [len(b) for _, b in texts])

    def stretches(self):
        """Token ranges of both kinds and of groups, about PIECE_BYTES long, cut where groups end."""
        ends = np.concatenate([[0], self.group_ends])
        until_a = np.concatenate([[0], np.flatnonzero(self.last_a) + 1])
        until_b = np.concatenate([[0], np.flatnonzero(self.last_b) + 1])
        first = 0
        while first < len(ends) - 1:
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + PIECE_BYTES, side="right")) - 1)
            yield until_a[first], until_a[last], until_b[first], until_b[last], first, last
            first = last

    def overlap_links(self):
        """(place in a, place in b, shared bytes), from the product of token-byte incidences."""
        for a0, a1, b0, b1, g0, g1 in self.stretches():
            width = int(self.lengths_a[a0:a1].sum())
            for row, column, shared in row_products(
                    incidence(self.lengths_a[a0:a1], width), transpose(incidence(self.lengths_b[b0:b1], width))):
                yield row + a0, column + b0, shared

    def group_links(self):
        """(place in a, place in b, 1) for pairs of one group, from the product of token-group incidences."""
        for a0, a1, b0, b1, g0, g1 in self.stretches():
            for row, column, one in row_products(
                    membership(self.group_a[a0:a1] - g0, g1 - g0),
                    transpose(membership(self.group_b[b0:b1] - g0, g1 - g0))):
                yield row + a0, column + b0, one

    def digests(self, pair, n):
        """SHA-256 of each text's groups: ids by comma, kinds by |, groups by ;."""
        n_a, n_b = len(pair.bytes_a), len(pair.bytes_b)
        before_b = np.searchsorted(self.group_b, self.group_a)
        until_a = np.searchsorted(self.group_a, self.group_b, side="right")
        parts = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        parts[np.arange(len(self.a)) + before_b] = self.a + n_a * self.last_a
        parts[np.arange(len(self.b)) + until_a] = 2 * n_a + self.b + n_b * self.last_b
        sizes = np.bincount(self.text_a, minlength=n) + np.bincount(self.text_b, minlength=n)
        parts, at, out = parts.tolist(), 0, []
        for size in sizes.tolist():
            joined = b"".join(map(pair.parts.__getitem__, parts[at:at + size]))
            out.append(hashlib.sha256(joined[:-1]).hexdigest() if size else "")
            at += size
        return out


def _runs(sizes, most):
    """Ranges of consecutive texts whose sizes sum to about `most`."""
    first, total = 0, 0
    for place, size in enumerate(sizes):
        if total and total + size > most:
            yield first, place
            first, total = place, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def _rows(frame, **values):
    """Rows of the encoded table; columns not given are null."""
    return pd.DataFrame({c: values.get(c, frame.get(c)) for c in ENCODED_NAMES}, index=frame.index)


class _Block:
    """A block's documents and pairs so far. Links name their pair by its place in the sorted list of the block's."""

    def __init__(self, number):
        self.number, self.links, self.parts = number, 0, []

    def add(self, rows, keys):
        """rows: a frame of documents; keys: the pairs of their links, document after document."""
        codes, pairs = pd.factorize(keys)
        self.parts.append((rows, codes, pairs, np.bincount(codes, minlength=len(pairs))))
        self.links += len(codes)

    def rows(self):
        """Frames of the block's documents, then of its pair counts."""
        pairs = np.unique(np.concatenate([p for _, _, p, _ in self.parts])) if self.parts else []
        counts = np.zeros(len(pairs), dtype=np.int64)
        kind = "<u2" if len(pairs) <= 1 << 16 else "<u4"
        for rows, codes, own, n in self.parts:
            place = np.searchsorted(pairs, own)
            counts[place] += n
            named = place.astype(kind)[codes]
            cuts = np.cumsum(rows["n_links"].to_numpy())
            links = [zlib.compress(named[s:e].tobytes(), 1) for s, e in zip([0, *cuts.tolist()], cuts.tolist())]
            yield _rows(rows, block=self.number, links=links)
        for at in range(0, len(pairs), PAIRS_A_ROW):
            yield _rows(pd.DataFrame({"block": [self.number]}), pairs=[pairs[at:at + PAIRS_A_ROW]],
                        counts=[counts[at:at + PAIRS_A_ROW]])


def _encode(files):
    def run(batches):
        pair = _loaded(files.value)
        width = len(pair.bytes_b)
        block = _Block(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for first, last in _runs([len(t or "") for t in batch["text"]], PIECE_BYTES):
                part = batch.iloc[first:last]
                texts = [pair.encode(t) for t in part["text"]]
                n = len(texts)
                aligned = Aligned(pair, texts)
                n_links, n_shared, keys = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), []
                for row, column, _ in aligned.overlap_links():
                    n_links += np.bincount(aligned.text_a[row], minlength=n)
                    keys.append(aligned.a[row] * width + aligned.b[column])
                for row, _, _ in aligned.group_links():
                    n_shared += np.bincount(aligned.text_a[row], minlength=n)
                block.add(pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(), "n_a": [len(a) for a, _ in texts],
                    "n_b": [len(b) for _, b in texts],
                    "n_groups": np.bincount(aligned.text_a[aligned.last_a], minlength=n), "n_links": n_links,
                    "n_shared": n_shared, "groups_sha256": aligned.digests(pair, n),
                }), np.concatenate([np.zeros(0, dtype=np.int64), *keys]))
                if block.links >= BLOCK_LINKS:
                    yield from block.rows()
                    block = _Block(block.number + 1)
        yield from block.rows()
    return run


def _totals(key, docs, totals):
    """Sums over each document's links of what the corpus says of their pairs."""
    totals = totals.sort_values("pair")
    total, best = totals["total"].to_numpy(), totals["best"].to_numpy()
    kind = "<u2" if len(totals) <= 1 << 16 else "<u4"
    named = [np.frombuffer(zlib.decompress(links), dtype=kind) for links in docs["links"]]
    return docs.assign(n_best=[int(best[n].sum()) for n in named],
                       count_sum=[int(total[n].sum()) for n in named])[RESULT_NAMES]


def encode(docs, files):
    """Documents with their links, and rows of the pair counts of each block of documents; stored."""
    held = docs.sparkSession.sparkContext.broadcast(files)
    return stored(docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(_encode(held), ENCODED))


def pair_totals(encoded, files):
    """Each pair's count by block and over the corpus, and whether it is the highest of its second id."""
    width = len(_loaded(files).bytes_b)
    pairs = encoded.where("pairs IS NOT NULL").select(
        "block", F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("n"))).alias("p")).select(
            F.col("block").alias("of_block"), "p.pair", "p.n")
    counted = pairs.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair") % width)
    highest = counted.groupBy("b").agg(F.max("total").alias("highest"))
    marked = counted.join(highest, "b").select(
        "pair", "total", (F.col("total") == F.col("highest")).cast("long").alias("best"))
    return pairs.join(marked, "pair").select("of_block", "pair", "total", "best")


def align(docs, files):
    """One row per document with its counts, digest and corpus-wide sums."""
    encoded = encode(docs, files)
    tokens = encoded.where("pairs IS NULL").drop("pairs", "counts")
    zero = F.lit(0).cast("long")
    without = tokens.where("n_a = 0").withColumns({"n_best": zero, "count_sum": zero}).select(*RESULT_NAMES)
    found = tokens.where("n_a > 0").groupBy("block").cogroup(
        pair_totals(encoded, files).groupBy("of_block")).applyInPandas(_totals, RESULT)
    return found.unionByName(without).withColumn("doc_id", F.col("doc_id").cast("long"))


def links(docs, files, kind="overlap"):
    """Every link as a row: the text's key, both places and ids, and the bytes shared (1 for kind "group")."""
    held = docs.sparkSession.sparkContext.broadcast(files)

    def run(batches):
        pair = _loaded(held.value)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                aligned = Aligned(pair, [pair.encode(text)])
                found = aligned.overlap_links() if kind == "overlap" else aligned.group_links()
                for row, column, shared in found:
                    yield pd.DataFrame({"doc_id": doc_id, "place_a": row, "place_b": column,
                                        "id_a": aligned.a[row], "id_b": aligned.b[column], "shared": shared})

    return docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        run, "doc_id string, place_a long, place_b long, id_a long, id_b long, shared long").withColumn(
            "doc_id", F.col("doc_id").cast("long"))


def op12_token_alignment(spark, sf_dir):
    return align(table(spark, sf_dir, "documents"), read_files())
