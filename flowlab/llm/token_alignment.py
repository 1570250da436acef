"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Method: both tokenizers cut the same bytes of a document. One NumPy state vector holds, for
all documents of a batch, a pointer to the current token of A and one of B. In each step every
document emits the link of its two current tokens, which overlap, and moves the pointer whose
token ends first; where both end, it emits a cut and moves both. Documents that have ended
are compacted out of the state, so a step costs what is still running.

Steps:
1. Batches of texts are encoded and merged; each document keeps its figures and its distinct
   links with their numbers, stored, so that texts are encoded once.
2. The numbers of each pair of ids are summed over the corpus, with partial sums before the
   shuffle, and the highest of each B id is found.
3. The sums are joined back. They are broadcast only up to MAX_PAIRS pairs; beyond that the
   documents' links are shuffled by pair, where adaptive execution splits frequent ones.

A is read from a byte-level BPE file and B from a sentencepiece model; their paths are
parameters. The BPE is run by a rank-based encoder built from that file, five times as fast as
the file's own library and equal to it in the tests.

Cases: a text that is null or empty has no tokens, nor has one whose tokens' bytes, in A or in
B, don't make up a space and the text (as where B drops or replaces characters). Repeated rows
count as often as they stand there. An empty table gives an empty result. Only the id and text
columns are used.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, functions as F

from flowlab.functions.columns import col
from flowlab.llm.common import stored
from flowlab.llm.shingles import slices

Batches = Iterable[pa.RecordBatch]

# Fixed value: how byte-level BPE of this kind cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_PAIRS = 2_000_000   # pairs of ids that are broadcast, at most (about 100 MB)
TEXT_BYTES = 8 << 20    # of text merged in lockstep, about
TOGETHER = 64           # texts encoded at once


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: printable ones stand
    for themselves, the others for the code points from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairs:
    """Tokenizer A."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        bytes_of = byte_alphabet()
        special = {token["content"] for token in data["added_tokens"] if token["special"]}
        ranks = {bytes(bytes_of[c] for c in entry): i for entry, i in data["model"]["vocab"].items()
                 if entry not in special}
        self.encoder = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.pieces[i] = piece

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoder.encode_to_numpy(" " + text, disallowed_special=()) for text in texts]


class Pieces:
    """Tokenizer B, which adds the space itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self.model.encode(texts, num_threads=1)]


class Merged:
    """Links and cuts of a batch, ordered by document: `link_a` and `link_b` are token ids of
    each link, `link_at` where a document's begin; `cut_a` and `cut_b` are the tokens (numbers
    in the batch) that end at each cut, `cut_at` where a document's begin."""

    def __init__(self, link_a, link_b, link_at, cut_a, cut_b, cut_at):
        self.link_a, self.link_b, self.link_at = link_a, link_b, link_at
        self.cut_a, self.cut_b, self.cut_at = cut_a, cut_b, cut_at


def merge_lockstep(ids_a: np.ndarray, ends_a: np.ndarray, at_a: np.ndarray,
                   ids_b: np.ndarray, ends_b: np.ndarray, at_b: np.ndarray) -> Merged:
    """The links and cuts of documents given by their tokens' ids and ends (bytes from the
    document's start), with the first token of each document in `at_a` and `at_b`. Both sides
    of a document end at the same byte, and no token is empty."""
    count = len(at_a) - 1
    docs = np.flatnonzero(at_a[1:] > at_a[:-1]).astype(np.min_scalar_type(max(count, 1)))
    a, b, last = at_a[docs], at_b[docs], at_a[docs + np.int64(1)]
    steps: list[tuple] = []
    while len(docs):
        end_a, end_b = ends_a[a], ends_b[b]
        steps.append((docs, a, b, end_a == end_b))
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        running = a < last
        if not running.all():
            docs, a, b, last = docs[running], a[running], b[running], last[running]
    if not steps:
        none = np.empty(0, np.int32)
        return Merged(none, none, np.zeros(count + 1, np.int64), none, none, np.zeros(count + 1, np.int64))
    owners, a, b, cuts = (np.concatenate(c) for c in zip(*steps))
    order = np.argsort(owners, kind="stable")  # by document; its steps are in order already
    owners, a, b, cuts = owners[order], a[order], b[order], cuts[order]
    bounds = np.arange(count + 1)
    return Merged(ids_a[a], ids_b[b], np.searchsorted(owners, bounds),
                  a[cuts], b[cuts], np.searchsorted(owners[cuts], bounds))


class Batch:
    """The tokens of a batch's documents on one side."""

    def __init__(self, tokens: list[np.ndarray], lengths: np.ndarray):
        self.at = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32)
        self.ids = np.concatenate([np.empty(0, np.int32), *tokens]).astype(np.int32)
        total = np.cumsum(lengths[self.ids])
        before = np.concatenate([[0], total])[self.at[:-1]]
        self.ends = (total - np.repeat(before, np.diff(self.at))).astype(np.int32)


def _group_hashes(side_a: Batch, side_b: Batch, merged: Merged, names: list[list[np.ndarray]]) -> Iterator[str]:
    """SHA-256 of each document's groups, written as `a1,a2|b1;a3|b2,b3`."""
    for d, (start, stop) in enumerate(zip(merged.cut_at[:-1], merged.cut_at[1:])):
        if start == stop:
            yield ""
            continue
        parts, ends = [], []
        for side, cuts, (comma, last) in ((side_a, merged.cut_a, names[0]), (side_b, merged.cut_b, names[1])):
            ids = side.ids[side.at[d]:side.at[d + 1]]
            at = cuts[start:stop] - side.at[d]
            text = comma[ids]
            text[at] = last[ids[at]]
            parts.append(text)
            ends.append(at + 1)
        # A token comes after all of its own side before it, and after the other side's groups
        # before its own; B's tokens also after those of A in their group.
        (text_a, text_b), (ends_a, ends_b) = parts, ends
        groups = np.arange(len(ends_a))
        before_b = np.concatenate([[0], ends_b[:-1]])
        out = np.empty(len(text_a) + len(text_b), object)
        out[np.arange(len(text_a)) + before_b[np.repeat(groups, np.diff(ends_a, prepend=0))]] = text_a
        out[np.arange(len(text_b)) + ends_a[np.repeat(groups, np.diff(ends_b, prepend=0))]] = text_b
        yield hashlib.sha256("".join(out.tolist())[:-1].encode()).hexdigest()


def _aligned(path_a: str, path_b: str):
    """(row, doc_id, text) batches to SCHEMA: `pairs` has each distinct link as A id << 32 | B id,
    `times` how often it stands in the document."""
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        sides = BytePairs(path_a), Pieces(path_b)
        lengths = [np.array([len(p) for p in s.pieces], np.int64) for s in sides]
        names = [[np.array([f"{i}{end}" for i in range(len(s.pieces))], object) for end in (",", last)]
                 for s, last in zip(sides, "|;")]
        for batch in batches:
            for start, texts in slices(batch.column(2), TEXT_BYTES):
                found = _merge_texts(texts.to_pylist(), sides, lengths, names)
                kept = [batch.column(i).slice(start, len(texts)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *found],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return run


def _merge_texts(texts: list[str | None], sides: tuple, lengths: list, names: list) -> list[pa.Array]:
    none = np.empty(0, np.int32)
    tokens: tuple[list, list] = ([none] * len(texts), [none] * len(texts))
    full = [i for i, t in enumerate(texts) if t]
    for at in range(0, len(full), TOGETHER):
        some = full[at:at + TOGETHER]
        part = [texts[i] for i in some]
        for i, text, *pair in zip(some, part, *(s.encode(part) for s in sides)):
            want = b" " + text.encode()
            # A's bytes are the text's by construction; B may drop or replace some.
            if b"".join(map(sides[1].pieces.__getitem__, pair[1].tolist())) == want:
                tokens[0][i], tokens[1][i] = pair
    side_a, side_b = (Batch(t, n) for t, n in zip(tokens, lengths))
    del tokens
    merged = merge_lockstep(side_a.ids, side_a.ends, side_a.at, side_b.ids, side_b.ends, side_b.at)
    hashes = list(_group_hashes(side_a, side_b, merged, names))
    linked = merged.link_a.astype(np.int64) << 32 | merged.link_b
    found = [np.unique(linked[i:j], return_counts=True) for i, j in zip(merged.link_at[:-1], merged.link_at[1:])]
    at = np.concatenate([[0], np.cumsum([len(p) for p, _ in found])]).astype(np.int32)
    pairs, times = (np.concatenate([np.empty(0, np.int64), *c]) for c in zip(*found))
    return [pa.array(np.diff(x).astype(np.int64)) for x in (side_a.at, side_b.at, merged.cut_at, merged.link_at)] + [
        pa.array(hashes, pa.string()), pa.ListArray.from_arrays(at, pa.array(pairs.astype(np.int64))),
        pa.ListArray.from_arrays(at, pa.array(times.astype(np.int32)))]


SCHEMA = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "pairs array<long>, times array<int>")


def links(aligned: DataFrame) -> DataFrame:
    """(row, pair, times): each document's distinct links."""
    return aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("z")).select(
        "row", F.col("z.pairs").alias("pair"), F.col("z.times").cast("bigint").alias("times"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, b, count, best): over the corpus, how many links hold each pair of ids, and
    whether no other pair with that B id has more."""
    counts = stored(links(aligned).groupBy("pair").agg(F.sum("times").alias("count")))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", b).join(most, "b").select(
        "pair", F.shiftright("pair", 32).alias("a"), "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align_tokens(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text: str = "text",
                 max_pairs: int = MAX_PAIRS) -> DataFrame:
    """One row per row of `docs`: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count
    is the highest of their B id), count_sum (of the counts over all links), groups_sha256."""
    # Rows are numbered in no order, but stored and so always the same.
    aligned = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), col(id_col).cast("bigint").alias("doc_id"),
        col(text).cast("string").alias("text")).mapInArrow(_aligned(path_a, path_b), SCHEMA))
    counts = stored(pair_counts(aligned).select("pair", "count", "best"))
    if counts.count() <= max_pairs:
        counts = F.broadcast(counts)
    n = F.col("times")
    sums = links(aligned).join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), n).otherwise(0)).alias("n_best"), F.sum(n * F.col("count")).alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    return aligned.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(
        sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
