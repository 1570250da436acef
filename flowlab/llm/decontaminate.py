"""Benchmark decontamination: test items found in documents up to a number of edits.

Method: an item that occurs with at most k edits has, cut into k + 1 pieces, one piece
without an edit. An automaton finds all pieces in one pass over each whole text; each
piece found names a window of the text, and Myers' bit-parallel distance decides whether
the item occurs there with at most k edits.

Texts are compared as lower-cased words joined by single spaces, so line breaks, case and
punctuation don't count; edits are in characters of that form. The items are a query set
that every document is held against, in blocks of bounded size: each block is one pass
over the documents, whose automaton is sent to the executors. Nothing is shuffled.

An item too short for an edit (fewer than 100 / max_edits_pct characters) has no piece but
itself: it matches where it stands exactly, between word bounds. Scripts without spaces have a
bound at every character.

Cases: a null or empty text holds nothing. Items without a letter or digit (null, empty, symbols
only) have no such form and match nothing; `blank_items` lists them. Equal items are all reported. Repeated rows are each reported. Rows without an id are
reported with a null id. Empty tables give empty results. Other columns aren't looked at.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowlab.functions.columns import col
from flowlab.llm.common import text_of
from flowlab.llm.shingles import slices

MAX_EDITS_PCT = 6     # edits allowed, as a share of the item's characters
BLOCK_CHARS = 1 << 21  # of items in one block, about

_WORD = re.compile(r"\w+")


def plain(text: str | None) -> str:
    """Words joined by single spaces, lower-cased."""
    return " ".join(_WORD.findall(text or "")).lower()


def span_in(text: str, start: int, end: int) -> tuple[int, int]:
    """Code points of `text` whose words hold plain(text)[start:end]."""
    at, first, last = 0, None, 0
    for m in _WORD.finditer(text):
        stop = at + len(m[0].lower())
        if stop > start and first is None:
            first = m.start()
        if at < end:
            last = m.end()
        at = stop + 1
    return first or 0, last


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """(start, piece) of edits + 1 pieces of about equal length."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_match(item: str, text: str, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """(distance, end) of the part of `text` nearest to `item`; the first such end.

    Myers' algorithm: a column of the table of distances is two bit vectors of its
    differences, updated by a few operations on long integers for each character."""
    masks = masks or item_masks(item)
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    up, down, score = full, 0, len(item)
    best, end = score, 0
    for i, c in enumerate(text):
        eq = masks.get(c, 0)
        zero = (((eq & up) + up) ^ up) | eq | down
        more = down | (full & ~(zero | up))
        less = up & zero
        if more & top:
            score += 1
        elif less & top:
            score -= 1
        more, less = (more << 1) & full, (less << 1) & full
        up = less | (full & ~(zero | more))
        down = more & zero
        if score < best:
            best, end = score, i + 1
    return best, end


def _unspaced(c: str) -> bool:
    """Whether a character is of a script that sets no spaces between words."""
    return "\u0e00" <= c <= "\u0eff" or "\u2e80" <= c <= "\ua4cf" or "\uf900" <= c <= "\ufaff" or c >= "\U00020000"


def bounded(form: str, start: int, end: int) -> bool:
    """Whether form[start:end] begins and ends between words."""
    def bound(at: int) -> bool:
        return at in (0, len(form)) or " " in form[at - 1:at + 1] or _unspaced(form[at - 1]) or _unspaced(form[at])

    return bound(start) and bound(end)


def item_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


class Matcher:
    """The automaton and bit masks of one block of items."""

    def __init__(self, items: list[tuple[int, str]], max_edits_pct: int):
        self.items = [(i, p) for i, t in items if (p := plain(t))]
        self.edits = [len(p) * max_edits_pct // 100 for _, p in self.items]
        self.masks = [item_masks(p) for _, p in self.items]
        spots: dict[str, list[tuple[int, int]]] = {}
        for n, (_, p) in enumerate(self.items):
            for at, piece in pieces(p, self.edits[n]):
                spots.setdefault(piece, []).append((n, at))
        self.pieces = ahocorasick.Automaton()
        for piece, where in spots.items():
            self.pieces.add_word(piece, (len(piece), where))
        self.pieces.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item id, distance, start, end) in the plain text, the best of each place."""
        if not self.items:
            return
        starts: dict[int, set[int]] = {}
        for last, (size, where) in self.pieces.iter(text):
            for n, at in where:
                starts.setdefault(n, set()).add(last + 1 - size - at)
        for n, found in starts.items():
            item, slack = self.items[n][1], self.edits[n]
            if not slack:
                for start in sorted(found):
                    if bounded(text, start, start + len(item)):
                        yield self.items[n][0], 0, start, start + len(item)
                continue
            spans: list[list[int]] = []
            # The pieces of one occurrence put its start at most 2 * slack apart.
            for start in sorted(found):
                if spans and start <= spans[-1][1] + 2 * slack:
                    spans[-1][1] = start
                else:
                    spans.append([start, start])
            for low, high in spans:
                low = max(low - slack, 0)
                window = text[low:high + len(item) + slack]
                distance, end = best_match(item, window, self.masks[n])
                if distance <= slack:
                    length = best_match(item[::-1], window[:end][::-1])[1]
                    yield self.items[n][0], distance, low + end - length, low + end


def _blocks(items: DataFrame, item_id: str, item_text: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about `block_chars` characters, one on the driver at a time."""
    rows = items.select(col(item_id).cast("bigint").alias("item_id"), text_of(item_text).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).head()[0] or 0
    count = -(-total // block_chars)
    for i in range(count):
        block = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i)
        yield sorted(((r[0], r[1]) for r in block.collect()), key=lambda r: (r[0] is not None, r[0], r[1]))


# The matcher of the latest block, built once in each Python worker.
_MATCHERS: dict[str, Matcher] = {}


def _matcher(key: str, sent) -> Matcher:
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(*sent.value)
    return _MATCHERS[key]


def _found(key: str, sent, texts: pa.Array) -> Iterator[tuple[int, str, str, list]]:
    """(row, text, plain text, places) of the texts that hold an item."""
    matcher = _matcher(key, sent)
    for first, part in slices(texts):
        for i, text in enumerate(part.to_pylist()):
            form = plain(text)
            if places := list(matcher.find(form)):
                yield first + i, text, form, places


def _reporter(key: str, sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text, _, places in _found(key, sent, batch.column(1)):
                by_item: dict[int, list] = {}
                for item, *place in places:
                    by_item.setdefault(item, []).append(tuple(place))
                for item, its in by_item.items():
                    distance, start, end = min(its)
                    rows.append((batch.column(0)[i].as_py(), item, len(its), distance,
                                 *span_in(text, start, end)))
            columns = list(zip(*rows)) or [()] * len(FIELDS)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], FIELDS)

    return run


def _filter(key: str, sent, at: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [True] * batch.num_rows
            for i, *_ in _found(key, sent, batch.column(at)):
                clean[i] = False
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


FIELDS = ["doc_id", "item_id", "n_places", "distance", "start_char", "end_char"]


def _sent(docs: DataFrame, items: DataFrame, item_id: str, item_text: str,
          max_edits_pct: int, block_chars: int):
    for block in _blocks(items, item_id, item_text, block_chars):
        yield uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast((block, max_edits_pct))


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", max_edits_pct: int = MAX_EDITS_PCT,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document row and item that occurs in it: doc_id, item_id, n_places, and the
    best place's distance and its code points start_char, end_char (end exclusive)."""
    rows = docs.select(col(id_col).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    schema = ", ".join(f"{f} long" for f in FIELDS)
    found = docs.sparkSession.createDataFrame([], schema)
    for key, sent in _sent(docs, items, item_id, item_text, max_edits_pct, block_chars):
        found = found.union(rows.mapInArrow(_reporter(key, sent), schema))
    return found


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", max_edits_pct: int = MAX_EDITS_PCT,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of `docs` in which no item occurs, unchanged."""
    at = docs.columns.index(text)
    for key, sent in _sent(docs, items, item_id, item_text, max_edits_pct, block_chars):
        docs = docs.mapInArrow(_filter(key, sent, at), docs.schema)
    return docs


def blank_items(items: DataFrame, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id) of the items that can't be looked for: those without a letter or digit."""
    return items.where(~text_of(item_text).rlike(r"[\p{L}\p{N}\p{M}_]")).select(
        col(item_id).cast("bigint").alias("item_id"))
