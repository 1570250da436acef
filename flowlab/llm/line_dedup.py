"""Line dedup: blocks of lines that a document shares with an earlier one are deleted.

Method: overlapping documents are found through shared rare line hashes. A short line is
rare only with those after it, so an anchor is the hash of a line and as many following
ones as make `MIN_WORDS` words; any block of that many words holds one. The first document
with an anchor is paired with each later one that has it; each pair's lines are aligned by
patience diff, and aligned runs of lines of `MIN_WORDS` words or more are deleted from the
later document. An alignment leaves what is repeated or comes in another order; where lines
of the first document are left in the later one, their longest common runs are found by a
suffix automaton, and those of `MIN_WORDS` words or more go as well, wherever they stand.

Pairs go from an anchor's first document to the others, so a passage that many documents
share gives one pair for each, never all pairs. Documents with the same lines are one until
the end, where all but the first lose what they share. Only hashes of lines are aligned;
texts are read to hash their lines and to write the result.

Lines are compared lower-cased, with white space evened out; empty ones never count as
shared, and are deleted with a block only inside of it. Earlier means: smaller id, then
smaller hash of the lines.

Cases: a null text stays null and has no lines. Rows without an id stay as they are.
Repeated rows are one document and change alike. An empty table gives an empty result.
Other columns are kept, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowlab.functions.columns import col
from flowlab.llm.common import stored, text_of, whole_rows

MIN_WORDS = 20  # of a block that is deleted
EMPTY = 0       # the hash of a line without words


def line_hashes(text: Column) -> Column:
    """The hash of each line, 0 for those without words."""
    even = F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(F.split(even, "\n"), lambda x: F.when(F.trim(x) == "", F.lit(EMPTY).cast("bigint"))
                       .otherwise(F.xxhash64(F.trim(x))))


def line_words(text: Column) -> Column:
    even = F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(F.split(even, "\n"), lambda x: F.when(F.trim(x) == "", 0).otherwise(
        F.length(F.trim(x)) - F.length(F.replace(F.trim(x), F.lit(" "), F.lit(""))) + 1))


# ---------------------------------------------------------------- patience diff

def _longest_rising(values: Sequence[int]) -> list[int]:
    """Places of a longest rising subsequence, by patience sorting."""
    tops: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
        before.append(at[pile - 1] if pile else -1)
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience_pairs(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Aligned (i, j) with a[i] == b[j], rising in both: equal ends first, then lines with
    words that are unique in both, and so on between them."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i, i_end, j, j_end = work.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        places = {v: n for n, v in enumerate(a[i:i_end], i) if in_a[v] == 1}
        unique = [(places[v], n) for n, v in enumerate(b[j:j_end], j)
                  if v != EMPTY and in_b[v] == 1 and v in places]
        anchors = [unique[n] for n in _longest_rising([x for x, _ in unique])]
        if anchors:
            # Each part begins at an anchor, which then is an equal beginning.
            edges = [(i, j), *anchors, (i_end, j_end)]
            work += [(x, y, u, v) for (x, u), (y, v) in zip(edges, edges[1:])]
    return sorted(out)


def common_runs(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """(first, end) of the runs of b that stand somewhere in a and can't be made longer,
    by the suffix automaton of a: time and memory grow with the lines of both."""
    nexts: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for v in a:
        new, p = len(nexts), last
        nexts.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        while p >= 0 and v not in nexts[p]:
            nexts[p][v] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][v]
            if longest[p] + 1 < longest[q]:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(v) == q:
                    nexts[p][v] = copy
                    p = link[p]
                link[q] = q = copy
            link[new] = q
        last = new
    out, state, size = [], 0, 0
    for n, v in enumerate(b):
        was = size
        while state and v not in nexts[state]:
            state = link[state]
            size = longest[state]
        if v in nexts[state]:
            state, size = nexts[state][v], size + 1
        if was and size <= was:
            out.append((n - was, n))
    if size:
        out.append((len(b) - size, len(b)))
    return out


def shared_blocks(a: Sequence[int], b: Sequence[int], words: Sequence[int],
                  min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """(first, end) lines of b in runs of at least `min_words` words that a has."""
    runs: list[list[int]] = []
    for i, j in patience_pairs(a, b):
        if runs and runs[-1][0] == i and runs[-1][2] == j:
            runs[-1][0], runs[-1][2] = i + 1, j + 1
        else:
            runs.append([i + 1, j, j + 1])
    out = []
    for _, first, end in runs:
        while first < end and b[first] == EMPTY:
            first += 1
        while end > first and b[end - 1] == EMPTY:
            end -= 1
        if sum(words[first:end]) >= min_words:
            out.append((first, end))
    gone = {n for first, end in out for n in range(first, end)}
    before = set(a)
    if any(v in before and n not in gone for n, v in enumerate(b)):
        full = [n for n, v in enumerate(b) if v != EMPTY]
        for first, end in common_runs([v for v in a if v != EMPTY], [b[n] for n in full]):
            if sum(words[n] for n in full[first:end]) >= min_words:
                out.append((full[first], full[end - 1] + 1))
    return out


# ---------------------------------------------------------------- the job

def _anchors(min_words: int):
    """(key, hashes, words) to (key, anchors): a hash for each line with words and as many
    following ones as make `min_words`."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for hashes, words in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                hashes = np.array(hashes, np.int64)
                full = np.flatnonzero(hashes != EMPTY)
                hashes = hashes[full].view(np.uint64)
                total = np.concatenate([[0], np.cumsum(np.array(words, np.int64)[full])])
                stops = np.searchsorted(total, total[:-1] + min_words)
                n = int((stops < len(total)).sum())
                # Sums of hashes times powers of an odd number, so that order counts.
                powers = np.ones(len(hashes) + 1, np.uint64)
                powers[1:] = np.cumprod(np.full(len(hashes), 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
                inverse = np.ones(len(hashes) + 1, np.uint64)
                inverse[1:] = np.cumprod(np.full(len(hashes), pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64),
                                         dtype=np.uint64)
                sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers[:-1], dtype=np.uint64)])
                runs = (sums[stops[:n]] - sums[:n]) * inverse[:n]
                out.append(np.unique(runs.view(np.int64)))
            at = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
            flat = np.concatenate(out) if out else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(at, pa.array(flat))], ["key", "anchors"])

    return run


def _aligned(min_words: int):
    """(key, first hashes, hashes, words) to (key, n, lines): the lines to delete of n."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, lines = [], [], []
            for key, a, b, words in zip(*(batch.column(i).to_pylist() for i in range(4))):
                found = sorted({n for first, end in shared_blocks(a, b, words, min_words) for n in range(first, end)})
                if found:
                    keys.append(key)
                    sizes.append(len(b))
                    lines.append(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.schema.field(0).type), pa.array(sizes, pa.int32()),
                 pa.array(lines, pa.list_(pa.int32()))], ["key", "n", "lines"])

    return run


def _flagged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n, lists of lines) to (key, gone): a flag for each of n lines."""
    for batch in batches:
        flags = []
        for n, lists in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            gone = np.zeros(n, bool)
            for lines in lists:
                gone[lines] = True
            flags.append(gone.tolist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(flags, pa.list_(pa.bool_()))], ["key", "gone"])


KEY = "struct<id: bigint, a: bigint, b: bigint>"


def _row_key(id_col: Column, text: Column) -> Column:
    hashes = line_hashes(text)
    return F.struct(id_col.cast("bigint").alias("id"), F.xxhash64(F.lit(1), hashes).alias("a"),
                    F.xxhash64(F.lit(2), hashes).alias("b"))


def shared_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                 min_words: int = MIN_WORDS) -> DataFrame:
    """(key, gone): for each document with a shared block, a flag for each of its lines.
    `key` is its id with a hash of its lines."""
    t = text_of(text)
    signed = stored(docs.where(col(id_col).isNotNull()).select(
        _row_key(col(id_col), t).alias("key"), line_hashes(t).alias("hashes"), line_words(t).alias("words")))
    # Documents with the same lines: the first stands for all.
    firsts = stored(signed.groupBy("key.a", "key.b").agg(
        F.min("key").alias("key"), F.any_value("hashes").alias("hashes"), F.any_value("words").alias("words")))
    anchors = (firsts.select("key", "hashes", "words")
               .mapInArrow(_anchors(min_words), f"key {KEY}, anchors array<long>")
               .select("key", F.explode("anchors").alias("anchor")))
    owners = (anchors.groupBy("anchor").agg(F.min("key").alias("owner"), F.max("key").alias("last"))
              .where("owner <> last").select("anchor", "owner"))
    pairs = anchors.join(owners, "anchor").where("owner <> key").select("owner", "key").distinct()
    lined = (pairs.join(firsts.select(F.col("key").alias("owner"), F.col("hashes").alias("before")), "owner")
             .join(firsts, "key").select("key", "before", "hashes", "words"))
    found = (lined.mapInArrow(_aligned(min_words), f"key {KEY}, n int, lines array<int>")
             .groupBy("key", "n").agg(F.collect_list("lines").alias("lines"))
             .mapInArrow(_flagged, f"key {KEY}, gone array<boolean>"))
    # A later copy shares all its lines with the first one.
    copies = (signed.join(firsts.select("a", "b", F.col("key").alias("first")),
                          (F.col("key.a") == F.col("a")) & (F.col("key.b") == F.col("b")))
              .where("key <> first"))
    whole = copies.where(F.aggregate("words", F.lit(0), lambda x, y: x + y) >= min_words).select(
        "key", F.transform("hashes", lambda _: F.lit(True)).alias("gone")).dropDuplicates(["key"])
    return found.union(whole)


def drop_shared_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                      min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of `docs`: `row`, the whole row with the shared blocks deleted from its text,
    n_lines (that the text had) and n_deleted."""
    gone = stored(shared_lines(docs, id_col, text, min_words).withColumnRenamed("key", "_key"))
    rows = docs.select(whole_rows(docs).alias("row"), _row_key(col(id_col), text_of(text)).alias("key"))
    # Joined by a shuffle at every size, as the keys of a large corpus need it.
    both = rows.join(gone.hint("merge"), F.col("key") == F.col("_key"), "left")
    lines = F.split(F.col("row").getField(text), "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.get("gone", i)), "\n")
    cleaned = F.when(F.col("gone").isNull(), F.col("row").getField(text)).otherwise(kept)
    return both.select(
        F.col("row").withField(f"`{text}`", cleaned).alias("row"),
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(F.filter("gone", lambda g: g)), F.lit(0)).cast("bigint").alias("n_deleted"))
