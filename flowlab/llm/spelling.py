"""Spelling variant grouping: the words of a corpus that are one edit apart, by PartEnum.

Method: a word is the multiset of its letters, a binary vector with a feature for the first,
second, ... occurrence of each letter. One inserted or deleted letter changes one feature, a
replaced one two: words one edit apart have vectors of Hamming distance at most two. The
features are cut into `parts` parts by hash. Two vectors that differ in at most two features
agree on all but two of the parts, whichever those are; so every vector emits a signature for
each choice of `parts` - 2 of them, and two near vectors share at least one.

Steps:
1. Words and their occurrences, counted with partial sums before the shuffle.
2. Words of equal letters (anagrams) have one vector and are signed once. A signature also
   holds the larger size of a pair: a vector signs for its own size and for the next.
3. Vectors are joined by signature and verified: each lacks at most one feature of the other.
4. Words of near (or the same) vectors are verified by their edit distance.
5. Each word's form is its most frequent near word, if that is frequent enough; the root is
   found by following forms in doubling steps.

A frequent word is one row after step 1, so no step has a hot word. The largest groups of
step 3 are vectors of one size that agree on nearly all parts.

Cases: a null or empty text has no words. Repeated rows count as often as they stand there. A
null id stands for the empty text in the hash that places the deletions. An empty table gives
an empty result. Only the id and text columns are used.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowlab.functions.columns import col
from flowlab.llm.common import stored, text_of
from flowlab.llm.shingles import mix

# What parts runs of letters, the letters that are lower-cased, and one run in so many
# that loses a letter.
OTHER = "[^A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DELETED = 199

PARTS = 8


def runs_of(docs: DataFrame, length: int = 1, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(word): every run of at least `length` letters, lower-cased; one in DELETED, chosen by hash
    of the id and the run, lacks a letter."""
    mark = F.crc32(F.concat(F.coalesce(F.col("id"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return (docs.select(col(id_col).cast("string").alias("id"),
                        F.explode(F.split(F.translate(text_of(text), UPPER, LOWER), OTHER)).alias("run"))
            .where(F.length("run") >= max(length, 1)).withColumn("h", mark)
            .select(F.when(F.pmod("h", F.lit(DELETED)) == 0, cut).otherwise(F.col("run")).alias("word")))


def frequent_words(docs: DataFrame, length: int = 6, times: int = 5,
                   id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of words of at least `length` code points and `times` occurrences."""
    # A run that lacks a letter is a shorter word, so shorter runs give none.
    return (runs_of(docs, length, id_col, text).where(F.length("word") >= length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= times))


def letters(word: Column) -> Column:
    """The letters of a word in order, as a text: equal for equal multisets."""
    return F.array_join(F.array_sort(F.split(word, "")), "")


def features(sorted_letters: str) -> list[int]:
    """Of letters in order: each with its number among the equal ones."""
    out, last, number = [], "", 0
    for letter in sorted_letters:
        number = number + 1 if letter == last else 0
        last = letter
        out.append(ord(letter) << 32 | number)
    return out


def signatures(vectors: list[list[int]], parts: int = PARTS) -> np.ndarray:
    """For each vector a signature for each choice of all but two parts, and for each size of
    the larger one of a pair: the vector's own and the next."""
    sizes = np.array([len(v) for v in vectors], np.uint64)
    owners = np.repeat(np.arange(len(vectors)), sizes.astype(np.int64))
    hashed = mix(np.array([f for v in vectors for f in v], np.uint64))
    total = np.zeros((len(vectors), parts), np.uint64)
    np.add.at(total, (owners, (hashed % np.uint64(parts)).astype(np.int64)), mix(hashed))
    out = []
    for larger in (sizes, sizes + np.uint64(1)):
        for i, chosen in enumerate(combinations(range(parts), parts - 2)):
            key = mix(larger << np.uint64(32) | np.uint64(i))
            for part in chosen:
                key = mix(key + total[:, part])
            out.append(key)
    return np.array(out).T


def _signed(parts: int):
    """(v) batches to (v, f, s): the features and signatures of each vector."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [features(v) for v in batch.column(0).to_pylist()]
            if vectors:
                signed = signatures(vectors, parts)
                at = np.arange(len(vectors) + 1, dtype=np.int32) * signed.shape[1]
                flat = pa.array(np.ascontiguousarray(signed).reshape(-1).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(vectors, pa.list_(pa.int64())),
                     pa.ListArray.from_arrays(at, flat)], ["v", "f", "s"])

    return run


def near_vectors(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(a, b), a < b: the sorted letters of words whose vectors are at most two features apart,
    of sizes that differ by one at most."""
    vectors = stored(words.select(letters(F.col("word")).alias("v")).distinct()
                     .mapInArrow(_signed(parts), "v string, f array<long>, s array<long>"))
    met = vectors.select("v", F.explode("s").alias("s"))
    pairs = (met.select("s", F.col("v").alias("a")).join(met.select("s", F.col("v").alias("b")), "s")
             .where("a < b").where(F.abs(F.length("a") - F.length("b")) <= 1))
    # Sizes differ by one at most, so one feature at most is missing on either side; letters in
    # order are then two edits apart at most, which drops most pairs before they are shuffled.
    likely = pairs.where(F.levenshtein("a", "b", 2) >= 0).select("a", "b").distinct()
    fa, fb = (vectors.select(F.col("v").alias(x), F.col("f").alias(f"f{x}")) for x in "ab")
    return (likely.join(fa, "a").join(fb, "b")
            .where((F.size(F.array_except("fa", "fb")) <= 1) & (F.size(F.array_except("fb", "fa")) <= 1))
            .select("a", "b"))


def near_words(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(word, n, near, near_n), in both directions: the words exactly one edit apart."""
    known = stored(words.withColumn("v", letters(F.col("word"))))
    left = known.select(F.col("v").alias("a"), F.col("word").alias("x"), F.col("n").alias("nx"))
    right = known.select(F.col("v").alias("b"), F.col("word").alias("y"), F.col("n").alias("ny"))
    # Words of the same letters are never one edit apart.
    pairs = stored(left.join(near_vectors(words, parts), "a").join(right, "b")
                   .where(F.levenshtein("x", "y", 1) == 1).select("x", "nx", "y", "ny"))
    return pairs.toDF("word", "n", "near", "near_n").union(
        pairs.select("y", "ny", "x", "nx"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last word that forms lead to. Each step doubles how
    far every word has followed them, so a chain of n takes about log2 n."""
    reached = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = reached.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        reached = stored(step)
        if not reached.where("moved").head(1):
            return reached.drop("moved")
        reached = reached.drop("moved")


def spelling_variants(docs: DataFrame, length: int = 6, times: int = 5, ratio: int = 5, parts: int = PARTS,
                      id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root. The form is the near word of
    largest n, the first of these by code points, if that n is `ratio` times the word's."""
    words = stored(frequent_words(docs, length, times, id_col, text))
    near = near_words(words, parts).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    best = stored(near.select("word", "n_near", F.when(
        -F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best")))
    found = roots(best.where("best IS NOT NULL").select("word", F.col("best.near").alias("form")))
    return words.join(best, "word", "left").join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"),
        F.coalesce("root", "word").alias("root"))
