"""N-gram Jaccard join: all documents whose shingle sets are similar enough, by PartEnum.

Method: two sets of Jaccard similarity T or more, in one band of sizes, differ in at most k
features, where k follows from T and the band. The feature domain is cut into partitions by
hash; sets that differ in at most k features agree on some partition, or on some subset of a
partition's parts. Each set therefore emits signatures: per first-level partition, hashes of
all subsets of its second-level parts, of the size that makes agreement certain. Sets that
share no signature are not similar enough, so no link can be lost.

Steps, none of which forms all pairs of a group as rows:
1. Texts with equal sets become one class, with a number of its own. The steps below know
   classes only, each by one set, however many rows or ids have it.
2. A set with more than 1 - T of its features found in no other class has no partner.
   The features of a part of the domain are counted, which drops most documents.
3. The rest emit signatures. Signatures shared by two or more are groups; groups with the
   same members are looked at once, large ones in pairs of blocks.
4. In a group, fingerprints of finer parts give a lower bound of how far two sets differ.
   Sets that may be linked are joined to clusters, so that each set is in one only.
5. In a cluster the sets themselves are compared, and links that join it are returned;
   large clusters go in pairs of blocks.
6. Components of these links and of those between the classes of one id, by large and
   small stars.

Cases: a null or wordless text has an empty set and links with nothing but its id's other
texts. Rows without an id count their shingles but aren't linked (their component is null).
Rows that share an id are one document: it links what any of its texts links. Repeated rows
come back as often as they went in. An empty table gives an empty result. Only the id and text columns are used.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlab.functions.columns import col
from flowlab.llm.common import digest, row_digest, stored, text_of, whole_rows
from flowlab.llm.components import components
from flowlab.llm.shingles import mix, set_digest, shingle_sets

Batches = Iterable[pa.RecordBatch]


@dataclass(frozen=True)
class PartEnum:
    """Signatures for sets whose Jaccard similarity is `percent` / 100 or more."""

    percent: int
    band: float = 1.4     # largest by smallest size of a band
    away: int = 1         # features in which a first-level partition may differ
    parts: int = 3        # second-level parts of a partition, more than `away`
    finer: int = 3        # fingerprints by each part that could differ

    def bounds(self, most: int = 1 << 40) -> list[int]:
        """The smallest size of each band."""
        out = [1]
        while out[-1] < most:
            out.append(max(out[-1] + 1, math.ceil(out[-1] * self.band)))
        return out

    def differ(self, both: int) -> int:
        """In how many features two linked sets of `both` features together may differ."""
        return (100 - self.percent) * both // (100 + self.percent)

    def instances(self, size: int, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(band, first-level partitions, those of them needed) under which a set of this
        size can meet a partner: its own band and those above that hold larger partners."""
        b = int(np.searchsorted(bounds, size, side="right")) - 1
        while 100 * size >= self.percent * int(bounds[b]):
            top = int(bounds[b + 1]) - 1
            partner = min(top, 100 * size // self.percent)
            # With any partner, the first `need` partitions leave too few differences for all.
            need = self.differ(size + partner) // (self.away + 1) + 1
            yield b, self.differ(2 * top) // (self.away + 1) + 1, need
            b += 1

    def signatures(self, features: np.ndarray, band: int, cells: int, need: int) -> np.ndarray:
        at = (mix(features + np.uint64(0x51ED270B)) >> np.uint64(16)) % np.uint64(cells * self.parts)
        total = np.zeros(cells * self.parts, np.uint64)
        np.add.at(total, at.astype(np.int64), mix(features))
        total = total.reshape(cells, self.parts)[:need]
        out = []
        for i, subset in enumerate(combinations(range(self.parts), self.parts - self.away)):
            hashed = mix(np.arange(len(total), dtype=np.uint64)
                         + np.uint64((band * 1009 + i) << 32))
            for part in subset:
                hashed = mix(hashed + total[:, part])
            out.append(hashed)
        return np.concatenate(out)

    def fingerprint(self, features: np.ndarray, cells: int) -> np.ndarray:
        """A byte of each finer part; parts with different bytes differ in a feature at least."""
        n = self.finer * cells * (self.away + 1)
        at = (mix(features + np.uint64(0x7F4A7C15)) >> np.uint64(16)) % np.uint64(n)
        total = np.zeros(n, np.uint64)
        np.add.at(total, at.astype(np.int64), mix(features))
        return (total >> np.uint64(56)).astype(np.uint8)


BLOCK_FEATURES = 1 << 20  # of a group compared in one go, about


def _binary(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def _shingled(size: int, sampled: float | None):
    """(id, a, b, text) batches to (id, a, b, n, x, y), x and y being the set's digest, or
    text batches to (x, features), a sample of the domain."""
    limit = np.uint64(min(int((sampled or 0) * 2 ** 64), 2 ** 64 - 1))

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, marks = [], []
            for found in shingle_sets(batch.column(batch.num_columns - 1), size):
                marks.append(set_digest(found))
                sets.append(len(found) if sampled is None else found[mix(found + np.uint64(1)) < limit])
            x, y = np.frombuffer(b"".join(marks), np.int64).reshape(-1, 2).T
            if sampled is None:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(sets, pa.int64()), pa.array(x), pa.array(y)],
                    ["id", "a", "b", "n", "x", "y"])
                continue
            at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x), pa.ListArray.from_arrays(at, pa.array(flat.view(np.int64)))],
                ["x", "features"])

    return run


def _arrays(size: int):
    """(id, text) batches to (id, n, set), without empty sets."""
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            kept = [(i, s) for i, s in zip(ids, shingle_sets(batch.column(1), size)) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in kept], pa.int64()),
                 pa.array([len(s) for _, s in kept], pa.int64()),
                 _binary([s for _, s in kept])], ["id", "n", "set"])

    return run


def _signed(plan: PartEnum, marks: bool):
    """(id, n, set) batches to (id, band, signatures), or (id, band, n, fingerprint)."""
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        bounds = np.array(plan.bounds())
        for batch in batches:
            ids, bands, sizes, out = [], [], [], []
            for i, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                features = np.frombuffer(blob, np.uint64)
                for band, cells, need in plan.instances(len(features), bounds):
                    ids.append(i)
                    bands.append(band)
                    sizes.append(len(features))
                    out.append(plan.fingerprint(features, cells) if marks
                               else plan.signatures(features, band, cells, need))
            head = [pa.array(ids, pa.int64()), pa.array(bands, pa.int32())]
            if marks:
                yield pa.RecordBatch.from_arrays(
                    [*head, pa.array(sizes, pa.int64()), _binary(out)], ["id", "band", "n", "mark"])
            else:
                at = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
                flat = np.concatenate(out) if out else np.empty(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [*head, pa.ListArray.from_arrays(at, pa.array(flat.view(np.int64)))],
                    ["id", "band", "signatures"])

    return run


def _runs(batches: Batches, keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal first `keys` columns, across batches, as (key, rows)."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def _merge(labels: np.ndarray, a: int, others: np.ndarray) -> np.ndarray:
    """Gives `a` and `others` one label; those of `others` that were still apart."""
    found, at = np.unique(labels[others], return_index=True)
    apart = found != labels[a]
    if apart.any():
        merged = np.append(found[apart], labels[a])
        labels[np.isin(labels, merged)] = merged.min()
    return others[at[apart]]


def _near(plan: PartEnum):
    """(group, band, i, j, block, id, n, mark) in order of the unit to (a, b): enough pairs
    to join the members of a unit that may be linked. A unit of two blocks compares across
    them only."""
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for (_, _, i, j), rows in _runs(batches, 4):
            ids = np.array([r[1] for r in rows])
            sides = np.array([r[0] for r in rows])
            sizes = np.array([r[2] for r in rows])
            marks = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), -1)
            labels = np.arange(len(rows))
            for a in range(len(rows) - 1):
                both = sizes[a] + sizes[a + 1:]
                small = np.minimum(sizes[a], sizes[a + 1:])
                fits = 100 * small >= plan.percent * (both - small)
                if i != j:
                    fits &= sides[a] != sides[a + 1:]
                at = np.flatnonzero(fits)
                apart = np.count_nonzero(marks[a + 1 + at] != marks[a], axis=1)
                most = (100 - plan.percent) * both[at] // (100 + plan.percent)
                found += [(ids[a], ids[b]) for b in _merge(labels, a, a + 1 + at[apart <= most])]
            if len(found) > 50_000:
                yield _pairs(found)
                found = []
        yield _pairs(found)

    return run


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = np.array(found, np.int64).reshape(-1, 2).T
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


DENSE_CELLS = 1 << 24  # sets x shared features up to which a matrix is multiplied


def linked_pairs(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each set a, all b > a with 100 * intersection >= percent * union.

    Only features that two sets share are counted: as a product of matrices where that
    is small, else along the list of sets that have each feature."""
    count = len(sets)
    sizes = np.array([len(s) for s in sets])
    codes, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    owners = np.repeat(np.arange(count), sizes)
    shared = times[codes] > 1
    owners, codes = owners[shared], (np.cumsum(times > 1) - 1)[codes[shared]]
    features = int((times > 1).sum())
    dense = count * features <= DENSE_CELLS
    if dense:
        matrix = np.zeros((count, features), np.float32)
        matrix[owners, codes] = 1
    else:
        order = np.argsort(codes, kind="stable")
        holders, starts = owners[order], np.searchsorted(codes[order], np.arange(features + 1))
        first = np.searchsorted(owners, np.arange(count + 1))
    for a in range(count - 1):
        if dense:
            common = (matrix[a + 1:] @ matrix[a]).astype(np.int64)
        else:
            own = codes[first[a]:first[a + 1]]
            long = starts[own + 1] - starts[own]
            at = np.repeat(starts[own] - np.cumsum(long) + long, long) + np.arange(long.sum())
            common = np.bincount(holders[at], minlength=count)[a + 1:]
        either = sizes[a] + sizes[a + 1:] - common
        yield a, a + 1 + np.flatnonzero(100 * common >= percent * either)


def _links(percent: int):
    """(cluster, i, j, id, set) in order of the unit to (a, b): links that join all linked sets."""
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, 3):
            ids = np.array([r[0] for r in rows])
            labels = np.arange(len(rows))
            yield _pairs([(ids[a], ids[b])
                          for a, others in linked_pairs([np.frombuffer(r[1], np.uint64) for r in rows], percent)
                          for b in _merge(labels, a, others)])

    return run


def _units(rows: DataFrame, key: list[str], features: Column) -> DataFrame:
    """`rows` in units of about BLOCK_FEATURES: one (i = j) for a small key; for a large one
    its members are dealt to blocks by hash, and each pair of blocks is a unit."""
    blocks = F.greatest(F.least(F.ceil(features / F.lit(BLOCK_FEATURES)), F.col("members")), F.lit(1)).cast("int")
    return (rows.withColumn("blocks", blocks)
            .withColumn("block", F.pmod(F.xxhash64(F.lit(3), "id"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(*key, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "block", "id"))


def links(texts: DataFrame, classes: DataFrame, size: int, percent: int,
          plan: PartEnum | None = None) -> DataFrame:
    """(a, b): enough links between classes to join every two that are linked.

    `texts` has text and a row's digest a, b; `classes` has class, n, x, y and the digest
    `row` of one of its rows, one row for each different set."""
    plan = plan or PartEnum(percent)
    # Step 2. A partner shares `percent` % of a set, so a set may have 100 - percent % of its
    # own; a quarter more of the domain than that is counted. Holders are told apart by half
    # of their digest; classes that share that half stay, whatever was counted.
    part = min(1.0, 1.25 * (100 - percent) / 100 + 0.025)
    own = (texts.select("text").mapInArrow(_shingled(size, part), "x long, features array<long>")
           .select("x", F.explode("features").alias("feature"))
           .groupBy("feature").agg(F.min("x").alias("x"), F.max("x").alias("last"))
           .where("x = last").groupBy("x").agg(F.count(F.lit(1)).alias("own")))
    halves = classes.where("n > 0").withColumn("same", F.count(F.lit(1)).over(Window.partitionBy("x")))
    able = stored(halves.join(own, "x", "left").where(
        (100 * F.coalesce("own", F.lit(0)) <= (100 - percent) * F.col("n")) | (F.col("same") > 1))
        .select(F.col("class").alias("id"), "row.a", "row.b"))
    # Joined by a shuffle at every size, as the rows of a large corpus need it; repeated rows
    # become one before it.
    sets = stored(texts.select("a", "b", "text").dropDuplicates(["a", "b"])
                  .join(able.hint("merge"), ["a", "b"]).select("id", "text")
                  .mapInArrow(_arrays(size), "id long, n long, set binary"))

    # Step 3.
    signed = (sets.mapInArrow(_signed(plan, False), "id long, band int, signatures array<long>")
              .select("id", "band", F.explode("signatures").alias("signature")))
    shared = signed.groupBy("signature").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = stored(signed.join(shared, "signature"))
    groups = (met.groupBy("signature", "band", "members")
              .agg(F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("x"),
                   F.bit_xor(F.xxhash64(F.lit(2), "id")).alias("y"))
              .groupBy("band", "members", "x", "y").agg(F.min("signature").alias("signature")))
    marks = sets.mapInArrow(_signed(plan, True), "id long, band int, n long, mark binary")
    tops = F.array(*[F.lit(b) for b in plan.bounds()])
    key = ["signature", "band"]
    units = _units(met.join(groups.select(*key), key), key,
                   F.col("members") * F.get(tops, F.col("band") + 1))

    # Step 4.
    near = components(units.join(marks, ["id", "band"])
                      .select(*key, "i", "j", "block", "id", "n", "mark")
                      .repartition(*key, "i", "j").sortWithinPartitions(*key, "i", "j")
                      .mapInArrow(_near(plan), "a long, b long"))

    # Step 5.
    clusters = stored(near.join(sets.select("id", "n"), near["node"] == sets["id"])
                      .select(F.col("component").alias("cluster"), "id", "n"))
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("features"))
    whole = _units(clusters.join(sizes, "cluster"), ["cluster"], F.col("features"))
    return (whole.join(sets.select("id", "set"), "id")
            .select("cluster", "i", "j", "id", "set")
            .repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
            .mapInArrow(_links(percent), "a long, b long"))


def _tables(docs: DataFrame, size: int, id_col: str, text: str, row: Column) -> tuple[DataFrame, DataFrame]:
    """(id, a, b, text) of each row, `row` being the digest a, b; and (id, a, b, n, x, y),
    stored, equal x, y standing for equal sets."""
    texts = docs.select(col(id_col).cast("bigint").alias("id"), row.alias("row"), text_of(text).alias("text")).select(
        "id", "row.a", "row.b", "text")
    table = texts.mapInArrow(_shingled(size, None), "id long, a long, b long, n long, x long, y long")
    # Texts without words are alike under one id only, without an id as whole rows.
    own = digest(F.col("id"), *[F.when(F.col("id").isNull(), F.col(c)) for c in "ab"])
    return texts, stored(table.withColumn("own", own).select(
        "id", "a", "b", "n", *[F.when(F.col("n") > 0, F.col(x)).otherwise(F.col("own")[o]).alias(x)
                               for x, o in zip("xy", "ab")]))


def _classes(table: DataFrame) -> DataFrame:
    """(x, y, n, row, class) of each different set: the digest of its first row, by id, and a
    number. The numbers follow no order, but are stored and so don't change."""
    row = F.struct(F.col("id").isNull().alias("nameless"), "id", "a", "b")
    return stored(table.groupBy("x", "y", "n").agg(F.min(row).alias("row"))
                  .withColumn("class", F.monotonically_increasing_id()))


def _same_id(table: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): the classes of each id that has several, with the first of them."""
    several = (table.where("id IS NOT NULL").groupBy("id")
               .agg(*[f(x).alias(f"{f.__name__}_{x}") for x in "xy" for f in (F.min, F.max)])
               .where("min_x <> max_x OR min_y <> max_y").select("id"))
    held = stored(table.join(several, "id").select("id", "x", "y").distinct()
                  .join(classes, ["x", "y"]).select("id", F.col("class").alias("a")))
    return held.join(held.groupBy("id").agg(F.min("a").alias("b")), "id").select("a", "b")


def _reached(texts: DataFrame, table: DataFrame, size: int, percent: int) -> DataFrame:
    """The classes of `table` with `component`, a number for all that links reach."""
    classes = _classes(table)
    found = components(links(texts, classes, size, percent).union(_same_id(table, classes)))
    return stored(classes.join(found, classes["class"] == found["node"], "left")
                  .select("x", "y", "row", F.coalesce("component", "class").alias("component")))


def jaccard_components(docs: DataFrame, size: int = 5, percent: int = 80,
                       id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id (the smallest id that
    links reach), class_id (the smallest id with an equal set)."""
    texts, table = _tables(docs, size, id_col, text, digest(col(id_col).cast("bigint"), text_of(text)))
    reached = _reached(texts.where("id IS NOT NULL"), table.where("id IS NOT NULL"), size, percent)
    names = reached.groupBy("component").agg(F.min("row.id").alias("name"))
    named = reached.join(names, "component").select(
        "x", "y", F.col("row.id").alias("class_id"), F.col("name").alias("component_id"))
    return table.join(named, ["x", "y"], "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
        F.when(F.col("id").isNotNull(), F.col("class_id")).alias("class_id"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80,
             id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near duplicates in `docs`: that of the smallest id, then of
    the smallest digest of the whole row; rows with an id go before those without.

    Rows that share an id are one document, so one stays. Rows without an id are linked by
    their texts like others; those without words as well stay, one of each repeated row."""
    row = row_digest(docs)
    texts, table = _tables(docs, size, id_col, text, row)
    first = (_reached(texts, table, size, percent).groupBy("component").agg(F.min("row").alias("row"))
             .select("row.a", "row.b"))
    rows = docs.select(row.alias("_row"), whole_rows(docs).alias("row")).select("_row.a", "_row.b", "row")
    return (rows.dropDuplicates(["a", "b"]).join(stored(first).hint("merge"), ["a", "b"], "left_semi")
            .select("row.*"))
