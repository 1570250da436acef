"""Embedding near-dedup: all vectors of one label whose cosine reaches a threshold, by cover trees.

Method: vectors are compared on the unit sphere, where a cosine of c is a distance of
sqrt(2 - 2c). A cover tree over a block of vectors has nested levels with halving radii: the
children of a node are a net of its members, none within the level's radius of another, each
with a covering radius, the distance to its furthest member. Two trees (or one with itself)
are traversed together from their roots. A pair of nodes goes when their centres are further
apart than both covering radii and the threshold's distance; it is linked as a whole when they
are that much nearer; else its children are paired. Both bounds are exact, so are the links.

Steps, none of which forms the pairs of a group as rows:
1. Vectors that are equal under one label become one class, weighted by its number of ids.
2. A label's classes are dealt to cells by their nearest of up to PIVOTS pivots, a sample
   chosen by hash, and cells to blocks of about `cell` classes. Labels of up to `cell` classes
   are one block.
3. Pairs of blocks whose covering radii let them meet are units; a task holds one unit at a
   time, builds both trees and gives each class's weight of links, and links that join what
   the unit joins (at most one for each class).
4. Weights are summed; components by large and small stars.

Work: what the radii prune isn't compared. Vectors without any structure (all far from each
other in many dimensions) have no prunable nodes above the lowest level, so blocks of one label
are then compared in full: the work grows with the square of a label's classes, in units of
bounded size.

Cases: a vector that is null, empty, zero or holds a null or non-finite component links with
nothing, nor does one with a null label; vectors of different lengths aren't compared. Labels
are compared as texts. Rows without an id come back with no links and no component. Rows that
share an id and a vector count once; under one id, different vectors have links of their own
but one component. Repeated rows come back as often as they went in. An empty table gives an
empty result. Only the id, label and vector columns are used.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from flowlab.functions.columns import col
from flowlab.llm.common import stored
from flowlab.llm.components import components

Batches = Iterable[pa.RecordBatch]

PIVOTS = 256          # of a label, at most
CELL = 8192           # classes of a block, about
LEAF = 16             # members up to which a node isn't cut further
SLACK = 1e-7          # of distances: what rounding may shift them
ROWS = 512            # of a matrix of distances held at once


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


# ------------------------------------------------------------------ the tree


class Node:
    """`members` are rows of the block, `centre` one of them, `radius` the distance to the
    furthest; a leaf has no `children`."""

    def __init__(self, centre: int, radius: float, members: np.ndarray):
        self.centre, self.radius, self.members = centre, radius, members
        self.children: list[Node] = []
        self._below: tuple[Nodes, Nodes] | None = None

    def below(self) -> tuple[Nodes, Nodes]:
        """The children (a leaf itself) of a single row, and the others."""
        if self._below is None:
            nodes = self.children or [self]
            self._below = (Nodes([n for n in nodes if len(n.members) == 1]),
                           Nodes([n for n in nodes if len(n.members) > 1]))
        return self._below


class Nodes:
    """Nodes with their centres and radii as arrays."""

    def __init__(self, nodes: list[Node]):
        self.nodes = nodes
        self.centres = np.array([n.centre for n in nodes], np.int64)
        self.radii = np.array([n.radius for n in nodes], np.float64)


def net(x: np.ndarray, members: np.ndarray, radius: float) -> list[tuple[int, np.ndarray, float]]:
    """(centre, its members, covering radius): centres further than `radius` apart, each
    member with the first centre that covers it."""
    out = []
    left = members
    while len(left):
        tried = left[:ROWS // 2]
        near = distances(x[tried], x[tried]) <= radius
        covered = np.zeros(len(tried), bool)
        chosen = []
        for i in range(len(tried)):
            if not covered[i]:
                chosen.append(i)
                covered |= near[i]
        centres = tried[chosen]
        apart = distances(x[centres], x[left])
        covers = apart <= radius
        first = np.where(covers.any(axis=0), covers.argmax(axis=0), -1)
        order = np.argsort(first, kind="stable")
        bounds = np.searchsorted(first[order], np.arange(len(centres) + 1))
        for i, centre in enumerate(centres):
            own = order[bounds[i]:bounds[i + 1]]
            if len(own):
                out.append((int(centre), left[own], float(apart[i, own].max())))
        left = left[np.sort(order[:bounds[0]])]
    return out


def cover_tree(x: np.ndarray) -> Node:
    """The tree of the rows of `x`, unit vectors; levels halve from the sphere's diameter."""
    every = np.arange(len(x))
    root = Node(0, float(distances(x[:1], x).max()), every)
    open_nodes = [(root, 2.0)]
    while open_nodes:
        node, level = open_nodes.pop()
        while len(node.members) > LEAF and level > SLACK:
            level /= 2
            if level >= node.radius:
                continue  # a single child, the node again
            node.children = [Node(c, r, m) for c, m, r in net(x, node.members, level)]
            open_nodes += [(c, level) for c in node.children if len(c.members) > LEAF]
            break
    return root


class Found:
    """Weights of links and joined labels of the rows of a unit."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.linked = np.zeros(len(weights), np.int64)
        self.parent = np.arange(len(weights))

    def top(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return int(i)

    def join(self, a: int, others: np.ndarray) -> None:
        """One label for `a` and all of the others."""
        a = self.top(a)
        for j in others[self.parent[others] != a]:
            j = self.top(int(j))
            self.parent[max(a, j)] = a = min(a, j)
        self.parent[others] = a

    def add(self, a: np.ndarray, b: np.ndarray, near: np.ndarray) -> None:
        """Rows `a` and other rows `b` linked where `near` holds."""
        self.linked[a] += near @ self.weights[b]
        self.linked[b] += self.weights[a] @ near
        for i in np.flatnonzero(near.any(axis=1)):
            self.join(int(a[i]), b[near[i]])

    def add_within(self, a: np.ndarray, near: np.ndarray) -> None:
        """Rows `a` linked among themselves where the symmetric `near` holds."""
        self.linked[a] += near @ self.weights[a]
        for i in np.flatnonzero(near.any(axis=1)):
            self.join(int(a[i]), a[near[i]])

    def add_all(self, a: np.ndarray, b: np.ndarray) -> None:
        """All rows of `a` linked with all of the others in `b`."""
        self.linked[a] += self.weights[b].sum()
        self.linked[b] += self.weights[a].sum()
        self.join(int(a[0]), b)
        self.join(int(b[0]), a)

    def add_all_within(self, a: np.ndarray) -> None:
        self.linked[a] += self.weights[a].sum() - self.weights[a]
        self.join(int(a[0]), a)


def traverse(x: np.ndarray, first: Node, second: Node | None, cosine: float, found: Found) -> None:
    """Adds the links between the members of two trees over rows of `x`, or within one."""
    reach = math.sqrt(2.0 - 2.0 * cosine)

    def compare(p: Node, q: Node) -> None:
        for at in range(0, len(p.members), ROWS):
            rows = p.members[at:at + ROWS]
            found.add(rows, q.members, x[rows] @ x[q.members].T >= cosine)

    def singles(a: np.ndarray, b: np.ndarray, same: bool) -> None:
        """Links between nodes of a single row each."""
        for at in range(0, len(a), ROWS):
            rows, rest = a[at:at + ROWS], b[at:] if same else b
            near = x[rows] @ x[rest].T >= cosine
            if same:
                near = np.triu(near, 1)
            some = near.any(axis=1)
            if some.any():
                found.add(rows[some], rest, near[some])

    def undecided(ps: Nodes, qs: Nodes, same: bool) -> list[tuple[Node, Node]]:
        """The pairs of nodes that the radii don't decide."""
        left = []
        for at in range(0, len(ps.nodes), ROWS):
            cut = slice(at, at + ROWS)
            apart = distances(x[ps.centres[cut]], x[qs.centres])
            reached = ps.radii[cut, None] + qs.radii[None, :]
            for i, j in zip(*np.nonzero(apart <= reached + reach + SLACK)):
                p, q = ps.nodes[at + i], qs.nodes[j]
                if same and at + i >= j:
                    continue
                if apart[i, j] + reached[i, j] + SLACK <= reach:
                    found.add_all(p.members, q.members)
                else:
                    left.append((p, q))
        return left

    def pair_up(p: Node, q: Node) -> list[tuple[Node, Node]]:
        same = p is q
        (p1, pn), (q1, qn) = p.below(), q.below()
        singles(p1.centres, q1.centres, same)
        left = undecided(pn, qn, same) + undecided(p1, qn, False)
        return left if same else left + undecided(pn, q1, False)

    pairs = [(first, second)] if second is not None else []
    alone = [first] if second is None else []
    while pairs or alone:
        if alone:
            p = alone.pop()
            if 2 * p.radius + SLACK <= reach:
                found.add_all_within(p.members)
            elif not p.children:
                for at in range(0, len(p.members), ROWS):
                    rows, rest = p.members[at:at + ROWS], p.members[at + ROWS:]
                    near = x[rows] @ x[rows].T >= cosine
                    np.fill_diagonal(near, False)
                    found.add_within(rows, near)
                    if len(rest):
                        found.add(rows, rest, x[rows] @ x[rest].T >= cosine)
            else:
                alone += [c for c in p.children if len(c.members) > 1]
                pairs += pair_up(p, p)
            continue
        p, q = pairs.pop()
        if p.children or q.children:
            pairs += pair_up(p, q)
        else:
            compare(p, q)


# ------------------------------------------------------------------ in tasks


def _unit_vectors(batches: Batches) -> Iterator[pa.RecordBatch]:
    """(a, b, label, vector) to (a, b, kind, vector): unit vectors as bytes, `kind` being label
    and length. Rows that link with nothing go."""
    for batch in batches:
        kept = [[], [], [], []]
        for a, b, label, vector in zip(*(c.to_pylist() if i < 3 else c for i, c in enumerate(batch.columns))):
            values = vector.values
            if values is None or not len(values) or values.null_count:
                continue
            x = values.to_numpy(zero_copy_only=False).astype(np.float64)
            largest = np.abs(x).max()
            if not np.isfinite(x).all() or not largest:
                continue
            x = x / largest
            for out, value in zip(kept, (a, b, f"{len(x)}:{label}", (x / math.sqrt(x @ x)).tobytes())):
                out.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept[0], pa.int64()), pa.array(kept[1], pa.int64()), pa.array(kept[2], pa.string()),
             pa.array(kept[3], pa.binary())], ["a", "b", "kind", "vector"])


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)


def _assign(rows: pa.Table, pivots: pa.Table) -> pa.Table:
    """Each row's nearest pivot (the first on a tie) and its distance."""
    pivots = pivots.sort_by("pivot")
    p, x = _matrix(pivots["vector"]), _matrix(rows["vector"]) if len(rows) else np.empty((0, 1))
    cells, apart = np.empty(len(x), np.int32), np.empty(len(x))
    for at in range(0, len(x), ROWS):
        d = distances(x[at:at + ROWS], p)
        cells[at:at + ROWS] = d.argmin(axis=1)
        apart[at:at + ROWS] = d.min(axis=1)
    numbers = pivots["pivot"].to_numpy()[cells] if len(x) else cells
    return pa.table({"kind": rows["kind"], "class": rows["class"], "n": rows["n"], "vector": rows["vector"],
                     "cell": pa.array(numbers, pa.int32()), "apart": pa.array(apart, pa.float64())})


def _units(batches: Batches) -> Iterator[tuple[str, list[tuple]]]:
    """Consecutive rows of one unit, across batches."""
    key, rows = None, []
    for batch in batches:
        for unit, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if unit != key:
                if rows:
                    yield key, rows
                key, rows = unit, []
            rows.append(row)
    if rows:
        yield key, rows


def _linked(cosine: float):
    """(unit, side, class, n, vector) in order of the unit to (a, b, linked): a class's weight of
    links in the unit (b null), and pairs of classes that join what the unit links."""
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for _, rows in _units(batches):
            sides = np.array([r[0] for r in rows])
            classes = np.array([r[1] for r in rows])
            found = Found(np.array([r[2] for r in rows], np.int64))
            x = np.frombuffer(b"".join(r[3] for r in rows), np.float64).reshape(len(rows), -1)
            other = np.flatnonzero(sides == 1)
            trees = [_shifted(cover_tree(x[at]), at) for at in (np.flatnonzero(sides == 0), other) if len(at)]
            if len(trees) == 2 or not len(other):
                traverse(x, trees[0], trees[1] if len(trees) == 2 else None, cosine, found)
            tops = np.array([found.top(i) for i in range(len(rows))])
            joined = np.flatnonzero(tops != np.arange(len(rows)))
            linked = np.flatnonzero(found.linked)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([classes[linked], classes[joined]])),
                 pa.array([None] * len(linked) + classes[tops[joined]].tolist(), pa.int64()),
                 pa.array(np.concatenate([found.linked[linked], np.zeros(len(joined), np.int64)]))],
                ["a", "b", "linked"])

    return run


def _shifted(root: Node, rows: np.ndarray) -> Node:
    """The tree with row numbers of the whole unit."""
    open_nodes = [root]
    while open_nodes:
        node = open_nodes.pop()
        node.centre, node.members = int(rows[node.centre]), rows[node.members]
        open_nodes += node.children
    return root


# ------------------------------------------------------------------ in Spark


def _dealt(classes: DataFrame, cell: int) -> tuple[DataFrame, DataFrame]:
    """(kind, cell, part, class, n, vector, apart), the blocks, stored; (kind, cell, centre)."""
    sizes = classes.groupBy("kind").agg(F.count(F.lit(1)).alias("size"))
    known = classes.join(stored(sizes), "kind")
    small = known.where(F.col("size") <= cell).select(
        "kind", "class", "n", "vector", F.lit(0).alias("cell"), F.lit(0.0).alias("apart"))
    big = stored(known.where(F.col("size") > cell))
    # Enough by their hashes that the wanted number is among them, and so a bounded window.
    wanted = F.least(F.lit(PIVOTS), F.ceil(2 * F.col("size") / cell))
    drawn = F.pmod(F.xxhash64(F.lit(11), "class"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    place = F.row_number().over(Window.partitionBy("kind").orderBy("drawn", "class"))
    pivots = stored(
        big.withColumn("drawn", drawn).where(F.col("drawn") < (4 * wanted + 64) / F.col("size"))
        .withColumn("pivot", place).where(F.col("pivot") <= wanted)
        .select("kind", F.col("pivot").cast("int").alias("pivot"), "vector", "size"))
    portions = F.ceil(F.col("size") / cell)
    rows = big.withColumn("portion", F.pmod(F.xxhash64(F.lit(12), "class"), portions))
    sent = pivots.withColumn("portion", F.explode(F.sequence(F.lit(0).cast("bigint"), portions - 1)))
    assigned = rows.select("kind", "portion", "class", "n", "vector").groupBy("kind", "portion").cogroup(
        sent.select("kind", "portion", "pivot", "vector").groupBy("kind", "portion")).applyInArrow(
        _assign, "kind string, class long, n long, vector binary, cell int, apart double")
    cells = stored(small.unionByName(assigned))
    blocks = cells.groupBy("kind", "cell").agg(F.ceil(F.count(F.lit(1)) / cell).alias("parts"))
    part = F.pmod(F.xxhash64(F.lit(13), "class"), F.col("parts")).cast("int")
    centres = pivots.select("kind", F.col("pivot").alias("cell"), F.col("vector").alias("centre"))
    return stored(cells.join(blocks, ["kind", "cell"]).withColumn("part", part).drop("parts")), centres


def _pairs(dealt: DataFrame, centres: DataFrame, cosine: float) -> DataFrame:
    """(unit, side, class, n, vector): each block with itself and each two that can meet."""
    reach = math.sqrt(2.0 - 2.0 * cosine) + SLACK

    @F.arrow_udf("double")
    def apart(p: pa.Array, q: pa.Array) -> pa.Array:
        """The distance of two centres; blocks without one (of an uncut label) aren't paired."""
        dots = [np.frombuffer(a) @ np.frombuffer(b) if a is not None and b is not None else 1.0
                for a, b in zip(p.to_pylist(), q.to_pylist())]
        return pa.array(np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.array(dots, np.float64))))

    block = F.concat_ws(":", F.col("cell"), F.col("part"))
    blocks = (dealt.groupBy("kind", "cell", "part").agg(F.max("apart").alias("radius"))
              .join(centres, ["kind", "cell"], "left").withColumn("block", block))
    a = blocks.select("kind", F.col("block").alias("i"), F.col("radius").alias("ri"), F.col("centre").alias("ci"))
    b = blocks.select("kind", F.col("block").alias("j"), F.col("radius").alias("rj"), F.col("centre").alias("cj"))
    meet = (a.join(b, "kind").where("i < j")
            .where((F.col("ci") == F.col("cj")) | (apart("ci", "cj") <= F.col("ri") + F.col("rj") + reach))
            .select("kind", "i", "j"))
    units = stored(meet.union(a.select("kind", "i", F.col("i").alias("j"))))
    sides = units.select("kind", F.col("i").alias("block"), "i", "j", F.lit(0).alias("side")).union(
        units.where("i <> j").select("kind", F.col("j").alias("block"), "i", "j", F.lit(1).alias("side")))
    return (dealt.withColumn("block", block).join(sides, ["kind", "block"])
            .select(F.concat_ws("/", "i", "j", "kind").alias("unit"), "side", "class", "n", "vector")
            .repartition("unit").sortWithinPartitions("unit"))


def near_vectors(rows: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector: str = "embedding",
                 label: str = "label", cell: int = CELL) -> DataFrame:
    """One row per row: vec_id, n_links (other vectors linked directly), component_id (the
    smallest id that links reach), kept (whether that is the row's own id)."""
    values = col(vector).cast("array<double>")
    read = rows.select(col(id_col).cast("bigint").alias("id"), col(label).cast("string").alias("label"),
                       values.alias("vector"))
    # Zeros of both signs are equal, and nulls among the values aren't zeros.
    even = F.transform("vector", lambda v: F.when(v == 0, 0.0).otherwise(v))
    marks = F.transform("vector", lambda v: v.isNull())
    base = read.select("id", "label", "vector", *[
        F.xxhash64(F.lit(seed), "label", even, marks).alias(name) for seed, name in ((1, "a"), (2, "b"))])
    usable = base.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    vectors = (usable.groupBy("a", "b").agg(F.first("label").alias("label"), F.first("vector").alias("vector"))
               .mapInArrow(_unit_vectors, "a long, b long, kind string, vector binary"))
    held = stored(usable.select("id", "a", "b").distinct())
    counts = held.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    # Numbered in no order, but stored and so always the same.
    classes = stored(vectors.join(counts, ["a", "b"]).withColumn("class", F.monotonically_increasing_id()))

    dealt, centres = _dealt(classes.select("kind", "class", "n", "vector"), cell)
    found = stored(_pairs(dealt, centres, cosine).mapInArrow(_linked(cosine), "a long, b long, linked long"))
    linked = found.where("b IS NULL").groupBy(F.col("a").alias("class")).agg(F.sum("linked").alias("linked"))

    numbers = classes.select("a", "b", "class")
    several = held.groupBy("id").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("id")
    shared = stored(held.join(several, "id").join(numbers, ["a", "b"]).select("id", "class"))
    same_id = shared.join(shared.groupBy("id").agg(F.min("class").alias("least")), "id").select("class", "least")
    reached = components(found.where("b IS NOT NULL").select("a", "b").union(same_id))
    known = stored(classes.drop("kind", "vector").join(reached, classes["class"] == reached["node"], "left")
                   .join(linked, "class", "left")
                   .select("a", "b", "n", "first", F.coalesce("linked", F.lit(0)).alias("linked"),
                           F.coalesce("component", "class").alias("component")))
    names = known.groupBy("component").agg(F.min("first").alias("name"))
    links = known.select("a", "b", (F.col("linked") + F.col("n") - 1).alias("links"))
    named = known.join(names, "component").select("a", "b", "name")
    by_id = held.join(named, ["a", "b"]).groupBy("id").agg(F.min("name").alias("name"))
    result = (base.where("id IS NOT NULL").select("id", "a", "b").join(links, ["a", "b"], "left")
              .join(by_id, "id", "left")
              .select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0).cast("bigint")).alias("n_links"),
                      F.coalesce("name", "id").alias("component_id")))
    nameless = base.where("id IS NULL").select(
        F.col("id").alias("vec_id"), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return result.union(nameless).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
