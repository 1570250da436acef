"""Joint multi-class gradient boosting: one softmax over all classes, a tree per class and round.

Rows are packed into blocks of binary columns: each feature's value as a code, its place among
candidate thresholds (midpoints of the values of a bounded sample), and the row's margins. A round
chooses each tree's thresholds by the hessians of the sample, and grows the trees of all classes
level by level: tasks add up gradients and hessians by (class, node, feature, bin), one row for each
class and feature is shuffled, and its best Newton gains come back. Leaf values are
-soft(G, l1) / (H + l2), and splits that gain less than `gamma` are taken back, from below.

Rows that are no more than one task's work are fitted in that task, by the same functions: a job for
each level would take longer than its sums.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, fields, replace

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasSeed,
    HasValidationIndicatorCol, HasWeightCol,
)
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
    MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from flowlab.functions.columns import col
from flowlab.functions.small import local_rows, use_checkpoints
from flowlab.operators.trees import Forest, Growth, Tree, Walk, reachable, regularised, softmax

Batches = Iterable[pa.RecordBatch]

LEAST_HESSIAN = 1e-6  # of a row of weight 1: keeps -g / h within bounds
CUT_ROUNDS = 20       # rounds after which margins are worked out anew from the rows and all trees
BLOCK_ROWS = 1 << 13  # rows of a block, fewer where they are wide: Spark's streams keep hold of a hundred blocks
BLOCK_VALUES = 1 << 17
JOINED_ROWS = 1 << 16  # rows worked on together, fewer where they are wide
JOINED_VALUES = 1 << 20
KEPT_BYTES = 1 << 26   # of the rows' state in a partition, about: a stream of it is held by a task
ALONE_VALUES = 1 << 22  # feature values times classes up to which one task fits them
TASK_VALUES = 1 << 21  # of them that a task reads, at least
SAMPLE_VALUES = 1 << 24  # feature values of the sample that thresholds come from, at most
SAMPLE_ROUND = 1 << 20  # a round's number of its own for drawing the sample
CANDIDATES = 1 << 16   # of a feature, where the sample isn't the whole table
CELLS = 1 << 23        # sums that a task holds at once
NOISE = 1e-12          # of a node's score: a gain below that share is rounding

BLOCK = "start long, count int, width int, top int, open long, x binary, label binary, weight binary, held binary"
CODED = "start long, count int, codes binary, label binary, weight binary, held binary"
STATE = f"{CODED}, margins binary, loss double, watched long"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(rows: np.ndarray) -> pa.Array:
    at = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(at, pa.array(np.ascontiguousarray(rows).reshape(-1)))


def gradients(share, own, weight):
    """Of the softmax loss by one class's margin: gradient, and an upper bound of its hessian."""
    return weight * (share - own), weight * np.maximum(2.0 * share * (1.0 - share), LEAST_HESSIAN)


def draws(rows: np.ndarray, round_: int, k: int, seed: int, share: float) -> np.ndarray:
    """(k, rows): whether a row is among those of each class's tree, by a hash of its number."""
    if share >= 1:
        return np.ones((k, len(rows)), bool)
    keys = np.array([(seed * 1_000_003 + round_) * 1_000_003 + c for c in range(k)], np.int64).view(np.uint64)
    base, out = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.empty((k, len(rows)), bool)
    for c, key in enumerate(keys * np.uint64(0xD1B54A32D192ED03)):
        x = base ^ key
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x ^= x >> np.uint64(shift)
            x *= np.uint64(factor)
        x ^= x >> np.uint64(31)
        np.less(x, np.uint64(int(share * 2 ** 64)), out=out[c])
    return out


# ---------------------------------------------------------------- blocks of rows

def _records(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, schema)],
                                      [n for n, _ in schema])


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}


def _fields(ddl: str) -> list[tuple[str, pa.DataType]]:
    return [(name, _ARROW[kind]) for name, kind in (f.split() for f in ddl.split(", "))]


def _packed(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Blocks from rows (row, x, label, weight, held), whose numbers follow one another."""
    kept: list[tuple] = []
    size = 0

    def block() -> pa.RecordBatch:
        x, label, weight, held = (np.concatenate(c) for c in zip(*[k[1:] for k in kept]))
        return _records([(int(kept[0][0]), len(x), x.shape[1], int(label.max()), int((~held & (weight > 0)).sum()),
                          x.tobytes(), label.tobytes(), weight.tobytes(), held.tobytes())], _fields(BLOCK))

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        row, x, label, weight, held = batch.columns
        if x.null_count or label.null_count:
            raise ValueError("a row to train on lacks its features or its label")
        widths = np.unique(np.diff(x.offsets.to_numpy()))
        if len(widths) > 1 or (kept and kept[0][1].shape[1] != widths[0]):
            raise ValueError("rows to train on have different numbers of features")
        values = _matrix(x, int(widths[0]))
        if not np.isfinite(values).all():
            raise ValueError("features to train on must not be NaN or infinite")
        columns = (values, label.to_numpy().astype(np.int32), weight.to_numpy(zero_copy_only=False).astype(np.float64),
                   held.to_numpy(zero_copy_only=False))
        most = min(BLOCK_ROWS, max(1, BLOCK_VALUES // max(1, int(widths[0]))))
        at = 0
        while at < n:
            upto = min(n, at + most - size)
            kept.append((row[at].as_py(), *(c[at:upto] for c in columns)))
            size, at = size + upto - at, upto
            if size == most:
                yield block()
                kept, size = [], 0
    if kept:
        yield block()


def _each(batches: Batches) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: c[i].as_py() for name, c in zip(batch.schema.names, batch.columns)}


def _unpacked(block: dict) -> tuple[np.ndarray, ...]:
    """Row numbers, labels, weights, and whether a row is held."""
    return (block["start"] + np.arange(block["count"], dtype=np.int64), np.frombuffer(block["label"], np.int32),
            np.frombuffer(block["weight"], np.float64), np.frombuffer(block["held"], bool))


def _sampled(share: float, seed: int):
    """Rows drawn by their numbers, all of them (held ones too) at a share of 1."""
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for block in _each(batches):
            rows, label, weight, held = _unpacked(block)
            at = np.arange(len(rows))
            if share < 1:
                at = np.flatnonzero(draws(rows, SAMPLE_ROUND, 1, seed, share)[0] & ~held & (weight > 0))
            x = np.frombuffer(block["x"], np.float64).reshape(len(rows), -1)
            yield _records([tuple(v[at].tobytes() for v in (rows, x, label, weight, held))],
                           [(n, pa.binary()) for n in ("row", "x", "label", "weight", "held")])

    return run


@dataclass
class Rows:
    """Rows side by side, with their margins."""

    rows: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    held: np.ndarray
    codes: np.ndarray           # (width, rows)
    margins: np.ndarray         # (classes, rows)

    @property
    def open(self) -> np.ndarray:
        return ~self.held & (self.weight > 0)

    def drawn(self, round_: int, seed: int, share: float) -> np.ndarray:
        """(classes, rows): the open rows that each class's tree sees."""
        return draws(self.rows, round_, len(self.margins), seed, share) & self.open

    def loss(self) -> tuple[float | None, int]:
        """Summed over the held rows, and their number."""
        n = int(self.held.sum())
        if not n:
            return None, 0
        own = softmax(self.margins[:, self.held], 0)[self.label[self.held], np.arange(n)]
        return float(-np.log(np.maximum(own, 1e-15)).sum()), n


@dataclass
class Sample(Rows):
    """Rows that thresholds come from; `whole` if they are the table."""

    values: list[np.ndarray]    # of each feature: the distinct ones, ascending
    middles: list[np.ndarray]   # between each two of them: the candidate thresholds
    whole: bool

    @classmethod
    def of(cls, table: pa.Table, width: int, k: int, whole: bool) -> "Sample":
        def joined(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(table[name].to_pylist()), kind)

        rows = joined("row", np.int64)
        order = np.argsort(rows)
        x = joined("x", np.float64).reshape(len(rows), width)[order]
        values = [np.unique(x[:, f]) for f in range(width)]
        if not whole:
            values = [v if len(v) <= CANDIDATES else v[np.linspace(0, len(v) - 1, CANDIDATES).astype(np.int64)]
                      for v in values]
        middles = [(v[:-1] + v[1:]) / 2.0 for v in values]
        return cls(rows[order], joined("label", np.int32)[order], joined("weight", np.float64)[order],
                   joined("held", bool)[order], coded(x, middles), np.zeros((k, len(rows))), values, middles, whole)

    def cuts(self, c: int, columns: list[int], share: np.ndarray, drawn: np.ndarray, bins: int) -> list:
        """For one class's tree, the cuts of each of its columns: (the codes up to which rows go
        left, thresholds), both ascending. `share` and `drawn` are the class's."""
        g, h = gradients(share, self.label == c, self.weight)
        at = np.flatnonzero(drawn)
        out = []
        for f in columns:
            there = np.bincount(self.codes[f][at], minlength=len(self.values[f])) > 0
            sums = np.bincount(self.codes[f][at], h[at], len(self.values[f]))
            thresholds = quantiles(self.values[f][there], sums[there], min(bins, len(at)) - 1)
            if self.whole:
                codes = np.searchsorted(self.values[f], thresholds, "right") - 1
            else:  # other rows have values between those of the sample
                codes = np.unique(np.searchsorted(self.middles[f], thresholds, "left"))
                codes = codes[codes < len(self.middles[f])]
                thresholds = self.middles[f][codes]
            out.append((codes, thresholds))
        return out


def coded(x: np.ndarray, middles: list[np.ndarray]) -> np.ndarray:
    """(width, rows): how many candidate thresholds each value is above."""
    most = max(map(len, middles), default=0)
    kind = np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32
    out = np.empty((len(middles), len(x)), kind)
    for f, m in enumerate(middles):
        out[f] = np.searchsorted(m, x[:, f], "left")
    return out


def quantiles(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """At most `most` thresholds, midway between values, that part their weight evenly."""
    if len(values) - 1 <= most:
        return (values[:-1] + values[1:]) / 2.0
    upto = np.cumsum(weights)
    stride = upto[-1] / (most + 1)
    middle, out, i, target = upto[:-1] + upto[1:], [], 1, stride
    while True:
        # The first value that takes the running weight further off its target than it was.
        i = max(i, int(np.searchsorted(middle, 2 * target * (1 - 1e-12), "left")))
        while i < len(upto) and not abs(upto[i - 1] - target) < abs(upto[i] - target):
            i += 1
        if i >= len(upto):
            return np.array(out)
        out.append((values[i - 1] + values[i]) / 2.0)
        i, target = i + 1, target + stride


# ---------------------------------------------------------------- passes over the rows

def _coded(middles: list[np.ndarray]):
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for block in _each(batches):
            x = np.frombuffer(block["x"], np.float64).reshape(block["count"], -1)
            yield _records([(block["start"], block["count"], coded(x, middles).tobytes(), block["label"],
                             block["weight"], block["held"])], _fields(CODED))

    return run


def _codes(block: dict, width: int) -> np.ndarray:
    n = block["count"]
    size = len(block["codes"]) // (n * width) if width else 1
    return np.frombuffer(block["codes"], f"u{size}").reshape(width, n)


def _joined(batches: Batches, width: int, k: int) -> Iterator[tuple[list[dict], Rows]]:
    """Blocks side by side, as many as are worked on together; margins that they lack are zero."""
    def rows(blocks: list[dict]) -> Rows:
        own = [_unpacked(b) for b in blocks]
        margins = [np.frombuffer(b["margins"], np.float64).reshape(k, -1) if "margins" in b
                   else np.zeros((k, b["count"])) for b in blocks]
        return Rows(*(np.concatenate(c) for c in zip(*own)),
                    np.concatenate([_codes(b, width) for b in blocks], axis=1), np.concatenate(margins, axis=1))

    most = min(JOINED_ROWS, max(1, JOINED_VALUES // max(1, width)))
    kept, size = [], 0
    for block in _each(batches):
        if kept and size + block["count"] > most:
            yield kept, rows(kept)
            kept, size = [], 0
        kept.append(block)
        size += block["count"]
    if kept:
        yield kept, rows(kept)


def _advanced(rounds: list[list[Walk]], width: int, k: int):
    """The state of rows after more rounds' trees, with the loss of those held."""
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for blocks, rows in _joined(batches, width, k):
            advance(rows, rounds)
            start = 0
            for block in blocks:
                n = block["count"]
                mine = replace(rows, label=rows.label[start:start + n], held=rows.held[start:start + n],
                               margins=rows.margins[:, start:start + n])
                start += n
                yield _records([(*(block[name] for name, _ in _fields(CODED)), mine.margins.tobytes(), *mine.loss())],
                               _fields(STATE))

    return run


def advance(rows: Rows, rounds: list[list[Walk]]) -> None:
    for walks in rounds:
        for c, walk in enumerate(walks):
            walk.added(rows.margins[c], rows.codes)


@dataclass
class Unit:
    """One feature of one class's tree, at one level: the bin of each code."""

    tree: int
    feature: int           # -1: all rows in one bin
    bins: np.ndarray
    count: int


Active = dict[int, np.ndarray]  # of each tree that still grows, the nodes that may be split


def empty_sums(units: list[Unit], active: Active, counted: bool) -> list[np.ndarray]:
    return [np.zeros((2 + counted, len(active[u.tree]) * u.count)) for u in units]


def add_sums(sums: list[np.ndarray], rows: Rows, units: list[Unit], walks: list[Walk], active: Active,
             drawn: np.ndarray) -> None:
    """Adds, for each unit, by (node, bin): gradients, hessians, and rows where these are counted."""
    of_tree: dict[int, list[int]] = {}
    for i, unit in enumerate(units):
        of_tree.setdefault(unit.tree, []).append(i)
    shares = softmax(rows.margins, 0)
    for c, mine in of_tree.items():
        at = np.flatnonzero(drawn[c])
        slots = np.full(len(walks[c].child), -1, np.int64)
        slots[active[c]] = np.arange(len(active[c]))
        slot = slots.take(walks[c].ends(rows.codes, at))
        open_ = slot >= 0
        if not open_.all():
            at, slot = at[open_], slot[open_]
        g, h = gradients(shares[c].take(at), rows.label.take(at) == c, rows.weight.take(at))
        for i in mine:
            unit, total = units[i], sums[i]
            where = slot * unit.count
            if unit.feature >= 0:
                where += unit.bins.take(rows.codes[unit.feature].take(at))
            size = total.shape[1]
            total[0] += np.bincount(where, g, size)
            total[1] += np.bincount(where, h, size)
            if len(total) > 2:
                total[2] += np.bincount(where, minlength=size)


def _sums(units: list[Unit], walks: list[Walk], active: Active, width: int, k: int, round_: int, seed: int,
          share: float, counted: bool):
    """A task's sums for each unit."""
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        sums = empty_sums(units, active, counted)
        for _, rows in _joined(batches, width, k):
            add_sums(sums, rows, units, walks, active, rows.drawn(round_, seed, share))
        for i, s in enumerate(sums):
            yield _records([(i, s.tobytes())], [("unit", pa.int32()), ("sums", pa.binary())])

    return run


SPLITS = "unit int, slot int, bin int, gain double, score double, gl double, hl double, gr double, hr double"


def best_splits(total: np.ndarray, nodes: int, least: float, rows: int) -> tuple[np.ndarray, ...]:
    """Of one unit's sums: each node's bin of highest gain, with the columns of SPLITS that follow it."""
    total = total.reshape(2 + (rows > 1), nodes, -1)
    left = np.cumsum(total, axis=2)
    right = np.cumsum(total[:, :, ::-1], axis=2)[:, :, ::-1]
    whole, n = left[:, :, -1], total.shape[2]
    score = whole[0] ** 2 / np.where(whole[1] > 0, whole[1], 1.0)
    if n == 1:
        none = np.full(nodes, -np.inf)
        return np.zeros(nodes, int), none, score, whole[0], whole[1], 0 * whole[0], 0 * whole[1]
    left, right = left[:, :, :-1], right[:, :, 1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - score[:, None]
    fit = np.ones(gain.shape, bool)
    for side in (left, right):
        fit &= (side[1] > 0) & (side[1] >= least * (1 - 1e-12))
        if rows > 1:
            fit &= side[2] >= rows
    gain = np.where(fit, gain, -np.inf)
    best = gain.argmax(axis=1)
    at = np.arange(len(best))
    return (best, gain[at, best], score, left[0][at, best], left[1][at, best], right[0][at, best],
            right[1][at, best])


def _splits(nodes: list[int], least: float, rows: int):
    """Of one unit's sums, added up over the tasks: each node's bin of highest gain."""
    def run(table: pa.Table) -> pa.Table:
        unit = table["unit"][0].as_py()
        total = sum(np.frombuffer(s.as_buffer(), np.float64) for s in table["sums"])
        found = best_splits(total, nodes[unit], least, rows)
        columns = [np.full(nodes[unit], unit), np.arange(nodes[unit]), *found]
        return pa.table([pa.array(c, pa.int32() if i < 3 else pa.float64()) for i, c in enumerate(columns)],
                        names=[f.split()[0] for f in SPLITS.split(", ")])

    return run


# ---------------------------------------------------------------- rounds

@dataclass(frozen=True)
class Plan:
    """The settings of a fit, and the numbers of its features and classes."""

    width: int
    k: int
    watched: bool
    seed: int
    rounds: int
    depth: int
    rate: float
    l1: float
    l2: float
    gamma: float
    leafWeight: float
    leafRows: int
    rows: float
    columns: float
    bins: int
    patience: int
    parallelism: int

    def columns_of(self, round_: int, c: int) -> list[int]:
        count = max(1, int(self.width * self.columns))
        return sorted(random.Random(f"{self.seed}:{round_}:{c}").sample(range(self.width), count))

    def round(self, sample: Sample, round_: int, splits, begun=lambda: None) -> list[Growth]:
        """A tree of each class. `splits(units, growths, active, round_)` gives the best split of
        each unit's nodes, as (unit, row of SPLITS), by units and nodes in order."""
        growths = [Growth() for _ in range(self.k)]
        cuts: list[dict] = []
        units: list[Unit] = []
        shares, drawn = softmax(sample.margins, 0), sample.drawn(round_, self.seed, self.rows)
        for c in range(self.k):
            columns = self.columns_of(round_, c)
            cuts.append(dict(zip(columns, sample.cuts(c, columns, shares[c], drawn[c], self.bins))))
            units.append(Unit(c, -1, np.zeros(1, np.uint8), 1))
            for f, (codes, _) in cuts[c].items():
                if len(codes):
                    bins = np.searchsorted(codes, np.arange(len(sample.values[f])), "left")
                    units.append(Unit(c, f, bins.astype(np.uint8 if len(codes) < 256 else np.int32), len(codes) + 1))
        active = {c: np.zeros(1, np.int64) for c in range(self.k)}
        for level in range(max(1, self.depth)):
            best: dict[tuple[int, int], tuple[Unit, dict]] = {}
            for unit, row in splits([u for u in units if u.tree in active and (u.feature >= 0 or not level)],
                                    growths, active, round_):
                if unit.feature < 0:
                    growths[unit.tree].total(row["gl"], row["hl"])
                elif row["gain"] > NOISE * row["score"]:
                    at = unit.tree, row["slot"]
                    if at not in best or row["gain"] > best[at][1]["gain"]:
                        best[at] = unit, row
            if not level:
                begun()
            after: dict[int, list[int]] = {}
            for (c, slot), (unit, row) in sorted(best.items(), key=lambda b: b[0]):
                node = int(active[c][slot])
                if level < self.depth and (level or growths[c].h[0] > 2 * self.leafWeight):
                    codes, thresholds = cuts[c][unit.feature]
                    after.setdefault(c, []).extend(growths[c].split(
                        node, unit.feature, thresholds[row["bin"]], codes[row["bin"]],
                        (row["gl"], row["gr"]), (row["hl"], row["hr"])))
            active = {c: np.array(nodes) for c, nodes in after.items()}
            if not active:
                break
        for growth in growths:
            tree, g, h = growth.tree()
            growth.value_by(regularised(tree, g, h, self.rate, self.l1, self.l2, self.gamma))
        return growths

    def ended(self, losses: list[float]) -> bool:
        return len(losses) - 1 - int(np.argmin(losses)) >= self.patience

    def kept(self, trees: list, losses: list[float]) -> list:
        return trees[:int(np.argmin(losses)) + 1] if self.watched and losses else trees


def _alone(plan: Plan):
    """A whole fit by one task that has all the rows: the rounds' trees, and then the losses."""
    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        rows = Sample.of(pa.Table.from_batches(_sampled(1.0, plan.seed)(batches)), plan.width, plan.k, True)

        def splits(units: list[Unit], growths: list[Growth], active: Active, round_: int):
            drawn = rows.drawn(round_, plan.seed, plan.rows)
            for part in plan_parts(units, active, plan.parallelism):
                sums = empty_sums(part, active, plan.leafRows > 1)
                add_sums(sums, rows, part, growths, active, drawn)
                for unit, total in zip(part, sums):
                    found = best_splits(total, len(active[unit.tree]), plan.leafWeight, plan.leafRows)
                    for slot, row in enumerate(zip(*found)):
                        yield unit, dict(zip(_SPLIT, (slot, *row)))

        trees: list[list[Tree]] = []
        losses: list[float] = []
        for round_ in range(plan.rounds):
            growths = plan.round(rows, round_, splits)
            trees.append([t.final for t in growths])
            advance(rows, [growths])
            if plan.watched:
                total, watched = rows.loss()
                losses.append(total / watched if watched else None)
                if plan.ended(losses):
                    break
        for i, c, tree in ((i, c, t) for i, r in enumerate(plan.kept(trees, losses)) for c, t in enumerate(r)):
            yield _tree_records([(i, c, tree)])
        nothing = np.zeros(0)
        yield _tree_records([(-1, -1, Tree(nothing, nothing, nothing, np.array(losses, float), nothing, nothing))])

    return run


_SPLIT = [f.split()[0] for f in SPLITS.split(", ")][1:]


def plan_parts(units: list[Unit], active: Active, parallelism: int) -> list[list[Unit]]:
    """The units of each pass, which holds a bounded number of sums."""
    parts: list[list[Unit]] = []
    cells = 0
    for unit in units:
        size = len(active[unit.tree]) * unit.count
        trees = {u.tree for u in parts[-1]} | {unit.tree} if parts else set()
        if not parts or cells + size > CELLS or len(trees) > parallelism:
            parts.append([])
            cells = 0
        parts[-1].append(unit)
        cells += size
    return parts


class _Settings(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol,
                HasSeed, HasWeightCol, HasValidationIndicatorCol):
    pass


class JointBoosting(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Fits labels 0..k-1. With a validation column, its true rows are held out: their loss is
    recorded each round, the fit ends `patience` rounds after the lowest, and only the rounds up
    to it are kept. Of equal losses the first counts."""

    rounds = Param(Params._dummy(), "rounds", "trees of each class", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of splits", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of a leaf value that is added", TypeConverters.toFloat)
    l1 = Param(Params._dummy(), "l1", "drawn from each leaf's gradient", TypeConverters.toFloat)
    l2 = Param(Params._dummy(), "l2", "added to each leaf's hessian", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "least gain of a split", TypeConverters.toFloat)
    leafWeight = Param(Params._dummy(), "leafWeight", "least hessian of a leaf", TypeConverters.toFloat)
    leafRows = Param(Params._dummy(), "leafRows", "least rows of a leaf", TypeConverters.toInt)
    rows = Param(Params._dummy(), "rows", "share of the rows that a tree sees", TypeConverters.toFloat)
    columns = Param(Params._dummy(), "columns", "share of the features that a tree sees", TypeConverters.toFloat)
    bins = Param(Params._dummy(), "bins", "candidate thresholds of a feature", TypeConverters.toInt)
    patience = Param(Params._dummy(), "patience", "rounds without a lower loss before the end", TypeConverters.toInt)
    parallelism = Param(Params._dummy(), "parallelism", "classes whose trees share a pass over the rows", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction",
                 probabilityCol="probability", rawPredictionCol="raw", weightCol=None,
                 validationIndicatorCol=None, seed=42, rounds=100, depth=3, rate=0.1, l1=0.0, l2=1.0,
                 gamma=0.0, leafWeight=1.0, leafRows=1, rows=1.0, columns=1.0, bins=256, patience=20,
                 parallelism=8):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        given = dict(seed=42, rounds=100, depth=3, rate=0.1, l1=0.0, l2=1.0, gamma=0.0, leafWeight=1.0,
                     leafRows=1, rows=1.0, columns=1.0, bins=256, patience=20, parallelism=8)
        self._setDefault(rawPredictionCol="raw", **given)
        for name in ("rows", "columns"):
            if not 0 < self.getOrDefault(name) <= 1:
                raise ValueError(f"{name} is a share above 0, up to 1; {self.getOrDefault(name)} is given")

    def _packed_rows(self, dataset: DataFrame) -> DataFrame:
        weight = col(self.getWeightCol()).cast("double") if self.isSet(self.weightCol) else F.lit(1.0)
        held = (col(self.getValidationIndicatorCol()) if self.isSet(self.validationIndicatorCol)
                else F.lit(False))
        held = F.coalesce(held.cast("boolean"), F.lit(False))
        base = dataset.select(
            F.monotonically_increasing_id().alias("row"), vector_to_array(col(self.getFeaturesCol())).alias("x"),
            col(self.getLabelCol()).cast("int").alias("label"), weight.alias("weight"), held.alias("held"))
        base = base.mapInArrow(_packed, BLOCK)
        return base.checkpoint() if use_checkpoints(dataset.sparkSession) else base.persist(StorageLevel.MEMORY_AND_DISK)

    def _fit(self, dataset: DataFrame) -> "JointBoostingModel":
        base = self._packed_rows(dataset)
        try:
            top, width, least, count, free = base.agg(
                F.max("top"), F.max("width"), F.min("width"), F.sum("count"), F.sum("open")).head()
            if top is None:
                raise ValueError("no rows to train on")
            if least != width:
                raise ValueError("rows to train on have different numbers of features")
            plan = Plan(width, top + 1, self.isSet(self.validationIndicatorCol), *(
                self.getOrDefault(f.name) for f in fields(Plan)[3:]))
            limit = min(2 * max(plan.bins ** 2, 10_000), SAMPLE_VALUES // max(1, width))
            share = 1.0 if count <= limit else min(0.999, limit / max(1, free))
            if share == 1.0 and count * width * plan.k <= ALONE_VALUES:
                trees, losses = _read_trees(base.coalesce(1).mapInArrow(_alone(plan), TREES).toArrow())
            else:
                trees, losses = self._fit_apart(base, plan, count, share)
        finally:
            base.unpersist()
        return self._copyValues(JointBoostingModel(trees, plan.k, width, losses))

    def _fit_apart(self, base: DataFrame, plan: Plan, count: int, share: float) -> tuple[list, list]:
        """Rounds of passes over rows that many tasks hold."""
        sample = Sample.of(base.mapInArrow(_sampled(share, plan.seed), "row binary, x binary, label binary, "
                           "weight binary, held binary").toArrow(), plan.width, plan.k, share == 1.0)
        # As many tasks as the values need, and the cores: each of them gives sums of its own. What they
        # read is kept in more partitions, where it is much.
        cores = base.sparkSession.sparkContext.defaultParallelism
        tasks = min(2 * cores, -(-count * plan.width * plan.k // TASK_VALUES))
        parts = max(tasks, -(-count * (sample.codes.itemsize * plan.width + 8 * plan.k + 13) // KEPT_BYTES))
        spread = base.coalesce(parts) if base.rdd.getNumPartitions() >= parts else base.repartition(parts, "start")
        packed = spread.mapInArrow(_coded(sample.middles), CODED)
        safe = use_checkpoints(base.sparkSession)
        packed = packed.checkpoint() if safe else packed

        def state(rows: DataFrame, rounds: list[list[Walk]]) -> DataFrame:
            return rows.mapInArrow(_advanced(rounds, plan.width, plan.k), STATE).persist(StorageLevel.MEMORY_AND_DISK)

        rows = before = state(packed, [])
        trees: list[list[Tree]] = []
        walks: list[list[Walk]] = []
        losses: list[float] = []
        try:
            for round_ in range(plan.rounds + plan.watched):
                if plan.watched and round_:
                    total, watched = rows.agg(F.sum("loss"), F.sum("watched")).head()  # reads all rows, and so keeps them
                    before.unpersist()
                    losses.append(total / watched if watched else None)
                    if plan.ended(losses):
                        break
                if round_ == plan.rounds:
                    break
                old = before if before is not rows else None
                growths = plan.round(sample, round_, lambda *given: self._passes(rows.coalesce(tasks), plan, *given),
                                     (old or base).unpersist)
                trees.append([t.final for t in growths])
                walks.append([t.walk() for t in growths])
                advance(sample, walks[-1:])
                cut = safe and round_ % CUT_ROUNDS == CUT_ROUNDS - 1
                before, rows = rows, state(packed, walks) if cut else state(rows, walks[-1:])
        finally:
            before.unpersist()
            rows.unpersist()
        return plan.kept(trees, losses), losses

    @staticmethod
    def _passes(rows: DataFrame, plan: Plan, units: list[Unit], growths: list[Growth], active: Active,
                round_: int) -> Iterator[tuple[Unit, dict]]:
        """The best splits of each unit's nodes, by passes over the rows."""
        for part in plan_parts(units, active, plan.parallelism):
            found = rows.select(*(n for n, _ in _fields(CODED)), "margins").mapInArrow(
                _sums(part, [g.walk() for g in growths], active, plan.width, plan.k, round_, plan.seed, plan.rows,
                      plan.leafRows > 1), "unit int, sums binary")
            splits = found.groupBy("unit").applyInArrow(
                _splits([len(active[u.tree]) for u in part], plan.leafWeight, plan.leafRows), SPLITS).toArrow()
            for row in sorted(splits.to_pylist(), key=lambda r: (r["unit"], r["slot"])):
                yield part[row["unit"]], row


class JointBoostingModel(Model, _Settings, MLWritable, MLReadable):
    """The trees of each round, evaluated over Arrow batches as one flat forest. `losses` are
    the held rows' after each round that was trained, kept or not."""

    def __init__(self, trees: list[list[Tree]] | None = None, k: int = 0, width: int = 0,
                 losses: list[float] | None = None):
        super().__init__()
        self.trees, self.k, self.width, self.losses = trees or [], k, width, losses or []

    @property
    def rounds(self) -> int:
        return len(self.trees)

    def forest(self) -> Forest:
        return Forest([t for r in self.trees for t in r], [c for r in self.trees for c in range(self.k)], self.k)

    @property
    def featureImportances(self) -> DenseVector:
        """Each feature's mean gain over its splits, as a share of all features' means."""
        gain, splits = np.zeros(self.width), np.zeros(self.width)
        for tree in (t for r in self.trees for t in r):
            used = np.flatnonzero(tree.inner & reachable(tree))
            np.add.at(gain, tree.feature[used], tree.gain[used])
            np.add.at(splits, tree.feature[used], 1)
        mean = gain / np.maximum(splits, 1)
        return DenseVector(mean / mean.sum() if mean.sum() > 0 else mean)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        forest, width = self.forest(), self.width

        @F.arrow_udf("struct<prediction:double,raw:array<double>,probability:array<double>>")
        def score(x: pa.Array) -> pa.Array:
            margins = forest.margins(_matrix(x, width))
            return pa.StructArray.from_arrays(
                [pa.array(margins.argmax(axis=1).astype(np.float64)), _lists(margins), _lists(softmax(margins))],
                ["prediction", "raw", "probability"])

        return dataset.withColumn("_boosted", score(vector_to_array(col(self.getFeaturesCol())))).withColumns({
            self.getPredictionCol(): F.col("_boosted.prediction"),
            self.getRawPredictionCol(): array_to_vector(F.col("_boosted.raw")),
            self.getProbabilityCol(): array_to_vector(F.col("_boosted.probability")),
        }).drop("_boosted")

    def rounds_table(self, spark) -> DataFrame:
        """(round, loss, kept) of every round trained with held rows."""
        return local_rows(spark, [(i + 1, loss, i < self.rounds) for i, loss in enumerate(self.losses)],
                          "round int, loss double, kept boolean")

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


TREES = ("round int, class int, feature array<int>, threshold array<double>, child array<int>, "
         "value array<double>, leaf array<int>, gain array<double>")


def _tree_records(trees: list[tuple[int, int, Tree]]) -> pa.RecordBatch:
    ints, doubles = pa.list_(pa.int32()), pa.list_(pa.float64())
    kinds = [ints if kind == "array<int>" else doubles if kind == "array<double>" else pa.int32()
             for kind in (f.split()[1] for f in TREES.split(", "))]
    rows = [(i, c, *(getattr(t, f.name).tolist() for f in fields(Tree))) for i, c, t in trees]
    return _records(rows, [(f.split()[0], kind) for f, kind in zip(TREES.split(", "), kinds)])


def _read_trees(table: pa.Table) -> tuple[list[list[Tree]], list[float]]:
    """The trees of each round, and the losses, which a row of round -1 has as its values."""
    kinds = {f.name: np.int32 if f.name in ("feature", "child", "leaf") else np.float64 for f in fields(Tree)}
    trees: dict[int, dict[int, Tree]] = {}
    losses: list[float] = []
    for row in table.to_pylist():
        if row["round"] < 0:
            losses = row["value"]
        else:
            trees.setdefault(row["round"], {})[row["class"]] = Tree(
                **{name: np.array(row[name], kind) for name, kind in kinds.items()})
    return [[r[c] for c in range(len(r))] for _, r in sorted(trees.items())], losses


class _ModelWriter(MLWriter):
    """The settings as metadata, the trees as a table of one row each."""

    def __init__(self, model: JointBoostingModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={
            "k": m.k, "width": m.width, "losses": m.losses})
        rows = [(i, c, *(getattr(t, f.name).tolist() for f in fields(Tree)))
                for i, r in enumerate(m.trees) for c, t in enumerate(r)]
        local_rows(self.sparkSession, rows, TREES).write.parquet(f"{path}/trees")


class _ModelReader(MLReader):
    def load(self, path: str) -> JointBoostingModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        table = self.sparkSession.read.schema(TREES).parquet(f"{path}/trees").toArrow()
        model = JointBoostingModel(_read_trees(table)[0], metadata["k"], metadata["width"], metadata["losses"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
