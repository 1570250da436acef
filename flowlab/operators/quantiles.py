"""Exact quantiles in bounded memory.

The built-in exact percentile keeps every distinct value of a column in one task. Here a
bounded sample brackets each wanted quantile, a pass over all rows counts those below and
inside the bracket, and only the values inside are grouped and ranked. A bracket that
still holds many rows is narrowed by another sample; one that missed its rank goes back
to the last one and is sampled anew; one that a sample can't narrow is cut into equal
ranges of values. The samples never decide a result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlab.functions.columns import number

# Rows taken for a bracket: a thousandth of those inside it, within these limits.
SAMPLE_ROWS = (50_000, 2_000_000)
SKETCH_ACCURACY = 10_000
# Half width of a bracket in standard errors of the sampled rank.
SIGMAS = 5.0
# Rows inside a bracket up to which its values are grouped and ranked.
BRACKET_ROWS = 500_000
# Ranges of values into which a bracket is cut that samples can't narrow.
CUTS = 1_000
MOST = 1.7e308
# Result columns of one aggregation; more of them make the generated code too big.
WIDTH = 200


@dataclass
class _Target:
    column: str
    position: float
    low: float
    high: float
    inside: int
    before: int = 0
    stuck: bool = False

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.position) + 1, math.ceil(self.position) + 1


def _run(df: DataFrame, exprs: list[Column]) -> list:
    out: list = []
    for at in range(0, len(exprs), WIDTH):
        out.extend(df.agg(*[e.alias(f"a{i}") for i, e in enumerate(exprs[at:at + WIDTH])]).head())
    return out


def _narrow(df: DataFrame, targets: list[_Target], xs: dict[str, Column], sample_rows, draw: int) -> None:
    """Shrink the brackets by a sample of the values inside; equal brackets share one."""
    if not targets:
        return
    fewest, most = sample_rows
    shared: dict[tuple, list[_Target]] = {}
    for t in targets:
        shared.setdefault((t.column, t.low, t.high, t.inside), []).append(t)
    sizes = {b: min(b[3], max(fewest, min(most, b[3] // 1000))) for b in shared}
    shares = {b: sizes[b] / b[3] for b in shared}
    drawn = df.withColumn("_draw", F.rand(draw)).where(F.col("_draw") < max(shares.values()))
    exprs, spans = [], []
    for b, group in shared.items():
        column, low, high, inside = b
        n = sizes[b]
        span = []
        for t in group:
            p = (t.position - t.before) / max(inside - 1, 1)
            slack = SIGMAS * math.sqrt(max(p * (1 - p), 1 / n) / n) + 2 / SKETCH_ACCURACY
            span.append((p - slack, p + slack))
        spans.append(span)
        x = xs[column]
        taken = (x >= low) & (x <= high) & (F.col("_draw") < shares[b])
        ends = [min(max(e, 0.0), 1.0) for pair in span for e in pair]
        exprs.append(F.percentile_approx(F.when(taken, x), ends, SKETCH_ACCURACY))
    for group, span, ends in zip(shared.values(), spans, _run(drawn, exprs)):
        for i, (t, (p_low, p_high)) in enumerate(zip(group, span)):
            if ends:
                t.low = t.low if p_low <= 0 else ends[2 * i]
                t.high = t.high if p_high >= 1 else ends[2 * i + 1]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float],
    known: dict[str, tuple] | None = None,
    sample_rows: tuple[int, int] = SAMPLE_ROWS,
    bracket_rows: int = BRACKET_ROWS,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column, nulls and NaN skipped.

    `known` passes (count, min, max) per column when the caller has aggregated them.
    """
    types = dict(df.dtypes)
    xs = {c: number(c, types[c]) for c in columns}
    if known is None:
        row = _run(df, [e for c in columns for e in (F.count(xs[c]), F.min(xs[c]), F.max(xs[c]))])
        known = {c: tuple(row[3 * i:3 * i + 3]) for i, c in enumerate(columns)}
    targets = [
        _Target(c, p * (known[c][0] - 1), known[c][1], known[c][2], known[c][0])
        for c in columns if known[c][0] for p in probs
    ]
    moving = [t for t in targets if t.inside > bracket_rows and t.low < t.high]
    draw = 16
    while moving:
        spans = [(t.low, t.high) for t in moving]
        draw += 1
        _narrow(df, [t for t in moving if not t.stuck], xs, sample_rows, draw)
        for t in moving:
            if t.stuck:
                _cut(df, t, xs[t.column])
        exprs = []
        for t in moving:
            x = xs[t.column]
            exprs += [F.count_if(x < t.low), F.count_if((x >= t.low) & (x <= t.high))]
        row = _run(df, exprs)
        again = []
        for i, (t, span) in enumerate(zip(moving, spans)):
            before, inside = row[2 * i], row[2 * i + 1]
            first, last = t.ranks
            if not (before < first and last <= before + inside):
                # The sample missed: back to the last bracket, whose counts are known.
                t.low, t.high = span
                again.append(t)
                continue
            t.before, t.inside = before, inside
            # Equal ranges of values narrow where samples can't, until one range is left.
            if t.low < t.high and inside > bracket_rows and not (t.stuck and (t.low, t.high) == span):
                t.stuck = (t.low, t.high) == span
                again.append(t)
        moving = again

    values = _order_statistics(df, targets, xs)
    out: dict[str, list[float | None]] = {
        c: [] if known[c][0] else [None] * len(probs) for c in columns}
    for i, t in enumerate(targets):
        low, high = values[i]
        share = t.position - math.floor(t.position)
        # Infinite neighbours count with their share only, so equal ones give themselves.
        out[t.column].append(low if low == high or not share else low * (1 - share) + high * share
                             if math.isinf(low) or math.isinf(high) else low + (high - low) * share)
    return out


def _cut(df: DataFrame, t: _Target, x: Column) -> None:
    """Narrow a bracket to those of `CUTS` equal ranges of values that hold its ranks."""
    low, high = max(t.low, -MOST), min(t.high, MOST)
    width = high / CUTS - low / CUTS
    at = F.least(F.greatest(F.floor(x / F.lit(width) - F.lit(low / width)), F.lit(-1)), F.lit(CUTS))
    rows = (df.where((x >= t.low) & (x <= t.high)).groupBy(at.alias("at"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi")).collect())
    before, found = t.before, []
    for row in sorted(rows, key=lambda r: r["at"]):
        if before < t.ranks[1] and before + row["n"] >= t.ranks[0]:
            found.append(row)
        before += row["n"]
    t.low, t.high = found[0]["lo"], found[-1]["hi"]


def _order_statistics(df, targets, xs) -> dict[int, tuple[float, float]]:
    """The values at each target's two ranks."""
    found = {i: (t.low, t.low) for i, t in enumerate(targets) if t.low == t.high}
    todo = {i: t for i, t in enumerate(targets) if i not in found}
    if not todo:
        return found
    inside = {i: (xs[t.column] >= t.low) & (xs[t.column] <= t.high) for i, t in todo.items()}
    some = None
    for c in inside.values():
        some = c if some is None else some | c
    hits = F.array(*[
        F.when(inside[i], F.struct(F.lit(i).alias("i"), xs[t.column].alias("x")))
        for i, t in todo.items()
    ])
    grouped = (
        df.where(some)
        .select(F.explode(F.array_compact(hits)).alias("h"))
        .groupBy(F.col("h.i").alias("i"), F.col("h.x").alias("x"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # One window per target, over the distinct values of its bracket.
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("x"))
    wanted = F.create_map(*[
        v for i, t in todo.items()
        for v in (F.lit(i), F.array(*[F.lit(r - t.before) for r in t.ranks]))
    ])
    ranked = grouped.withColumn("upto", upto).withColumn("r", wanted[F.col("i")])
    first = F.min(F.when(F.col("upto") >= F.col("r")[0], F.col("x")))
    last = F.min(F.when(F.col("upto") >= F.col("r")[1], F.col("x")))
    rows = ranked.groupBy("i").agg(first.alias("lo"), last.alias("hi")).collect()  # one per target
    found.update({r["i"]: (r["lo"], r["hi"]) for r in rows})
    return found
