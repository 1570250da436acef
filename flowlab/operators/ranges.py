"""Running totals over a whole order, without all rows meeting in one task."""

from __future__ import annotations

import bisect
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.storagelevel import StorageLevel

from flowlab.functions.columns import col
from flowlab.functions.small import local_rows, settle, use_checkpoints

RANGE = "_range"
# Rows that one task orders, about; fewer, for more tasks; ranges of a column at most; sampled values for
# each; bytes of a cut.
RANGE_ROWS = 500_000
FEWER_ROWS = 50_000
MAX_RANGES = 2_000
SAMPLES = 50
CUT_BYTES = 256


def ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """`df` dealt to partitions by ranges of `order`, the number of each in RANGE.

    The ranges come from a sample and only balance the work. They are kept (in the shared
    folder, if the cluster names one), so that all that reads them sees the same ones."""
    dealt = df.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id())
    if use_checkpoints(df.sparkSession):
        return dealt.checkpoint()
    return dealt.persist(StorageLevel.DISK_ONLY)


def with_totals_before(df: DataFrame, amounts: dict[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """`df` (as from `ranged`) with, for each new name, the total of its amount over all earlier
    ranges, per key. One row per key and range is all that a task sees."""
    sums = df.groupBy(*keys, RANGE).agg(*[F.sum(a).alias(n) for n, a in amounts.items()])
    earlier = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))).orderBy(RANGE).rowsBetween(
        Window.unboundedPreceding, -1)
    before = sums.select(*keys, RANGE, *[
        F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in amounts])
    return df.join(settle(before).df, [*keys, RANGE])


def ranks(df: DataFrame, order: Sequence[Column], keys: Sequence[str], out: str) -> DataFrame:
    """Each row's place 0, 1, ... in `order` among the rows of its key; `order` begins with the keys."""
    dealt = with_totals_before(ranged(df, order), {"_before": F.lit(1)}, keys)
    inside = Window.partitionBy(*map(col, keys), RANGE).orderBy(*order)
    return dealt.withColumn(out, F.col("_before") + F.row_number().over(inside) - 1).drop("_before", RANGE)


def cuts(df: DataFrame, places: Sequence[Column], rows: int, seed: int = 42) -> list[list]:
    """For each of `places`, numbers or binaries, the values that cut it into ranges of about
    RANGE_ROWS rows. They come from a bounded sample and only balance the work."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    n = min(MAX_RANGES, max(-(-rows // RANGE_ROWS), min(cores, rows // FEWER_ROWS)))
    if n < 2:
        return [[] for _ in places]
    types = [t for _, t in df.select(*[p.alias(f"_p{i}") for i, p in enumerate(places)]).dtypes]
    short = [F.substring(p, 1, CUT_BYTES) if t == "binary" else p for p, t in zip(places, types)]
    drawn = df.sample(min(1.0, n * SAMPLES / rows), seed).select(
        *[p.alias(f"_p{i}") for i, p in enumerate(short)]).limit(2 * n * SAMPLES).toArrow()
    out = []
    for column in drawn.columns:
        values = sorted(v for v in column.to_pylist() if v is not None and v == v)  # without NaN
        out.append(sorted({values[len(values) * i // n] for i in range(1, n)}) if values else [])
    return out


def range_number(place: Column, at: Sequence) -> Column:
    """The range of a value: 2 i between cuts i - 1 and i, 2 i + 1 at cut i itself, so that a frequent
    value has one of its own; the last of all for a missing one."""
    at, last = list(at), 2 * len(at) + 1
    numbers = np.array(at, dtype=np.float64) if not at or not isinstance(at[0], bytes) else None

    @F.arrow_udf("int")
    def number(x: pa.Array) -> pa.Array:
        if pa.types.is_floating(x.type):
            values = x.to_numpy(zero_copy_only=False)
            found = np.searchsorted(numbers, values, "left") + np.searchsorted(numbers, values, "right")
            return pa.array(found.astype(np.int32), mask=x.is_null().to_numpy(zero_copy_only=False))
        return pa.array([None if v is None else bisect.bisect_left(at, v) + bisect.bisect_right(at, v)
                         for v in x.to_pylist()], pa.int32())

    return F.coalesce(number(place), F.lit(last))


def with_dense_codes(df: DataFrame, source: DataFrame, order: Sequence[Column], place: Column, at: Sequence,
                     out: str) -> DataFrame:
    """`df` with `out`: how many distinct values of `order` come before the row's. `place`, a double or a
    binary that never falls as `order` rises, deals the rows to the ranges that `at` cuts.

    The distinct values of each range are counted over `source`, which has the rows of `df` in a form
    that is cheaper to compute; then the rows are shuffled once, with their range's count of earlier
    values. A range of one value needs no order, and its rows are spread over all tasks."""
    names = [f"_o{i}" for i in range(len(order))]
    number = range_number(place, at)
    found = (source.select(number.alias(RANGE), *[o.alias(n) for o, n in zip(order, names)])
             .distinct().groupBy(RANGE).agg(F.count(F.lit(1)).alias("n")).collect())  # a row per range
    rows, before = [], 0
    for r in sorted(found, key=lambda r: r[RANGE]):
        rows.append((r[RANGE], before, r["n"] == 1))
        before += r["n"]
    known = F.broadcast(local_rows(df.sparkSession, rows, f"{RANGE} int, _before bigint, _one boolean"))
    tasks = len(at) + 1
    dealt = (df.withColumn(RANGE, number).join(known, RANGE)
             .withColumn("_spread", F.when(F.col("_one"), F.spark_partition_id() % tasks).otherwise(0))
             .repartition(tasks, RANGE, "_spread"))
    inside = Window.partitionBy(RANGE, "_spread").orderBy(*[o.asc_nulls_last() for o in order])
    return (dealt.withColumn("_code", F.col("_before") + F.dense_rank().over(inside) - 1)
            .select(*[col(c) for c in df.columns if c != out], F.col("_code").alias(out)))
