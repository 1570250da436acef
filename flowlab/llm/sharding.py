"""Sharding by a keyed permutation of the rows' numbers.

Method: rows are numbered 0 to n - 1 in an order that their contents alone decide. A Feistel
network over pairs (left < a, right < b), with a and b about the square root of n, permutes
0 to a * b - 1; where it leaves 0 to n - 1 it is applied again (cycle walking), which
permutes 0 to n - 1 itself. The permuted number gives the shard (its remainder by the number
of shards) and the slot (its quotient). So any row's place can be computed from its number,
and any slot's row number from its place, without a table: see `place` and `number_at`.

Law: `rows`. Shards differ by one row at most, and slots run from 0 without gaps.

Numbers are sums over hash buckets of bounded size, in two levels; equal rows are counted
before they are numbered. Only DataFrame functions run here.

Cases: a null text has no bytes and the checksum of none. Ids may be null or repeat; rows
equal in id, size and checksum are interchangeable. An empty table gives an empty result.
Other columns aren't looked at.
"""

from __future__ import annotations

import math
import struct

import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlab.functions.columns import col
from flowlab.llm.common import offsets, stored, text_of

SHARDS = 8
SEED = 20_240_601
ROUNDS = 6
BUCKET_ROWS = 4_096  # rows numbered together, about


def domain(n: int) -> tuple[int, int]:
    """Numbers of left and right halves: a * b >= n, by less than a."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def _hash(seed: int, value: int) -> int:
    """xxhash64(seed, value) as the cluster computes it."""
    mixed = xxhash.xxh64_intdigest(struct.pack("<q", seed), 42)
    mixed = xxhash.xxh64_intdigest(struct.pack("<q", value), mixed)
    return mixed - (1 << 64) if mixed >> 63 else mixed


def _network(number: Column, a: int, b: int, seed: int, move: int) -> Column:
    """One pass over 0 to a * b - 1: each round shifts one half by a hash of the other."""
    keys = [seed + i for i in range(ROUNDS)][::move]
    halves = F.struct(F.call_function("div", number, F.lit(b)).alias("left"),
                      (number % F.lit(b).cast("bigint")).alias("right"))

    def turn(pair: Column, key: Column) -> Column:
        left, right = pair["left"], pair["right"]
        return F.when((key - seed) % 2 == 0, F.struct(
            F.pmod(left + move * F.pmod(F.xxhash64(key, right), F.lit(a)), F.lit(a)).alias("left"),
            right.alias("right"))).otherwise(F.struct(
                left.alias("left"),
                F.pmod(right + move * F.pmod(F.xxhash64(key, left), F.lit(b)), F.lit(b)).alias("right")))

    return F.aggregate(F.array(*[F.lit(k).cast("bigint") for k in keys]), halves, turn,
                       lambda pair: pair["left"] * F.lit(b) + pair["right"])


def step(number: Column, a: int, b: int, seed: int = SEED) -> Column:
    return _network(number, a, b, seed, 1)


def back(number: Column, a: int, b: int, seed: int = SEED) -> Column:
    """The inverse of `step`."""
    return _network(number, a, b, seed, -1)


def _walk(number: int, n: int, seed: int, forward: bool) -> int:
    a, b = domain(n)
    move = 1 if forward else -1
    while True:
        left, right = divmod(number, b)
        for i in range(ROUNDS)[::move]:
            if i % 2 == 0:
                left = (left + move * (_hash(seed + i, right) % a)) % a
            else:
                right = (right + move * (_hash(seed + i, left) % b)) % b
        number = left * b + right
        if number < n:
            return number


def place(number: int, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """(shard, slot) of row `number` of n."""
    slot, shard = divmod(_walk(number, n, seed, True), shards)
    return shard, slot


def number_at(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The number of the row in that place."""
    return _walk(slot * shards + shard, n, seed, False)


def most_passes(df: DataFrame, n: int, seed: int = SEED) -> int:
    """Passes after which every number is back in 0 to n - 1, found by walking the few
    numbers outside (fewer than the square root of n) that a number inside can reach."""
    a, b = domain(n)
    out = (df.sparkSession.range(n, a * b).select(F.col("id").alias("p"))
           .where(back(F.col("p"), a, b, seed) < n))
    passes = 1
    while not out.isEmpty():
        out = out.select(step(F.col("p"), a, b, seed).alias("p")).where(F.col("p") >= n)
        passes += 1
    return passes


def permuted(number: Column, n: int, passes: int, seed: int = SEED) -> Column:
    a, b = domain(n)
    out = step(number, a, b, seed)
    if passes == 1:
        return out
    return F.aggregate(F.sequence(F.lit(2), F.lit(passes)), out,
                       lambda p, _: F.when(p < n, p).otherwise(step(p, a, b, seed)))


def numbered(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """`rows` with `number`, 0 to n - 1, in an order decided by the keys' values alone."""
    same = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("mark", F.xxhash64(*keys))
            .withColumn("bucket", F.pmod("mark", F.lit(max(1, -(-n // BUCKET_ROWS))).cast("bigint"))))
    before = offsets(same.groupBy("bucket").agg(F.sum("copies").alias("held")), [], "bucket", "held")
    inside = (Window.partitionBy("bucket").orderBy("mark", *keys)
              .rowsBetween(Window.unboundedPreceding, -1))
    first = F.col("before") + F.coalesce(F.sum("copies").over(inside), F.lit(0))
    return (same.join(before.select("bucket", "before"), "bucket").withColumn("first", first)
            .select(*keys, F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1)).alias("number")))


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
          id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, size (bytes of the text and 1), text_crc32, law,
    shard, slot, and grown_shard (null: another number of shards moves rows anywhere)."""
    content = text_of(text)
    rows = stored(docs.select(
        col(id_col).alias("doc_id"),
        (F.octet_length(content) + 1).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32")))
    n = rows.count()
    placed = numbered(rows, ["doc_id", "size", "text_crc32"], n).withColumn(
        "at", permuted(F.col("number"), n, most_passes(docs, n, seed), seed))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("at") % shards).cast("int").alias("shard"),
        F.call_function("div", F.col("at"), F.lit(shards)).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(placed: DataFrame, path: str) -> None:
    """Sharded rows as one folder per shard, in order of the slots within each file."""
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
