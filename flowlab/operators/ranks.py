"""Exact ranks within classes, without sorting the classes.

Sampling, splitting and folding all ask the same question: which rows come before
rank r of their class, in keyed-hash order? A window per class would put a class that
holds a third of the table into one task. Here the hash at each wanted rank is searched
by counting hash prefixes, longer ones at each pass, so a pass shuffles only counts;
then every row is compared with its class's few hashes, in a map.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlab.functions.columns import col, key_hash, row_hash, row_text
from flowlab.functions.small import Settled, settle

# Hash digits looked at per pass: 32 from the key, then 32 from the whole row.
PREFIXES = (2, 5, 10, 32, 34, 37, 42, 64)
# A prefix with at most this many rows is resolved to the single hash in one pass.
RESOLVE_ROWS = 1_000_000
# Copies of one row written by one task when copies have to be told apart.
COPIES_PER_TASK = 1_000_000


def _before(*keys: str) -> Column:
    """Rows in the prefixes that come earlier."""
    earlier = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(earlier), F.lit(0))


def _holds_rank() -> Column:
    rank, before = F.col("_rank"), F.col("_before")
    return ((rank > before) & (rank <= before + F.col("_n"))) | ((rank == 0) & (before == 0))


def _first_pass(rows: DataFrame, cuts: Sequence[Callable[[Column], Column]]) -> Settled:
    size = F.sum("_n").over(Window.partitionBy("_c"))
    wanted = [F.least(F.greatest(cut(F.col("_size")), F.lit(0)), F.col("_size")).cast("long")
              for cut in cuts]
    counts = (
        rows.groupBy("_c", F.substr("_h", F.lit(1), F.lit(PREFIXES[0])).alias("_p"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_size", size)
        .withColumn("_before", _before("_c"))
    )
    return settle(
        counts.select("_c", "_p", "_n", "_before", F.posexplode(F.array(*wanted)).alias("_j", "_rank"))
        .where(_holds_rank()))


def _next_pass(rows: DataFrame, found: DataFrame, length: int, target: int) -> DataFrame:
    at = found.select(F.col("_c").alias("_fc"), "_j", F.col("_p").alias("_fp"),
                      F.col("_before").alias("_base"), F.col("_rank").alias("_r"))
    counts = (
        rows.join(at, F.col("_c").eqNullSafe(F.col("_fc"))
                  & (F.substr("_h", F.lit(1), F.lit(length)) == F.col("_fp")))
        .groupBy("_c", "_j", "_base", "_r",
                 F.substr("_h", F.lit(1), F.lit(target)).alias("_p"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    located = counts.withColumn("_before", F.col("_base") + _before("_c", "_j"))
    return located.withColumnRenamed("_r", "_rank").where(_holds_rank()).select(
        "_c", "_p", "_n", "_before", "_j", "_rank")


def _thresholds(rows: DataFrame, cuts, digits: int, resolve_rows: int) -> Settled:
    """One row per class and cut: the hash at that rank, and its copies."""
    found = _first_pass(rows, cuts)
    length = PREFIXES[0]
    while (found.peak("_n") or 0) > resolve_rows:
        longer = [p for p in PREFIXES if length < p < digits]
        if not longer:
            break
        found = settle(_next_pass(rows, found.df, length, longer[0]))
        length = longer[0]
    exact = _next_pass(rows, found.df, length, digits)
    partial = (F.col("_rank") > F.col("_before")) & (
        F.col("_rank") < F.col("_before") + F.col("_n"))
    return settle(exact.select(
        "_c", "_j", F.when(F.col("_rank") == 0, "").otherwise(F.col("_p")).alias("_t"),
        "_n", "_before", "_rank", F.when(partial, 1).otherwise(0).alias("_partial"),
    ))


def _per_class(found: Settled, n: int) -> DataFrame:
    """One row per class: hash and rank of every cut, and the hashes that a cut splits."""
    if found.table is None:
        at = F.col("_j")
        return settle(found.df.groupBy(F.col("_c").alias("_fc")).agg(
            *[F.max(F.when(at == j, F.col("_t"))).alias(f"_t{j}") for j in range(n)],
            *[F.max(F.when(at == j, F.col("_rank"))).alias(f"_r{j}") for j in range(n)],
            F.collect_set(F.when(F.col("_partial") == 1, F.col("_t"))).alias("_split"),
        )).df
    classes: dict = {}
    for row in found.table.to_pylist():
        t, r, split = classes.setdefault(row["_c"], ([""] * n, [0] * n, []))
        t[row["_j"]], r[row["_j"]] = row["_t"], row["_rank"]
        if row["_partial"]:
            split.append(row["_t"])
    columns = [pa.array(list(classes), found.table.schema.field("_c").type)]
    columns += [pa.array([v[0][j] for v in classes.values()], pa.string()) for j in range(n)]
    columns += [pa.array([v[1][j] for v in classes.values()], pa.int64()) for j in range(n)]
    columns.append(pa.array([v[2] for v in classes.values()], pa.list_(pa.string())))
    names = ["_fc", *[f"_t{j}" for j in range(n)], *[f"_r{j}" for j in range(n)], "_split"]
    local = pa.Table.from_arrays(columns, names=names)
    return F.broadcast(found.df.sparkSession.createDataFrame(local))


def rank_segments(
    df: DataFrame,
    cuts: Sequence[Callable[[Column], Column]],
    label: str | None = None,
    key_cols: Sequence[str] | None = None,
    seed: int = 42,
    out: str = "segment",
    resolve_rows: int = RESOLVE_ROWS,
) -> DataFrame:
    """Adds `out`: how many of the cuts lie before the row in its class.

    Each cut maps the class size to a rank; cuts must not decrease. `label=None` takes
    the table as one class. Rows are ordered by the hash of `key_cols` (default: all
    columns); rows that share a key are ordered by their content, and copies of one
    row are numbered, so every segment has exactly its size.
    """
    columns = df.columns
    h = key_hash(key_cols, seed) if key_cols else row_hash(df, seed)
    c = col(label) if label else F.lit(0)
    rows = df.select(c.alias("_c"), h.alias("_h"))
    found = _thresholds(rows, cuts, 32, resolve_rows)
    if found.peak("_partial") and key_cols:
        h = F.concat(h, row_hash(df, seed))
        rows = df.select(c.alias("_c"), h.alias("_h"))
        found = _thresholds(rows, cuts, 64, resolve_rows)

    limits = _per_class(found, len(cuts))
    keyed = df.withColumn("_h", h)
    if label:
        keyed = keyed.join(limits, c.eqNullSafe(F.col("_fc")))
    else:
        only = limits.head()
        if only is None:
            return df.withColumn(out, F.lit(0))
        keyed = keyed.withColumns(
            {n: F.lit(only[n]).cast(t) for n, t in limits.dtypes})
    after = [F.when(F.col("_h") > F.col(f"_t{j}"), 1).otherwise(0) for j in range(len(cuts))]
    segment = sum(after[1:], after[0])
    plain = [col(n) for n in columns]
    if not found.peak("_partial"):
        return keyed.select(*plain, segment.alias(out))

    # Copies of one row on both sides of a cut: count them, then write them out again
    # with their ranks, at most COPIES_PER_TASK from one input row. They are grouped by the
    # row's whole content, so that no hash decides what a copy is.
    is_split = F.array_contains("_split", F.col("_h"))
    whole = keyed.where(~is_split).select(*plain, segment.alias(out))
    bounds = found.df.where("_partial = 1").groupBy(
        F.col("_c").alias("_bc"), F.col("_t").alias("_bh")).agg(F.max("_before").alias("_start"))
    copies = (
        keyed.where(is_split)
        .withColumn("_content", row_text(df))
        .groupBy("_fc", "_h", "_content")
        .agg(F.count(F.lit(1)).alias("_m"), F.first(F.struct(*plain)).alias("_row"),
             *[F.first(f"_r{j}").alias(f"_r{j}") for j in range(len(cuts))])
        .join(settle(bounds).df,
              F.col("_fc").eqNullSafe(F.col("_bc")) & (F.col("_h") == F.col("_bh")))
    )
    edges = [F.col("_start"), *[F.col(f"_r{j}") for j in range(len(cuts))],
             F.col("_start") + F.col("_m")]
    inside = [F.least(F.greatest(e, edges[0]), edges[-1]) for e in edges]
    parts = F.array(*[
        F.struct(F.lit(s).alias("s"), (inside[s + 1] - inside[s]).alias("n"))
        for s in range(len(cuts) + 1)
    ])
    per_task = F.lit(COPIES_PER_TASK)
    again = (
        copies.select("_row", F.explode(parts).alias("_part"))
        .select("_row", F.col("_part.s").alias(out), F.col("_part.n").alias("_m"))
        .where("_m > 0")
        .withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1, per_task.cast("long"))))
        .repartition(F.col("_at"), F.col(out))
        .withColumn("_i", F.explode(F.sequence(
            F.lit(1).cast("long"), F.least(per_task, F.col("_m") - F.col("_at")))))
        .select(*[F.col("_row").getField(n).alias(n) for n in columns], out)
    )
    return whole.unionByName(again)
