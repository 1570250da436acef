"""Samples, splits and folds, exact per class and repeatable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlab.functions.columns import col, key_hash, row_hash
from flowlab.functions.small import settle
from flowlab.operators.ranks import rank_segments


def _order(df: DataFrame, key_cols: Sequence[str] | None, seed: int) -> list[Column]:
    """Keyed order of the rows; rows that share a key follow their content."""
    content = row_hash(df, seed)
    return [key_hash(key_cols, seed), content] if key_cols else [content]


def sample_n(
    df: DataFrame, n: int, key_cols: Sequence[str] | None = None, seed: int = 42,
) -> DataFrame:
    """n random rows, the same ones on every run."""
    part = rank_segments(df, [lambda size: F.lit(n)], None, key_cols, seed, "_segment")
    return part.where("_segment = 0").drop("_segment")


def stratified_sample(
    df: DataFrame, label: str, fraction: float = 0.12,
    key_cols: Sequence[str] | None = None, seed: int = 42,
) -> DataFrame:
    """Keeps round(fraction * size) rows of every class."""
    part = rank_segments(df, [lambda size: F.round(size * F.lit(float(fraction)))],
                         label, key_cols, seed, "_segment")
    return part.where("_segment = 0").drop("_segment")


def approximate_sample(
    df: DataFrame, fraction: float = 0.12, key_cols: Sequence[str] | None = None, seed: int = 42,
) -> DataFrame:
    """Keeps each row whose hash is in the lowest `fraction` of all hashes: one scan, no ranks and
    no shuffle, the same rows on every run and whatever else the table holds.

    Class sizes are exact on average only: of n rows with hashes of their own, n * fraction are
    kept, give or take sqrt(n * fraction * (1 - fraction)) in two classes of three; rows that
    share a key stay or go together. `sample_errors` holds a sample against that."""
    limit = min(max(round(fraction * 16 ** 32), 0), 16 ** 32)
    if limit == 16 ** 32:
        return df
    return df.where(_order(df, key_cols, seed)[0] < f"{limit:032x}")


def sample_errors(df: DataFrame, sample: DataFrame, label: str, fraction: float) -> DataFrame:
    """Per class: rows, kept rows, the expected number, and how many standard errors lie between."""
    sizes = df.groupBy(col(label).alias(label)).agg(F.count(F.lit(1)).alias("rows"))
    kept = sample.groupBy(col(label).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    expected = F.col("rows") * F.lit(fraction)
    error = F.sqrt(expected * F.lit(1.0 - fraction))
    n = F.coalesce("_n", F.lit(0))
    return sizes.join(kept, col(label).eqNullSafe(F.col("_c")), "left").select(
        label, "rows", n.alias("kept"), expected.alias("expected"),
        F.coalesce(F.try_divide(n - expected, error), F.lit(0.0)).alias("errors_off"))


def random_split(
    df: DataFrame, fraction: float = 0.2, key_cols: Sequence[str] | None = None,
    seed: int = 42, out: str = "is_test",
) -> DataFrame:
    """Flags round(fraction * rows) rows as test, whatever their class."""
    part = rank_segments(df, [lambda size: F.round(size * F.lit(float(fraction)))],
                         None, key_cols, seed, "_segment")
    return part.withColumn(out, F.col("_segment") == 0).drop("_segment")


def stratified_split(
    df: DataFrame, label: str, fraction: float = 0.2,
    key_cols: Sequence[str] | None = None, seed: int = 42, out: str = "is_test",
) -> DataFrame:
    """Flags round(fraction * size) rows of every class as test. With a class of fewer
    than two rows the split ignores the classes, as a stratified one is impossible."""
    smallest = df.groupBy(col(label)).count().agg(F.min("count")).head()[0]
    if smallest is not None and smallest < 2:
        return random_split(df, fraction, key_cols, seed, out)
    part = rank_segments(df, [lambda size: F.round(size * F.lit(float(fraction)))],
                         label, key_cols, seed, "_segment")
    return part.withColumn(out, F.col("_segment") == 0).drop("_segment")


def split_summary(df: DataFrame, flag: str = "is_test") -> DataFrame:
    """Rows and percentage on each side of a split."""
    total = F.sum(F.col("n")).over(Window.partitionBy(F.lit(1)))
    sides = df.groupBy(flag).agg(F.count(F.lit(1)).alias("n"))  # two rows
    return sides.withColumn("pct", F.lit(100.0) * F.col("n") / total)


def assign_folds(
    df: DataFrame, label: str, k: int = 3, key_cols: Sequence[str] | None = None,
    seed: int = 42, out: str = "fold",
) -> DataFrame:
    """Fold 0..k-1 for every row; fold sizes differ by at most one within a class."""
    def upto(j: int):
        # The first size % k folds get the extra rows.
        return lambda size: j * F.floor(size / k) + F.least(F.lit(j), size % k)

    return rank_segments(df, [upto(j) for j in range(1, k)], label, key_cols, seed, out)


def per_class_sample(
    df: DataFrame, label: str, n: int = 2000,
    key_cols: Sequence[str] | None = None, seed: int = 42,
) -> DataFrame:
    """At most max(1, n // classes) rows of each class, shuffled, n rows in all."""
    classes = df.select(col(label)).distinct().count()
    each = max(1, n // max(classes, 1))
    part = rank_segments(df, [lambda size: F.lit(each)], label, key_cols, seed, "_segment")
    return sample_n(part.where("_segment = 0").drop("_segment"), n, key_cols, seed + 1)


def cv_subsample(
    df: DataFrame, label: str, n: int = 30_000, key_cols: Sequence[str] | None = None,
    seed: int = 42, min_rows: int = 3,
) -> DataFrame:
    """A class-proportional sample of about n rows for cross-validation.

    Class c gives max(min_rows, floor(n * size_c / rows)) rows; a class that is smaller
    than that gives its rows again. The sample is cut to n rows unless that would leave
    a class with fewer than min_rows.
    """
    sizes = df.groupBy(col(label).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    known = settle(sizes)
    total, classes = known.df.agg(F.sum("_n"), F.count(F.lit(1))).head()
    if not total:
        return df

    def quota(size: Column) -> Column:
        return F.greatest(F.lit(min_rows), F.floor(size * F.lit(n) / F.lit(total)))

    part = rank_segments(df, [quota], label, key_cols, seed, "_segment")
    sample = part.where("_segment = 0").drop("_segment")

    tiny = known.df.where(F.col("_n") < min_rows)
    if known.df.agg(F.min("_n")).head()[0] < min_rows:
        # Fewer than min_rows rows per class here, so this window is small by definition.
        rank = F.row_number().over(Window.partitionBy("_c").orderBy(*_order(df, key_cols, seed)))
        again = F.floor((F.lit(min_rows) - F.col("_i")) / F.col("_n"))
        extra = (
            sample.join(tiny, col(label).eqNullSafe(F.col("_c")))
            .withColumn("_i", rank)
            .where(again >= 1)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), again.cast("long"))))
        )
        sample = sample.unionByName(extra.select(*[col(c) for c in df.columns]))

    planned = known.df.agg(F.sum(quota(F.col("_n")))).head()[0]
    if planned <= n:
        return sample
    cut = sample_n(sample, n, key_cols, seed + 1)
    left = cut.groupBy(col(label)).count().agg(F.count(F.lit(1)), F.min("count")).head()
    return cut if left[0] == classes and left[1] >= min_rows else sample


def ensure_classes(
    part: DataFrame, full: DataFrame, label: str,
    key_cols: Sequence[str] | None = None, seed: int = 42, classes: DataFrame | None = None,
) -> DataFrame:
    """Adds one row from `full` for every class that `part` lost. `classes` may name a
    smaller table that is known to hold every class; `full` is then read only if needed."""
    present = part.select(col(label).alias("_pc")).distinct()
    absent = settle(
        (full if classes is None else classes).select(col(label).alias("_c")).distinct()
        .join(present, F.col("_c").eqNullSafe(F.col("_pc")), "left_anti")
    )
    if absent.table is not None and absent.table.num_rows == 0:
        return part
    columns = part.columns
    first = (
        full.join(absent.df, col(label).eqNullSafe(F.col("_c")), "left_semi")
        .groupBy(col(label).alias("_c"))
        .agg(F.min_by(F.struct(*[col(c) for c in columns]), F.struct(*_order(full, key_cols, seed))).alias("_row"))
    )
    return part.unionByName(
        first.select(*[F.col("_row").getField(c).alias(c) for c in columns])
    )
