"""Profiles of a wide table: shape, types, nulls, statistics, classes, correlations."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlab.functions.columns import col, missing, number
from flowlab.functions.small import local_rows
from flowlab.operators.quantiles import exact_quantiles

NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")
QUARTILES = (0.25, 0.5, 0.75)
# Columns aggregated in one pass; wider tables take several.
COLUMNS_PER_PASS = 40


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC or t.startswith("decimal")]


def shape(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows, columns and features."""
    features = len([c for c in df.columns if c != label])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.lit(features).alias("features"),
    )


def dtypes(df: DataFrame) -> DataFrame:
    rows = [(i, c, t) for i, (c, t) in enumerate(df.dtypes)]
    return local_rows(df.sparkSession, rows, "position int, column string, dtype string")


def dtype_counts(df: DataFrame) -> DataFrame:
    return dtypes(df).groupBy("dtype").agg(F.count(F.lit(1)).alias("columns"))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls (or NaN) per column, for the columns that have any."""
    counts = df.agg(*[
        F.count_if(missing(col(c), t)).alias(f"n{i}") for i, (c, t) in enumerate(df.dtypes)
    ])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"))
        for i, c in enumerate(df.columns)
    ])
    return counts.select(F.inline(pairs)).where("nulls > 0")


def null_total(df: DataFrame) -> DataFrame:
    return null_counts(df).agg(F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"))


def describe(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False,
) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, quartiles and maximum.

    Quartiles are exact unless `approximate` is set, which takes a single pass.
    """
    columns = list(columns or numeric_columns(df))
    types = dict(df.dtypes)
    stats: dict[str, tuple] = {}
    for at in range(0, len(columns), COLUMNS_PER_PASS):
        part = columns[at:at + COLUMNS_PER_PASS]
        exprs = []
        for c in part:
            x = number(c, types[c])
            exprs += [F.count(x), F.avg(x), F.stddev_samp(x), F.min(x), F.max(x),
                      F.percentile_approx(x, list(QUARTILES)) if approximate else F.lit(None)]
        row = df.agg(*[e.alias(f"a{i}") for i, e in enumerate(exprs)]).head()
        stats.update({c: tuple(row[6 * i:6 * i + 6]) for i, c in enumerate(part)})
    if approximate:
        quartiles = {c: stats[c][5] or [None] * 3 for c in columns}
    else:
        known = {c: (s[0], s[3], s[4]) for c, s in stats.items()}
        quartiles = exact_quantiles(df, columns, QUARTILES, known)
    rows = [
        (c, stats[c][0], stats[c][1], stats[c][2], stats[c][3], *quartiles[c], stats[c][4])
        for c in columns
    ]
    return local_rows(df.sparkSession, rows,
                      "feature string, count bigint, mean double, std double, min double, "
                      "p25 double, p50 double, p75 double, max double")


def head(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """The first n rows in order of the given columns, or of all."""
    return df.orderBy(*[col(c) for c in order_by or df.columns]).limit(n)


def class_distribution(df: DataFrame, label: str = "label", top: int | None = None) -> DataFrame:
    """Rows per class, largest first, ties by class."""
    counts = df.groupBy(col(label).alias(label)).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), col(label))
    return ordered.limit(top) if top else ordered


def label_summary(df: DataFrame, label: str = "label") -> DataFrame:
    """Number of classes and their range."""
    classes = df.select(col(label).alias("c")).where("c is not null").distinct()
    return classes.agg(F.count(F.lit(1)).alias("classes"), F.min("c").alias("min_label"),
                       F.max("c").alias("max_label"))


def imbalance(df: DataFrame, label: str = "label") -> DataFrame:
    """Largest to smallest class size; ties go to the smaller class."""
    counts = df.groupBy(col(label).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    largest = F.struct((-F.col("n")).alias("n"), F.col("c").alias("c"))
    smallest = F.struct(F.col("n").alias("n"), F.col("c").alias("c"))
    ends = counts.agg(F.min(largest).alias("big"), F.min(smallest).alias("small"))
    return ends.select(
        (-F.col("big.n")).alias("max_n"), F.col("big.c").alias("max_label"),
        F.col("small.n").alias("min_n"), F.col("small.c").alias("min_label"),
        (-F.col("big.n") / F.col("small.n")).alias("ratio"),
    )


def correlation(
    df: DataFrame, columns: Sequence[str] | None = None, pairwise: bool = False,
) -> DataFrame:
    """Pearson r for all ordered pairs, in long form; null where a column is constant.

    The default takes a table without nulls, in one distributed pass over centred
    vectors. `pairwise=True` skips, for each pair, the rows where either side is missing.
    """
    columns = list(columns or numeric_columns(df))
    types = dict(df.dtypes)
    r = _pairwise(df, columns, types) if pairwise else _complete(df, columns)
    rows = [(a, b, i, j, r[i, j]) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return local_rows(df.sparkSession, rows, "feature_i string, feature_j string, "
                      "pos_i int, pos_j int, r double")


def _complete(df: DataFrame, columns: list[str]) -> dict:
    values = df.select(*[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    rows = VectorAssembler(inputCols=values.columns, outputCol="v").transform(values).select("v")
    matrix = Correlation.corr(rows, "v").head()[0].toArray()
    r = {(i, j): float(v) if v == v else None for (i, j), v in np.ndenumerate(matrix)}
    if len(columns) == 1 or any(v is None for v in r.values()):
        # The diagonal comes back as 1 even for a constant column.
        ends = values.agg(*[(F.min(c) == F.max(c)).alias(c) for c in values.columns]).head()
        r.update({(i, i): None for i, flat in enumerate(ends) if flat})
    return r


def _pairwise(df: DataFrame, columns: list[str], types: dict) -> dict:
    """Masked sums of products of all pairs, in one pass about the columns' means."""
    p = len(columns)
    xs = [number(c, types[c]).alias(f"x{i}") for i, c in enumerate(columns)]
    values = df.select(*xs)
    centre = [m or 0.0 for m in values.agg(*[F.avg(c).alias(c) for c in values.columns]).head()]

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, p, p))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            held = ~np.isnan(x)
            x, held = np.where(held, x - centre, 0.0), held.astype(float)
            total += [held.T @ held, x.T @ held, (x * x).T @ held, x.T @ x]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "v"])

    total = np.zeros(4 * p * p)
    for at, v in values.mapInArrow(sums, "at long, v double").groupBy("at").agg(F.sum("v")).collect():
        total[at] = v  # 4 * p * p values
    n, s, ss, cross = total.reshape(4, p, p)
    r: dict = {}
    for i in range(p):
        for j in range(p):
            if n[i, j] < 2:
                r[i, j] = None
                continue
            # s[i, j]: sum of column i over the rows that also have j.
            spread = [ss[a, b] - s[a, b] ** 2 / n[i, j] for a, b in ((i, j), (j, i))]
            flat = any(v <= 1e-12 * ss[a, b] for v, (a, b) in zip(spread, ((i, j), (j, i))))
            r[i, j] = None if flat else float(
                (cross[i, j] - s[i, j] * s[j, i] / n[i, j]) / np.sqrt(spread[0] * spread[1]))
    return r


def lower_triangle(corr: DataFrame) -> DataFrame:
    """The strict lower triangle, as a heat map shows it."""
    return corr.where("pos_j < pos_i")


def upper_triangle(corr: DataFrame) -> DataFrame:
    return corr.where("pos_i < pos_j")


def mean_abs_correlation(corr: DataFrame) -> DataFrame:
    """Mean |r| per feature, the diagonal included, undefined r skipped."""
    return corr.groupBy(F.col("feature_i").alias("feature"), F.col("pos_i").alias("pos")).agg(
        F.avg(F.abs("r")).alias("mean_abs_r"))


def top_correlated(corr: DataFrame, k: int = 8) -> DataFrame:
    return (mean_abs_correlation(corr).orderBy(F.desc_nulls_last("mean_abs_r"), "pos")
            .limit(k).select("feature", "mean_abs_r"))


def feature_histogram(
    df: DataFrame, feature: str, label: str = "label", bins: int = 20,
    bounds: tuple[float, float] | None = None,
) -> DataFrame:
    """Rows per class in equal-width bins over the range of a feature."""
    x = number(feature, dict(df.dtypes)[feature])
    if bounds is None:
        bounds = tuple(df.agg(F.min(x), F.max(x)).head())
    low, high = bounds
    if low is None:
        return df.groupBy(col(label).alias(label), F.lit(0).alias("bin")).count().where("false") \
            .select(label, "bin", F.col("count").alias("n"))
    width = (high - low) / bins or 1.0
    at = F.floor((x - F.lit(low)) / F.lit(width)).cast("int")
    return (
        df.where(x.isNotNull())
        .groupBy(col(label).alias(label), F.least(F.greatest(at, F.lit(0)), F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _bounds(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Each feature's least and greatest finite value, from one scan; (0, 0) without any."""
    types = dict(df.dtypes)
    values = [_finite(f, types[f]) for f in features]
    found = df.agg(*[a for v in values for a in (F.min(v), F.max(v))]).head()
    return {f: (found[2 * i], found[2 * i + 1]) if found[2 * i] is not None else (0.0, 0.0)
            for i, f in enumerate(features)}


def _finite(name: str, kind: str) -> Column:
    x = number(name, kind)
    return F.when(F.abs(x) < F.lit(float("inf")), x)


def _bin(x: Column, low: float, high: float, bins: int) -> Column:
    width = (high - low) / bins or 1.0
    at = F.least(F.greatest(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(0)), F.lit(bins - 1))
    return F.when(x.isNotNull(), at.cast("int"))


def pair_panels(
    df: DataFrame, features: Sequence[str], label: str = "label", bins: int = 20,
) -> DataFrame:
    """(feature_x, feature_y, label, bin_x, bin_y, n): rows per class in the cells of a grid over
    every two features, empty cells left out, from one scan for the bounds and one for the cells.
    A row that lacks either value (missing or infinite) is in no cell of that pair."""
    types, bounds = dict(df.dtypes), _bounds(df, features)
    at = {f: _bin(_finite(f, types[f]), *bounds[f], bins) for f in features}
    binned = df.select(col(label).alias(label), *[at[f].alias(f"_b{i}") for i, f in enumerate(features)])
    pairs = [F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"),
                      F.col(f"_b{i}").alias("bin_x"), F.col(f"_b{j}").alias("bin_y"))
             for i, a in enumerate(features) for j, b in enumerate(features) if i < j]
    return (binned.select(label, F.inline(F.array(*pairs))).where("bin_x IS NOT NULL AND bin_y IS NOT NULL")
            .groupBy("feature_x", "feature_y", col(label).alias(label), "bin_x", "bin_y")
            .agg(F.count(F.lit(1)).alias("n")))


def smooth_density(
    df: DataFrame, features: Sequence[str], label: str = "label", bins: int = 200,
) -> DataFrame:
    """(feature, label, at, density): each class's smooth density of each feature at the centres
    of `bins` bins, by a Gaussian kernel whose width is the class's deviation times n ^ -1/5.

    The kernel sums run over the bins' counts, not the rows: one scan for the bounds, one for the
    counts. A class whose values don't vary, or with fewer than two of them, has no density."""
    types, bounds = dict(df.dtypes), _bounds(df, features)
    values = [F.struct(F.lit(f).alias("feature"), _finite(f, types[f]).alias("_x"),
                       _bin(_finite(f, types[f]), *bounds[f], bins).alias("_b")) for f in features]
    rows = df.select(col(label).alias(label), F.inline(F.array(*values))).where("_x IS NOT NULL")
    cells = rows.groupBy("feature", col(label).alias(label), "_b").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_x").alias("_s"),
        F.var_pop("_x").alias("_v"))
    # A class's mean and deviation from those of its bins; features x classes x bins rows.
    part = Window.partitionBy("feature", label)
    known = (cells.withColumn("_all", F.sum("_n").over(part)).withColumn("_mean", F.sum("_s").over(part) / F.col("_all"))
             .withColumn("_m2", F.sum(F.col("_n") * (F.col("_v") + F.pow(F.col("_s") / F.col("_n") - F.col("_mean"), 2))).over(part))
             .where("_all > 1 AND _m2 > 0")
             .withColumn("_h", F.sqrt(F.col("_m2") / (F.col("_all") - 1)) * F.pow("_all", F.lit(-0.2))))
    spans = F.create_map(*[x for f in features for x in (F.lit(f), F.array(
        F.lit(float(bounds[f][0])), F.lit((bounds[f][1] - bounds[f][0]) / bins or 1.0)))])
    low, width = spans[F.col("feature")][0], spans[F.col("feature")][1]
    # Each bin's mean stands for its rows: closer to the sum over the rows than its centre.
    each = known.withColumn("at", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: low + (i + 0.5) * width)))
    z = (F.col("at") - F.col("_s") / F.col("_n")) / F.col("_h")
    kernel = F.col("_n") * F.exp(-0.5 * z * z) / (F.col("_all") * F.col("_h") * F.sqrt(2 * F.pi()))
    return each.groupBy("feature", label, "at").agg(F.sum(kernel).alias("density"))
