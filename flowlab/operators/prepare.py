"""Merging, coercion, filling, encoding and scaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame, functions as F, types as T

from flowlab.functions.columns import NUMERIC_TEXT, col, missing, number
from flowlab.functions import small
from flowlab.functions.small import settle
from flowlab.operators.profile import numeric_columns
from flowlab.operators.quantiles import exact_quantiles
from flowlab.operators.ranges import cuts, ranks, with_dense_codes

# Indicator columns that a table may have.
MAX_COLUMNS = 5_000


def merge_sources(a: DataFrame, b: DataFrame) -> DataFrame:
    """Stacks two tables of differing columns, with nulls where a side has none."""
    return a.unionByName(b, allowMissingColumns=True)


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric strings to double; anything else becomes null."""
    def parse(c: str):
        text = col(c).cast("string")
        return F.when(text.rlike(NUMERIC_TEXT), text.try_cast("double"))

    return df.withColumns({c: parse(c) for c in columns})


def medians(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> dict[str, float | None]:
    columns = list(columns)
    if approximate:
        types = dict(df.dtypes)
        row = df.agg(*[F.percentile_approx(number(c, types[c]), 0.5).alias(f"m{i}")
                       for i, c in enumerate(columns)]).head()
        return dict(zip(columns, row))
    return {c: q[0] for c, q in exact_quantiles(df, columns, [0.5]).items()}


def fill_median(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False,
) -> DataFrame:
    """Missing numbers become the median of their column."""
    columns = list(columns or numeric_columns(df))
    types = dict(df.dtypes)
    mid = medians(df, columns, approximate)
    return df.withColumns({
        c: F.coalesce(number(c, types[c]), F.lit(mid[c]).cast("double")) for c in columns
    })


def categories(df: DataFrame, columns: Sequence[str], null_value: str | None = "unknown") -> DataFrame:
    """(column, category, code) with codes 0..k-1 per column, in the order of the column's
    own type: numbers by value, texts by code point. A missing value counts as the text
    `null_value`: sorted among texts, after all values of other types."""
    parts = [F.struct(F.lit(c).alias("column"), category(c, null_value).alias("category"),
                      *_order_of(c, df.schema[c].dataType, null_value)) for c in columns]
    order = [f"_o{i}" for i in range(len(KINDS))]
    found = (df.select(F.inline(F.array(*parts))).where("category is not null")
             .groupBy("column", "category", *order).agg(F.count(F.lit(1)).alias("n")).drop("n"))
    # Codes are places within ranges of values, plus all of the column's values in lower ranges.
    places = ranks(found, [F.col(c).asc() for c in ("column", *order, "category")], ["column"], "code")
    return places.select("column", "category", "code")


# What values are ordered by, one after the other: texts; whole parts and fractions of exact
# numbers; other numbers. Each column fills those of its own type and leaves the others null.
KINDS = ("string", "decimal(38,0)", "decimal(38,37)", "double")


def _order_of(c: str, kind: T.DataType, null_value: str | None) -> list:
    """The values of a column in the order of its own type, without loss."""
    value = col(c)
    text = whole = part = size = None
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        text = category(c, null_value)
    else:
        text = F.when(value.isNull(), category(c, null_value))
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            size = value.cast("double")
        elif isinstance(kind, T.DecimalType):
            whole = F.floor(value)
            part = (value - whole).cast(KINDS[2])
        elif isinstance(kind, T.DateType):
            whole = F.unix_date(value)
        elif isinstance(kind, T.TimestampType):
            whole = F.unix_micros(value)
        elif isinstance(kind, (T.IntegralType, T.BooleanType)):
            whole = value.cast("int") if isinstance(kind, T.BooleanType) else value
        else:
            text = category(c, null_value)
    return [(F.lit(None) if x is None else x).cast(k).alias(f"_o{i}")
            for i, (x, k) in enumerate(zip((text, whole, part, size), KINDS))]


def category(c: str, null_value: str | None):
    text = col(c).cast("string")
    return text if null_value is None else F.coalesce(text, F.lit(null_value))


def label_encode(
    df: DataFrame, columns: Sequence[str], null_value: str | None = "unknown",
    codes: DataFrame | None = None,
) -> DataFrame:
    """Categories to 0..k-1 in sorted order; a missing one counts as `null_value`.

    Columns of few categories are joined with their codes. For each of the others the rows are
    shuffled once, by ranges of its values, and numbered there."""
    many, rows = ([], 0) if codes is not None else _many(df, columns, null_value)
    few = [c for c in columns if c not in many]
    if codes is None and few:
        codes = settle(categories(df, few, null_value)).df
    out = df
    for i, c in enumerate(few):
        of_column = codes.where(F.col("column") == c).select(
            F.col("category").alias(f"_k{i}"), F.col("code").alias(f"_v{i}"))
        out = out.join(of_column, category(c, null_value) == F.col(f"_k{i}"), "left")
    encoded = {c: i for i, c in enumerate(few)}
    out = out.select(*[
        F.col(f"_v{encoded[c]}").alias(c) if c in encoded else col(c) for c in df.columns
    ])
    places = [_place_of(c, df.schema[c].dataType, null_value) for c in many]
    for c, (order, place), at in zip(many, places, cuts(df, [p for _, p in places], rows)):
        missing_ = col(c).isNull() if null_value is None else F.lit(False)
        out = with_dense_codes(out.withColumn("_none", missing_), df, order, place, at, c)
        out = out.withColumn(c, F.when(~F.col("_none"), col(c))).drop("_none")
    return out.select(*[col(c) for c in df.columns])


def _many(df: DataFrame, columns: Sequence[str], null_value: str | None) -> tuple[list[str], int]:
    """The columns that have too many categories to be broadcast together, by estimate, those of wide
    values first, as the later ones are shuffled without them; and the number of rows."""
    counts = df.agg(F.count(F.lit(1)), *[
        F.approx_count_distinct(category(c, null_value)) for c in columns]).head()
    many, total = [], 0
    for c, n in sorted(zip(columns, counts[1:]), key=lambda pair: pair[1]):
        total += n
        if total > small.MAX_LOCAL_ROWS * 0.8:  # estimates are a few hundredths off
            many.append(c)
    wide = {c: 2 if _is_text(df.schema[c].dataType) else isinstance(df.schema[c].dataType, T.DecimalType) for c in many}
    return sorted(many, key=lambda c: -wide[c]), counts[0]


def _is_text(kind: T.DataType) -> bool:
    """Whether a column is ordered by its values' texts."""
    return not isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType))


def _place_of(c: str, kind: T.DataType, null_value: str | None) -> tuple[list, object]:
    """What the categories of a column are ordered by, and a double or binary that follows it."""
    value = col(c)
    if _is_text(kind):
        text = category(c, null_value)
        return [text], text.cast("binary")
    if isinstance(kind, T.DateType):
        return [value], F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return [value], F.unix_micros(value).cast("double")
    number_ = value.cast("double")
    # 0.0 and -0.0 are two categories.
    return ([value, category(c, null_value)] if isinstance(kind, (T.FloatType, T.DoubleType)) else [value]), number_


def one_hot(
    df: DataFrame, columns: Sequence[str], null_value: str | None = "unknown", max_columns: int = MAX_COLUMNS,
) -> DataFrame:
    """A 0/1 column `<column>_<category>` per category, in place of the column. With more than
    `max_columns` of them this is an error; see `one_hot_vector` and the encoder."""
    found = settle(categories(df, columns, null_value), max_columns)
    if found.table is None:
        raise ValueError(f"more than {max_columns} categories; encode them as vectors")
    rows = found.df.orderBy("column", "code").collect()  # a column each
    kept = [col(c) for c in df.columns if c not in columns]
    flags = [
        F.coalesce((category(r["column"], null_value) == r["category"]).cast("int"), F.lit(0))
        .alias(f"{r['column']}_{r['category']}") for r in rows
    ]
    return df.select(*kept, *flags)


def one_hot_vector(df: DataFrame, columns: Sequence[str], out: str = "indicators") -> DataFrame:
    """The indicators of one column each as a sparse vector, for any number of categories."""
    names = [f"_i{n}" for n in range(len(columns))]
    outs = [out if len(columns) == 1 else f"{out}_{c}" for c in columns]
    stages = [
        StringIndexer(inputCols=list(columns), outputCols=names,
                      stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=names, outputCols=outs, dropLast=False),
    ]
    return Pipeline(stages=stages).fit(df).transform(df).drop(*names)


def assert_numeric(df: DataFrame) -> DataFrame:
    """Returns the table if every column is numeric and nothing is missing."""
    odd = sorted(set(df.columns) - set(numeric_columns(df)))
    if odd:
        raise ValueError(f"not numeric: {odd}")
    holes = df.agg(*[F.count_if(missing(col(c), t)).alias(f"n{i}")
                     for i, (c, t) in enumerate(df.dtypes)]).head()
    bad = {c: n for c, n in zip(df.columns, holes) if n}
    if bad:
        raise ValueError(f"missing values: {bad}")
    return df


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[col(c) for c in df.columns if c not in set(columns)])


def split_xy(df: DataFrame, label: str = "label") -> tuple[DataFrame, DataFrame]:
    """Features and target."""
    return drop_columns(df, [label]), df.select(col(label))


def align_features(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The model's columns in training order; a missing one is an error."""
    return df.select(*[col(c) for c in (*names, *keep)])


@dataclass(frozen=True)
class Scaling:
    """Mean and population standard deviation per feature."""

    mean: dict[str, float]
    std: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        def scaled(c: str):
            s = self.std[c] or 1.0
            return (col(c).cast("double") - F.lit(self.mean[c])) / F.lit(s)

        return df.select(*[
            scaled(c).alias(c) if c in self.mean else col(c) for c in df.columns])


def fit_scaling(train: DataFrame, columns: Sequence[str]) -> Scaling:
    columns = list(columns)
    row = train.agg(
        *[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(col(c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).head()
    p = len(columns)
    return Scaling(dict(zip(columns, row[:p])), dict(zip(columns, row[p:])))


def standardize(
    train: DataFrame, test: DataFrame, columns: Sequence[str],
) -> tuple[DataFrame, DataFrame]:
    """Both sides scaled by the statistics of the training side."""
    scaling = fit_scaling(train, columns)
    return scaling.apply(train), scaling.apply(test)


def scaled_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and standard deviation over all cells: about 0 and 1 for scaled features."""
    columns = list(columns)
    parts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.var_pop(col(c)).alias(f"v{i}") for i, c in enumerate(columns)],
    )
    p = float(len(columns))
    means = [F.col(f"m{i}") for i in range(len(columns))]
    mean = sum(means[1:], means[0]) / p
    spread = [F.col(f"v{i}") + (m - F.col("mean")) * (m - F.col("mean"))
              for i, m in enumerate(means)]
    return parts.withColumn("mean", mean).select(
        "mean", F.sqrt(sum(spread[1:], spread[0]) / p).alias("std"))


def class_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Adds the balanced weight rows / (classes * class size)."""
    sizes = settle(
        df.groupBy(col(label).alias("_c")).agg(F.count(F.lit(1)).alias("_n")))
    rows, classes = sizes.df.agg(F.sum("_n"), F.count(F.lit(1))).head()
    weights = sizes.df.withColumn(out, F.lit(float(rows or 0)) / (F.lit(classes) * F.col("_n")))
    return df.join(weights.drop("_n"), col(label).eqNullSafe(F.col("_c"))).drop("_c")
