"""Feature selection: redundant pairs and near-constant columns."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import takewhile

from pyspark.sql import DataFrame, functions as F

from flowlab.functions.columns import col
from flowlab.functions.small import local_rows
from flowlab.operators.prepare import drop_columns
from flowlab.operators.profile import COLUMNS_PER_PASS, correlation, mean_abs_correlation

# Fixed values: |r| of a redundant pair, and the variance below which a column is flat.
THRESHOLD = 0.90
MIN_VARIANCE = 1e-5


def correlated_pairs(corr: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs with |r| at or over the threshold, and the side with the lower mean |r|."""
    mean = mean_abs_correlation(corr).select("feature", "mean_abs_r")
    first = mean.select(F.col("feature").alias("feature_i"), F.col("mean_abs_r").alias("mean_i"))
    second = mean.select(F.col("feature").alias("feature_j"), F.col("mean_abs_r").alias("mean_j"))
    pairs = corr.where((F.col("pos_i") < F.col("pos_j")) & (F.abs("r") >= threshold))
    weaker = F.when(F.col("mean_j") >= F.col("mean_i"), F.col("feature_i")).otherwise(F.col("feature_j"))
    return (pairs.join(first, "feature_i").join(second, "feature_j")
            .select("feature_i", "feature_j", "r", weaker.alias("weaker")))


def redundant_features(
    columns: Sequence[str], r: dict[tuple[str, str], float | None], threshold: float = THRESHOLD,
) -> list[str]:
    """The columns to drop. Columns are visited in table order and compared with the
    earlier ones that still stand; of a redundant pair the one with the lower mean |r|
    goes, and on a tie the earlier one. Means include the diagonal and never change."""
    strength = {}
    for a in columns:
        known = [abs(r[a, b]) for b in columns if r[a, b] is not None]
        strength[a] = sum(known) / len(known) if known else float("nan")
    standing: list[str] = []
    for current in columns:
        # The earlier ones that stand and are redundant with this one, up to the first that
        # is stronger: this one drops those before it, and falls to that one if there is one.
        rivals = [e for e in standing if r[e, current] is not None and abs(r[e, current]) >= threshold]
        weaker = list(takewhile(lambda e: strength[current] >= strength[e], rivals))
        standing = [e for e in standing if e not in weaker]
        if len(weaker) == len(rivals):
            standing.append(current)
    return [c for c in columns if c not in standing]


def low_variance_features(
    df: DataFrame, columns: Sequence[str], minimum: float = MIN_VARIANCE,
) -> list[str]:
    """Columns whose sample variance is below the minimum."""
    columns = list(columns)
    low = []
    for at in range(0, len(columns), COLUMNS_PER_PASS):
        part = columns[at:at + COLUMNS_PER_PASS]
        row = df.agg(*[F.var_samp(col(c)).alias(f"v{i}") for i, c in enumerate(part)]).head()
        low += [c for c, v in zip(part, row) if v is not None and v < minimum]
    return low


def drop_low_variance(df: DataFrame, label: str = "label", minimum: float = MIN_VARIANCE) -> DataFrame:
    features = [c for c in df.columns if c != label]
    return drop_columns(df, low_variance_features(df, features, minimum))


def select_uncorrelated(
    df: DataFrame, label: str = "label", threshold: float = THRESHOLD, pairwise: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The table without redundant features, and a report (position, feature, kept)."""
    features = [c for c in df.columns if c != label]
    rows = correlation(df, features, pairwise).collect()  # p * p values
    r = {(x["feature_i"], x["feature_j"]): x["r"] for x in rows}
    gone = set(redundant_features(features, r, threshold))
    report = local_rows(df.sparkSession, [(i, c, c not in gone) for i, c in enumerate(features)],
                        "position int, feature string, kept boolean")
    return drop_columns(df, gone), report
