"""From an encoded table to a clean one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from flowlab.operators.prepare import drop_columns
from flowlab.operators.select import (
    MIN_VARIANCE, THRESHOLD, low_variance_features, select_uncorrelated,
)


def clean(
    df: DataFrame, label: str = "label", exclude: Sequence[str] = (),
    threshold: float = THRESHOLD, minimum: float = MIN_VARIANCE, pairwise: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Leave out named columns, redundant features, then near-constant ones. `pairwise`
    takes tables with missing values: each pair is compared where both are known."""
    kept, report = select_uncorrelated(drop_columns(df, exclude), label, threshold, pairwise)
    flat = low_variance_features(kept, [c for c in kept.columns if c != label], minimum)
    return drop_columns(kept, flat), report
