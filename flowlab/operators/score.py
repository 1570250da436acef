"""Scoring rows with several models and voting on the class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from flowlab.functions.columns import col
from flowlab.functions.verdicts import one_vs_rest_probability, rules, top_probability, vote


def confidence(df: DataFrame, key: str) -> Column:
    """Highest class probability of a model's output, 1 where it gives none."""
    if f"{key}_probability" in df.columns:
        return top_probability(F.col(f"{key}_probability"), is_vector=True)
    if f"{key}_raw" in df.columns:
        return F.array_max(one_vs_rest_probability(vector_to_array(F.col(f"{key}_raw"))))
    return F.lit(1.0)


def predict_attacks(df: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """Adds `<key>_prediction` and `<key>_confidence` per model. Row-local: no shuffle."""
    kept = list(df.columns)
    out = df
    for key, model in models.items():
        scored = model.transform(out)
        scored = scored.withColumn(f"{key}_confidence", confidence(scored, key))
        scored = scored.withColumn(
            f"{key}_prediction", F.col(f"{key}_prediction").cast("bigint"))
        kept += [f"{key}_prediction", f"{key}_confidence"]
        out = scored.select(*[col(c) for c in kept])
    return out


def attack_probability(df: DataFrame, key: str, benign: int = 0) -> Column:
    """1 less a model's probability of the benign class: the score of a ROC over attacks."""
    if f"{key}_probability" in df.columns:
        shares = vector_to_array(F.col(f"{key}_probability"))
    else:
        shares = one_vs_rest_probability(vector_to_array(F.col(f"{key}_raw")))
    return F.lit(1.0) - F.get(shares, F.lit(benign))


def attack_scores(df: DataFrame, key: str, model: PipelineModel, benign: int = 0) -> DataFrame:
    """Adds `<key>_attack`, the probability that a row is of another class than `benign`."""
    scored = model.transform(df)
    return scored.select(*[col(c) for c in df.columns],
                         attack_probability(scored, key, benign).alias(f"{key}_attack"))


def majority_vote(df: DataFrame, predictions: Sequence[str], out: str = "vote") -> DataFrame:
    """Adds the most frequent of the predictions, the smallest class on a tie."""
    return df.withColumn(out, vote([col(p) for p in predictions]))


def majority_vote_long(
    df: DataFrame, row: Sequence[str], prediction: str = "prediction", out: str = "vote",
) -> DataFrame:
    """The same vote over one line per row and model."""
    return df.groupBy(*[col(c) for c in row]).agg(F.mode(col(prediction), True).alias(out))


def match_status(df: DataFrame, prediction: str, label: str = "label", out: str = "status") -> DataFrame:
    return df.withColumn(out, F.when(col(prediction) == col(label), "correct").otherwise("wrong"))


def prediction_table(
    df: DataFrame, keys: Sequence[str], best: str, label: str = "label",
    row: Sequence[str] = (),
) -> DataFrame:
    """True class and every model's class side by side, with the best model's
    confidence and whether it was right."""
    status = match_status(df, f"{best}_prediction", label)
    return status.select(
        *[col(c) for c in row], col(label).alias("true_class"),
        *[col(f"{k}_prediction").alias(k) for k in keys],
        col(f"{best}_confidence").alias("confidence"), "status")


def apply_rules(
    df: DataFrame, cases: Sequence[tuple[str, object]], otherwise: object = None,
    out: str = "rule_class",
) -> DataFrame:
    """Adds the class of the first (SQL predicate, class) rule that holds."""
    return df.withColumn(out, rules(cases, otherwise))
