"""Metrics, all derived from the counts of (label, prediction)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlab.functions.columns import col, ratio
from flowlab.functions.verdicts import MILD, gap_verdict
from flowlab.operators.ranges import RANGE, ranged, with_totals_before


def confusion_counts(
    df: DataFrame, label: str = "label", prediction: str = "prediction",
) -> DataFrame:
    """Rows per (label, prediction) that occurs."""
    return df.groupBy(col(label).cast("bigint").alias("label"),
                      col(prediction).cast("bigint").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """The counts over all classes on either side, with zeros."""
    classes = counts.agg(F.array_sort(F.array_union(
        F.collect_set("label"), F.collect_set("prediction"))).alias("classes"))
    grid = classes.select(F.explode("classes").alias("label"), "classes").select(
        "label", F.explode("classes").alias("prediction"))
    return grid.join(counts, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def accuracy(counts: DataFrame) -> DataFrame:
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    return counts.agg(ratio(right, F.sum("n")).alias("accuracy"))


def class_totals(counts: DataFrame) -> DataFrame:
    """Support, predicted and correct rows per class on either side."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"),
                 zero.alias("predicted"), hit.cast("bigint").alias("correct")),
        F.struct(F.col("prediction").alias("class"), zero.alias("support"),
                 F.col("n").alias("predicted"), zero.alias("correct")),
    )
    return counts.select(F.inline(sides)).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "correct")])


def report_from_totals(totals: DataFrame) -> DataFrame:
    correct, support, predicted = F.col("correct"), F.col("support"), F.col("predicted")
    return totals.select(
        "class",
        ratio(correct, predicted).alias("precision"),
        ratio(correct, support).alias("recall"),
        ratio(2 * correct, support + predicted).alias("f1"),
        "support",
    )


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where undefined."""
    return report_from_totals(class_totals(counts))


def macro_avg(report: DataFrame) -> DataFrame:
    return report.agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1")],
                      F.sum("support").alias("support"))


def weighted_avg(report: DataFrame) -> DataFrame:
    return report.agg(
        *[ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c)
          for c in ("precision", "recall", "f1")],
        F.sum("support").alias("support"))


def diagonal(counts: DataFrame) -> DataFrame:
    """Correct and all rows per class, with the percentage."""
    return class_totals(counts).select(
        "class", "correct", F.col("support").alias("total"),
        (F.lit(100.0) * ratio(F.col("correct"), F.col("support"))).alias("pct"))


def summary(counts: DataFrame) -> DataFrame:
    """Accuracy, weighted F1 and macro F1 in one row."""
    totals = class_totals(counts)
    f1 = ratio(2 * F.col("correct"), F.col("support") + F.col("predicted"))
    return totals.agg(
        ratio(F.sum("correct"), F.sum("support")).alias("accuracy"),
        ratio(F.sum(f1 * F.col("support")), F.sum("support")).alias("f1_weighted"),
        F.coalesce(F.avg(f1), F.lit(0.0)).alias("f1_macro"),
    )


def overfitting_gap(counts: DataFrame, flag: str = "is_test") -> DataFrame:
    """Train accuracy - test accuracy from counts that carry the split flag."""
    def side(test: bool) -> Column:
        mine = F.col(flag) if test else ~F.col(flag)
        right = mine & (F.col("label") == F.col("prediction"))
        return ratio(F.sum(F.when(right, F.col("n")).otherwise(0)),
                     F.sum(F.when(mine, F.col("n")).otherwise(0)))

    both = counts.agg(side(False).alias("train_accuracy"), side(True).alias("test_accuracy"))
    gap = both.withColumn("gap", F.col("train_accuracy") - F.col("test_accuracy"))
    return gap.withColumn("overfitting", F.col("gap") > MILD).withColumn(
        "verdict", gap_verdict(F.col("gap")))


def compare(results: DataFrame) -> DataFrame:
    """Result rows, the best test accuracy first, with their rank."""
    rank = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(
        F.desc("test_accuracy"), F.asc("model")))  # one row per model
    return results.withColumn("rank", rank).orderBy("rank")


def best_model(results: DataFrame) -> DataFrame:
    return results.orderBy(F.desc("test_accuracy"), F.asc("model")).limit(1)


def _score_groups(df: DataFrame, score: str, positive: Column) -> DataFrame:
    s = col(score).cast("double")
    return (
        df.select(s.alias("threshold"), F.coalesce(positive.cast("int"), F.lit(0)).alias("_y"))
        .where(F.col("threshold").isNotNull() & ~F.isnan("threshold"))
        .groupBy("threshold")
        .agg(F.sum("_y").alias("_p"), F.sum(1 - F.col("_y")).alias("_q"))
    )


def roc(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """True and false positive rate at each distinct score, counting rows at or above it.

    Scores are dealt to tasks by ranges, from the highest; running sums are taken inside a range
    and shifted by the totals of the higher ones, so no task sees more than one range.
    """
    dealt = ranged(_score_groups(df, score, positive), [F.desc("threshold")])
    shifted = with_totals_before(dealt, {"_hp": F.col("_p"), "_hq": F.col("_q")})
    all_p, all_q = dealt.agg(F.sum("_p"), F.sum("_q")).head()
    upto = Window.partitionBy(RANGE).orderBy(F.desc("threshold"))
    counted = shifted.select(
        "threshold", "_p", "_q", F.lit(all_p).cast("bigint").alias("_allp"), F.lit(all_q).cast("bigint").alias("_allq"),
        (F.col("_hp") + F.sum("_p").over(upto)).alias("tp"),
        (F.col("_hq") + F.sum("_q").over(upto)).alias("fp"),
    )
    return counted.select(
        "threshold", "tp", "fp",
        ratio(F.col("tp"), F.col("_allp")).alias("tpr"),
        ratio(F.col("fp"), F.col("_allq")).alias("fpr"),
        # Trapezium between this point and the one before it.
        ratio(F.col("_q") * (F.col("tp") - F.col("_p") / 2),
              F.col("_allp").cast("double") * F.col("_allq")).alias("area"),
    )


def roc_auc(df: DataFrame, score: str, positive: Column) -> DataFrame:
    return roc(df, score, positive).agg(F.sum("area").alias("auc"))


def threshold_sweep(
    df: DataFrame, score: str, positive: Column, thresholds: Sequence[float],
) -> DataFrame:
    """Precision, recall and F1 when rows at or above each threshold are flagged, in order
    of the thresholds."""
    ends = sorted({float(t) for t in thresholds})
    groups = df.select(col(score).cast("double").alias("s"), F.coalesce(positive, F.lit(False)).alias("y")) \
        .where(F.col("s").isNotNull() & ~F.isnan("s"))
    # Each score goes once to the range between two thresholds; sums from the top follow.
    splits = [float("-inf"), *ends, float("inf")]
    counted = Bucketizer(splits=splits, inputCol="s", outputCol="b").transform(groups).groupBy("b").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("y").alias("p"))
    known = counted.union(df.sparkSession.range(len(splits) - 1).select(
        F.col("id").cast("double"), F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))).groupBy("b").agg(
        F.sum("n").alias("n"), F.sum("p").alias("p"))
    down = Window.partitionBy(F.lit(1)).orderBy(F.desc("b"))  # one row per threshold
    whole = Window.partitionBy(F.lit(1))
    names = F.array(*[F.lit(t) for t in ends])
    return known.select(
        "b", F.sum("n").over(down).alias("flagged"), F.sum("p").over(down).alias("tp"),
        F.sum("p").over(whole).alias("all")).where("b > 0").orderBy("b").select(
        F.get(names, F.col("b").cast("int") - 1).alias("threshold"), "flagged", "tp",
        ratio(F.col("tp"), F.col("flagged")).alias("precision"),
        ratio(F.col("tp"), F.col("all")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("flagged") + F.col("all")).alias("f1"),
    )
