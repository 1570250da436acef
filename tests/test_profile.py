import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowlab.operators import profile as E
from flowlab.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(3)
    n = 3001
    heavy = np.exp(rng.normal(0, 6, n))
    hot = np.where(rng.random(n) < 0.4, 0.0, rng.normal(0, 1, n))
    few = rng.integers(0, 4, n).astype(float)
    holes = [None if i % 3 == 0 else (math.nan if i % 3 == 1 else float(i)) for i in range(n)]
    rows = list(zip(heavy.tolist(), hot.tolist(), few.tolist(), holes, [None] * n))
    schema = "heavy double, hot double, few double, holes double, none double"
    return spark.createDataFrame(rows, schema).repartition(6).cache(), heavy, hot, few, holes


@pytest.mark.parametrize("limits", [dict(), dict(sample_rows=(300, 400), bracket_rows=50), dict(sample_rows=(2, 2), bracket_rows=5)])
def test_quantiles_are_exact(mixed, limits):
    df, heavy, hot, few, holes = mixed
    got = exact_quantiles(df, df.columns, PROBS, **limits)
    known = np.array([h for h in holes if h is not None and not math.isnan(h)])
    for name, values in (("heavy", heavy), ("hot", hot), ("few", few), ("holes", known)):
        assert got[name] == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12), name
    assert got["none"] == [None] * len(PROBS)


def test_a_bad_sample_does_not_change_the_result(mixed):
    # Two sampled rows bracket nothing: the brackets fall back to the whole column.
    df, heavy, *_ = mixed
    got = exact_quantiles(df, ["heavy"], [0.3], sample_rows=(2, 2), bracket_rows=1)
    assert got["heavy"][0] == pytest.approx(np.quantile(heavy, 0.3))


def test_describe(mixed):
    df, heavy, *_ = mixed
    rows = {r["feature"]: r for r in E.describe(df).collect()}
    assert rows["heavy"]["count"] == len(heavy)
    assert rows["heavy"]["std"] == pytest.approx(heavy.std(ddof=1))
    assert rows["none"]["count"] == 0 and rows["none"]["p50"] is None
    rough = {r["feature"]: r for r in E.describe(df, approximate=True).collect()}
    assert rough["heavy"]["p50"] == pytest.approx(np.quantile(heavy, 0.5), rel=0.05)


def test_nulls_count_nan(mixed):
    df, *_, holes = mixed
    got = {r["column"]: r["nulls"] for r in E.null_counts(df).collect()}
    assert got == {"holes": 2001, "none": 3001}
    assert E.null_total(df).head()[0] == 5002


def test_names_with_spaces(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (3.0, None, "b")], "`Tot sum` double, `a.b` double, label string")
    assert E.null_counts(df).head()["column"] == "a.b"
    assert E.describe(df).count() == 2


def test_correlation_of_flat_and_missing_columns(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0), (4.0, 8.2, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, flat double")
    whole = {(r["feature_i"], r["feature_j"]): r["r"] for r in E.correlation(df).collect()}
    pairs = {(r["feature_i"], r["feature_j"]): r["r"] for r in E.correlation(df, pairwise=True).collect()}
    want = np.corrcoef([r[0] for r in rows], [r[1] for r in rows])[0, 1]
    for r in (whole, pairs):
        assert r["a", "b"] == pytest.approx(want) and r["b", "b"] == pytest.approx(1)
        assert r["flat", "flat"] is None and r["a", "flat"] is None
    holes = df.withColumn("b", F.when(F.col("a") < 4, F.col("b")))
    r = {(x["feature_i"], x["feature_j"]): x["r"] for x in E.correlation(holes, pairwise=True).collect()}
    assert r["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3], [2.0, 4.1, 5.9])[0, 1])
    assert E.correlation(df, ["flat"]).head()["r"] is None


def test_imbalance_ties_go_to_the_smaller_class(spark):
    df = spark.createDataFrame([(c,) for c in [3, 3, 1, 1, 2, 0]], "label long")
    assert E.imbalance(df).head().asDict() == {
        "max_n": 2, "max_label": 1, "min_n": 1, "min_label": 0, "ratio": 2.0}
    assert [r["label"] for r in E.class_distribution(df, top=3).collect()] == [1, 3, 0]


def test_histogram_of_a_flat_feature(spark):
    df = spark.createDataFrame([(1.0, "a"), (1.0, "b"), (None, "b")], "x double, label string")
    assert {(r["label"], r["bin"], r["n"]) for r in E.feature_histogram(df, "x").collect()} == {
        ("a", 0, 1), ("b", 0, 1)}
    assert E.feature_histogram(df.where("x is null"), "x").count() == 0


@pytest.mark.parametrize("limits", [dict(), dict(sample_rows=(50, 60), bracket_rows=20)])
def test_quantiles_with_infinities(spark, limits):
    values = [float(i) for i in range(400)] + [math.inf] * 700
    df = spark.createDataFrame([(v, -v) for v in values], "up double, down double").repartition(3)
    got = exact_quantiles(df, ["up", "down"], [0.25, 0.5, 0.75], **limits)
    assert got["up"] == [pytest.approx(274.75), math.inf, math.inf]
    assert got["down"] == [-math.inf, -math.inf, pytest.approx(-274.75)]


def test_quantile_of_values_that_samples_cant_narrow(spark):
    # Two values hold nearly all rows, at the rank itself and far apart.
    values = [1.0] * 500 + [1e300] * 500 + [float(i) for i in range(2, 40)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, ["x"], [0.2, 0.49, 0.9], sample_rows=(20, 30), bracket_rows=10)["x"]
    assert got == pytest.approx(np.quantile(values, [0.2, 0.49, 0.9]).tolist())


def test_head_orders_by_all_columns_by_default(spark):
    df = spark.createDataFrame([(2, "a"), (1, "b"), (1, "a")], "n int, t string").repartition(3)
    assert [tuple(r) for r in E.head(df, 2).collect()] == [(1, "a"), (1, "b")]


def test_pairwise_correlation_equals_pandas(spark):
    rng = np.random.default_rng(8)
    frame = pd.DataFrame(rng.normal(1e6, 1, (300, 4)), columns=list("abcd"))
    frame["b"] += 0.7 * frame["a"]
    frame["flat"] = 5.0
    frame = frame.mask(rng.random(frame.shape) < 0.3)
    frame["none"] = np.nan
    df = spark.createDataFrame(frame).repartition(4)
    got = {(r["feature_i"], r["feature_j"]): r["r"] for r in E.correlation(df, pairwise=True).collect()}
    want = frame.corr()
    for a in "abcd":
        for b in "abcd":
            assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-8)
    assert got["a", "flat"] is None and got["flat", "flat"] is None and got["a", "none"] is None
