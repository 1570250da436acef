import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowlab.functions import small
from flowlab.operators import prepare as P
from flowlab.operators import select as X
from flowlab.sources import tables


def test_coerce_keeps_only_plain_numbers(spark):
    texts = ["1.5", " 2 ", "x", "", "NaN", None, "1d", "0x10", "-3e2", ".5", "5.", "inf", "1,000"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["t"] for r in P.coerce_numeric(df, ["t"]).collect()]
    assert got == [1.5, 2.0, None, None, None, None, None, None, -300.0, 0.5, 5.0, math.inf, None]


def test_fill_median_even_odd_empty(spark):
    df = spark.createDataFrame(
        [(1.0, 1, None), (math.nan, 2, None), (4.0, 3, None), (None, None, None)],
        "even double, odd int, none double")
    rows = P.fill_median(df).collect()
    assert [r["even"] for r in rows] == [1.0, 2.5, 4.0, 2.5]
    assert [r["odd"] for r in rows] == [1.0, 2.0, 3.0, 2.0]
    assert [r["none"] for r in rows] == [None] * 4


@pytest.mark.parametrize("limit", [100_000, 2])
def test_label_encode_small_and_large(spark, monkeypatch, limit):
    monkeypatch.setattr(small, "MAX_LOCAL_ROWS", limit)
    rows = [("b", "z"), ("a", None), ("a", "y"), (None, "é"), ("B", "y")]
    df = spark.createDataFrame(rows, "p string, q string").repartition(3)
    got = Counter((r["p"], r["q"]) for r in P.label_encode(df, ["p", "q"]).collect())
    p = {v: i for i, v in enumerate(sorted({"b", "a", "unknown", "B"}))}
    q = {v: i for i, v in enumerate(sorted({"z", "unknown", "y", "é"}))}
    assert got == Counter((p[a or "unknown"], q[b or "unknown"]) for a, b in rows)


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "u"), (2, None), (3, "t")], "id int, c string")
    rows = {r["id"]: r.asDict() for r in P.one_hot(df, ["c"]).collect()}
    assert rows[2] == {"id": 2, "c_t": 0, "c_u": 0, "c_unknown": 1}
    assert sum(rows[i][c] for i in rows for c in ("c_t", "c_u", "c_unknown")) == 3
    assert P.one_hot_vector(df.where("c is not null"), ["c"]).head()["indicators"].toArray().sum() == 1


def test_assert_numeric(spark):
    good = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert P.assert_numeric(good) is good
    with pytest.raises(ValueError, match="not numeric"):
        P.assert_numeric(spark.createDataFrame([("x",)], "a string"))
    with pytest.raises(ValueError, match="missing"):
        P.assert_numeric(spark.createDataFrame([(math.nan,)], "a double"))


def test_align_features_refuses_a_missing_column(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert P.align_features(df, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(Exception, match="c"):
        P.align_features(df, ["a", "c"]).columns


def test_standardize_uses_training_statistics(spark):
    train = spark.createDataFrame([(1.0, 7.0, "k"), (3.0, 7.0, "k")], "a double, flat double, label string")
    test = spark.createDataFrame([(5.0, 9.0, "k")], "a double, flat double, label string")
    a, b = P.standardize(train, test, ["a", "flat"])
    assert [tuple(r) for r in a.collect()] == [(-1.0, 0.0, "k"), (1.0, 0.0, "k")]
    assert tuple(b.head()) == (3.0, 2.0, "k")


def test_weights_sum_to_the_rows(spark):
    df = spark.createDataFrame([(c,) for c in "aaaabbc"], "label string")
    rows = P.class_weights(df).collect()
    assert sum(r["weight"] for r in rows) == pytest.approx(7)
    assert {r["label"]: r["weight"] for r in rows}["c"] == pytest.approx(7 / 3)


def test_merge_and_unique_names(spark, tmp_path):
    a = spark.createDataFrame([(1, 2.0)], "id int, x double")
    b = spark.createDataFrame([(2, "t")], "id int, proto string")
    assert [tuple(r) for r in P.merge_sources(a, b).collect()] == [(1, 2.0, None), (2, None, "t")]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        odd = spark.createDataFrame([(1.0, 2.0, 3.0)], "rate double, Rate double, `Tot sum` double")
        tables.save(odd, str(tmp_path / "odd"))
        clean = tables.unique_names(tables.load(spark, str(tmp_path / "odd")))
        rows = [tuple(r) for r in clean.collect()]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert clean.columns == ["rate", "Rate_2", "Tot_sum"] and rows == [(1.0, 2.0, 3.0)]


def test_load_many_merges_schemas(spark, tmp_path):
    tables.save(spark.createDataFrame([(1,)], "a int"), str(tmp_path / "p0"))
    tables.save(spark.createDataFrame([(2, "x")], "a int, b string"), str(tmp_path / "p1"))
    both = tables.load_many(spark, [str(tmp_path / "p0"), str(tmp_path / "p1")], merge_schema=True)
    assert sorted(tuple(r) for r in both.select("a", "b").collect()) == [(1, None), (2, "x")]


def matrix(columns, pairs):
    r = {(a, b): 1.0 if a == b else 0.0 for a in columns for b in columns}
    for (a, b), v in pairs.items():
        r[a, b] = r[b, a] = v
    return r


def test_greedy_selection():
    # On a tie the earlier column goes.
    assert X.redundant_features("ab", matrix("ab", {("a", "b"): 0.95})) == ["a"]
    # The threshold itself counts, and so does a negative r.
    assert X.redundant_features("ab", matrix("ab", {("a", "b"): -0.90})) == ["a"]
    assert X.redundant_features("ab", matrix("ab", {("a", "b"): 0.8999})) == []
    # In a chain b outlives a, then c is weaker than b.
    chain = matrix("abc", {("a", "b"): 0.95, ("b", "c"): 0.95, ("a", "c"): 0.5})
    assert X.redundant_features("abc", chain) == ["a", "c"]
    # A column that falls is not compared any further: c falls to a, so b stays.
    fall = matrix("abcd", {("a", "c"): 0.95, ("b", "c"): 0.95, ("a", "d"): 0.6, ("a", "b"): 0.8, ("b", "d"): 0.2})
    assert X.redundant_features("abcd", fall) == ["c"]
    # Undefined correlations never make a column redundant.
    flat = matrix("ab", {("a", "b"): None}) | {("b", "b"): None}
    assert X.redundant_features("ab", flat) == []
    assert X.redundant_features("a", {("a", "a"): 1.0}) == []


def test_low_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0.001, 1), (2.0, 5.0, 0.002, 2)],
                               "wide double, flat double, thin double, label int")
    assert X.drop_low_variance(df).columns == ["wide", "label"]


@pytest.mark.parametrize("limit", [20_000, 2])
def test_codes_follow_the_values_own_order(spark, monkeypatch, limit):
    monkeypatch.setattr(small, "MAX_LOCAL_ROWS", limit)
    numbers = [10, 2, -3, None, 100, 0, -40, 2, 9_000_000_000, 9_000_000_001]
    df = spark.createDataFrame([(n, None if n is None else n / 4, n is not None and n > 5) for n in numbers],
                               "n long, x double, b boolean")
    got = {tuple(r) for r in P.label_encode(df.withColumn("o", F.col("n")), ["n", "x", "b"]).select("o", "n", "x", "b").collect()}
    order = {v: i for i, v in enumerate(sorted({n for n in numbers if n is not None}))}
    order[None] = len(order)
    assert got == {(n, order[n], order[n], int(n is not None and n > 5)) for n in numbers}


def test_many_indicators(spark):
    df = spark.range(300).selectExpr("id", "concat('c', id) AS c")
    wide = P.one_hot(df, ["c"])
    assert len(wide.columns) == 301 and wide.where("c_c7 = 1").head()["id"] == 7
