from decimal import Decimal

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from flowlab.operators import prepare as P
from flowlab.operators import ranges as R
from flowlab.operators.encoder import CategoryEncoder, CategoryEncoderModel


def codes(df, *columns):
    out = P.label_encode(df.withColumns({f"raw_{c}": F.col(c) for c in columns}), list(columns))
    return [{r[f"raw_{c}"]: r[c] for r in out.collect()} for c in columns]


def test_codes_follow_each_types_own_order(spark):
    big = [2 ** 53 + i for i in range(-3, 4)] + [10 ** 16, 10 ** 16 - 1, -2 ** 53, -2 ** 53 - 1, 0, -(2 ** 63), 2 ** 63 - 1]
    wide = [Decimal(f"{10 ** 20 + i}.{j:02d}") for i in (0, 1) for j in (1, 2, 99)] + [Decimal("-0.01"), Decimal("0.00"), Decimal("-7.50")]
    rows = [(big[i % len(big)], wide[i % len(wide)], [None, 1.5, float("nan"), -0.25][i % 4], ["b", "é", "A", None, ""][i % 5],
             [True, False, None][i % 3]) for i in range(len(big) * 20)]
    df = spark.createDataFrame(rows, "big long, wide decimal(25,2), num double, text string, flag boolean")
    got = codes(df, "big", "wide", "text", "flag")
    assert got[0] == {v: i for i, v in enumerate(sorted(big))}
    assert got[1] == {v: i for i, v in enumerate(sorted(wide))}
    assert got[2] == {v: i for i, v in enumerate(["", "A", "b", None, "é"])}  # a missing one is 'unknown'
    assert got[3] == {False: 0, True: 1, None: 2}
    found = {str(k): v for k, v in codes(df, "num")[0].items()}
    assert found == {"-0.25": 0, "1.5": 1, "nan": 2, "None": 3}


def test_ranges_bound_the_largest_task(spark):
    """A hundred thousand texts that begin alike are ranked in ranges, not in one task."""
    df = spark.range(100_000).select(F.format_string("https://example.com/%06d", F.col("id")).alias("url"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = R.ranged(df, [F.col("url").asc()])
        sizes = [r["count"] for r in dealt.groupBy(R.RANGE).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)
        ranked = R.ranks(df.withColumn("k", F.lit(1)), [F.col("k").asc(), F.col("url").asc()], ["k"], "place")
        assert ranked.where("cast(right(url, 6) as long) = place").count() == 100_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.fixture
def tables(spark):
    train = spark.createDataFrame([(1, "b", 10), (2, "a", 20), (3, None, 10), (4, "b", 30)], "id long, c string, n long")
    new = spark.createDataFrame([(1, "a", 30), (2, "zz", 10), (3, None, 99)], "id long, c string, n long")
    return train, new


def test_saved_encoder_gives_the_training_codes(spark, tables, tmp_path):
    train, new = tables
    fitted = Pipeline(stages=[CategoryEncoder(inputCols=["c", "n"], outputCols=["ci", "ni"], unseen="keep")]).fit(train)
    fitted.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    for model in (fitted, loaded):
        assert sorted((r["id"], r["ci"], r["ni"]) for r in model.transform(train).collect()) == [
            (1, 1, 0), (2, 0, 1), (3, 2, 0), (4, 1, 2)]
        assert sorted((r["id"], r["ci"], r["ni"]) for r in model.transform(new).collect()) == [(1, 0, 2), (2, 3, 0), (3, 2, 3)]


def test_rules_for_unseen_values(spark, tables):
    train, new = tables
    fit = lambda **more: CategoryEncoder(inputCols=["c"], outputCols=["c"], **more).fit(train)
    assert sorted((r["id"], r["c"]) for r in fit(unseen="null").transform(new).collect()) == [(1, 0), (2, None), (3, 2)]
    with pytest.raises(Exception, match="no code in c for zz"):
        fit().transform(new).collect()
    with pytest.raises(ValueError):
        CategoryEncoder(inputCols=["c"], outputCols=["c"], unseen="drop")


def test_indicators_are_sparse_vectors(spark, tables):
    train, new = tables
    model = CategoryEncoder(inputCols=["c"], outputCols=["v"], unseen="keep", vectors=True).fit(train)
    got = {r["id"]: r["v"] for r in model.transform(new).collect()}
    assert {i: v.toArray().tolist() for i, v in got.items()} == {1: [1, 0, 0, 0], 2: [0, 0, 0, 1], 3: [0, 0, 1, 0]}
    assert all(type(v).__name__ == "SparseVector" for v in got.values())
    none = CategoryEncoder(inputCols=["c"], outputCols=["v"], unseen="null", vectors=True).fit(train).transform(new)
    assert {r["id"]: r["v"] is None for r in none.collect()} == {1: False, 2: True, 3: False}


def test_codes_beyond_the_broadcast_limit(spark, monkeypatch):
    from flowlab.functions import small

    monkeypatch.setattr(small, "MAX_LOCAL_ROWS", 3)
    df = spark.range(50).select("id", F.format_string("k%02d", F.col("id") % 20).alias("c"))
    model = CategoryEncoder(inputCols=["c"], outputCols=["i"]).fit(df)
    assert all(r["i"] == r["id"] % 20 for r in model.transform(df).collect())


def made_many(monkeypatch):
    """Few categories are many, and few rows are a range of their own."""
    from flowlab.functions import small

    monkeypatch.setattr(small, "MAX_LOCAL_ROWS", 3)
    monkeypatch.setattr(R, "RANGE_ROWS", 200)


def odd_rows(spark):
    num = [None, 1.5, float("nan"), -0.25, float("inf"), -0.0, 0.0, float("-inf"), 1e300]
    rows = [(i, 2 ** 53 + i % 61 if i % 3 else 7, Decimal(10 ** 20 + i % 50) if i % 7 else None, num[i % 9],
             None if i % 11 == 0 else ["b", "é", "A", "", "b\0", "😀", "ﬀ"][i % 7] * (1 + i % 13), bool(i % 2) if i % 5 else None)
            for i in range(900)]
    df = spark.createDataFrame(rows, "id long, big long, wide decimal(25,2), num double, text string, flag boolean")
    return df.withColumn("at", F.timestamp_micros(F.col("big"))).withColumn("day", F.date_from_unix_date(F.col("id").cast("int") % 70))


@pytest.mark.parametrize("null_value, columns", [("unknown", ["big", "num", "text", "at"]), (None, ["wide", "num", "day"])])
def test_codes_by_ranges_equal_those_joined(spark, monkeypatch, null_value, columns):
    df = odd_rows(spark).select("id", *columns)
    want = P.label_encode(df, columns, null_value)
    rows = sorted(map(str, want.collect()))
    made_many(monkeypatch)
    got = P.label_encode(df, columns, null_value)
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == rows


def test_a_frequent_value_is_spread_over_the_tasks(spark, monkeypatch):
    made_many(monkeypatch)
    df = spark.range(0, 4000, 1, 20).select("id", F.when(F.col("id") % 4 > 0, "same").otherwise(
        F.format_string("k%04d", F.col("id"))).alias("c")).persist()
    coded = P.label_encode(df, ["c"])
    sizes = [r["count"] for r in coded.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000, sizes  # 3000 rows have one value
    raw = df.select("id", F.col("c").alias("raw")).join(coded, "id").select("raw", "c").distinct().collect()
    assert {r["raw"]: r["c"] for r in raw} == {v: i for i, v in enumerate(sorted(r["raw"] for r in raw))} and len(raw) == 1001
    df.unpersist()


def test_rows_are_shuffled_once_for_a_column_of_many_categories(spark, monkeypatch):
    made_many(monkeypatch)
    df = spark.range(1000).select("id", F.format_string("k%04d", F.col("id")).alias("c"))
    plan = P.label_encode(df, ["c"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_one_hot_refuses_too_many_columns(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="more than 10"):
        P.one_hot(df, ["c"], max_columns=10)
    assert len(P.one_hot(df, ["c"], max_columns=50).columns) == 50
