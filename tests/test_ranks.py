import hashlib
from collections import Counter

import pytest

from flowlab.functions import small
from flowlab.operators import sampling as M
from flowlab.operators.ranks import rank_segments
from pyspark.sql import functions as F


def md5(seed, *parts):
    return hashlib.md5(":".join([str(seed), *map(str, parts)]).encode()).hexdigest()


@pytest.fixture(scope="module")
def rows(spark):
    # One class holds most rows, one is missing its label, three are tiny.
    data = [(i, "big" if i % 3 else None) for i in range(900)]
    data += [(1000, "one"), (1001, "two"), (1002, "two"), (1003, "three"), (1004, "three"), (1005, "three")]
    return spark.createDataFrame(data, "id long, label string").repartition(5), data


def by_class(data):
    out = {}
    for i, c in data:
        out.setdefault(c, []).append(i)
    return {c: sorted(v, key=lambda i: md5(42, i)) for c, v in out.items()}


@pytest.mark.parametrize("resolve", [1_000_000, 2])
def test_segments_equal_sorted_ranks(rows, resolve):
    df, data = rows
    out = rank_segments(df, [lambda n: F.floor(n / 4), lambda n: F.floor(n / 2)], "label", ["id"],
                        resolve_rows=resolve)
    got = {r["id"]: r["segment"] for r in out.collect()}
    for ids in by_class(data).values():
        n = len(ids)
        for at, i in enumerate(ids):
            assert got[i] == (at >= n // 4) + (at >= n // 2)


def test_more_classes_than_the_driver_takes(rows, monkeypatch):
    df, data = rows
    monkeypatch.setattr(small, "MAX_LOCAL_ROWS", 1)
    got = {r["id"] for r in M.stratified_sample(df, "label", 0.3, ["id"]).collect()}
    want = set()
    for ids in by_class(data).values():
        want.update(ids[:int(0.3 * len(ids) + 0.5)])
    assert got == want


@pytest.mark.parametrize("resolve", [1_000_000, 5])
def test_copies_and_shared_keys(spark, resolve):
    # A third of the rows are copies of one row; all rows share three keys.
    data = [(1, "a", 0)] * 200 + [(i % 3, "a", i) for i in range(400)]
    df = spark.createDataFrame(data, "k int, label string, v int").repartition(4)
    for key in (["k"], None):
        out = rank_segments(df, [lambda n: F.lit(100), lambda n: F.lit(250)], "label", key,
                            resolve_rows=resolve).collect()
        assert Counter(r["segment"] for r in out) == {0: 100, 1: 150, 2: 350}
        assert Counter((r["k"], r["label"], r["v"]) for r in out) == Counter(data)


def test_only_copies(spark):
    df = spark.createDataFrame([("x", 1)] * 97, "label string, v int").repartition(3)
    folds = Counter(r["fold"] for r in M.assign_folds(df, "label", 3).collect())
    assert folds == {0: 33, 1: 32, 2: 32}


def test_split_is_disjoint_and_complete(rows):
    df, data = rows
    out = M.stratified_split(df.where("label <> 'one'"), "label", 0.2, ["id"]).collect()
    assert sorted(r["id"] for r in out) == sorted(i for i, c in data if c not in (None, "one"))
    share = Counter((r["label"], r["is_test"]) for r in out)
    assert share["big", True] == 120 and share["three", True] == 1 and share["two", True] == 0


def test_split_falls_back_when_a_class_has_one_row(rows):
    df, data = rows
    out = M.stratified_split(df, "label", 0.2, ["id"]).collect()
    assert sum(r["is_test"] for r in out) == round(0.2 * len(data))


def test_folds_are_balanced(rows):
    df, data = rows
    sizes = Counter((r["label"], r["fold"]) for r in M.assign_folds(df, "label", 4, ["id"]).collect())
    for c, ids in by_class(data).items():
        per = [sizes[c, f] for f in range(4)]
        assert sum(per) == len(ids) and max(per) - min(per) <= 1


def test_same_rows_whatever_the_partitioning(rows):
    df, _ = rows
    a = {r["id"] for r in M.stratified_sample(df, "label", 0.5, ["id"]).collect()}
    b = {r["id"] for r in M.stratified_sample(df.repartition(11, "id"), "label", 0.5, ["id"]).collect()}
    c = {r["id"] for r in M.stratified_sample(df, "label", 0.5, ["id"], seed=7).collect()}
    assert a == b != c


def test_cv_subsample_repeats_tiny_classes(rows):
    df, data = rows
    sizes = Counter(r["label"] for r in M.cv_subsample(df, "label", 90, ["id"]).collect())
    n = len(data)
    assert sizes == {"big": 90 * 600 // n, None: 90 * 300 // n, "one": 3, "two": 3, "three": 3}


def test_cv_subsample_is_cut_only_if_every_class_stays(spark):
    # 40 classes of 3 rows cannot be cut to 60 rows without losing some.
    data = [(i, i % 40) for i in range(120)]
    df = spark.createDataFrame(data, "id long, label long")
    assert M.cv_subsample(df, "label", 60, ["id"]).count() == 120
    # 29 + 29 + 1 + 1 + 1 rows are one too many, and the one cut off is of a large class.
    data = [(i, i % 2) for i in range(1000)] + [(5000, 2), (5001, 3), (5002, 4)]
    df = spark.createDataFrame(data, "id long, label long")
    assert M.cv_subsample(df, "label", 60, ["id"], min_rows=1).count() == 60


def test_ensure_classes_adds_one_row_each(rows):
    df, data = rows
    part = df.where("label = 'big'")
    out = M.ensure_classes(part, df, "label", ["id"])
    extra = {r["label"]: r["id"] for r in out.where("label is null or label <> 'big'").collect()}
    assert extra == {c: ids[0] for c, ids in by_class(data).items() if c != "big"}
    assert M.ensure_classes(df, df, "label", ["id"]).count() == len(data)


def test_sample_n_large_and_small(rows):
    df, data = rows
    order = sorted((i for i, _ in data), key=lambda i: md5(42, i))
    assert {r["id"] for r in M.sample_n(df, 7, ["id"]).collect()} == set(order[:7])
    assert {r["id"] for r in M.sample_n(df, 300, ["id"]).collect()} == set(order[:300])


def test_empty_table(rows):
    empty = rows[0].where("id < 0")
    assert M.assign_folds(empty, "label", 3, ["id"]).count() == 0
    assert M.random_split(empty, 0.2, ["id"]).count() == 0
    assert M.stratified_split(empty, "label", 0.2, ["id"]).count() == 0


def test_per_class_sample(rows):
    df, data = rows
    sizes = Counter(r["label"] for r in M.per_class_sample(df, "label", 10, ["id"]).collect())
    assert sizes == {"big": 2, None: 2, "one": 1, "two": 2, "three": 2}


def test_rows_are_not_shuffled_or_sorted(spark, rows, tmp_path):
    rows[0].write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    for out in (M.stratified_sample(df, "label", 0.1, ["id"]), M.assign_folds(df, "label", 3, ["id"]),
                M.random_split(df, 0.2, ["id"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan
        assert not any(x in plan for x in ("Exchange hash", "Exchange range", "Exchange Single", "Window", "Sort"))


def test_rows_that_share_a_key_differ_below_the_millisecond(spark):
    # Ten rows of one key, microseconds apart, in three partitionings: none may be merged,
    # and the same ones are picked each time.
    rows = [(1, i, f"2024-01-01 00:00:00.{i:06d}") for i in range(10)] + [(2, 99, "2024-01-01 00:00:01")]
    df = spark.createDataFrame(rows, "k long, id long, t string").selectExpr("k", "id", "to_timestamp(t) AS ts")
    picked = set()
    for parts in (1, 3, 7):
        dealt = df.repartition(parts)
        out = M.random_split(dealt, 0.4, ["k"]).collect()
        assert sorted(r["id"] for r in out) == sorted(r[1] for r in rows)
        added = M.ensure_classes(dealt.where("k = 2"), dealt, "k", ["k"]).where("k = 1").collect()
        assert len(added) == 1
        picked.add((tuple(sorted(r["id"] for r in out if r["is_test"])), added[0]["id"],
                    tuple(sorted(r["id"] for r in M.sample_n(dealt, 3, ["k"]).collect()))))
    assert len(picked) == 1


def test_content_is_told_apart_whatever_its_type(spark):
    from flowlab.functions.columns import row_text

    df = spark.sql("""SELECT * FROM VALUES
      (array(timestamp_micros(1)), map('a', 1), named_struct('x', CAST(NULL AS INT)), CAST('a' AS BINARY), 1),
      (array(timestamp_micros(2)), map('a', 1), named_struct('x', CAST(NULL AS INT)), CAST('a' AS BINARY), 1),
      (array(timestamp_micros(1)), map('a', 2), named_struct('x', CAST(NULL AS INT)), CAST('a' AS BINARY), 1),
      (array(timestamp_micros(1)), map('a', 1), NULL, CAST('a' AS BINARY), 1),
      (array(timestamp_micros(1)), map('a', 1), named_struct('x', 0), CAST('b' AS BINARY), 1),
      (NULL, map('a', 1), named_struct('x', CAST(NULL AS INT)), CAST('a' AS BINARY), 1) AS t(a, m, s, b, n)""")
    texts = [r[0] for r in df.select(row_text(df)).collect()]
    assert len(set(texts)) == 6
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert [r[0] for r in df.select(row_text(df)).collect()] == texts
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
