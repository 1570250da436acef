import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlab.operators import classifiers as C
from flowlab.operators import profile as E
from flowlab.operators import sampling as M
from flowlab.plans import train as T


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 3, 900)
    x = rng.normal(size=(900, 3)) * [1, 2, 0.5] + y[:, None] * [2, 0, 1]
    x[::50, 0] = np.nan
    data = [(i, *(None if np.isnan(v) else float(v) for v in x[i]), int(y[i])) for i in range(900)]
    return spark.createDataFrame(data, "id long, a double, b double, c double, label long").cache(), x, y


def test_densities_are_near_the_direct_kernel_sums(rows):
    df, x, y = rows
    got = {}
    for r in E.smooth_density(df, ["a", "b", "c"], "label", 200).collect():
        got.setdefault((r["feature"], r["label"]), []).append((r["at"], r["density"]))
    assert len(got) == 9
    for (f, k), points in got.items():
        v = x[y == k, "abc".index(f)]
        v = v[~np.isnan(v)]
        h = v.std(ddof=1) * len(v) ** -0.2
        at, density = np.array(sorted(points)).T
        direct = np.exp(-0.5 * ((at[:, None] - v) / h) ** 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
        assert len(at) == 200 and np.abs(density - direct).max() < 0.01 * direct.max()


def test_panels_count_every_pair(rows, spark):
    df, x, y = rows
    got = {(r["feature_x"], r["feature_y"], r["label"], r["bin_x"], r["bin_y"]): r["n"]
           for r in E.pair_panels(df, ["a", "b", "c"], "label", 5).collect()}
    want = {}
    low, high = np.nanmin(x, axis=0), np.nanmax(x, axis=0)
    for row, k in zip(x, y):
        at = np.clip(np.floor((row - low) / ((high - low) / 5)), 0, 4)
        for i in range(3):
            for j in range(i + 1, 3):
                if not np.isnan(row[[i, j]]).any():
                    key = ("abc"[i], "abc"[j], int(k), int(at[i]), int(at[j]))
                    want[key] = want.get(key, 0) + 1
    assert got == want
    empty = df.limit(0)
    assert E.pair_panels(empty, ["a", "b"]).count() == 0 and E.smooth_density(empty, ["a"]).count() == 0
    odd = spark.createDataFrame([(float("inf"), 1.0, 0), (1.0, 1.0, 0), (None, 2.0, 1)], "a double, b double, label int")
    assert [tuple(r) for r in E.pair_panels(odd, ["a", "b"], bins=2).collect()] == [("a", "b", 0, 0, 0, 1)]
    assert E.smooth_density(odd, ["a"]).count() == 0


def test_sample_by_hash_is_one_scan_with_known_errors(spark):
    df = spark.range(60_000).select("id", F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid")
                                    .otherwise("small").alias("label"))
    sample = M.approximate_sample(df, 0.12, ["id"], 7)
    assert "Exchange" not in sample._jdf.queryExecution().executedPlan().toString()
    off = M.sample_errors(df, sample, "label", 0.12).collect()
    assert len(off) == 3 and all(abs(r["errors_off"]) < 4 and r["kept"] > 0 for r in off)
    assert M.approximate_sample(df.repartition(5), 0.12, ["id"], 7).exceptAll(sample).count() == 0
    assert M.approximate_sample(df, 1.0).count() == 60_000 and M.approximate_sample(df, 0.0).count() == 0


def test_all_folds_of_naive_bayes_at_once_equal_a_fit_for_each(rows, monkeypatch):
    df = rows[0].where("a IS NOT NULL")
    once = T.cross_validate(C.BAYES, df, ["a", "b", "c"], "label", 3, 600, ["id"])
    monkeypatch.setattr(T, "_bayes_folds", lambda *a: None)
    each = T.cross_validate(C.BAYES, df, ["a", "b", "c"], "label", 3, 600, ["id"])
    a, b = ({r["fold"]: r["f1_weighted"] for r in t.collect()} for t in (once, each))
    assert a == pytest.approx(b) and len(a) == 3


def test_a_class_of_one_fold_is_added_to_the_others(rows, spark):
    df = rows[0].where("a IS NOT NULL AND label < 2").select("id", "a", "b", "label")
    rare = spark.createDataFrame([(-1, 50.0, 50.0, 2)], df.schema)
    folds = T.cross_validate(C.BAYES, df.union(rare), ["a", "b"], "label", 3, 300, ["id"]).collect()
    assert len(folds) == 3 and all(0 < r["f1_weighted"] <= 1 for r in folds)
