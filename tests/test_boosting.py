import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from flowlab.operators import boosting as B
from flowlab.operators import trees as T

FEATURES = ["x0", "x1", "x2"]


def table(spark, n=240, seed=3, k=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = np.clip(np.floor(x[:, 0] + 0.6 * (x[:, 1] > 0) + rng.normal(0, 0.4, n) + k / 2), 0, k - 1).astype(int)
    df = spark.createDataFrame([(i, *map(float, x[i]), int(y[i])) for i in range(n)],
                               "id long, x0 double, x1 double, x2 double, label long")
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df), x, y


def grown(x, g, h, depth):
    """The tree of greedy Newton gains as nested tuples; leaves are masks' sums."""
    best, here = (1e-12, None), g.sum() ** 2 / h.sum()
    for f in range(x.shape[1]) if depth else ():
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            left = x[:, f] <= t
            gain = g[left].sum() ** 2 / h[left].sum() + g[~left].sum() ** 2 / h[~left].sum() - here
            if gain > best[0]:
                best = gain, (f, t)
    if best[1] is None:
        return g.sum(), h.sum()
    f, t = best[1]
    left = x[:, f] <= t
    return f, t, grown(x[left], g[left], h[left], depth - 1), grown(x[~left], g[~left], h[~left], depth - 1)


def pruned(node, l1, l2, gamma):
    if len(node) == 2:
        return node
    f, t, a, b = node[0], node[1], pruned(node[2], l1, l2, gamma), pruned(node[3], l1, l2, gamma)
    if len(a) == len(b) == 2:
        score = lambda g, h: max(abs(g) - l1, 0) ** 2 / (h + l2)
        if score(*a) + score(*b) - score(a[0] + b[0], a[1] + b[1]) < gamma:
            return a[0] + b[0], a[1] + b[1]
    return f, t, a, b


def value(node, row, rate, l1, l2):
    while len(node) == 4:
        node = node[2] if row[node[0]] <= node[1] else node[3]
    g, h = node
    return -rate * np.sign(g) * max(abs(g) - l1, 0) / (h + l2)


def by_hand(x, y, k, rounds, depth, rate, l1, l2, gamma, weight):
    margins = np.zeros((len(x), k))
    for _ in range(rounds):
        p = T.softmax(margins)
        step = np.zeros_like(margins)
        for c in range(k):
            g, h = weight * (p[:, c] - (y == c)), weight * 2 * p[:, c] * (1 - p[:, c])
            node = pruned(grown(x, g, h, depth), l1, l2, gamma)
            step[:, c] = [value(node, row, rate, l1, l2) for row in x]
        margins += step
    return margins


@pytest.mark.parametrize("depth, l1, l2, gamma", [(1, 0.0, 1.0, 0.0), (2, 0.5, 3.0, 0.0), (3, 1.0, 10.0, 2.0)])
def test_two_rounds_equal_those_worked_out_by_hand(spark, depth, l1, l2, gamma):
    df, x, y = table(spark)
    weight = 1.0 + (y == 1)
    df = df.withColumn("w", F.when(F.col("label") == 1, 2.0).otherwise(1.0))
    model = B.JointBoosting(rounds=2, depth=depth, rate=0.5, l1=l1, l2=l2, gamma=gamma, leafWeight=0.0,
                            weightCol="w").fit(df)
    got = np.array([r["raw"].toArray() for r in model.transform(df).orderBy("id").collect()])
    want = by_hand(x, y, 3, 2, depth, 0.5, l1, l2, gamma, weight)
    assert np.allclose(got, want, atol=1e-9)
    if gamma:
        whole = B.JointBoosting(rounds=2, depth=depth, rate=0.5, l1=l1, l2=l2, leafWeight=0.0, weightCol="w").fit(df)
        splits = lambda m: sum((t.inner & T.reachable(t)).sum() for r in m.trees for t in r)
        assert splits(model) < splits(whole)


def test_probabilities_and_classes_follow_the_margins(spark):
    df, x, y = table(spark, 600, k=4)
    model = B.JointBoosting(rounds=8, depth=3, rate=0.3, rows=0.7, columns=0.7).fit(df)
    rows = model.transform(df).orderBy("id").collect()
    raw = np.array([r["raw"].toArray() for r in rows])
    share = np.array([r["probability"].toArray() for r in rows])
    assert np.allclose(share, T.softmax(raw)) and (raw.argmax(axis=1) == [r["prediction"] for r in rows]).all()
    assert (raw.argmax(axis=1) == y).mean() > 0.7
    # Each tree sees its own draw of columns, two of the three.
    seen = [frozenset(t.feature[t.inner].tolist()) for r in model.trees for t in r]
    assert all(len(s) <= 2 for s in seen) and len(set(seen)) > 2
    again = B.JointBoosting(rounds=8, depth=3, rate=0.3, rows=0.7, columns=0.7).fit(df)
    assert np.allclose(raw, [r["raw"].toArray() for r in again.transform(df).orderBy("id").collect()])


def test_flat_forest_equals_spark_trees_row_by_row(spark):
    df, x, _ = table(spark, 500)
    x = np.concatenate([x, [[np.nan, 0.0, 1.0], [0.0, np.inf, -np.inf]]])
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x], "x0 double, x1 double, x2 double")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(
        rows.coalesce(1))
    trees, want = [], []
    for depth in (0, 1, 4, 7):
        target = df.withColumn("t", F.sin(F.col("x0") * (depth + 1)) + F.col("x1"))
        model = DecisionTreeRegressor(labelCol="t", maxDepth=depth, leafCol="leaf").fit(target)
        trees.append(T.parse_tree(model.toDebugString))
        out = model.transform(rows).collect()
        want.append([(r["prediction"], r["leaf"]) for r in out])
    forest = T.Forest(trees, range(4), 4)
    assert (forest.margins(x) == np.array([[v for v, _ in w] for w in want]).T).all()
    assert (forest.leaves(x) == np.array([[n for _, n in w] for w in want]).T).all()


def test_patience_keeps_the_rounds_up_to_the_lowest_loss(spark):
    df, _, _ = table(spark, 300)
    df = df.withColumn("held", F.col("id") % 3 == 0)
    model = B.JointBoosting(rounds=60, depth=4, rate=1.0, l2=0.1, leafWeight=0.0, patience=5,
                            validationIndicatorCol="held").fit(df)
    losses = model.losses
    best = int(np.argmin(losses))
    assert len(losses) == best + 1 + 5 < 60 and model.rounds == best + 1
    kept = [r["kept"] for r in model.rounds_table(spark).orderBy("round").collect()]
    assert kept == [True] * (best + 1) + [False] * 5
    # The losses are those of the held rows, by the rounds kept.
    share = model.transform(df.where("held"))
    got = [r["probability"][int(r["label"])] for r in share.collect()]
    assert -np.log(got).mean() == pytest.approx(losses[best])


def test_saved_models_have_the_same_margins(spark, tmp_path):
    df, _, _ = table(spark, 300)
    model = B.JointBoosting(rounds=3, depth=3, featuresCol="features").fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = B.JointBoostingModel.load(str(tmp_path / "m"))
    a, b = (m.transform(df).select("raw", "probability", "prediction").collect() for m in (model, loaded))
    assert a == b and loaded.featureImportances == model.featureImportances


def test_odd_tables(spark):
    df, _, _ = table(spark, 60)
    one = B.JointBoosting(rounds=2).fit(df.where("label = 1").withColumn("label", F.lit(0)))
    assert {r["prediction"] for r in one.transform(df).collect()} == {0.0}
    flat = df.withColumn("features", F.first("features").over(__import__("pyspark").sql.Window.partitionBy(F.lit(1))))
    shares = {tuple(r["probability"]) for r in B.JointBoosting(rounds=3, depth=2).fit(flat).transform(flat).collect()}
    assert len(shares) == 1
    with pytest.raises(ValueError):
        B.JointBoosting(rounds=2).fit(df.limit(0))
    with pytest.raises(ValueError):
        B.JointBoosting(rows=1.5)


def test_a_round_takes_the_same_passes_for_any_number_of_classes(spark):
    context, jobs = spark.sparkContext, []
    for k in (2, 6):
        df, _, _ = table(spark, 400, k=k)
        context.setJobGroup(f"classes{k}", "boosting")
        B.JointBoosting(rounds=2, depth=2, leafWeight=0.0).fit(df)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"classes{k}")))
    context.setJobGroup("others", "")
    assert jobs[0] == jobs[1] > 0


def test_rows_beyond_the_sample_get_the_margins_of_the_model(spark):
    df = spark.range(30_000).selectExpr("id", "sin(id * 1.7) x0", "cos(id * 0.3) * 5 x1", "id % 7 * 1.0 x2").selectExpr(
        "*", "cast(x0 > 0.2 as int) + cast(x1 > x2 - 3 as int) label", "id % 3 = 0 held")
    df = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)
    model = B.JointBoosting(rounds=4, depth=4, rate=0.5, bins=16, rows=0.7, leafWeight=0.0, patience=9,
                            validationIndicatorCol="held").fit(df)
    rows = model.transform(df.where("held")).select("probability", "label", "prediction").collect()
    # The last kept round's loss, taken over codes, is that of the scored rows.
    assert -np.log([r["probability"][r["label"]] for r in rows]).mean() == pytest.approx(model.losses[model.rounds - 1])
    assert np.mean([r["prediction"] == r["label"] for r in rows]) > 0.9


def test_thresholds_part_the_weight_evenly():
    rng = np.random.default_rng(1)
    values, weights = np.arange(5000.0), rng.random(5000) * (1 + np.arange(5000) % 3)
    upto, target, want = np.cumsum(weights), weights.sum() / 32, []
    for i in range(1, 5000):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            want.append(values[i] - 0.5)
            target += weights.sum() / 32
    assert B.quantiles(values, weights, 31).tolist() == want and len(want) == 31
    assert B.quantiles(values[:4], weights[:4], 3).tolist() == [0.5, 1.5, 2.5]


def test_blocks_are_bounded_whatever_the_batches():
    n, width = 30_000, 40
    x = np.random.default_rng(1).normal(size=(n, width))
    batches = [pa.RecordBatch.from_arrays(
        [pa.array(np.arange(a, b)), B._lists(x[a:b]), pa.array(np.arange(a, b) % 3, pa.int32()), pa.array(np.ones(b - a)),
         pa.array(np.zeros(b - a, bool))], ["row", "x", "label", "weight", "held"])
        for a, b in ((0, 10_000), (10_000, 10_007), (10_007, 20_000), (20_000, n))]
    blocks = list(B._each(B._packed(batches)))
    assert max(len(b["x"]) for b in blocks) <= 8 * B.BLOCK_VALUES == 1 << 20
    assert [b["start"] for b in blocks] == np.cumsum([0, *(b["count"] for b in blocks)])[:-1].tolist()
    assert b"".join(b["x"] for b in blocks) == x.tobytes() and sum(b["count"] for b in blocks) == n


@pytest.mark.parametrize("watched", [False, True])
def test_one_task_and_many_grow_the_same_trees(spark, monkeypatch, watched):
    df, _, _ = table(spark, 900, k=4)
    df = df.repartition(5, "id").withColumn("held", F.col("id") % 4 == 0).withColumn("w", 1 + F.col("id") % 3)
    more = {"validationIndicatorCol": "held", "patience": 9} if watched else {}
    booster = B.JointBoosting(rounds=7, depth=3, rate=0.6, rows=0.8, columns=0.7, leafRows=3, weightCol="w", **more)
    jobs, context = [], spark.sparkContext
    for values in (B.ALONE_VALUES, 0):
        monkeypatch.setattr(B, "ALONE_VALUES", values)
        monkeypatch.setattr(B, "TASK_VALUES", 4000)
        monkeypatch.setattr(B, "KEPT_BYTES", 5000)
        monkeypatch.setattr(B, "CUT_ROUNDS", 2)
        context.setJobGroup(f"fit{values}{watched}", "boosting")
        model = booster.fit(df)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"fit{values}{watched}")))
        if values:
            alone = model
    context.setJobGroup("others", "")
    assert jobs[0] < 7 < jobs[1]  # no job for each round, where a task can hold the rows
    assert alone.rounds == model.rounds and np.allclose(alone.losses, model.losses) and bool(alone.losses) == watched
    a, b = ([r["raw"].toArray() for r in m.transform(df).orderBy("id").collect()] for m in (alone, model))
    assert np.allclose(a, b, atol=1e-9)


def test_kept_rows_lie_in_partitions_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(B, "ALONE_VALUES", 0)
    monkeypatch.setattr(B, "KEPT_BYTES", 1 << 16)
    monkeypatch.setattr(B, "TASK_VALUES", 1 << 16)
    tasks, parts = [], []
    passes, persist = B.JointBoosting._passes, DataFrame.persist
    monkeypatch.setattr(B.JointBoosting, "_passes", staticmethod(
        lambda rows, *more: (tasks.append(rows.rdd.getNumPartitions()), passes(rows, *more))[1]))
    monkeypatch.setattr(DataFrame, "persist", lambda df, *more: (parts.append(df), persist(df, *more))[1])
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.range(20_000).selectExpr("id * 0.5d a", "id % 7 * 1d b", "id % 3 label"))
    B.JointBoosting(rounds=1, depth=1).fit(df.coalesce(2))
    # 20,000 rows of 41 bytes fill 13 partitions of 64 kB; 120,000 values are read by two tasks.
    assert {d.rdd.getNumPartitions() for d in parts if "margins" in d.columns} == {13} and set(tasks) == {2}
