import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from flowlab import catalog
from flowlab.operators import classifiers as C
from flowlab.operators import evaluate as V
from flowlab.operators import sampling as M
from flowlab.operators import score as S
from flowlab.plans import train as T
from flowlab.plans.clean import clean
from flowlab.plans.scoring import score
from flowlab.sources import models as store
from flowlab.streaming.scoring import score_stream

FEATURES = ["x0", "x1", "x2"]
BRIEF = [
    C.LOGISTIC.with_params(iterations=30), C.BAYES, C.FOREST.with_params(trees=5, leaf=2),
    C.BOOSTING_REGULARISED.with_params(rounds=3, rate=0.3, rows=1.0, columns=1.0),
    C.BOOSTING_BALANCED.with_params(rounds=2, depth=3, leaf=2),
]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n, centres = 600, np.array([[0, 0, 5.0], [3, 0, 5], [0, 3, 5]])
    y = rng.choice(3, n, p=[0.6, 0.3, 0.1])
    x = centres[y] + rng.normal(0, 0.7, (n, 3)) * [1, 1, 0]
    rows = [(i, *map(float, x[i]), int(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, x0 double, x1 double, x2 double, label long")
    split = M.stratified_split(df, "label", 0.25, ["id"]).cache()
    return split.where("NOT is_test").drop("is_test"), split.where("is_test").drop("is_test")


@pytest.fixture(scope="module")
def fitted(data):
    return {p.key: C.fit_model(p, data[0], FEATURES) for p in BRIEF}


def test_every_model_beats_the_largest_class(data, fitted):
    scored = S.predict_attacks(data[1], fitted).toPandas()
    for key in fitted:
        assert (scored[f"{key}_prediction"] == scored["label"]).mean() > 0.8, key
        assert scored[f"{key}_confidence"].between(1 / 3 - 1e-9, 1).all(), key


def test_bayes_equals_the_formula(data, fitted):
    train, test = (d.toPandas() for d in data)
    m, s = train[FEATURES].mean(), train[FEATURES].std(ddof=0).replace(0, 1)
    a, b = ((d[FEATURES] - m) / s for d in (train, test))
    eps = 1e-5 * a.var(ddof=0).max()
    scores = []
    for c in range(3):
        part = a[train["label"] == c]
        var = part.var(ddof=0) + eps
        scores.append(np.log(len(part) / len(a)) - 0.5 * (
            np.log(2 * np.pi * var) + (b - part.mean()) ** 2 / var).sum(axis=1))
    joint = np.array(scores).T
    share = np.exp(joint - joint.max(axis=1, keepdims=True))
    share /= share.sum(axis=1, keepdims=True)
    got = S.predict_attacks(data[1], {"naive_bayes": fitted["naive_bayes"]}).toPandas()
    assert (got["naive_bayes_prediction"] == joint.argmax(axis=1)).all()
    assert np.allclose(got["naive_bayes_confidence"], share.max(axis=1))


def test_saved_models_score_alike(spark, data, fitted, tmp_path):
    store.save_models(fitted, str(tmp_path))
    loaded = store.load_models(list(fitted), str(tmp_path))
    assert store.feature_names(loaded["random_forest"]) == FEATURES
    a = score(data[1], fitted, ["id"]).orderBy("id").toPandas()
    b = score(data[1], loaded, ["id"]).orderBy("id").toPandas()
    assert a.equals(b)


def test_scoring_does_not_shuffle(spark, data, fitted, tmp_path):
    data[1].write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    plan = score(rows, fitted, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_streamed_rows_score_alike(spark, data, fitted, tmp_path):
    data[1].write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(data[1].schema).parquet(str(tmp_path / "in"))
    score_stream(stream, fitted, str(tmp_path / "out"), str(tmp_path / "state"), ["id"]).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch").orderBy("id").toPandas()
    want = score(data[1], fitted, ["id"]).orderBy("id").toPandas()
    assert got[want.columns].equals(want)


@pytest.mark.parametrize("given", [False, True])
def test_early_stopping_keeps_the_rounds_up_to_the_lowest_loss(data, given):
    preset = C.BOOSTING_BALANCED.with_params(rounds=12, depth=5, rate=1.0, leaf=1, l2=0.5)
    model, found = C.fit_early_stopping(preset, data[0], FEATURES, key_cols=["id"], patience=3,
                                        watched=data[1] if given else None)
    rows = found.orderBy("round").collect()
    losses = [r["loss"] for r in rows]
    best = losses.index(min(losses))
    assert len(rows) == min(12, best + 4) and [r["kept"] for r in rows] == [i <= best for i in range(len(rows))]
    assert model.stages[-1].rounds == best + 1
    scored = S.predict_attacks(data[1], {preset.key: model})
    assert V.accuracy(V.confusion_counts(scored, prediction=f"{preset.key}_prediction")).head()[0] > 0.8


def test_importance_finds_the_useful_features(spark, fitted):
    for key in ("random_forest", "boosting_regularised", "boosting_balanced"):
        rows = C.feature_importance(fitted[key], FEATURES, spark, 2).collect()
        assert {r["feature"] for r in rows} == {"x0", "x1"}


def test_fallback_takes_the_next_preset(data):
    broken = C.BOOSTING_REGULARISED.with_params(rows=2.0)
    used, model, errors = C.fit_with_fallback([broken, BRIEF[3]], lambda p: C.fit_model(p, data[0], FEATURES))
    assert used == BRIEF[3] and isinstance(model, PipelineModel)
    assert len(errors) == 1 and "rows is a share" in errors[0]
    with pytest.raises(Exception):
        C.fit_with_fallback([broken], lambda p: C.fit_model(p, data[0], FEATURES))


def test_grid_has_all_settings_of_the_search(data):
    booster = C.pipeline(C.BOOSTING_REGULARISED, FEATURES, "label", 0).getStages()[-1]
    grid = C.boosting_grid(booster)
    assert len(grid) == len({C.settings(g) for g in grid}) == 27
    assert {tuple(p.name for p in g) for g in grid} == {("rate", "depth", "l2")}


def test_grid_search_prefers_the_better_setting(data):
    folded = M.assign_folds(data[0], "label", 3, ["id"])
    pipe = C.pipeline(BRIEF[2], FEATURES, "label", 0)
    pipe.getStages()[-1].clear(pipe.getStages()[-1].weightCol)
    forest = pipe.getStages()[-1]
    grid = C.ParamGridBuilder().addGrid(forest.maxDepth, [0, 4]).build()
    _, table = C.grid_search(pipe, grid, folded, "label", "random_forest_prediction")
    rows = table.orderBy("trial").collect()
    assert rows[1]["mean_accuracy"] > rows[0]["mean_accuracy"] + 0.1
    assert [r["best"] for r in rows] == [False, True] and rows[0]["tried"] is None


def test_halving_finds_the_best_of_the_whole_search(data):
    folded = M.assign_folds(data[0].limit(200), "label", 2, ["id"])
    assembler, booster = C.pipeline(BRIEF[3].with_params(rounds=4), FEATURES, "label", 0).getStages()
    vectors = assembler.transform(folded).persist()
    grid = C.boosting_grid(booster, rate=(0.001, 0.3), depth=(1, 3), l2=(1.0,))
    prediction = "boosting_regularised_prediction"
    _, whole = C.grid_search(booster, grid, vectors, "label", prediction, parallelism=4)
    model, halved = C.grid_search(booster, grid, vectors, "label", prediction, parallelism=4,
                                  halving=(booster.rounds, 4), factor=2)
    vectors.unpersist()
    best = lambda t: [r["settings"] for r in t.where("best").collect()]
    assert best(whole) == best(halved) and model.rounds == 4
    assert sorted(r["tried"] for r in halved.collect()) == [2, 2, 4, 4] and whole.count() == 4


def test_evaluation_record(spark, data):
    done = T.evaluate_model(C.BAYES, *data, FEATURES, key_cols=["id"], k=3, cv_rows=300)
    row = T.results_table(spark, [done]).head().asDict()
    assert set(row) == {"model", *T.FIGURES}
    assert row["gap"] == pytest.approx(row["train_accuracy"] - row["test_accuracy"])
    assert row["cv_f1_weighted"] > 0.8 and row["train_seconds"] > 0
    assert sum(r["n"] for r in done.counts.collect()) == data[1].count()


def test_clean_drops_redundant_and_flat_columns(spark, data):
    wide = data[0].drop("id").withColumn("copy", 2 * F.col("x0")).withColumn("extra", F.lit(1))
    kept, report = clean(wide, "label", exclude=["extra"])
    # x0 and its copy tie, so the earlier one goes; x2 never varies.
    assert kept.columns == ["x1", "label", "copy"]
    assert {r["feature"] for r in report.where("NOT kept").collect()} == {"x0"}


def test_a_forest_deals_its_rows_to_tasks_of_bounded_size(spark, monkeypatch):
    rows = spark.range(5000).selectExpr("id * 1.0 x0", "id % 9 * 1.0 x1", "id % 2 label").coalesce(1).persist()
    monkeypatch.setattr(C, "FOREST_BYTES", 1 << 16)
    dealt = C._dealt(rows, 5000, 2, 10)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 5000 and max(sizes) * (4 * 2 + 4 * 10 + 128) < 2 << 16
    monkeypatch.setattr(C, "FOREST_BYTES", 1 << 28)
    assert C._dealt(rows, 5000, 2, 10).rdd.getNumPartitions() == 1
    rows.unpersist()


def test_a_forest_computes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def marked(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 400, 1, 2).selectExpr("id % 7 * 1.0d x0", "id % 2 label").mapInArrow(marked, "x0 double, label long")
    model = C.fit_model(C.FOREST.with_params(trees=3, leaf=2), rows, ["x0"])
    assert seen.value == 400 and model.stages[-1].getNumTrees == 3


def test_models_share_the_rows_that_they_are_cross_validated_on(data, monkeypatch):
    alone = T.cross_validate(BRIEF[2], data[0], FEATURES, k=3, rows=300, key_cols=["id"]).orderBy("fold").collect()
    drawn = []
    draw = T.cv_subsample
    monkeypatch.setattr(T, "cv_subsample", lambda *a: (drawn.append(1), draw(*a))[1])
    done = T.evaluate_all([C.BAYES, BRIEF[2]], *data, FEATURES, key_cols=["id"], k=3, cv_rows=300)
    assert len(drawn) == 1
    assert done[1].figures["cv_f1_weighted"] == pytest.approx(sum(r["f1_weighted"] for r in alone) / 3)


class Done(Exception):
    pass


@pytest.mark.parametrize("name", ["score_flow", "train_and_compare", "training_run"])
def test_the_whole_flows_train_the_presets_as_they_are(spark, tmp_path, monkeypatch, name):
    spark.range(600).selectExpr(
        "id l_orderkey", "id % 40 l_partkey", "id % 12 l_suppkey", "1 l_linenumber", "id % 50 + 1.0d l_quantity",
        "id * 1.5d l_extendedprice", "id % 11 * 0.01d l_discount", "id % 9 * 0.01d l_tax", "'A' l_returnflag",
        "'F' l_linestatus").write.parquet(str(tmp_path / "lineitem.parquet"))
    seen = []

    def record(preset, *a, **b):
        seen.append(preset)
        if len(seen) == len(C.PRESETS):
            raise Done

    monkeypatch.setattr(catalog.C if name == "score_flow" else T,
                        "fit_model" if name == "score_flow" else "evaluate_with_fallback", record)
    with pytest.raises(Done):
        catalog.QUERIES[name](spark, str(tmp_path))
    assert tuple(seen) == C.PRESETS
