import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from flowlab.functions.small import local_rows
from flowlab.functions.verdicts import gap_verdict, vote
from flowlab.operators import evaluate as V
from flowlab.operators import score as S

# Published test-set totals of the regularised booster, classes 0-35.
SUPPORT = [2232, 3952, 14, 4434, 23, 21, 1154, 115, 29053, 1821, 16502, 16292, 16404, 96, 14481,
           18147, 21858, 1167, 728, 52, 291, 8155, 10774, 13380, 1246, 3983, 3047, 3592, 541, 396,
           8, 332, 21, 5, 149, 15]
CORRECT = [1626, 3451, 0, 4299, 0, 0, 1109, 69, 29022, 1781, 16483, 16275, 16382, 7, 14457, 18133,
           21827, 1128, 334, 0, 217, 8109, 10741, 13335, 733, 3920, 2966, 3555, 285, 1, 0, 37, 0,
           0, 87, 0]
PREDICTED = [2127, 4057, 0, 5977, 0, 0, 1111, 69, 29471, 1781, 16486, 16310, 16504, 8, 14458, 18151,
             21918, 1128, 504, 0, 218, 8166, 10877, 13355, 830, 3950, 2984, 3555, 359,
             2, 0, 37, 0, 0, 88, 0]


def test_published_figures(spark):
    rows = [(c, s, p, k) for c, (s, p, k) in enumerate(zip(SUPPORT, PREDICTED, CORRECT))]
    totals = local_rows(spark, rows, "class bigint, support bigint, predicted bigint, correct bigint")
    report = V.report_from_totals(totals)
    assert sum(CORRECT) / sum(SUPPORT) == pytest.approx(0.978857, abs=5e-7)
    assert V.weighted_avg(report).head()["f1"] == pytest.approx(0.976452, abs=5e-7)
    assert V.macro_avg(report).head()["f1"] == pytest.approx(0.635398, abs=5e-7)
    by_class = {r["class"]: r for r in report.collect()}
    assert round(by_class[29]["precision"], 2) == 0.5 and round(by_class[0]["f1"], 2) == 0.75
    assert by_class[33]["f1"] == 0 and by_class[33]["precision"] == 0


def test_classes_on_one_side_only(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (2, 0), (2, 1), (0, 0)], "label long, prediction long")
    counts = V.confusion_counts(df)
    assert V.confusion_matrix(counts).count() == 9
    report = {r["class"]: r for r in V.class_report(counts).collect()}
    assert (report[1]["support"], report[1]["recall"], report[1]["f1"]) == (0, 0.0, 0.0)
    assert (report[2]["support"], report[2]["precision"]) == (2, 0.0)
    row = V.summary(counts).head()
    assert row["accuracy"] == pytest.approx(0.4)
    assert row["f1_macro"] == pytest.approx((4 / 6) / 3)


def test_empty_input(spark):
    counts = V.confusion_counts(spark.createDataFrame([], "label long, prediction long"))
    assert V.confusion_matrix(counts).count() == 0
    assert tuple(V.summary(counts).head()) == (0.0, 0.0, 0.0)
    assert V.accuracy(counts).head()[0] == 0.0


def test_verdict_bounds(spark):
    gaps = [-0.3, 0.0, 0.019, 0.02, 0.05, 0.10, 0.2]
    df = local_rows(spark, [(g,) for g in gaps], "gap double")
    got = [r[0] for r in df.select(gap_verdict(F.col("gap"))).collect()]
    assert got == ["excellent"] * 3 + ["good", "mild overfitting", "overfitting", "overfitting"]


@pytest.mark.parametrize("partitions", ["200", "7", "1"])
def test_roc_equals_sorting(spark, monkeypatch, partitions):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _roc_equals_sorting(spark)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_roc_plan_does_not_grow_with_the_rows(spark):
    df = spark.range(5000).select((F.col("id") / 7).alias("s"), (F.col("id") % 3 == 0).alias("y"))
    plans = [V.roc(df.limit(n), "s", F.col("y"))._jdf.queryExecution().optimizedPlan().toString() for n in (50, 5000)]
    assert abs(len(plans[0]) - len(plans[1])) < 200


def _roc_equals_sorting(spark):
    rng = np.random.default_rng(1)
    scores = np.round(rng.random(500), 2)
    scores[:200] = 0.5
    y = rng.random(500) < scores
    df = spark.createDataFrame(list(zip(scores.tolist(), y.tolist())), "s double, y boolean")
    got = V.roc(df, "s", F.col("y")).orderBy(F.desc("threshold")).collect()
    for r in got:
        assert r["tp"] == int((y & (scores >= r["threshold"])).sum())
        assert r["fp"] == int((~y & (scores >= r["threshold"])).sum())
    pos, neg = scores[y][:, None], scores[~y][None, :]
    want = ((pos > neg) + 0.5 * (pos == neg)).mean()
    assert sum(r["area"] for r in got) == pytest.approx(want)


def test_threshold_sweep_without_any_flag(spark):
    df = spark.createDataFrame([(0.2, True), (0.9, False), (None, True)], "s double, y boolean")
    rows = V.threshold_sweep(df, "s", F.col("y"), [0.0, 5.0]).collect()
    assert (rows[0]["precision"], rows[0]["recall"]) == (0.5, 1.0)
    assert (rows[1]["precision"], rows[1]["recall"], rows[1]["f1"]) == (0.0, 0.0, 0.0)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.integers(0, 4)] * 5), min_size=1, max_size=60))
def test_vote(spark, ballots):
    fixed = [(4, 4, 1, 1, 2), (5, 3, 9, 1, 7), (2, 2, 2, 2, 2)]
    rows = [tuple(b) for b in ballots] + fixed
    df = local_rows(spark, [(i, *b) for i, b in enumerate(rows)],
                    "i bigint, a bigint, b bigint, c bigint, d bigint, e bigint")
    wide = {r["i"]: r["vote"] for r in S.majority_vote(df, list("abcde")).collect()}
    long = df.select("i", F.explode(F.array(*"abcde")).alias("prediction"))
    narrow = {r["i"]: r["vote"] for r in S.majority_vote_long(long, ["i"]).collect()}
    want = {i: min(b, key=lambda v: (-b.count(v), v)) for i, b in enumerate(rows)}
    assert wide == narrow == want


def test_rules_and_status(spark):
    df = spark.createDataFrame([(60, 5, 1), (60, 50, 2), (1, 1, None)], "syn int, ack int, label int")
    out = S.apply_rules(df, [("syn > 50 AND ack < 10", 1), ("syn > 50", 9)], 0, "rule")
    rows = S.match_status(out, "rule").collect()
    assert [r["rule"] for r in rows] == [1, 9, 0]
    assert [r["status"] for r in rows] == ["correct", "wrong", "wrong"]


def test_compare(spark):
    df = local_rows(spark, [("b", 0.5), ("a", 0.5), ("c", 0.9)], "model string, test_accuracy double")
    assert [r["model"] for r in V.compare(df).collect()] == ["c", "a", "b"]
    assert V.best_model(df).head()["model"] == "c"
