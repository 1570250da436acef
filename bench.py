"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The flow table is loaded once, spread over the cores and kept in memory, as `load`;
every other figure is the wall time of one operator or flow on it, results included.
Training uses the full presets, but for the boosters' rounds: $BENCH_ROUNDS of the
published 100 (default 20), as stated in the output.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from flowlab import catalog as K  # noqa: E402
from flowlab.operators import classifiers as C  # noqa: E402
from flowlab.operators import evaluate as V  # noqa: E402
from flowlab.operators import prepare as P  # noqa: E402
from flowlab.operators import profile as E  # noqa: E402
from flowlab.operators import sampling as M  # noqa: E402
from flowlab.operators import score as S  # noqa: E402
from flowlab.plans.clean import clean  # noqa: E402
from flowlab.sources.tables import spread  # noqa: E402


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    rounds = int(os.environ.get("BENCH_ROUNDS", "20"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        # One machine, so a folder of its own is shared by all tasks.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def run(name: str, action):
        start = time.perf_counter()
        out = action()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
        return out

    flows = spread(K.flows(spark, folder)).persist()
    rows = run("load", flows.count)
    label, key = "band", K.KEY
    features = K.MODEL_FEATURES

    run("class_distribution", lambda: E.class_distribution(flows, "label").collect())
    run("null_counts", lambda: E.null_counts(flows).collect())
    run("describe", lambda: E.describe(flows, K.FEATURES).collect())
    run("correlation", lambda: E.correlation(flows, K.FEATURES).collect())
    run("clean", lambda: drain(clean(flows.select(*K.FEATURES, "label"))[0]))
    run("label_encode", lambda: drain(P.label_encode(flows, ["label"])))
    run("fill_median", lambda: drain(P.fill_median(flows, ["price", "revenue"])))
    run("class_weights", lambda: drain(P.class_weights(flows, label)))
    run("stratified_sample", lambda: drain(M.stratified_sample(flows, label, 0.12, key)))
    split = run("stratified_split", lambda: M.stratified_split(flows, label, 0.2, key).persist())
    run("split_materialised", lambda: split.groupBy("is_test").count().collect())
    train = split.where("NOT is_test").drop("is_test")
    test = split.where("is_test").drop("is_test")
    run("standardize", lambda: [drain(d) for d in P.standardize(train, test, features)])
    run("cv_subsample_folds", lambda: drain(
        M.assign_folds(M.cv_subsample(train, label, 30_000, key), label, 3, key)))

    presets = [p.with_params(rounds=rounds) if p.family == "boosting" else p for p in C.PRESETS]
    models, quality = {}, {}
    for p in presets:
        models[p.key] = run(f"train_{p.key}", lambda: C.fit_model(p, train, features, label))
        counts = run(f"score_{p.key}", lambda: V.confusion_counts(
            models[p.key].transform(test), label, f"{p.key}_prediction").collect())
        right = sum(r["n"] for r in counts if r["label"] == r["prediction"])
        quality[p.key] = round(right / sum(r["n"] for r in counts), 6)
    run("predict_and_vote", lambda: drain(S.majority_vote(
        S.predict_attacks(test, models), [f"{k}_prediction" for k in models])))
    pseudo = flows.withColumn("prediction", F.expr(K.PSEUDO))
    run("class_report", lambda: V.class_report(V.confusion_counts(pseudo, label)).collect())
    run("roc_auc", lambda: V.roc_auc(flows, "price", F.col(label) == 5).collect())

    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "rows": rows, "cpus": cpus, "boosting_rounds": rounds, "test_accuracy": quality,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
