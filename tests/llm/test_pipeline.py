import random

import pytest

import corpus_pipeline as P
from flowlab.llm import decontaminate as D
from flowlab.llm.sharding import SHARDS
from test_decontaminate import nearest
from test_jaccard_join import brute as near
from test_mixing import targets
from test_quality_rules import stated


@pytest.fixture(scope="module")
def folder(spark, make_docs, text_of_words, tmp_path_factory):
    r = random.Random(3)
    docs = [(i, "\n".join(text_of_words(i * 10 + j, r.randint(8, 30)) for j in range(3)), r.choice(["a", "b", "hot", "hot", None]))
            for i in range(150)]
    for i in range(150, 190):  # near copies
        words = r.choice(docs[:100])[1].split(" ")
        if i % 2:
            words[r.randrange(len(words))] = "changed"
        docs.append((i, " ".join(words), r.choice("ab")))
    items = [(i, text_of_words(9000 + i, 25)) for i in range(5)]
    docs += [(190 + i, f"{text_of_words(8000 + i, 30)} {items[i][1]}", "a") for i in range(5)]
    docs += [(200, "too short", "a"), (201, None, "a"), (202, "again and again " * 30, "b")]
    out = tmp_path_factory.mktemp("tables")
    make_docs(docs).write.parquet(str(out / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(out / "benchmark.parquet"))
    return str(out), docs, items


def test_equals_brute_force(spark, folder):
    path, docs, items = folder
    left = [d for d in docs if not stated(d[1])[-1]]
    parts = near([(d[0], d[1]) for d in left], 5, 80)
    left = [d for d in left if parts[d[0]][1] == d[0]]
    assert len(left) < len(docs) - 20
    left = [d for d in left if not any(
        nearest(f := D.plain(t), D.plain(d[1])) <= len(f) * D.MAX_EDITS_PCT // 100 for _, t in items)]
    want = {d[0] for d in left}
    got = P.run(spark, path).collect()
    times = {}
    for r in got:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert set(times) <= want and max(times.values()) <= 3
    size, taken = {}, {}
    for i, text, source in left:
        n = len(text.split())
        size[source] = size.get(source, 0) + n
        taken[source] = taken.get(source, 0) + n * times.get(i, 0)
    longest = max(len(t.split()) for _, t, _ in left)
    for source, words in targets(size).items():
        assert abs(taken[source] - words) <= longest / 2 + 1
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and len(slots) == SHARDS


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, folder[0]).dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), folder[0]).count() == 0


def test_no_kept_text_holds_a_frequent_line(spark, make_docs, text_of_words, tmp_path):
    menu = text_of_words(500, 25)
    docs = make_docs([(i, f"{menu}\n{text_of_words(i, 40)}", "shop") for i in range(60)])
    kept = P.quality(spark, docs, "").collect()
    assert len(kept) == 60 and all(r["text"] == text_of_words(r["doc_id"], 40) for r in kept)


def test_odd_rows_clashing_names_and_empty_tables(spark, odd_docs, with_clashes, text_of_words, tmp_path):
    """From end to end: the last stage's rows are those of the odd documents that are kept."""
    items = [(1, text_of_words(1, 60)), (2, None)]
    for name, docs in (("odd", with_clashes(odd_docs)), ("empty", odd_docs.limit(0))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    # Documents 5 and 6 hold the item; 4, 8 and the one without an id are left.
    assert {r["doc_id"] for r in P.run(spark, f"{tmp_path}/odd").collect()} <= {4, 8, None}
    assert P.run(spark, f"{tmp_path}/empty").count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
