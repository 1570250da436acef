import math
import random

from pyspark.sql import functions as F

from flowlab.llm import mixing as M


def targets(sizes):
    """The rule of the targets, source after source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: M.WEIGHTS[i % len(M.WEIGHTS)] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed.update({s: 3 * sizes[s] for s in above})


def check(docs, got):
    size = {}
    for _, text, source in docs:
        size[source] = size.get(source, 0) + len((text or "").split())
    want, taken = targets(size), dict.fromkeys(size, 0)
    by_id = {d[0]: d for d in docs}
    for r in got:
        source = by_id[r["doc_id"]][2]
        assert r["size"] == len((by_id[r["doc_id"]][1] or "").split())
        assert r["source_size"] == size[source] and abs(r["target"] - want[source]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for source, words in taken.items():
        assert abs(words - want[source]) <= 0.5 + 1e-6
    # A source is taken in whole passes, with one document cut at most.
    for source in size:
        passes = math.floor(want[source] / size[source]) if size[source] else 0
        cut = [r for r in got if by_id[r["doc_id"]][2] == source and r["size"]
               and r["taken"] not in (passes * r["size"], (passes + 1) * r["size"])]
        assert len(cut) <= 1


def corpus(r, words):
    sources = ["hot"] * 6 + ["a", "b", "tiny", None, "é", "z"]
    return [(i, words(i, r.choice([1, 3, 20, 200])), r.choice(sources)) for i in range(400)] + [
        (400, None, "empty"), (401, " \t", "a"), (402, "w " * 40_000, "b"), (403, "one", "lone")]


def test_targets_are_met(make_docs, text_of_words, with_clashes, rows):
    docs = corpus(random.Random(6), text_of_words)
    frame = make_docs(docs)
    first = M.mix(frame)
    check(docs, first.collect())
    assert rows(M.mix(frame.repartition(7))) == rows(first)
    clashing = M.mix(with_clashes(frame.repartition(7)))
    assert clashing.columns == first.columns
    check(docs, clashing.collect())


def test_schedule_keeps_the_shares_all_along(make_docs, text_of_words):
    docs = [(i, text_of_words(i, 50), f"s{i % 3}") for i in range(600)]
    pieces = M.mixing_schedule(make_docs(docs)).groupBy("slot", "at").agg(F.sum("n_words").alias("n")).orderBy("slot").collect()
    total, by = 0, [0, 0, 0]
    for r in pieces:
        by[r["at"]] += r["n"]
        total += r["n"]
        if total > 3000 and r["slot"] < 2300:
            for i, share in enumerate((1 / 6, 2 / 6, 3 / 6)):
                assert abs(by[i] / total - share) < 0.02


def test_schedule_places_the_documents(make_docs, text_of_words, monkeypatch):
    """Documents in order of their first slots keep the shares all along; with points that
    aren't spread evenly they are placed elsewhere."""
    docs = make_docs([(i, text_of_words(i, 50), f"s{i % 3}") for i in range(600)])
    got = M.mix(docs).where("taken > 0").select("doc_id", "taken", "first_slot", "n_slots").orderBy("first_slot").collect()
    source = lambda r: r["doc_id"] % 3
    total, by = 0, [0, 0, 0]
    for r in got[:250]:  # before any document is taken again
        by[source(r)] += 1
        total += 1
        if total > 60:
            for i, share in enumerate((1 / 6, 2 / 6, 3 / 6)):
                assert abs(by[i] / total - share) < 0.05
    monkeypatch.setattr(M, "PHI", 1)
    other = {r["doc_id"]: r["first_slot"] for r in M.mix(docs).collect()}
    assert sum(other[r["doc_id"]] != r["first_slot"] for r in got) > 300


def test_mixed_rows_come_in_order_of_their_slots(make_docs, text_of_words):
    docs = make_docs([(i, text_of_words(i, 50), f"s{i % 3}") for i in range(600)])
    rows = M.mixed_rows(docs).collect()
    by = [0, 0, 0]
    for n, r in enumerate(rows[:500], 1):
        by[r["doc_id"] % 3] += 1
        if n > 60:
            for i, share in enumerate((1 / 6, 2 / 6, 3 / 6)):
                assert abs(by[i] / n - share) < 0.05


def test_pieces_join_to_whole_documents(make_docs, text_of_words):
    docs = [(i, text_of_words(i, 5 + i % 90), f"s{i % 4}") for i in range(200)]
    pieces = M.mixing_schedule(make_docs(docs)).collect()
    seen = {}
    for r in pieces:
        seen.setdefault((r["doc_id"], r["pass"]), []).append((r["first_word"], r["n_words"]))
    for spans in seen.values():
        at = 0
        for first, n in sorted(spans):
            assert first == at
            at += n


def test_rows_come_as_often_as_they_are_taken(make_docs, text_of_words, with_clashes):
    docs = [(i, text_of_words(i, 30), "abc"[i % 3] if i else "c") for i in range(300)] + [(5, text_of_words(5, 30), "c")] * 3
    frame = with_clashes(make_docs(docs))
    mixed = M.mixed_rows(frame)
    assert mixed.columns == frame.columns
    times = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    words = sum(times.values()) * 30
    assert abs(words - 303 * 30) <= 3 * 30 and max(times.values()) <= 3 * 4
    assert M.mixed_rows(frame).exceptAll(mixed).count() == 0


def test_odd_rows_and_empty_tables(odd_docs, make_docs):
    got = M.mix(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert sum(r["taken"] for r in got) > 0 and all(r["taken"] <= 3 * r["size"] for r in got)
    assert M.mix(odd_docs.limit(0)).count() == 0 and M.mixed_rows(odd_docs.limit(0)).count() == 0
    assert sorted(tuple(r) for r in M.mix(make_docs([(1, None), (2, "")])).collect()) == [
        (1, 0, 0, 0.0, 0, None, 0), (2, 0, 0, 0.0, 0, None, 0)]


def test_map_columns_and_many_equal_rows(make_docs, text_of_words):
    same = [(7, text_of_words(7, 20), "hot")] * 400
    docs = make_docs(same + [(100 + i, text_of_words(i, 20), "b") for i in range(200)])
    docs = docs.withColumn("tags", F.create_map(F.lit("k"), F.array(F.create_map(F.lit(1), F.col("lang")))))
    got = M.mix(docs)
    assert got.count() == 600 and got.agg(F.sum("taken")).head()[0] == 12_000
    mixed = M.mixed_rows(docs)
    assert mixed.columns == docs.columns
    # Weights 1 and 2 of b and hot.
    assert {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()} == {"b": 200, "hot": 400}
