import zlib

from pyspark.sql import functions as F

from flowlab.llm import sharding as S


def check(placed, n):
    slots = {}
    for r in placed:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sum(map(len, slots.values())) == n
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(S.SHARDS)]
    assert max(sizes) - min(sizes) <= 1


def test_permutation_equals_the_plain_one(spark):
    for n in (1, 2, 3, 5, 7, 8, 10, 99, 1000, 2503):
        want = [S.place(i, n) for i in range(n)]
        assert len(set(want)) == n
        assert [S.number_at(*p, n) for p in want] == list(range(n))
        passes = S.most_passes(spark.range(1), n)
        at = S.permuted(F.col("id"), n, passes)
        got = spark.range(n).select((at % S.SHARDS).alias("a"), F.call_function("div", at, F.lit(S.SHARDS)).alias("b"))
        assert [tuple(r) for r in got.collect()] == want


def test_shards_are_even_and_repeatable(make_docs, text_of_words, with_clashes, rows):
    docs = make_docs([(i, text_of_words(i % 300, 20)) for i in range(1003)])
    first = S.shard(docs)
    check(first.collect(), 1003)
    assert rows(S.shard(with_clashes(docs.repartition(5)))) == rows(first)
    # The order is mixed: neighbours don't stay together.
    near = [r["shard"] for r in first.orderBy("doc_id").collect()]
    assert sum(a == b for a, b in zip(near, near[1:])) < 250


def test_numbers_follow_from_the_rows_alone(make_docs, text_of_words):
    docs = make_docs([(i, text_of_words(i, 3)) for i in range(9000)]).selectExpr("doc_id", "n_chars AS size")
    numbers = S.numbered(docs, ["doc_id", "size"], 9000)
    assert sorted(r["number"] for r in numbers.collect()) == list(range(9000))
    assert numbers.exceptAll(S.numbered(docs.repartition(3), ["doc_id", "size"], 9000)).count() == 0


def test_odd_rows_and_empty_tables(odd_docs, make_docs):
    got = S.shard(odd_docs).collect()
    check(got, odd_docs.count())
    texts = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect() if r["doc_id"] is not None}
    for r in got:
        if r["doc_id"] is not None:
            raw = texts[r["doc_id"]].encode()
            assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
            assert r["law"] == "rows" and r["grown_shard"] is None
    assert S.shard(odd_docs.limit(0)).count() == 0
    check(S.shard(make_docs([(1, "same")] * 50)).collect(), 50)


def test_written_shards(spark, make_docs, tmp_path):
    placed = S.shard(make_docs([(i, str(i)) for i in range(100)]))
    S.write_shards(placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.select("shard").distinct().count() == S.SHARDS
