import random

from flowlab.llm import decontaminate as D

ITEMS = "item_id long, text string"


def nearest(item, text):
    """Least edits between the item and any part of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_distance_equals_the_table():
    r = random.Random(4)
    for _ in range(500):
        item, text = ("".join(r.choices("abc ", k=r.randint(1, n))) for n in (90, 120))
        distance, end = D.best_match(item, text)
        assert distance == nearest(item, text)
        assert nearest(item, text[:end]) == distance


def edited(text, edits, r):
    chars = list(text)
    for _ in range(edits):
        at = r.randrange(len(chars))
        kind = r.random()
        if kind < 0.34:
            chars[at] = r.choice("xyz")
        elif kind < 0.67:
            chars.insert(at, r.choice("xyz"))
        else:
            del chars[at]
    return "".join(chars)


def test_equals_brute_force(spark, make_docs, text_of_words, with_clashes, rows):
    r = random.Random(8)
    items = [(i, text_of_words(100 + i, r.randint(6, 40))) for i in range(12)] + [
        (12, "short one"), (13, None), (14, ""), (15, text_of_words(103, 30)), (16, text_of_words(103, 30))]
    docs = []
    for i in range(70):
        body = text_of_words(500 + i, r.randint(0, 60))
        if i % 2:
            item = r.choice(items[:12])[1]
            body += " " + edited(item, r.randint(0, len(item) // 10), r) + " " + text_of_words(900 + i, r.randint(0, 30))
        docs.append((i, body.replace(" the", ".\nThe").upper() if i % 5 == 0 else body))
    want = set()
    for i, text in docs:
        for n, item in items:
            form = D.plain(item)
            slack = len(form) * D.MAX_EDITS_PCT // 100
            whole = f" {form} " in f" {D.plain(text)} "
            if form and (nearest(form, D.plain(text)) <= slack if slack else whole):
                want.add((i, n, nearest(form, D.plain(text))))
    assert 10 < len(want) < 200
    table = spark.createDataFrame(items, ITEMS)
    for block in (D.BLOCK_CHARS, 500):
        found = D.find_leaks(with_clashes(make_docs(docs)), with_clashes(table), block_chars=block)
        assert {tuple(x) for x in found.select("doc_id", "item_id", "distance").collect()} == want
        assert found.count() == len(want)
    left = D.without_leaks(make_docs(docs), table)
    assert {x["doc_id"] for x in left.collect()} == {i for i, _ in docs} - {i for i, _, _ in want}
    assert rows(left) == rows(make_docs(docs).join(left.select("doc_id"), "doc_id").select(*left.columns))


def test_short_items_are_found_where_they_stand_exactly(spark, make_docs):
    """Too short for an edit: exactly, between word bounds, which scripts without spaces have
    at every character."""
    items = spark.createDataFrame([(1, "Who is it, Bob 42?"), (2, "one"), (3, "什么是最大的行星"), (4, "?!"), (5, None),
                                   (6, " \n"), (7, "it"), (8, "sixteen letters")], ITEMS)
    docs = make_docs([(1, "He said: who is\nit - bob 42!"), (2, "someone, oneself, bones"), (3, "the One"),
                      (4, "问题:什么是最大的行星?答案是木星"), (5, "我想知道什么是最大的行星吗"), (6, "who is it bob 421"),
                      (7, "Sixteen letters."), (8, "sixteen lettersx"), (9, "?!"), (10, None)])
    found = {tuple(r)[:2] for r in D.find_leaks(docs, items).collect()}
    assert found == {(1, 1), (1, 7), (3, 2), (4, 3), (5, 3), (6, 7), (7, 8)}
    assert {r["doc_id"] for r in D.without_leaks(docs, items).collect()} == {2, 8, 9, 10}
    assert sorted(r[0] for r in D.blank_items(items).collect()) == [4, 5, 6]


def test_places_are_those_of_the_text(spark, make_docs, text_of_words):
    item = text_of_words(1, 20)
    text = f"«Été» {text_of_words(2, 15)}:\n\n{item.upper()}!! {text_of_words(3, 9)} ({item})"
    found = D.find_leaks(make_docs([(1, text)]), spark.createDataFrame([(7, item)], ITEMS)).collect()
    assert [tuple(r)[:4] for r in found] == [(1, 7, 2, 0)]
    assert text[found[0]["start_char"]:found[0]["end_char"]] == item.upper()


def test_odd_rows_and_empty_tables(spark, odd_docs, text_of_words):
    items = spark.createDataFrame([(1, text_of_words(1, 60)), (2, text_of_words(2, 60))], ITEMS)
    got = sorted((tuple(r)[:2] for r in D.find_leaks(odd_docs, items).collect()), key=repr)
    assert got == [(5, 1), (6, 1), (6, 1), (None, 2)]
    assert D.without_leaks(odd_docs, items).count() == odd_docs.count() - 4
    none = items.limit(0)
    assert D.find_leaks(odd_docs, none).count() == 0
    assert D.without_leaks(odd_docs, none).count() == odd_docs.count()
    assert D.find_leaks(odd_docs.limit(0), items).count() == 0
