import re

from flowlab.llm import quality_rules as Q

WORD = r"[^\x20\x09-\x0D]+"


def stated(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), failed)


FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_statistics_equal_the_stated_ones(odd_docs, make_docs, text_of_words, with_clashes):
    rep = text_of_words(1, 12)
    docs = make_docs([
        (1, f"{rep} {rep} {text_of_words(2, 30)}"), (2, "a b c d e f g h " * 5), (3, "a " * 300), (4, "# * é ü <>|"),
        (5, f"{rep}\n{rep}\n\n \n{rep} \n{text_of_words(3, 90)}"), (6, text_of_words(4, 8)), (7, text_of_words(5, 7)),
        (8, text_of_words(6, 19)), (9, text_of_words(6, 20)), (10, "Été ÇA " * 9), (11, "a b\x0bc\x1cd " + text_of_words(9, 25))])
    for table in (with_clashes(docs), odd_docs):
        texts = {r["doc_id"]: r["text"] for r in table.collect()}
        for r in Q.judge(table).collect():
            if r["doc_id"] is not None:
                assert tuple(r[f] for f in FIELDS) == stated(texts[r["doc_id"]]), r["doc_id"]
                assert not (r["kept"] and r["base_failed"])


def test_frequent_lines_deplete_documents(make_docs, text_of_words):
    menu = text_of_words(500, 25)
    docs = [(i, f"{menu}\n{text_of_words(i, 60 if i % 2 else 6)}", "shop" if i < 40 else None) for i in range(80)]
    docs += [(100 + i, f"{menu.upper()}\n{text_of_words(i, 60)}", "other") for i in range(5)]
    got = {r["doc_id"]: r for r in Q.judge(make_docs(docs)).collect()}
    for i in range(80):
        assert got[i]["n_kept_words"] == (60 if i % 2 else 6) and got[i]["kept"] == bool(i % 2)
    assert all(got[100 + i]["kept"] and got[100 + i]["n_kept_words"] == 85 for i in range(5))  # too few documents
    good = {r["doc_id"]: r["text"] for r in Q.keep_good(make_docs(docs)).collect()}
    assert good == {i: text_of_words(i, 60) for i in range(80) if i % 2} | {
        100 + i: f"{menu.upper()}\n{text_of_words(i, 60)}" for i in range(5)}
    clean = {r["doc_id"]: r["text"] for r in Q.without_frequent_lines(make_docs(docs)).collect()}
    assert clean[1] == text_of_words(1, 60) and clean[101].startswith(menu.upper())


def test_copies_of_a_text_dont_make_its_lines_frequent(make_docs, text_of_words, rows):
    docs = make_docs([(i, text_of_words(1, 40)) for i in range(50)] + [(100, text_of_words(2, 40))])
    assert Q.judge(docs).where("kept").count() == 51
    assert rows(Q.keep_good(docs)) == rows(docs)


def test_odd_rows_and_empty_tables(odd_docs, with_clashes, rows):
    kept = Q.keep_good(with_clashes(odd_docs))
    assert kept.columns == with_clashes(odd_docs).columns
    assert {r["doc_id"] for r in kept.collect()} == {4, 5, 6, 8, None}
    assert kept.count() == 6
    assert Q.judge(odd_docs.limit(0)).count() == 0
    cleaned = Q.without_frequent_lines(odd_docs)
    assert rows(cleaned) == rows(odd_docs)
