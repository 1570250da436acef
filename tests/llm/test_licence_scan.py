import random
import re

from flowlab.llm import licence_scan as L


def stated(text):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at, labels = [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        at += found
        labels |= {label} if found else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_equals_the_stated_rule(make_docs, with_clashes):
    r = random.Random(2)
    parts = "MIT license Apache License, general PUBLIC License. licence x é-mit 3 GNU\nlicense the".split(" ")
    docs = [(i, " ".join(r.choices(parts, k=r.randint(0, 14)))) for i in range(400)]
    got = {x[0]: tuple(x)[1:] for x in L.scan_licences(with_clashes(make_docs(docs))).collect()}
    for i, text in docs:
        assert got[i][:5] == stated(text), text
        assert set(filter(None, got[i][4].split(","))) <= set(got[i][5].split(",")) | {""}
        assert 0 <= got[i][6] <= 1


def test_templates_are_found_and_mandatory_phrases_decide(make_docs, text_of_words):
    docs, want = [], {}
    for i, (label, text, _) in enumerate(L.TEMPLATES):
        docs.append((i, f"{text_of_words(i, 50)}\n{text.upper()}. {text_of_words(100 + i, 30)}"))
        want[i] = label
    docs += [(100, text_of_words(3, 200)),
             (101, "Redistribution and use in binary forms, with or without modification, are permitted"),
             (102, "source conditions forms use binary redistribution following met permitted " * 3),
             (103, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.")]
    got = {r["doc_id"]: r for r in L.scan_licences(make_docs(docs)).collect()}
    for i, label in want.items():
        assert label in got[i]["labels"].split(","), label
    assert [got[i]["labels"] for i in (100, 101, 102)] == ["", "", ""]
    assert got[103]["labels"] == "cc-by-nc,mit" and got[103]["base_labels"] == "mit"


def test_frequencies_count_all_documents(make_docs):
    docs = make_docs([(i, "license license mit" if i < 3 else "other words") for i in range(10)])
    idf = L.inverse_frequencies(docs.select("text"))
    assert idf["license"] == idf["mit"] < idf["apache"]


def test_odd_rows_and_empty_tables(odd_docs):
    got = L.scan_licences(odd_docs).collect()
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect()}
    assert len(got) == odd_docs.count()
    assert all(tuple(r)[1:6] == stated(texts[r["doc_id"]]) for r in got if r["doc_id"] is not None)
    assert L.scan_licences(odd_docs.limit(0)).count() == 0
