import random
import re

import numpy as np
import pytest

from flowlab.llm import jaccard_join as J


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(docs, size, percent):
    """(n_shingles, component) of each id, from all pairs."""
    sets = {i: shingles(t, size) for i, t in docs}
    least = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return {i: (len(sets[i]), least[i]) for i in sets}


def family(r, words, seed, n, edits):
    """A text and edited copies of it and of each other."""
    out = [words(seed, r.randint(5, 150)).split()]
    for _ in range(n):
        copy = list(r.choice(out))
        for _ in range(r.randint(0, edits)):
            copy[r.randrange(len(copy))] = f"w{r.randrange(10**6)}"
        out.append(copy)
    return [" ".join(x) for x in out]


@pytest.mark.parametrize("size,percent,plan", [
    (3, 90, None), (5, 80, None), (5, 80, J.PartEnum(80, away=0, parts=1)),
    (2, 60, J.PartEnum(60, band=2.0, away=2, parts=4, finer=2))])
def test_equals_brute_force(spark, make_docs, text_of_words, monkeypatch, size, percent, plan):
    r = random.Random(size * percent)
    texts = [t for s in range(25) for t in family(r, text_of_words, s, r.randint(0, 12), 4)]
    texts += [text_of_words(700 + i, r.randint(0, 6)) for i in range(40)] + [texts[0], texts[0].upper(), texts[9]]
    shared = text_of_words(5000, 30)
    texts += [f"{shared} {text_of_words(900 + i, 25)}" for i in range(30)]
    r.shuffle(texts)
    docs = list(enumerate(texts))
    if plan:
        real = J.links
        monkeypatch.setattr(J, "links", lambda t, c, s, p: real(t, c, s, p, plan))
    for block in (1 << 20, 300):
        monkeypatch.setattr(J, "BLOCK_FEATURES", block)
        got = J.jaccard_components(make_docs(docs).repartition(3), size, percent).collect()
        assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got} == brute(docs, size, percent)


def test_signatures_meet_whenever_sets_are_alike():
    r = np.random.default_rng(3)
    for plan in (J.PartEnum(90), J.PartEnum(80, away=0, parts=1), J.PartEnum(50, away=2, parts=4)):
        bounds = np.array(plan.bounds())
        met = 0
        for _ in range(400):
            size = int(r.integers(1, 200))
            a = r.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64)
            gone = int(r.integers(0, size * (100 - plan.percent) // 100 + 1))
            b = np.concatenate([a[gone:], r.integers(0, 2**63, int(r.integers(0, 6)), dtype=np.int64).astype(np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if 100 * both < plan.percent * (len(a) + len(b) - both):
                continue
            met += 1
            one, two = ({s for band, cells, need in plan.instances(len(x), bounds)
                         for s in plan.signatures(x, band, cells, need)} for x in (a, b))
            assert one & two
        assert met > 100


def test_pairs_by_matrix_and_by_lists(monkeypatch):
    r = random.Random(1)
    sets = [np.array(sorted(r.sample(range(40), r.randint(1, 30))), np.uint64) for _ in range(60)]
    want = {(a, b) for a in range(60) for b in range(a + 1, 60)
            if 100 * len(set(sets[a]) & set(sets[b])) >= 50 * len(set(sets[a]) | set(sets[b]))}
    for cells in (1 << 24, 0):
        monkeypatch.setattr(J, "DENSE_CELLS", cells)
        assert {(a, int(b)) for a, bs in J.linked_pairs(sets, 50) for b in bs} == want


def test_exact_threshold_and_short_texts(make_docs):
    ten = " ".join(f"a{i}" for i in range(12))  # ten 3-word shingles
    docs = [(1, ten), (2, ten + " z"), (3, "one two"), (4, "ONE  two"), (5, "one"), (6, ""), (7, None), (8, ten + " y z")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_components(make_docs(docs), 3, 90).collect()}
    assert got == {1: (10, 1), 2: (11, 1), 3: (1, 3), 4: (1, 3), 5: (1, 5), 6: (0, 6), 7: (0, 7), 8: (12, 8)}


def test_odd_rows_and_empty_tables(odd_docs, make_docs, with_clashes, rows):
    got = sorted((tuple(r)[:3] for r in J.jaccard_components(with_clashes(odd_docs)).collect()), key=repr)
    known = {r[0]: r[2] for r in got if r[0] is not None}
    assert len(got) == odd_docs.count()
    assert known == {i: 5 if i == 6 else i for i in range(1, 13)}
    assert [r for r in got if r[0] is None] == [(None, 0, None), (None, 56, None)]
    kept = J.keep_one(with_clashes(odd_docs))
    assert rows(kept) == rows(with_clashes(odd_docs).where("doc_id IS NULL OR doc_id <> 6"))
    assert J.jaccard_components(odd_docs.limit(0)).count() == 0 and J.keep_one(odd_docs.limit(0)).count() == 0


def test_repeated_rows_keep_their_links(make_docs, text_of_words):
    docs = []
    for i in range(40):  # near pairs of about one size, far from each other
        words = text_of_words(3000 + i, 60).split()
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:-1] + ["changed"]))]
    got = J.jaccard_components(make_docs(docs * 2 + docs[::3] + docs[:20]).repartition(3)).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(i, i - i % 2) for i, _ in docs}


def test_an_id_links_what_any_of_its_texts_links(make_docs, text_of_words):
    short, long, other = (text_of_words(4000 + i, n) for i, n in enumerate((60, 3000, 50)))
    docs = [(5, short), (5, long), (7, short + " more"), (3, other), (9, other + " more"), (9, long + " more"),
            (11, None), (11, text_of_words(4010, 40)), (12, ""), (12, " ")]
    got = {(r["doc_id"], r["component_id"]) for r in J.jaccard_components(make_docs(docs)).collect()}
    assert got == {(5, 3), (7, 3), (3, 3), (9, 3), (11, 11), (12, 12)}


def test_texts_of_one_id_are_judged_apart(make_docs, text_of_words):
    short, long, one, two = (text_of_words(4200 + i, n) for i, n in enumerate((60, 2000, 50, 50)))
    docs = [(25, short), (25, long), (27, short + " more"), (33, one), (35, one), (35, two)]
    got = {(r["doc_id"], r["component_id"]) for r in J.jaccard_components(make_docs(docs)).collect()}
    assert got == {(25, 25), (27, 25), (33, 33), (35, 33)}


def test_one_row_of_each_group_is_kept(make_docs, text_of_words):
    a, b, c = (text_of_words(4100 + i, 60) for i in range(3))
    docs = [(2, a), (2, a), (3, a), (None, a), (None, a + " more"), (4, b), (4, b), (None, b),
            (None, c), (None, c), (None, c + " more"), (6, None), (6, None), (None, None), (None, None)]
    kept = [(r["doc_id"], r["text"]) for r in J.keep_one(make_docs(docs * 2).repartition(3)).collect()]
    assert len(kept) == 5 and len([t for i, t in kept if i is None and (t or "").startswith(c)]) == 1
    assert {(2, a), (4, b), (6, None), (None, None)} <= set(kept)


def test_components_of_a_long_chain_and_a_star(spark):
    from flowlab.llm.components import components

    chain = [(i, i + 1) for i in range(100, 180)] + [(300, x) for x in range(301, 400)] + [(5, 5), (7, 6), (6, 7)]
    links = spark.createDataFrame(chain, "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {**{i: 100 for i in range(100, 181)}, **{i: 300 for i in range(300, 400)}, 6: 6, 7: 6}
