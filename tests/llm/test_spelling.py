import random
import zlib
from collections import Counter
from itertools import combinations

import re

from flowlab.llm import spelling as S


def brute(docs, length=6, times=5):
    """Rows of the query, words compared with all others."""
    count = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            count[run[:at] + run[at + 1:] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in count.items() if len(w) >= length and n >= times}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    form = {}
    rows = {}
    for w, n in words.items():
        others = [o for o in words if o != w and near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
        rows[w] = [w, n, len(others), form[w], words[form[w]] if form[w] else None]
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows[w].append(root)
    return sorted(map(tuple, rows.values()), key=repr)


def misspelt(seed, words=60):
    r = random.Random(seed)
    letters = "abcdeé"
    base = ["".join(r.choices(letters, k=r.randint(5, 9))) for _ in range(words)]
    texts = []
    for i in range(120):
        out = []
        for w in r.choices(base, [2.0 ** -(j % 9) for j in range(words)], k=120):
            if r.random() < 0.3:
                at = r.randrange(len(w))
                w = w[:at] + r.choice(["", r.choice(letters), r.choice(letters) + w[at]]) + w[at + 1:]
            out.append(r.choice([w, w.capitalize(), w.upper()]))
        texts.append((i, r.choice([" ", "-", "\n", "1"]).join(out)))
    return texts


def test_equals_brute_force(make_docs, rows):
    docs = misspelt(1) + [(500, "harbourage " * 230 + "harbourge " * 40 + "harbourg " * 7 + "harburge " * 40)]
    got = rows(S.spelling_variants(make_docs(docs)), "word", "n", "n_near", "form", "form_n", "root")
    want = brute(docs)
    assert got == want
    # Chains of forms, ties and runs that lost a letter occur.
    assert any(r[3] is not None and r[5] != r[3] for r in want)
    assert any(r[2] > 5 for r in want)


def test_near_words_share_a_signature():
    """Exact: whatever the edit, one signature at least is shared; the parts are enumerated."""
    r = random.Random(3)
    for parts in (4, 6, 8):
        for _ in range(300):
            a = "".join(r.choices("abcdefghé", k=r.randint(6, 12)))
            at = r.randrange(len(a))
            b = a[:at] + r.choice(["", "x", "a" + a[at], "b"]) + a[at + 1:]
            x, y = (S.features("".join(sorted(w))) for w in (a, b))
            assert len(set(x) ^ set(y)) <= 2
            sa, sb = S.signatures([x, y], parts)
            assert len(sa) == 2 * len(list(combinations(range(parts), 2)))
            assert set(sa) & set(sb)


def test_near_vectors_are_all_those_of_near_sizes(spark, rows):
    r = random.Random(5)
    words = sorted({"".join(r.choices("abcd", k=r.randint(6, 8))) for _ in range(300)})
    vectors = sorted({"".join(sorted(w)) for w in words})
    want = [(a, b) for a, b in combinations(vectors, 2)
            if len(set(S.features(a)) ^ set(S.features(b))) <= 2 and abs(len(a) - len(b)) <= 1]
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    assert rows(S.near_vectors(df)) == want and want


def test_odd_rows(odd_docs, with_clashes, rows, make_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    want = brute(docs)
    columns = ("word", "n", "n_near", "form", "form_n", "root")
    assert rows(S.spelling_variants(odd_docs), *columns) == want
    assert rows(S.spelling_variants(with_clashes(odd_docs)), *columns) == want
    assert rows(S.spelling_variants(odd_docs.limit(0))) == []
    # Repeated rows count as often as they stand there.
    twice = [(1, "Wonder WONDER wonder")] * 2 + [(None, "wonder wondér × a×bcdefgh")] * 5
    assert rows(S.spelling_variants(make_docs(twice)), *columns) == brute(twice)
