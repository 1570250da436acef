import random

import pytest

from flowlab.llm import line_dedup as L


def brute(docs, min_words=L.MIN_WORDS):
    """What is left of each text: every document against each earlier one, by its first holders of runs."""
    norm = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        norm[i] = [" ".join(x.lower().split()) for x in lines]
    out = {}
    first = {}
    for i in sorted(norm):
        lines, gone = norm[i], set()
        full = [n for n, x in enumerate(lines) if x]
        runs = []
        for a in range(len(full)):
            total, run = 0, []
            for n in full[a:]:
                run.append(lines[n])
                total += len(lines[n].split())
                if total >= min_words:
                    runs.append(tuple(run))
                    break
        codes = {}
        def coded(x):
            return [0 if not y else codes.setdefault(y, len(codes) + 1) for y in x]
        for owner in {first[r] for r in runs if r in first}:
            words = [len(x.split()) for x in lines]
            for a, b in L.shared_blocks(coded(norm[owner]), coded(lines), words, min_words):
                gone |= set(range(a, b))
        for r in runs:
            first.setdefault(r, i)
        out[i] = gone
    return out


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_is_a_common_subsequence_and_longest_where_lines_are_unique():
    r = random.Random(2)
    for _ in range(400):
        a, b = ([r.randint(1, 6) for _ in range(r.randint(0, 9))] for _ in range(2))
        pairs = L.patience_pairs(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
        a, b = r.sample(range(1, 12), 8), r.sample(range(1, 12), 8)
        assert len(L.patience_pairs(a, b)) == lcs(a, b)


def test_equals_brute_force(spark, make_docs, text_of_words, with_clashes):
    r = random.Random(9)
    lines = [text_of_words(i, r.randint(1, 25)) for i in range(40)] + ["", " "]
    docs = []
    for i in range(60):
        body = [r.choice(lines) for _ in range(r.randint(1, 4))]
        if docs and r.random() < 0.6:
            other = r.choice(docs)[1].split("\n")
            a = r.randrange(len(other))
            body += other[a:a + r.randint(1, 6)]
        docs.append((i, "\n".join(body + [text_of_words(1000 + i, 12)])))
    docs.append((60, docs[3][1]))
    docs.append((61, docs[3][1].upper()))
    want = brute(docs)
    assert sum(map(bool, want.values())) > 20
    got = L.drop_shared_lines(with_clashes(make_docs(docs))).select("row.*", "n_lines", "n_deleted").collect()
    for row in got:
        source = dict(docs)[row["doc_id"]].split("\n")
        kept = [x for n, x in enumerate(source) if n not in want[row["doc_id"]]]
        assert row["text"] == "\n".join(kept), row["doc_id"]
        assert (row["n_lines"], row["n_deleted"]) == (len(source), len(want[row["doc_id"]]))


def test_blocks(make_docs, text_of_words):
    block, short = "\n".join(text_of_words(i, 8) for i in range(4)), text_of_words(9, 5)
    own = [text_of_words(50 + i, 10) for i in range(5)]
    docs = make_docs([
        (5, f"{own[0]}\n{block}\n{own[1]}"), (2, f"{block}\n{short}\n{own[2]}"), (7, f"{short}\n{own[3]}"),
        (8, f"{own[4]}\n" + block.upper().replace(" ", "  "))])
    got = {r["row"]["doc_id"]: r["row"]["text"] for r in L.drop_shared_lines(docs).collect()}
    assert got == {2: f"{block}\n{short}\n{own[2]}", 5: f"{own[0]}\n{own[1]}", 7: f"{short}\n{own[3]}", 8: own[4]}


def test_common_runs():
    r = random.Random(5)
    for _ in range(500):
        a, b = ([r.randint(1, 3) for _ in range(r.randint(0, 9))] for _ in range(2))
        held = {tuple(a[i:j]) for i in range(len(a)) for j in range(i + 1, len(a) + 1)}
        runs = {(i, j) for i in range(len(b)) for j in range(i + 1, len(b) + 1) if tuple(b[i:j]) in held}
        most = {(i, j) for i, j in runs if not {(i - 1, j), (i, j + 1)} & runs}
        assert set(L.common_runs(a, b)) == most


def test_no_passage_of_an_earlier_document_is_left(make_docs, text_of_words):
    """Against the texts alone: what goes is in a run that an earlier document has, and
    nothing else stays that is in a shortest such run."""
    r = random.Random(11)
    p, q, x, y = (text_of_words(6000 + i, n) for i, n in enumerate((25, 25, 5, 5)))
    docs = [(1, f"{p}\n{x}\n{p}"), (2, f"{y}\n{p}\nz"), (3, f"{q}\n{x}\n\n{y} 1"), (4, f"u\n{q}\nv\n{q}\n{p}\nw")]
    lines = [text_of_words(6100 + i, r.randint(3, 14)) for i in range(12)]
    docs += [(10 + i, "\n".join(r.choice(lines + [""]) for _ in range(r.randint(4, 12)))) for i in range(40)]
    got = {row["row"]["doc_id"]: row["n_deleted"] for row in L.drop_shared_lines(make_docs(docs)).collect()}
    assert (got[1], got[2], got[4]) == (0, 1, 3)
    left = {row["row"]["doc_id"]: row["row"]["text"] for row in L.drop_shared_lines(make_docs(docs)).collect()}
    before = []
    for i, text in docs:
        full = [v for v in text.split("\n") if v]
        must, may = set(), set()
        for a in range(len(full)):
            for b in range(a + 1, len(full) + 1):
                run = full[a:b]
                if sum(len(v.split()) for v in run) >= L.MIN_WORDS and any(
                        d[n:n + len(run)] == run for d in before for n in range(len(d))):
                    may |= set(range(a, b))
                    if sum(len(v.split()) for v in run[:-1]) < L.MIN_WORDS:
                        must |= set(range(a, b))
        kept = [v for v in left[i].split("\n") if v]
        assert len(full) - len(may) <= len(kept) <= len(full) - len(must), i
        before.append(full)


def test_odd_rows_and_empty_tables(odd_docs):
    got = [(r["row"]["doc_id"], r["row"]["text"], r["n_deleted"]) for r in L.drop_shared_lines(odd_docs).collect()]
    assert len(got) == odd_docs.count()
    texts = {(r["doc_id"], r["text"]) for r in odd_docs.collect()}
    for i, text, deleted in got:
        assert text == "" and deleted if i == 6 else (i, text) in texts and not deleted
    assert L.drop_shared_lines(odd_docs.limit(0)).count() == 0


def test_a_passage_that_many_share_makes_one_pair_each(make_docs, text_of_words):
    shared = text_of_words(77, 40)
    docs = make_docs([(i, f"{text_of_words(i, 30)}\n{shared}") for i in range(100, 300)])
    got = L.drop_shared_lines(docs)
    assert got.where("n_deleted = 1").count() == 199
    assert got.where("row.doc_id = 100 AND n_deleted = 0").count() == 1
