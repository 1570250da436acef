import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from flowlab.llm import token_alignment as A

TOKENIZERS = "/opt/tokenizers"
PATHS = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
pytestmark = pytest.mark.skipif(not os.path.isdir(TOKENIZERS), reason="vocabularies not here")


@pytest.fixture(scope="module")
def library():
    """Both tokenizers by their own libraries, as (ids, bytes of each token)."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    alphabet = A.byte_alphabet()

    def tokens(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        first = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in ids]
        second = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            second.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        want = b" " + text.encode()
        if any(b"".join(p for _, p in side) != want for side in (first, second)):
            return [], []
        return first, second

    return tokens


def spans(tokens):
    out, at = [], 0
    for i, piece in tokens:
        out.append((i, at, at + len(piece)))
        at += len(piece)
    return out


def brute(rows, tokens):
    """Rows of the query by comparing every token of A with every one of B."""
    found, count = [], Counter()
    for doc_id, text in rows:
        a, b = (spans(t) for t in tokens(text)) if text else ([], [])
        links = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]
        cuts = sorted({e for *_, e in a} & {f for *_, f in b})
        parts, before = [], 0
        for cut in cuts:
            parts.append("|".join(",".join(str(i) for i, s, e in side if before < e <= cut) for side in (a, b)))
            before = cut
        count.update(links)
        found.append((doc_id, len(a), len(b), len(cuts), links,
                      hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted(((d, na, nb, ng, len(links), sum(count[p] == most[p[1]] for p in links),
                    sum(count[p] for p in links), sha) for d, na, nb, ng, links, sha in found), key=repr)


TEXTS = [(1, "The quick brown fox, isn't it?"), (2, "naïve café — 東京 🙂 x́"), (3, ""), (4, None),
         (5, "<|endoftext|> and </s> <s> <unk> <0x0A>"), (6, "a  b   c\n\n\td \r\n"), (7, " leading and trailing "),
         (8, "▁underscore"), (9, "The quick brown fox, isn't it?"), (9, "The quick brown fox, isn't it?"),
         (None, "the the the"), (10, "antidisestablishmentarianism 123456789 3.14159"), (11, " ​﻿"),
         (12, "\x00\x01"), (13, "x" * 300), (14, " " * 40)]


@pytest.fixture(scope="module")
def texts(text_of_words):
    return TEXTS + [(100 + i, text_of_words(i, 40)) for i in range(20)]


@pytest.mark.parametrize("max_pairs", [A.MAX_PAIRS, 10])
def test_equals_brute_force(make_docs, rows, texts, library, max_pairs):
    got = rows(A.align_tokens(make_docs(texts), *PATHS, max_pairs=max_pairs))
    want = brute(texts, library)
    assert got == want
    assert sum(r[1] > 0 for r in want) > 25 and any(r[1] > r[3] for r in want)


def test_byte_pairs_equal_their_library():
    """The rank-based encoder and the vocabulary's own library cut alike: every assigned block,
    white space and classes in several contexts, specials as plain text."""
    from tokenizers import Tokenizer

    own, other = A.BytePairs(PATHS[0]), Tokenizer.from_file(PATHS[0])
    other.encode_special_tokens = True
    points = [c for c in range(0x30000) if not 0xD800 <= c <= 0xDFFF]
    r = random.Random(4)
    texts = ["".join(f"a{chr(c)}b {chr(c)}{chr(c)}1" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    texts += ["".join(chr(r.choice(points)) if r.random() < 0.2 else r.choice(" ab'st1\n\t.") for _ in range(200))
              for _ in range(300)] + [t for _, t in TEXTS if t]
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == other.encode(" " + text, add_special_tokens=False).ids, text


def test_lockstep_equals_interval_overlap():
    r = np.random.default_rng(2)
    ends_a, ends_b, at_a, at_b = [], [], [0], [0]
    for d in range(60):
        total = int(r.integers(0, 80)) if d % 7 else 0
        for ends, at in ((ends_a, at_a), (ends_b, at_b)):
            inner = np.flatnonzero(r.random(max(total - 1, 0)) < r.random()) + 1
            ends += [*inner.tolist(), *([total] if total else [])]
            at.append(len(ends))
    a, b = np.array(ends_a), np.array(ends_b)
    at_a, at_b = np.array(at_a), np.array(at_b)
    merged = A.merge_lockstep(np.arange(len(a)), a, at_a, np.arange(len(b)), b, at_b)
    for d in range(60):
        sides = []
        for ends, at in ((a, at_a), (b, at_b)):
            own = ends[at[d]:at[d + 1]]
            sides.append(list(zip(range(at[d], at[d + 1]), [0, *own[:-1]], own)))
        want = [(x, y) for x, s, e in sides[0] for y, t, f in sides[1] if s < f and t < e]
        got = slice(merged.link_at[d], merged.link_at[d + 1])
        assert list(zip(merged.link_a[got], merged.link_b[got])) == want
        cut = slice(merged.cut_at[d], merged.cut_at[d + 1])
        assert a[merged.cut_a[cut]].tolist() == b[merged.cut_b[cut]].tolist() == sorted(
            {e for *_, e in sides[0]} & {f for *_, f in sides[1]})


def test_counts_hold_every_link(spark, make_docs, texts, library):
    aligned = make_docs(texts).selectExpr("monotonically_increasing_id() AS row", "doc_id", "text").mapInArrow(
        A._aligned(*PATHS), A.SCHEMA).cache()
    got = {(r["a"], r["b"]): r["count"] for r in A.pair_counts(aligned).collect()}
    want = Counter()
    for _, text in texts:
        a, b = (spans(t) for t in library(text)) if text else ([], [])
        want.update((x, y) for x, s, e in a for y, t, f in b if s < f and t < e)
    assert got == want


def test_odd_rows(odd_docs, with_clashes, rows, library):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect() if len(r["text"] or "") < 2000]
    short = odd_docs.where("text IS NULL OR length(text) < 2000")
    want = brute(docs, library)
    assert rows(A.align_tokens(short, *PATHS)) == want
    assert rows(A.align_tokens(with_clashes(short), *PATHS)) == want
    assert rows(A.align_tokens(short.limit(0), *PATHS)) == []
    whole = {r["doc_id"]: r for r in A.align_tokens(odd_docs, *PATHS).where("doc_id IN (4, 9, 10)").collect()}
    assert all(r["n_a"] > 1000 and r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] for r in whole.values())
