import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from flowlab.llm import pii
from flowlab.llm.pii_lines import labelled_lines

# The stated patterns, as they are.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def stated(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        spans = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and sum(
                    sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            spans.append(m.span())
        out[kind] = spans
    return out


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.createDataFrame(labelled_lines(), "text string, spans string"))


def test_patterns_equal_the_stated_ones():
    r = random.Random(11)
    for alphabet in ("ab@.-1", "0123.. 25", "12 -+().", "+1 2()-", "4.1 @a+-"):
        for _ in range(3000):
            text = "".join(r.choices(alphabet, k=r.randint(0, 30)))
            assert pii.base_spans(text) == stated(text), text
    card = "4111 1111-1111 1111"
    assert pii.base_spans(f"x{card}x")["card"] == [(1, 20)]


def test_patterns_take_time_in_proportion(model):
    tagger = pii.Tagger(model)
    for text in ("a" * 300_000, "a@" * 100_000, "1" * 300_000, "1." * 100_000, "+1" * 100_000, "+1" + "(" * 300_000,
                 "1 " * 100_000, "x " * 100_000):
        list(tagger.tag(pa.array([text])))


def test_gradient_training_fits_and_generalises(model):
    held_out = labelled_lines(3, seed=99)
    tagger = pii.Tagger(model)
    right = 0
    for text, spans in held_out:
        states, _ = tagger.states(pa.array([text]))
        right += ",".join(f"{k}:{a}:{b}" for k, a, b in tagger.spans(text, states)) == spans
    assert right / len(held_out) > 0.95


def test_viterbi_equals_all_paths():
    r = np.random.default_rng(1)
    crf = pii.Crf({}, np.zeros((pii.OFFSETS, 0, pii.STATES)), r.normal(size=(pii.STATES,) * 2), r.normal(size=pii.STATES))
    emitted = r.normal(size=(3, 4, pii.STATES)).astype(np.float32)
    lengths = np.array([4, 3, 1])
    got = crf.viterbi(emitted, lengths, np.ones(3, bool), np.ones(3, bool))
    for i, n in enumerate(lengths):
        def value(path):
            return crf.starts[path[0]] + sum(emitted[i, t, s] for t, s in enumerate(path)) + sum(
                crf.moves[a, b] for a, b in zip(path, path[1:]))
        best = max(itertools.product(range(pii.STATES), repeat=int(n)), key=value)
        assert tuple(got[i, :n]) == best


def test_cutting_calm_runs_changes_nothing(model):
    assert model.run
    r = random.Random(5)
    lines = [" ".join(r.choices(["alpha", "beta,", "at", "x1", "12", "me@site.org", "+1", "(017)", "555-7713", "4000"],
                                weights=[20, 20, 1, 1, 1, 1, 1, 1, 1, 1], k=r.randint(0, 60))) for _ in range(400)]
    texts = pa.array(["\n".join(lines[i:i + 4]) for i in range(0, 400, 4)])
    cut, _ = pii.Tagger(model).states(texts)
    whole = pii.Crf(model.features, model.weights, model.moves, model.starts, 0)
    full, _ = pii.Tagger(whole).states(texts)
    assert (cut == full).all()
    # Line by line, each word of each line.
    for line in lines[:100] + ["alpha", "", "alpha beta"]:
        keys = [pii.key_of(w) for w in line.split()]
        scores = np.concatenate([model.scores(keys), np.zeros((pii.OFFSETS, 1, pii.STATES), np.float32)], axis=1)
        n = len(keys)
        at = np.arange(n)[:, None] + np.arange(-pii.AROUND, pii.AROUND + 1)
        emitted = scores[np.arange(pii.OFFSETS), np.where((at >= 0) & (at < n), at, n)].sum(axis=1)
        got, _ = pii.Tagger(model).states(pa.array([line]))
        if n:
            want = model.viterbi(emitted[None], np.array([n]), np.ones(1, bool), np.ones(1, bool))[0]
            assert (got == want).all(), line


def test_finds_what_the_patterns_miss(spark, model, make_docs, with_clashes):
    docs = make_docs([
        (1, "write to anna at example dot org today"), (2, "call (017) 555-7713 now"),
        (3, "visa 9807915762804490 on file"), (4, "the quick brown fox, 12 of 30 in 1999. at at at"),
        (5, "from me@site.org or +1 (017) 555-7713"), (5, "from me@site.org or +1 (017) 555-7713")])
    found = sorted((tuple(r) for r in pii.find_personal_data(with_clashes(docs), model).collect()), key=repr)
    spans = {r[0]: r[6] for r in found}
    assert spans == {1: "email:9:32", 2: "phone:5:19", 3: "card:5:21", 4: "", 5: "email:5:16,phone:20:37"}
    assert len(found) == 6 and {r[1:5] for r in found if r[0] == 5} == {(1, 0, 0, 1)}
    assert {r[5] for r in found if r[0] == 5} == {hashlib.sha256(b"email:5:16,phone:20:37").hexdigest()}
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs, model).collect()}
    assert clean[3] == "visa [CARD] on file" and clean[5] == "from [EMAIL] or [PHONE]"


def test_odd_rows_and_empty_tables(odd_docs, model):
    got = pii.find_personal_data(odd_docs, model).collect()
    assert len(got) == odd_docs.count()
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect()}
    for r in got:
        if r["doc_id"] is not None:
            fixed = pii.base_spans(texts[r["doc_id"]] or "")
            assert r["base_sha256"] == hashlib.sha256(pii._joined(fixed).encode()).hexdigest()
    assert pii.find_personal_data(odd_docs.limit(0), model).count() == 0
    assert pii.redact(odd_docs, model).where("text IS NULL").count() == 2
