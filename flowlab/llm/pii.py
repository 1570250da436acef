"""Personal data in texts: fixed patterns, and a linear-chain conditional random field.

Method: words are described by their shape (letters, digits and marks in runs), by how many
digits they hold and by a short list of telling words; a conditional random field over a
line's words, trained from a small labelled table, weighs these features for each word and
two neighbours on either side, and Viterbi's algorithm, in numpy over many lines at once, finds the
most likely labels. Its spans are added to those of the fixed patterns.

Features depend on a word's key only, so weights are summed once per different key. Long
runs of plain words needn't be decoded: the model itself shows, for runs of some length,
that whatever stands around them the best labels in their middle are `outside`; lines are
cut there, and only the parts around other words go through the algorithm.

Training takes at most `MAX_LABELLED` rows, on the driver; decoding is one pass over the
whole texts, without a shuffle. Patterns take time in proportion to the text, also where it
is one long run of digits or letters.

Cases: a null text is empty and holds nothing. Repeated rows are each judged. An empty table
gives an empty result. Other columns aren't looked at. Positions are code points of the text.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from flowlab.functions.columns import col
from flowlab.llm.common import text_of
from flowlab.llm.shingles import slices

KINDS = ("email", "ip", "card", "phone")  # fixed values, in this order
MAX_LABELLED = 2_000   # rows that the model is trained from
CELLS = 1 << 18        # words decoded together, about

Span = tuple[int, int]

# ---------------------------------------------------------------- fixed patterns

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]")


def _emails(text: str) -> Iterator[Span]:
    """Around each @: all local characters before it, and a domain with a dot after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) < 256


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of the fixed patterns by kind."""
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = list(_emails(text))
    if not _DIGITS.search(text):
        return out
    out["ip"] = [m.span() for m in _IP.finditer(text) if all(map(_small, m.groups()))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in _PHONE.finditer(text)
                        if 9 <= len(_DIGITS.findall(m[0])) <= 15]
    return out


# ---------------------------------------------------------------- features

_EDGE = ".,;:!?\"'()[]{}<>*#$%&|"
# Words that tell something by themselves.
_TELLING = frozenset(("at dot (at) [at] (dot) [dot] mail e-mail email phone tel telefon fax call card visa karte "
                      "ip host server version token page license com org net").split())
_RUNS = re.compile(r"([a-z]+)|([0-9]+)|([^a-z0-9])", re.I)
_ENDS = (".com", ".org", ".net", ".de", ".fr", ".es")
PLAIN = ("plain",)


@functools.lru_cache(maxsize=1 << 16)
def _described(word: str) -> tuple[str, ...]:
    lower = word.lower()
    core = word.strip(_EDGE)
    runs = _RUNS.findall(core[:64])
    shape = "".join("x" if a else "d" if d else "x" if o.isalpha() else o for a, d, o in runs)
    shape = re.sub(r"x+", "x", shape)
    digits = sum(c.isdigit() for c in core[:64])
    out = [f"shape={shape[:14]}", f"digits={min(digits, 20)}", f"first={word[0] if not word[0].isalnum() else ''}"]
    if digits:
        out.append("groups=" + "-".join(str(min(len(d), 20)) for _, d, _ in runs if d)[:14])
    if digits and any(a for a, _, _ in runs):
        out.append("mixed")
    if "@" in core:
        out.append("has@")
    if lower in _TELLING or lower.strip(_EDGE) in _TELLING:
        out.append("is=" + (lower if lower in _TELLING else lower.strip(_EDGE)))
    if lower.rstrip(_EDGE).endswith(_ENDS):
        out.append("site")
    return tuple(out)


def key_of(word: str) -> tuple[str, ...]:
    """All features of a word: plain for letters that tell nothing, else its shape and more."""
    core = word.strip(_EDGE)
    if (core.isalpha() or not core) and word.lower() not in _TELLING and core.lower() not in _TELLING:
        return PLAIN
    return _described(word)


# ---------------------------------------------------------------- the model

STATES = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
AROUND = 2                   # neighbours on either side whose features count
OFFSETS = 2 * AROUND + 1


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Crf:
    features: dict[str, int]
    weights: np.ndarray      # offset from -AROUND, feature, state
    moves: np.ndarray        # state, next state
    starts: np.ndarray       # state of the first word
    run: int = 0             # plain words that surely are outside in their middle; 0: never

    def scores(self, keys: list[tuple[str, ...]]) -> np.ndarray:
        """offset, key, state."""
        out = np.zeros((OFFSETS, len(keys), STATES), np.float32)
        for i, key in enumerate(keys):
            for f in key:
                if (at := self.features.get(f)) is not None:
                    out[:, i] += self.weights[:, at]
        return out

    def viterbi(self, emitted: np.ndarray, lengths: np.ndarray, from_start: np.ndarray,
                to_end: np.ndarray) -> np.ndarray:
        """Best states of sequences in order of falling length, padded to (n, longest, states).
        Those that don't begin or end their line are outside there."""
        n, longest, _ = emitted.shape
        back = np.zeros((n, longest, STATES), np.int8)
        outside = np.full(STATES, -1e9, np.float32)
        outside[0] = 0
        best = emitted[:, 0] + np.where(from_start[:, None], self.starts, outside)
        final = best.copy()
        for t in range(1, longest):
            m = int(np.searchsorted(-lengths, -t, side="left"))  # those longer than t
            ways = best[:m, :, None] + self.moves
            back[:m, t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + emitted[:m, t]
            final[:m] = best
        states = np.zeros((n, longest), np.int8)
        last = np.where(to_end, final.argmax(axis=1), 0)
        rows = np.arange(n)
        states[rows, lengths - 1] = last
        for t in range(longest - 1, 0, -1):
            m = int(np.searchsorted(-lengths, -t, side="left"))
            last[:m] = back[rows[:m], t, states[:m, t]]
            states[:m, t - 1] = last[:m]
        return states

    def find_run(self, most: int = 16) -> int:
        """The shortest odd run of plain words among plain ones whose middle is outside on a
        best path from any state before to any state after, and which is outside all along
        between two that are."""
        emit = self.scores([PLAIN]).sum(axis=0)[0].astype(np.float64)
        moves = self.moves.astype(np.float64)

        def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return (a[:, :, None] + b[None]).max(axis=1)

        power = [None, moves + emit]  # to a state so many words on
        for _ in range(2 * most):
            power.append(times(power[-1], moves + emit))
        calm = all(power[k][0, 0] <= k * (moves[0, 0] + emit[0]) + 1e-6 for k in range(1, most + 2))
        for run in range(3, most, 2):
            half = run // 2 + 1
            through = power[half][:, :1] + times(power[half - 1], moves)[:1]
            if calm and (through >= times(power[run], moves) - 1e-6).all():
                return run
        return 0


def _gold(words: list[Span], spans: str) -> list[int]:
    """The state of each word, of labelled spans as kind:start:end."""
    out = [0] * len(words)
    for span in filter(None, spans.split(",")):
        kind, start, end = span.split(":")
        inside = [i for i, (a, b) in enumerate(words) if a < int(end) and b > int(start)]
        for i in inside:
            out[i] = 1 + 2 * KINDS.index(kind) + (i != inside[0])
    return out


def train(labelled: list[tuple[str, str]], rounds: int = 120, rate: float = 0.15, ridge: float = 0.002) -> Crf:
    """The model that makes the labelled lines likely (penalised by `ridge`), by gradient steps.

    Gradients come from the forward and backward sums over all lines at once."""
    lines = [[(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)] for text, _ in labelled]
    kept = [i for i, line in enumerate(lines) if line]
    gold = [_gold(lines[i], labelled[i][1]) for i in kept]
    keys: dict[tuple, int] = {}
    codes = [[keys.setdefault(key_of(labelled[i][0][a:b]), len(keys)) for a, b in lines[i]] for i in kept]
    features = {f: n for n, f in enumerate(sorted({f for k in keys for f in k}))}
    has = np.zeros((len(keys), len(features)))
    for key, i in keys.items():
        has[i, [features[f] for f in key]] = 1
    n, longest = len(codes), max(map(len, codes), default=1)
    lengths = np.array([len(c) for c in codes])
    code = np.full((n, longest + 2 * AROUND), len(keys))
    state = np.zeros((n, longest), int)
    for i, (c, g) in enumerate(zip(codes, gold)):
        code[i, AROUND:len(c) + AROUND], state[i, :len(g)] = c, g
    real = np.arange(longest) < lengths[:, None]
    rows = np.arange(n)
    weights = np.zeros((OFFSETS, len(features), STATES))
    moves, starts = np.zeros((STATES, STATES)), np.zeros(STATES)
    params = [weights, moves, starts]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        table = np.concatenate([has @ weights, np.zeros((OFFSETS, 1, STATES))], axis=1)
        emitted = sum(table[o][code[:, o:o + longest]] for o in range(OFFSETS))
        ahead = np.zeros((n, longest, STATES))
        ahead[:, 0] = starts + emitted[:, 0]
        for t in range(1, longest):
            ahead[:, t] = emitted[:, t] + _log_sum(ahead[:, t - 1, :, None] + moves, 1)
        behind = np.zeros((n, longest, STATES))
        pairs = np.zeros((STATES, STATES))
        whole = _log_sum(ahead[rows, lengths - 1], 1)
        for t in range(longest - 2, -1, -1):
            on = (t + 1 < lengths)[:, None]
            after = emitted[:, t + 1] + behind[:, t + 1]
            behind[:, t] = np.where(on, _log_sum(moves + after[:, None], 2), 0)
            both = ahead[:, t, :, None] + moves + after[:, None] - whole[:, None, None]
            pairs += np.exp(both[on[:, 0]]).sum(axis=0)
            hit = on[:, 0]
            np.add.at(pairs, (state[hit, t], state[hit, t + 1]), -1)
        chance = np.exp(ahead + behind - whole[:, None, None]) * real[:, :, None]
        np.add.at(chance, (rows[:, None], np.arange(longest)[None], state), -1.0 * real)
        by_key = np.zeros((OFFSETS, len(keys) + 1, STATES))
        for o in range(OFFSETS):
            np.add.at(by_key[o], code[:, o:o + longest], chance)
        slopes = [np.einsum("kf,oks->ofs", has, by_key[:, :-1]), pairs, chance[:, 0].sum(axis=0)]
        for p, g, a, b in zip(params, slopes, first, second):
            g = g / n + ridge * p
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    model = Crf(features, weights.astype(np.float32), moves.astype(np.float32), starts.astype(np.float32))
    model.run = model.find_run()
    return model


# ---------------------------------------------------------------- decoding

def _labels(model: Crf, codes: np.ndarray, scores: np.ndarray, line_starts: np.ndarray,
            plain: int) -> np.ndarray:
    """The state of each word of many lines, given each word's key."""
    n = len(codes)
    states = np.zeros(n, np.int8)
    if not n:
        return states
    first = np.zeros(n + 1, bool)
    first[line_starts[line_starts < n]] = True
    first[n] = True
    last = first[1:]
    nothing = len(scores[0]) - 1
    near = {0: codes}
    for d in range(1, AROUND + 1):
        near[-d] = np.where(first[:n], nothing, np.concatenate([[nothing], near[1 - d][:-1]]))
        near[d] = np.where(last, nothing, np.concatenate([near[d - 1][1:], [nothing]]))
    # A calm word is plain among plain ones; the others, and some words around, are decoded.
    calm = np.logical_and.reduce([x == plain for x in near.values()])
    wanted = np.ones(n, bool)
    if model.run:
        reach = model.run // 2 + 1
        edge = np.zeros(n + 1, int)
        at = np.flatnonzero(~calm)
        np.add.at(edge, np.maximum(at - reach, 0), 1)
        np.add.at(edge, np.minimum(at + reach + 1, n), -1)
        wanted = np.cumsum(edge[:n]) > 0
    begins = np.flatnonzero(wanted & (first[:n] | ~np.concatenate([[False], wanted[:-1]])))
    ends = np.flatnonzero(wanted & (last | ~np.concatenate([wanted[1:], [False]]))) + 1
    # Plain words only, at an end of their line: one part stands for all of its length.
    busy = np.concatenate([[0], np.cumsum(codes != plain)])
    quiet = busy[ends] == busy[begins]
    kinds = (ends - begins) * 4 + first[begins] * 2 + last[ends - 1]
    same, models = np.unique(kinds[quiet], return_index=True)
    models = np.flatnonzero(quiet)[models]
    chosen = np.concatenate([np.flatnonzero(~quiet), models])
    order = chosen[np.argsort((begins - ends)[chosen], kind="stable")]
    all_begins, all_ends = begins, ends
    begins, ends = begins[order], ends[order]
    lengths = ends - begins
    at = 0
    while at < len(begins):
        stop = at + max(1, int(CELLS // lengths[at]))
        b, e, size = begins[at:stop], ends[at:stop], lengths[at:stop]
        spots = np.minimum(b[:, None] + np.arange(size[0]), n - 1)
        emitted = sum(scores[AROUND + d][x[spots]] for d, x in near.items())
        found = model.viterbi(emitted, size, first[b], last[e - 1])
        real = np.arange(size[0]) < size[:, None]
        states[spots[real]] = found[real]
        at = stop
    for kind, model_part in zip(same, models):
        got = states[all_begins[model_part]:all_ends[model_part]].copy()
        if got.any():
            for b in all_begins[quiet & (kinds == kind)]:
                states[b:b + len(got)] = got
    return states


class Tagger:
    """Adds the model's spans to the fixed ones, a slice of texts at a time."""

    def __init__(self, model: Crf):
        self.model = model

    def states(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The state of every word of the texts, and where each text's words begin."""
        lines = pc.split_pattern(texts, "\n")
        split = pc.ascii_split_whitespace(lines.flatten())
        words, at = split.flatten(), split.offsets.to_numpy().astype(np.int64)
        kept = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(kept)])
        line_at = before[at - at[0]]
        coded = words.filter(pa.array(kept)).dictionary_encode()
        keys: dict[tuple, int] = {PLAIN: 0}
        by_word = np.fromiter((keys.setdefault(key_of(w), len(keys)) for w in coded.dictionary.to_pylist()),
                              np.int64, len(coded.dictionary))
        codes = by_word[coded.indices.to_numpy()] if len(coded) else np.empty(0, np.int64)
        scores = np.concatenate([self.model.scores(list(keys)), np.zeros((OFFSETS, 1, STATES), np.float32)], axis=1)
        text_at = line_at[lines.offsets.to_numpy() - lines.offsets[0].as_py()]
        return _labels(self.model, codes, scores, line_at[:-1], 0), text_at

    def spans(self, text: str, states: np.ndarray) -> list[tuple[str, int, int]]:
        """The spans of a text's words' states, without marks at their ends."""
        out: list[list] = []
        for m, s in zip(re.finditer(r"[^\x20\x09-\x0D]+", text), states.tolist()):
            if s:
                kind, begins = KINDS[(s - 1) // 2], s % 2 == 1
                if not begins and out and out[-1][0] == kind and out[-1][3]:
                    out[-1][2] = m.end()
                else:
                    out.append([kind, m.start(), m.end(), True])
            elif out:
                out[-1][3] = False
        spans = []
        for kind, start, end, _ in out:
            while start < end and text[start] in _EDGE and not (kind == "phone" and text[start] == "("):
                start += 1
            while start < end and text[end - 1] in _EDGE:
                end -= 1
            if start < end:
                spans.append((kind, start, end))
        return spans

    def tag(self, texts: pa.Array) -> Iterator[tuple[dict[str, list[Span]], dict[str, list[Span]]]]:
        """(fixed spans, all spans) of each text. A span of the model that meets a fixed one
        is left out."""
        for _, part in slices(texts):
            states, at = self.states(part)
            marked = np.concatenate([[0], np.cumsum(states > 0)])
            for i, text in enumerate(part.to_pylist()):
                fixed = base_spans(text)
                spans = {k: list(v) for k, v in fixed.items()}
                if marked[at[i + 1]] > marked[at[i]]:
                    taken = [s for v in fixed.values() for s in v]
                    for kind, a, b in self.spans(text, states[at[i]:at[i + 1]]):
                        if not any(a < y and x < b for x, y in taken):
                            spans[kind].append((a, b))
                yield fixed, {k: sorted(v) for k, v in spans.items()}


def _joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
          "spans string, n_added long")


def _finder(sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(sent.value)
        for batch in batches:
            rows = []
            for fixed, spans in tagger.tag(batch.column(1)):
                counts = [len(fixed[k]) for k in KINDS]
                rows.append((*counts, hashlib.sha256(_joined(fixed).encode()).hexdigest(), _joined(spans),
                             sum(map(len, spans.values())) - sum(counts)))
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])

    return run


def fit(labelled: DataFrame, text: str = "text", spans: str = "spans", most: int = MAX_LABELLED) -> Crf:
    """The model trained from up to `most` rows of a labelled table, the first by text."""
    rows = labelled.select(text_of(text).alias("t"), text_of(spans).alias("s")).orderBy("t", "s").limit(most)
    return train([(r[0], r[1]) for r in rows.collect()])


def find_personal_data(docs: DataFrame, model: Crf, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, how many spans of each kind the fixed patterns find,
    base_sha256 of these, `spans` (theirs and the model's) and n_added, the model's."""
    rows = docs.select(col(id_col).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(_finder(docs.sparkSession.sparkContext.broadcast(model)), SCHEMA)


def redacted(text: str, spans: str) -> str:
    """The text with each span replaced by its kind in brackets."""
    for kind, a, b in sorted((s.split(":") for s in filter(None, spans.split(","))),
                             key=lambda s: int(s[1]), reverse=True):
        text = f"{text[:int(a)]}[{kind.upper()}]{text[int(b):]}"
    return text


def redact(docs: DataFrame, model: Crf, text: str = "text") -> DataFrame:
    """`docs` with the spans of its texts replaced; null texts stay null."""
    at = docs.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(sent.value)
        for batch in batches:
            texts = batch.column(at)
            full = pc.fill_null(texts, "")
            out = [None if t is None else redacted(t, _joined(spans))
                   for t, (_, spans) in zip(texts.to_pylist(), tagger.tag(full))]
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, texts.type))

    return docs.mapInArrow(run, docs.schema)
