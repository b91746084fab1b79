"""A linear-chain conditional random field over words: fitted on a bounded sample, applied to every word of every text.

Emission features are the word's affixes, inner character n-grams and, for words that are frequent in the sample, the word
itself (the lexicon). Fitting climbs the regularised log-likelihood; its gradient is what forward-backward expects less
what the tags show. Texts are tagged in stretches of ``STRETCH`` words, each with ``MARGIN`` words of context on both sides
whose own marginals come from the neighbouring stretch, so memory doesn't grow with a text and no word is left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np

WORD = re.compile(r"[^\W\d_]+")
STRETCH, MARGIN = 480, 32
#: Words that are tagged together; words whose emissions a task remembers; characters of a text that are cut into words at once.
TOGETHER, REMEMBERED, BLOCK = 300_000, 300_000, 1 << 20


def features(word: str, affix: int = 5, gram: int = 3) -> Iterator[str]:
    """Of a lower-cased word."""
    yield "=" + word
    for n in range(1, min(affix, len(word)) + 1):
        yield "^" + word[:n]
        yield word[-n:] + "$"
    for i in range(1, len(word) - gram):
        yield word[i : i + gram]


@dataclass
class Model:
    labels: list
    known: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray


def forward_backward(e: np.ndarray, moves: np.ndarray, ids: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of every word of the sequences ids[start:start + len], one after the other, and expected moves.

    ``e``: positive emission factors of each id; ``moves``: positive factors. All sequences advance together.
    """
    order = np.argsort(-lens, kind="stable")
    at, ends = starts[order], -lens[order]
    place = (np.cumsum(lens) - lens)[order]
    out = np.empty((int(lens.sum()), e.shape[1]), e.dtype)
    alive = np.searchsorted(ends, -np.arange(-ends[0] if len(ends) else 0), side="left")
    a = None
    for t, n in enumerate(alive):
        a = e[ids[at[:n] + t]] if a is None else (a[:n] @ moves) * e[ids[at[:n] + t]]
        a = a / a.sum(1, keepdims=True)
        out[place[:n] + t] = a
    expected = np.zeros_like(moves)
    b = np.ones((0, e.shape[1]), e.dtype)
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        b = np.concatenate([b, np.ones((n - len(b), e.shape[1]), e.dtype)])
        g = out[place[:n] + t] * b
        out[place[:n] + t] = g / g.sum(1, keepdims=True)
        if t:
            before = out[place[:n] + t - 1]
            m = b * e[ids[at[:n] + t]]
            expected += moves * (before.T @ (m / ((before @ moves) * m).sum(1, keepdims=True)))
            b = m @ moves.T
            b = b / b.sum(1, keepdims=True)
    return out, expected


def _factors(scores: np.ndarray) -> np.ndarray:
    """exp of the scores; each row's largest is 1, none is zero."""
    return np.exp(np.maximum(scores - scores.max(1, keepdims=True), -30)).astype(scores.dtype)


def fit(sequences: list[tuple[list[str], list[int]]], labels: list, lexicon_from: int = 5, feature_from: int = 2, rounds: int = 60, rate: float = 0.15, l2: float = 2e-6) -> Model:
    """``sequences``: lower-cased words and the index of each word's label."""
    sequences = [s for s in sequences if s[0]]
    vocabulary: dict[str, int] = {}
    ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for words, _ in sequences for w in words], np.int64)
    tags = np.array([t for _, ts in sequences for t in ts], np.int64)
    lens = np.array([len(words) for words, _ in sequences], np.int64)
    k, n, u = len(labels), len(ids), len(vocabulary)
    if not n:
        return Model(labels, {}, np.zeros((0, k), np.float32), np.zeros((k, k), np.float32))
    seen, total = Counter(), np.bincount(ids, minlength=u).tolist()
    for w, i in vocabulary.items():
        for f in features(w):
            seen[f] += total[i] if f[0] == "=" else 1
    kept = [f for f, c in seen.items() if c >= (lexicon_from if f[0] == "=" else feature_from)]
    known = {f: i for i, f in enumerate(kept)}
    of = [[known[f] for f in features(w) if f in known] for w in vocabulary]
    word = np.repeat(np.arange(u), [len(x) for x in of])
    feature = np.array([f for x in of for f in x], np.int64)
    starts = np.cumsum(lens) - lens
    inner = np.ones(n, bool)
    inner[starts] = False
    follow = np.flatnonzero(inner)
    shown = np.zeros((k, k))
    np.add.at(shown, (tags[follow - 1], tags[follow]), 1)
    hot = np.zeros((u, k))
    np.add.at(hot, (ids, tags), 1)
    w, m = np.zeros((len(known), k)), np.zeros((k, k))
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, m)]
    spread = lambda index, values, size: np.stack([np.bincount(index, values[:, j], size) for j in range(k)], 1)
    for step in range(1, rounds + 1):
        scores = spread(word, w[feature], u)
        marginals, expected = forward_backward(_factors(scores), np.exp(m), ids, starts, lens)
        up = (hot - spread(ids, marginals, u)) / n
        grads = (spread(feature, up[word], len(known)) - l2 * w, (shown - expected) / n - l2 * m)
        for x, g, (first, second) in zip((w, m), grads, state):
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            x += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(labels, known, w.astype(np.float32), m.astype(np.float32))


def words_of(text: str) -> Iterator[re.Match]:
    return WORD.finditer(text)


def _blocks(text: str) -> Iterator[list[str]]:
    """Words of a text, block by block; a word is never cut."""
    at = 0
    while at < len(text):
        end = at + BLOCK
        while end < len(text) and WORD.match(text[end - 1 : end]):
            end += 1
        yield WORD.findall(text, at, end)
        at = end


class Tagger:
    """Applies a model; remembers the emissions of a bounded number of words."""

    def __init__(self, model: Model):
        self.model, self.moves = model, np.exp(model.moves)
        self.forget()

    def forget(self) -> None:
        self.row: dict[str, int] = {}
        self.rows: list[np.ndarray] = []
        self.table = np.zeros((0, len(self.model.labels)), np.float32)

    def _learn(self, words: Iterable[str]) -> None:
        known, index, sizes = self.model.known, [], []
        for w in words:
            self.row[w] = len(self.row)
            found = [known[f] for f in features(w.lower()) if f in known]
            index += found
            sizes.append(len(found))
        if sizes:
            word = np.repeat(np.arange(len(sizes)), sizes)
            weights = self.model.weights[index]
            scores = np.stack([np.bincount(word, weights[:, j], len(sizes)) for j in range(weights.shape[1])], 1)
            self.table = np.concatenate([self.table, _factors(scores.astype(np.float32))])

    def ids(self, parts: list[list[str]]) -> np.ndarray:
        row = self.row
        self._learn(dict.fromkeys(w for words in parts for w in words if w not in row))
        return np.array([row[w] for words in parts for w in words], np.int64)

    def marginals(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of the words of several texts one after the other; ends: where each text ends."""
        starts, lens, skip, core, begin = [], [], [], [], 0
        for end in ends.tolist():
            for at in range(begin, end, STRETCH):
                stop = min(end, at + STRETCH)
                first, last = max(begin, at - MARGIN), min(end, stop + MARGIN)
                starts.append(first)
                lens.append(last - first)
                skip.append(at - first)
                core.append(stop - at)
            begin = end
        if not starts:
            return np.zeros((0, self.table.shape[1]), np.float32)
        starts, lens, skip, core = (np.array(x, np.int64) for x in (starts, lens, skip, core))
        out, _ = forward_backward(self.table, self.moves, ids, starts, lens)
        begin = np.cumsum(lens) - lens + skip
        return out[np.repeat(begin - (np.cumsum(core) - core), core) + np.arange(int(core.sum()))]

    def texts(self, texts: Iterable[str | None], use: Callable[[int, np.ndarray], None]) -> None:
        """Call use(number of the text, marginals of some of its words) until every word has been shown.

        Many short texts, or a part of a long one, are tagged together.
        """
        parts: list[list[str]] = []
        whose: list[int] = []
        total = 0

        def show() -> None:
            nonlocal total
            ends = np.cumsum([len(p) for p in parts])
            out = self.marginals(self.ids(parts), ends)
            for i, a, b in zip(whose, [0, *ends.tolist()], ends.tolist()):
                use(i, out[a:b])
            parts.clear()
            whose.clear()
            total = 0
            if len(self.row) > REMEMBERED:
                self.forget()

        for i, text in enumerate(texts):
            for words in _blocks(text or ""):
                if words:
                    parts.append(words)
                    whose.append(i)
                    total += len(words)
                    if total > TOGETHER:
                        show()
        if parts:
            show()
