"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

A text is read as a stream of symbols: letters without case, usual stand-ins
(``@ $ 0 1 3``) as the letters they stand for, white space as a word boundary, all
other punctuation dropped, spelled-out words (``i d i o t``) closed up. The units
that the kernel compares are windows of a sentence's words: the gapped
subsequences of three and of five symbols that start in ``WINDOW`` neighbouring
places of one word, each weighted by ``DECAY`` per symbol left out. An inserted character thus
lowers the similarity to an insult but does not end it.

Windows that begin a word are also read on across the boundaries after it, up to
``REACH`` symbols (the end of a sentence is not marked in the stream). The same machine
values them, less a price: ``ACROSS``, or more if clean texts of the sample would pass otherwise. So a space
put into an insult doesn't end it. Insults of several ordinary words have a second
machine: where more toxic texts than chance would give share the start of words on end, and nothing
within one word tells, those texts are left out of the first machine's fitting and such windows, as positives,
are set against those of clean texts, first the ones that begin alike. A text's value is the higher of both machines'.


Learning is on a bounded sample of labelled rows (``TOXIC_ROWS`` and
``CLEAN_ROWS``, of at most ``SAMPLE_CHARS`` characters each, taken in the order of
a hash), on the driver. The label of a text says that at least one of its
sentences is toxic, not which, so the witness is learned too: the first positives
are the starts of words that more toxic texts share than chance would give, and of every other toxic text its most telling window, however weak
the evidence; then each toxic text
gives its highest-scoring window as a positive if it is above 0, each clean text
its highest-scoring one as a hard negative, and the machine is fitted again.
A window counts by how many toxic and clean texts hold a word with its start: with
a far higher rate among toxic ones and enough evidence it is no negative, so one clean text
that quotes or mislabels an insult doesn't end it; positives without that weigh little
once there are others. Positives that don't hold against the hard negatives are dropped; if none does,
those of the round before stay. A weak one stays only as the highest of its text.
Positives also enter with letters inserted.
Landmarks are windows of both kinds; windows are mapped by their kernel values
with the landmarks times the inverse root of the landmark kernel, and a linear
SVM (squared hinge, Newton) is fitted there. The landmarks then fold into one
weight per subsequence, which gives the same decision values without visiting
landmarks, so scoring is a few table look-ups per character, in numpy, over
whole texts. A text's value is that of its highest window; a logistic curve
fitted on the sample makes it a score.

The model is one or two tables of ``FEATURES`` weights (5 MB each), whatever the corpus, and is
broadcast.

Defined results: a null or empty text has the value of an empty window. Rows
with a null label or without a text are not learned from. If the sample lacks
one of the two classes, or is empty, all scores are 0. Equal texts get equal
scores. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

TOXIC_ROWS, CLEAN_ROWS, SAMPLE_CHARS = 1500, 5000, 16_000
THRESHOLD = 0.7

SYMBOLS = 64
WINDOW = 7
DECAY = 0.6
#: Where the symbols of a subsequence stand, from the first one on: three with up to two left out between
#: them, and five with up to one.
SHAPES = (
    (0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4),
    (0, 1, 2, 3, 4), (0, 2, 3, 4, 5), (0, 1, 3, 4, 5), (0, 1, 2, 4, 5), (0, 1, 2, 3, 5),
)
#: Names of subsequences: all of three symbols, then those of five in so many hash values.
LONGER = 1 << 20
FEATURES = SYMBOLS**3 + LONGER
STARTS, CHANCE, LEAST_ODDS, LEAST_EVIDENCE, LEAST_TARGET = (6, 8, 10), 1e-5, 3.0, 5.0, 0.9
LANDMARKS = 256
ROUNDS = 5
#: The weight, as a number of texts, of a positive that counts don't bear out, once others are borne out.
LIGHT = 0.01
#: What a window costs at least that reads on across word boundaries, and the share of clean texts it may raise.
ACROSS, RAISED = 0.1, 0.001
REACH = WINDOW + max(shape[-1] for shape in SHAPES)
PIECE = 1 << 20

_DROP = 255
_SYMBOL = np.full(256, _DROP, np.uint8)
_SYMBOL[[0x20, *range(0x09, 0x0E)]] = 0
for _i in range(26):
    _SYMBOL[[65 + _i, 97 + _i]] = 1 + _i
_SYMBOL[list(b"0123456789")] = 27
for _sign, _letter in (("@", "a"), ("$", "s"), ("0", "o"), ("1", "i"), ("3", "e")):
    _SYMBOL[ord(_sign)] = ord(_letter) - 96
_SYMBOL[0x80:0xC0] = 28 + np.arange(64) % 36  # what follows a lead byte; lead bytes are dropped


# ---- windows and their subsequences --------------------------------------------


def stream(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of some texts, one after another, and where each text starts."""
    raws = [b" " + t.encode() for t in texts]
    codes = _SYMBOL[np.frombuffer(b"".join(raws), np.uint8)]
    starts = np.cumsum([0, *map(len, raws)])[:-1]
    codes, starts = _without(codes, starts, codes == _DROP)
    at = codes == 0  # close up words of one letter each
    single = np.zeros(len(codes), bool)
    single[1:-1] = at[:-2] & ~at[1:-1] & at[2:]
    single[-1:] = at[-2:-1] & ~at[-1:] if len(codes) > 1 else False
    inner = np.zeros(len(codes), bool)
    inner[1:-1] = at[1:-1] & single[:-2] & single[2:]
    inner[starts] = False
    return _without(codes, starts, inner)


def _without(codes: np.ndarray, starts: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    before = np.concatenate([[0], np.cumsum(gone)])
    return codes[~gone], starts - before[starts]


def _name(symbols: list[np.ndarray]) -> np.ndarray:
    """The names of subsequences, from the arrays of their first, second, ... symbols."""
    name = symbols[0]
    for s in symbols[1:]:
        name = name * SYMBOLS + s
    return name if len(symbols) == 3 else SYMBOLS**3 + (name * 0x9E3779B1 >> 16) % LONGER


def _weight(shape: tuple[int, ...]) -> float:
    return DECAY ** (shape[-1] - len(shape) + 1)


def subsequences(codes: np.ndarray):
    """For each shape: (its weight, the name of the subsequence that starts at each place, whether it stays in one word)."""
    word = np.cumsum(codes == 0, dtype=np.int32)
    wide, n = codes.astype(np.int64), len(codes)
    for shape in SHAPES:
        span = shape[-1]
        if n > span:
            yield _weight(shape), _name([wide[at : n - span + at] for at in shape]), word[: n - span] == word[span:]


def window_values(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The decision value, without its constant, of the window that starts at each place, within its word."""
    value = np.zeros(len(codes))
    for decay, code, whole in subsequences(codes):
        value[: len(code)] += decay * weights[code] * whole
    total = np.concatenate([[0], np.cumsum(value)])
    zeros = np.flatnonzero(codes == 0)
    ends = np.repeat(np.append(zeros[1:], len(codes)), np.diff(np.append(zeros, len(codes))))
    return total[np.minimum(np.arange(len(codes)) + WINDOW, ends)] - total[:-1]


def _words(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The boundaries before words, and where each word begins among the symbols that are no boundary."""
    at = codes == 0
    places = np.flatnonzero(at[:-1] & ~at[1:])
    return places, places + 1 - np.cumsum(at)[places]


def across_values(codes: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The boundaries before words, and the value of the window that begins there and skips all boundaries after it.

    It ends with its text; the price is not taken off.
    """
    places, first = _words(codes)
    if not len(places):
        return places, np.zeros(0)
    letter = codes != 0
    letters, n = codes[letter].astype(np.int64), int(letter.sum())
    begins = np.zeros(len(codes), np.int32)
    np.add.at(begins, starts, 1)
    text = np.cumsum(begins)[letter]
    ends = np.cumsum(np.bincount(text))[text[first]]  # of the text that each word is in
    after = np.append(letters, np.zeros(REACH, np.int64))
    inner, lead = np.zeros(n), np.zeros(len(places))
    for shape in SHAPES:
        span = shape[-1]
        if n > span:
            name = _name([letters[at : n - span + at] for at in shape])
            inner[: n - span] += _weight(shape) * weights[name] * (text[: n - span] == text[span:])
        name = _name([np.zeros(len(first), np.int64), *(after[first + at - 1] for at in shape[1:])])
        lead += _weight(shape) * weights[name] * (first + span <= ends)
    total = np.concatenate([[0], np.cumsum(inner)])
    return places, lead + total[np.minimum(first + WINDOW - 1, ends)] - total[first]


def window_features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(subsequences, weights) of one window, given from its first symbol to the end of its word or of its reach."""
    found, values = [], []
    for decay, code, whole in subsequences(codes):
        code = code[:WINDOW][whole[:WINDOW]]
        found.append(code)
        values.append(np.full(len(code), decay))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    keys, at = np.unique(np.concatenate(found), return_inverse=True)
    return keys, np.bincount(at, np.concatenate(values), len(keys))


# ---- the machine ---------------------------------------------------------------


def nystroem_svm(
    positive: list[bytes], negative: list[bytes], landmarks: list[bytes], importance: np.ndarray | None = None, c: float = 4.0
):
    """(weight per subsequence, constant) of an SVM on windows, fitted in the space of the landmarks.

    Both classes count alike; ``importance`` weights the positives among themselves.
    """
    features = [window_features(np.frombuffer(x, np.uint8)) for x in landmarks]
    space = np.unique(np.concatenate([k for k, _ in features]))

    def rows(windows: list[bytes]) -> np.ndarray:
        out = np.zeros((len(windows), len(space)), np.float32)
        for row, x in zip(out, windows):
            keys, values = window_features(np.frombuffer(x, np.uint8))
            at = np.minimum(np.searchsorted(space, keys), len(space) - 1)
            known = space[at] == keys
            row[at[known]] = values[known]
        return out

    marks = rows(landmarks)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(float))
    root = np.where(values > 1e-6 * values[-1], values, np.inf) ** -0.5
    to_space = vectors * root @ vectors.T
    blocks = [windows[i : i + 512] for windows in (positive, negative) for i in range(0, len(windows), 512)]
    z = np.concatenate([rows(b) @ marks.T @ to_space for b in blocks])
    z = np.hstack([z, np.ones((len(z), 1))])
    y = np.repeat([1.0, -1.0], [len(positive), len(negative)])
    shares = np.ones(len(positive)) if importance is None else importance
    cost = np.concatenate([shares / shares.sum(), np.full(len(negative), 1 / len(negative))]) * c * len(y) / 2
    w, ridge = np.zeros(z.shape[1]), np.append(np.ones(z.shape[1] - 1), 1e-3)
    for _ in range(30):
        active = y * (z @ w) < 1
        za, ca = z[active], cost[active]
        new = np.linalg.solve(za.T @ (za * ca[:, None]) + np.diag(ridge), za.T @ (ca * y[active]))
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    weights = np.zeros(FEATURES, np.float32)
    weights[space] = (to_space @ w[:-1]) @ marks
    return weights, float(w[-1])


def logistic(values: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of a logistic curve; targets are kept off 0 and 1, also of a few toxic texts above the threshold."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, max((n1 + 1) / (n1 + 2), LEAST_TARGET), 1 / (n0 + 2))
    share = 1 / len(labels)
    x = np.stack([values, np.ones(len(values))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = x.T @ (x * (share * p * (1 - p))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (share * (target - p)) - 1e-6 * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    constant: float
    slope: float
    offset: float
    #: What the first machine takes off a window that reads on across boundaries.
    price: float = np.inf
    #: The weights and the constant of the machine for insults of several words, if there are any.
    phrases: tuple[np.ndarray, float] | None = None

    def values(self, texts: list[str]) -> np.ndarray:
        """The decision value of each text: that of its highest window."""
        out, part, size = [], [], 0
        for t in [*texts, None]:
            if part and (t is None or size + len(t) > PIECE):
                codes, starts = stream(part)
                value = window_values(codes, self.weights) + self.constant
                if self.price < np.inf:
                    places, across = across_values(codes, starts, self.weights)
                    value[places] = np.maximum(value[places], across + self.constant - self.price)
                if self.phrases:
                    places, across = across_values(codes, starts, self.phrases[0])
                    value[places] = np.maximum(value[places], across + self.phrases[1])
                out.append(np.maximum.reduceat(value, starts))
                part, size = [], 0
            if t is not None:
                part.append(t)
                size += len(t)
        return np.concatenate(out) if out else np.zeros(0)

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.offset == -np.inf:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.slope * self.values(texts) + self.offset, -30, 30)))


NEVER = Model(np.zeros(FEATURES, np.float32), 0.0, 0.0, -np.inf)


def _word_starts(text: str) -> set[bytes]:
    """The first symbols of each word of a text, its boundary included, up to each length of ``STARTS``."""
    codes, _ = stream([text])
    zeros = np.flatnonzero(codes == 0)
    ends, raw = np.append(zeros[1:], len(codes)), codes.tobytes()
    words = {raw[i:j] for i, j in zip(zeros.tolist(), np.minimum(ends, zeros + STARTS[-1]).tolist()) if j - i > 3}
    return {w[:n] for w in words for n in STARTS}


def _apart(toxic: list[str], ordinary: set[bytes]) -> list[str]:
    """``toxic`` without texts that share half of their words outside ``ordinary`` with one before (near copies)."""
    holders: dict[bytes, list[int]] = {}
    out = []
    for i, t in enumerate(toxic):
        words = _word_starts(t) - ordinary
        shared = Counter(j for w in words for j in holders.get(w, ()))
        if len(words) < 6 or 2 * max(shared.values(), default=0) < len(words):
            out.append(t)
            for w in words:
                holders.setdefault(w, []).append(i)
    return out


def _evidence(n_toxic: np.ndarray, n_clean: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Log-likelihood ratio of what so many toxic and clean texts have; below 0 if clean texts have it more often."""

    def part(n: np.ndarray, of: int) -> np.ndarray:
        return n * np.log(np.maximum(n, 1e-9) / (of * both)) + (of - n) * np.log(np.maximum(of - n, 1e-9) / (of * (1 - both)))

    both = np.clip((n_toxic + n_clean) / (toxic + clean), 1e-9, 1 - 1e-9)
    return np.sign(n_toxic * clean - n_clean * toxic) * (part(n_toxic, toxic) + part(n_clean, clean))


def _rate(n_toxic: np.ndarray, n_clean: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """How many times as often toxic texts have it as clean ones."""
    return (n_toxic + 0.5) / (toxic + 1) * (clean + 1) / (n_clean + 0.5)


class _Counts:
    """How many toxic and clean texts hold a word with each start of a word of the toxic ones."""

    def __init__(self, toxic: list[str], clean: list[str]):
        self.toxic, self.clean = len(toxic), len(clean)
        self.held = [_word_starts(t) for t in toxic]
        self.n_toxic = Counter(w for ws in self.held for w in ws)
        self.n_clean = Counter(w for t in clean for w in _word_starts(t) & self.n_toxic.keys())

        self.sure = self._shared()

    def _shared(self) -> Counter:
        """Starts that more toxic texts have than chance would give, and how many."""
        starts = list(self.n_toxic)
        n = np.array([[self.n_toxic[w], self.n_clean[w]] for w in starts], float).reshape(-1, 2).T
        rate, evidence = _rate(*n, self.toxic, self.clean), _evidence(*n, self.toxic, self.clean)
        keep = (evidence > -np.log(CHANCE)) & (np.log(rate) > LEAST_ODDS)
        return Counter({starts[i]: self.n_toxic[starts[i]] for i in np.flatnonzero(keep)})

    def telling(self, window: bytes) -> bool:
        """Whether enough toxic texts, against clean ones, have a word with the window's shorter and its longer start."""
        for start in (window[: STARTS[0]], window[: STARTS[1]]):
            n = np.array([self.n_toxic[start], self.n_clean[start]], float)
            if np.log(_rate(*n, self.toxic, self.clean)) <= LEAST_ODDS or _evidence(*n, self.toxic, self.clean) <= LEAST_EVIDENCE:
                return False
        return True

    def light(self, window: bytes) -> bool:
        """Whether the counts do not bear the window out, though they do others."""
        return bool(self.sure) and not any(window[:n] in self.sure for n in STARTS) and not self.telling(window)


def _first_positives(toxic: list[str], clean: list[str]) -> tuple[Counter, Counter, _Counts]:
    """Windows to begin with, sure and weak ones, and how many toxic texts have them; and the counts behind.

    Word starts that more toxic texts have than chance would give; and, of every text with none of them, the
    window with the most telling subsequences, whatever its value.
    """
    ordinary = {w for t in clean for w in _word_starts(t)}
    distinct = _apart(toxic, ordinary)
    counts = _Counts(distinct, clean)
    found = Counter(counts.sure)
    numbers = []
    for texts in (distinct, clean):
        n = np.zeros(FEATURES)
        for t in texts:
            codes, _ = stream([t])
            n[np.unique(np.concatenate([np.zeros(0, int), *(c[w] for _, c, w in subsequences(codes))]))] += 1
        numbers.append(n)
    evidence = _evidence(*numbers, len(distinct), len(clean))
    telling = np.log(_rate(*numbers, len(distinct), len(clean))) > LEAST_ODDS
    strong, evidence = np.where(telling, evidence, np.minimum(evidence, 0)).astype(np.float32), evidence.astype(np.float32)
    open_ = [t for t, ws in zip(distinct, counts.held) if not ws & found.keys()]
    seeds = [x if _value(x, strong) > 0 else _highest([t], evidence)[0] for t, x in zip(open_, _highest(open_, strong))]
    return found, Counter(seeds), counts


def _highest(texts: list[str], weights: np.ndarray) -> list[bytes]:
    """The highest window of each text."""
    reach, out = WINDOW + max(shape[-1] for shape in SHAPES), []
    for t in texts:
        codes, _ = stream([t])
        at = int(window_values(codes, weights).argmax())
        window = codes[at : at + reach]
        end = np.flatnonzero(window[1:] == 0)
        out.append(window[: end[0] + 1 if len(end) else None].tobytes())
    return out


def _value(window: bytes, weights: np.ndarray) -> float:
    keys, values = window_features(np.frombuffer(window, np.uint8))
    return float(weights[keys] @ values)


def _with_insertions(windows: list[bytes], rng: np.random.Generator) -> list[bytes]:
    """Each window and two copies with a letter inserted inside its word."""
    out = list(windows)
    for x in windows * 2:
        if len(x) > 3:
            at = int(rng.integers(2, len(x)))
            out.append(x[:at] + bytes([int(rng.integers(1, 27))]) + x[at:])
    return out


def _across(texts: list[str], weights: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The highest value of each text's windows across boundaries, and the window, without them."""
    highest, windows = np.full(len(texts), -np.inf), []
    for i, t in enumerate(texts):
        codes, starts = stream([t])
        _, values = across_values(codes, starts, weights)
        if len(values):
            at = int(_words(codes)[1][values.argmax()])
            highest[i] = values.max()
            windows.append(b"\0" + codes[codes != 0][at : at + REACH - 1].tobytes())
    return highest, windows


def _phrase_starts(text: str) -> dict[bytes, bytes]:
    """The starts of words on end that reach beyond their first word, each with a window that begins so."""
    codes, _ = stream([text])
    places, first = _words(codes)
    letters = codes[codes != 0].tobytes()
    ends = np.append(first[1:], len(letters))
    return {
        b"\0" + letters[i : i + n - 1]: b"\0" + letters[i : i + REACH - 1]
        for n in STARTS
        for i, j in zip(first.tolist(), ends.tolist())
        if j < i + n - 1 <= len(letters)
    }


def _phrases(toxic: list[str], clean: list[str]) -> tuple[Counter, set[str]]:
    """Windows of insults of several words, with how many toxic texts have them, and these texts.

    Their starts are shared by more toxic texts than chance would give, counted among those without a word that is.
    """
    ordinary = {w for t in clean for w in _word_starts(t)}
    counts = _Counts(_apart(toxic, ordinary), clean)
    del ordinary
    plain = [t for t in toxic if not _word_starts(t) & counts.sure.keys()]
    if not plain:
        return Counter(), set()
    held = [_phrase_starts(t) for t in plain]
    n_toxic = Counter(w for ws in held for w in ws)
    n_toxic = {w: n for w, n in n_toxic.items() if n > 2}
    n_clean = Counter(w for t in clean for w in _phrase_starts(t).keys() & n_toxic.keys())
    starts = list(n_toxic)
    n = np.array([[n_toxic[w], n_clean[w]] for w in starts], float).reshape(-1, 2).T
    rate, evidence = _rate(*n, len(toxic), len(clean)), _evidence(*n, len(toxic), len(clean))
    sure = {starts[i] for i in np.flatnonzero((evidence > -np.log(CHANCE)) & (np.log(rate) > LEAST_ODDS))}
    windows = Counter(w for ws in held for start, w in ws.items() if start in sure)
    return windows, {t for t, ws in zip(plain, held) if ws.keys() & sure}


def _fit_phrases(positive: Counter, clean: list[str]) -> tuple[np.ndarray, float]:
    """A machine that tells windows of several words from those of clean texts, first the ones that begin alike."""
    ranked = [x for x, _ in sorted(positive.items(), key=lambda i: (-i[1], i[0]))]
    alike = {x[:4] for x in ranked}
    negative: dict[bytes, None] = {}
    rng = np.random.default_rng(8)
    for t in clean:
        codes, _ = stream([t])
        letters, firsts = codes[codes != 0].tobytes(), _words(codes)[1].tolist()
        windows = [b"\0" + letters[i : i + REACH - 1] for i in firsts]
        near = [w for w in windows if w[:4] in alike and w not in positive]
        negative |= dict.fromkeys(near[:2] + windows[:1])
    machine = None
    for _ in range(ROUNDS):
        others = [x for x in negative if x not in positive]
        order = rng.permutation(len(others))[: LANDMARKS // 2]
        machine = nystroem_svm(ranked, others, ranked[: LANDMARKS // 2] + [others[i] for i in sorted(order)])
        values, windows = _across(clean, machine[0])
        hard = [w for w in windows if w not in negative and w not in positive and _value(w, machine[0]) + machine[1] > -1]
        if not hard:
            break
        negative = dict.fromkeys(hard) | negative
    return machine


def fit(texts: list[str], labels: list[int]) -> Model:
    """Fit the model on a sample; equal texts count once."""
    sample = list(dict.fromkeys(zip(texts, labels)))
    toxic, clean = ([t for t, y in sample if y == label] for label in (1, 0))
    if not toxic or not clean:
        return NEVER
    windows, explained = _phrases(toxic, clean)
    phrases = _fit_phrases(windows, clean) if windows else None
    worded = [t for t in toxic if t not in explained]
    if worded:
        weights, constant = _fit_words(worded, clean)
        value, _ = _across(clean, weights)
        price = max(ACROSS, float(np.quantile(value, 1 - RAISED)) + constant) if np.isfinite(value).all() else np.inf
    else:
        weights, constant, price = np.zeros(FEATURES, np.float32), -1.0, np.inf
    raw = Model(weights, constant, 1.0, 0.0, price, phrases)
    values = np.clip(raw.values(toxic + clean), -1, 1)  # the margin decides, not how far beyond it a text lies
    slope, offset = logistic(values, np.repeat([1, 0], [len(toxic), len(clean)]))
    if slope <= 0:  # the classes can't be told apart: the share of toxic texts
        slope, offset = 0.0, float(np.log(len(toxic) / len(clean)))
    return replace(raw, slope=slope, offset=offset)


def _fit_words(toxic: list[str], clean: list[str]) -> tuple[np.ndarray, float]:
    """The first machine: weights and constant of windows within one word."""
    rng = np.random.default_rng(8)
    ordinary = sorted(set(_highest(clean, rng.random(FEATURES).astype(np.float32))))
    (sure, weak, counts), hard = _first_positives(toxic, clean), {}
    positive = sure | weak
    for _ in range(ROUNDS):
        ranked = [x for x, _ in sorted(positive.items(), key=lambda i: (-i[1], i[0]))]
        negative = [*(x for x in hard if x not in positive), *(x for x in ordinary if x not in hard and x not in positive)]
        marks = ranked[: LANDMARKS // 2] + negative[: LANDMARKS // 2]
        light = {x for x in ranked if counts.light(x)}
        copies = ranked + _with_insertions(firm := [x for x in ranked if x not in light], rng)[len(firm) :]
        importance = np.array([LIGHT if x in light else positive[x] for x in ranked] + [1] * (len(copies) - len(ranked)), float)
        weights, constant = nystroem_svm(copies, negative, marks, np.sqrt(importance))
        hard = dict.fromkeys(x for x in _highest(clean, weights) if not counts.telling(x)) | hard
        seen = Counter(x for x in _highest(toxic, weights) if _value(x, weights) + constant > 0)
        held = Counter({x: n for x, n in positive.items() if _value(x, weights) + constant > 0 and x not in weak}) | seen
        held = Counter({x: n for x, n in held.items() if x not in hard})
        if not held:
            break
        positive = held
    return weights, constant


# ---- Spark --------------------------------------------------------------------


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    """Fit on a bounded sample of the labelled rows of ``docs`` that are not held out."""
    marked = labels.where(F.col("toxic").isin(0, 1) & ~held_out()).select("doc_id", F.col("toxic").cast("int").alias("y"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(
        F.length("text").between(1, SAMPLE_CHARS)
    )
    rows = []
    for label, most in ((1, toxic_rows), (0, clean_rows)):
        order = F.xxhash64(F.col("doc_id"), F.lit(label))
        chosen = marked.where(F.col("y") == label).orderBy(order, "doc_id").limit(2 * most)
        found = texts.join(F.broadcast(chosen), "doc_id").orderBy(order, "doc_id", "text").limit(most)
        rows += [(r.text, r.y) for r in found.select("text", "y").collect()]
    return fit([t for t, _ in rows], [y for _, y in rows])


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the toxicity score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf(DoubleType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores([t or "" for t in texts]), dtype=float)

    return docs.withColumn(column, run(F.col(text).cast("string")))


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    columns, mark = docs.columns, "score"
    while mark in columns:
        mark += "_"
    return score(docs, model, column=mark).where(F.col(mark) < threshold).select(*[f"`{c}`" for c in columns])
