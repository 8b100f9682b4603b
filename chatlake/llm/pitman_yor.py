"""Log probabilities of whole texts under a hierarchical Pitman-Yor language model.

A token is seated in the restaurant of its context, the whole word before it or the start of a
text; each word has a restaurant of its own as a context. All context restaurants share one
parent, the restaurant of words, whose base is uniform over the V words of the training texts
and one unknown word. Every table of a
context restaurant is a customer of the parent. With c customers at t tables for a
word, C customers at T tables in all, discount d and strength s, a restaurant gives
the word (c - d * t + (s + d * T) * parent) / (s + C).

Seating is sampled by Gibbs: a step takes all customers of one word out of one
restaurant and seats them anew by the Chinese restaurant process. What matters
later is only their number of tables, which is drawn from its exact
distribution given all other tables and the parent's probability at that time
(generalised Stirling numbers; up to ``LISTED`` customers). More customers come in at most
``PARTIES`` parties of growing size, whose new tables are binomial draws. A sweep does
this for all words of all restaurants, then for the parent. Restaurants
exchange their total numbers of tables (one number per context) after a
sweep, so words can be sampled apart from each other. After ``BURN_IN`` sweeps,
the predictive probabilities of ``SAMPLES`` sweeps are averaged; the logarithm is taken of
the average. Discounts are n1 / (n1 + 2 * n2) of the cells with one and two customers.

How it runs: texts are written once as *chunks* of some ``CHUNK`` tokens: the chunk's words and each
token's word. Its distinct (word, context) cells are sorted by a 64-bit hash of the word, then of the context.
A range of word hashes is a *part*: it gets what each chunk has of it, sums the training
counts, and so holds all contexts of its words. A *hot* word (frequent, with more than ``PART`` cells asked) is
dealt over all parts by context instead. Counts, cells and parts grow with the input;
a word that makes a third of all tokens is one cell per chunk and context.

Contexts lie across parts. Their numbers of customers and tables go two ways: of the start and of the ``FREQUENT``
most frequent words through the driver (``CONTEXTS`` numbers per sweep, as for the hot words in the parent), of all other words through
*owners*, each of a range of context hashes: a part names its contexts once; after each sweep it sends its tables beyond
the first of its cells, and owners answer with the sums. Either way the numbers are the same, and so are the draws.

A sweep is a job over the cells with two customers and more (any other cell's tables are known); it runs the sweeps before it again
from their numbers (draws are seeded by part and sweep), so a lost executor loses
nothing and no state is rewritten. In the end each part answers each chunk, and a chunk adds up
its texts.

Two words share a hash with a probability of V * V / 2 ** 65, two contexts with V * V / 2 ** 49 (48 bits).

Defined results: a null text counts as empty: one token, the end. A row with a null doc_id is
not held out. Repeated rows each count and get equal scores. Without training tokens all
probabilities are 1. An empty table gives an empty result. Other columns are not read. A text
is read whole by the task that has it, however long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import stored
from chatlake.llm.shingles import mix, word_hashes

FOLDS, HELD_OUT = 7, 2
#: Contexts whose numbers the driver keeps: the start of a text and the most frequent words.
CONTEXTS = 1024
FREQUENT = CONTEXTS - 1
BURN_IN, SAMPLES = 2, 3
STRENGTH = 1.0
LISTED, PARTIES = 64, 64
#: Tokens of a chunk, and cells asked of a part.
CHUNK, PART = 1 << 22, 1 << 20

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
END = b""


def held_out() -> Column:
    fold = F.pmod(F.crc32(F.col("doc_id").cast("long").cast("string")), F.lit(FOLDS))
    return F.coalesce(fold == HELD_OUT, F.lit(False))


# ---- chunks ----------------------------------------------------------------------


class _Ids(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def tokens_of(text: str | None) -> list[bytes]:
    """The words of a text (bytes are split at exactly \\x20 and \\x09-\\x0D) and one end."""
    return [*(text or "").encode().translate(_LOWER).split(), END]


def _hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each distinct word; the end has 0."""
    out = np.zeros(len(words), np.uint64)
    there = np.array([w != END for w in words], bool)
    if there.any():
        out[there] = word_hashes(b" ".join(w for w in words if w != END).decode())
    return out


def pack(values: np.ndarray) -> bytes:
    """Numbers (integers from 0 up in as few bytes as the largest needs), byte by byte place, compressed."""
    if values.dtype.kind in "iu":
        values = values.astype(np.min_scalar_type(int(values.max(initial=0))))
    raw = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return values.dtype.char.encode() + len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(raw: bytes) -> np.ndarray:
    kind, size = np.dtype(chr(raw[0])), int.from_bytes(raw[1:9], "little")
    planes = np.frombuffer(pa.decompress(raw[9:], size, "zstd", asbytes=True) if size else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def pack_rising(values: np.ndarray) -> bytes:
    """Mostly rising numbers by their steps (modulo 2 ** 64)."""
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unpack_rising(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=np.uint64).astype(np.int64)


def cells_of(tokens: np.ndarray, lengths: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct cells of a chunk: rank of the word and of the word before (from 1; 0 is the start of a text),
    and each token's cell."""
    word, n = rank[tokens].astype(np.int64), len(rank) + 1
    before = np.zeros(len(word), np.int64)
    before[1:] = word[:-1] + 1
    before[np.cumsum(lengths) - lengths] = 0
    cells, at = np.unique(word * n + before, return_inverse=True)
    return cells // n, cells % n, at


def names_of(hashes: np.ndarray) -> np.ndarray:
    """48-bit names of the contexts of rank 0 (the start), 1, 2, ..., from the words' sorted hashes."""
    return np.concatenate([np.zeros(1, np.uint64), hashes >> np.uint64(16)])


_CHUNKS = (
    "chunk long, ids array<long>, held array<boolean>, lengths array<int>, n_cells int, tokens binary, "
    "ranks binary, hashes binary, top array<struct<word: long, n: long, cells: long>>"
)
_CHUNK_TYPES = [
    pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.int32(), *[pa.binary()] * 3,
    pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64()), ("cells", pa.int64())])),
]


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    chunk = TaskContext.get().partitionId() << 32
    names = ["chunk", "ids", "held", "lengths", "n_cells", "tokens", "ranks", "hashes", "top"]
    ids, docs, size = _Ids(), [], 0

    def done() -> pa.RecordBatch:
        lengths = np.array([len(d[2]) for d in docs], np.int64)
        tokens = np.concatenate([d[2] for d in docs])
        hashes = _hashes(list(ids))
        order = np.argsort(hashes, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        hashes = hashes[order]
        word, _, _ = cells_of(tokens, lengths, rank)
        n, cells = np.bincount(rank[tokens], minlength=len(order)), np.bincount(word, minlength=len(order))
        often = np.flatnonzero(n * 2 * CONTEXTS >= len(tokens))
        top = [
            {"word": w, "n": a, "cells": b}
            for w, a, b in zip(hashes[often].astype(np.int64).tolist(), n[often].tolist(), cells[often].tolist())
        ]
        binary = [pack(tokens), pack(rank), hashes.astype("<u8").tobytes()]
        row = [chunk, [d[0] for d in docs], [d[1] for d in docs], lengths.tolist(), len(word), *binary, top]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _CHUNK_TYPES)], names=names)

    for batch in batches:
        for doc_id, held, text in zip(*(c.to_pylist() for c in batch.columns)):
            words = np.array(list(map(ids.__getitem__, tokens_of(text))), np.int64)
            docs.append((doc_id, held, words))
            size += len(words)
            if size >= most:
                yield done()
                chunk += 1
                ids, docs, size = _Ids(), [], 0
    if docs:
        yield done()


def chunks_of(docs: DataFrame) -> DataFrame:
    most = CHUNK
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held"), F.col("text").cast("string").alias("text"))
    return stored(read.mapInArrow(lambda batches: _chunks(batches, most), _CHUNKS), "chunks")


# ---- parts -----------------------------------------------------------------------


def _among(values: np.ndarray, known: np.ndarray, numbers: np.ndarray, other: int) -> np.ndarray:
    """The number of each value that is known, ``other`` of any other."""
    if not len(known):
        return np.full(len(values), other, np.int64)
    order = np.argsort(known, kind="stable")
    at = np.minimum(np.searchsorted(known[order], values), len(known) - 1)
    return np.where(known[order][at] == values, numbers[order][at], other)


def _range(high: np.ndarray, n: int) -> np.ndarray:
    """Which of n equal ranges a 32-bit number is in."""
    return ((high * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


@dataclass(frozen=True)
class Deal:
    """Who gets what: the number of parts, the hashes of frequent words, and of those that are hot as words."""

    parts: int
    frequent: np.ndarray
    hot: np.ndarray

    def slots(self, names: np.ndarray) -> np.ndarray:
        """The numbers of contexts that are exchanged by the driver; ``CONTEXTS`` for any other."""
        known = names_of(self.frequent)
        return _among(names, known, np.arange(len(known)), CONTEXTS)

    def hot_slots(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of hot words from 1; 0 for any other."""
        return _among(hashes, self.hot, np.arange(1, len(self.hot) + 1), 0)

    def order(self, hashes: np.ndarray, word: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The part of each cell of a chunk, and the cells in the order of parts."""
        part = _range(hashes >> np.uint64(32), self.parts)[word]
        hot = self.hot_slots(hashes)[word] > 0
        if hot.any():
            part[hot] = _range(mix(names_of(hashes)) >> np.uint64(32), self.parts)[before[hot]]
        return part, np.argsort(part, kind="stable")


def deal_of(chunks: DataFrame) -> Deal:
    cells = chunks.agg(F.sum("n_cells")).first()[0] or 0
    parts = max(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-cells // PART))
    top = chunks.select(F.explode("top").alias("t")).groupBy("t.word").agg(F.sum("t.n").alias("n"), F.sum("t.cells").alias("cells"))
    top = top.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    words = np.array([r.word for r in top], np.int64).astype(np.uint64)
    return Deal(parts, words, words[np.array([r.cells > PART for r in top], bool)])


def _short(names: np.ndarray) -> bytes:
    return names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


_ASKED = "part int, chunk long, words binary, sizes binary, slots binary, names binary, trained binary"


def _split(batches: Iterator[pa.RecordBatch], deal: Deal) -> Iterator[pa.RecordBatch]:
    """What each part gets of a chunk's cells."""
    names = [c.split()[0] for c in _ASKED.split(", ")]
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
    for batch in batches:
        for chunk, held, lengths, tokens, ranks, hashes in zip(*(c.to_pylist() for c in batch.columns)):
            lengths, hashes = np.array(lengths, np.int64), np.frombuffer(hashes, "<u8")
            word, before, at = cells_of(unpack(tokens), lengths, unpack(ranks))
            trained = np.bincount(at[np.repeat(~np.array(held, bool), lengths)], minlength=len(word))
            contexts = names_of(hashes)
            slots = deal.slots(contexts)
            part, order = deal.order(hashes, word, before)
            part = part[order]
            edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part)).tolist()
            rows = []
            for a, b in zip(edges[:-1], edges[1:]):
                own = order[a:b]
                first = np.flatnonzero(np.diff(word[own], prepend=-1))
                slot = slots[before[own]]
                rare = contexts[before[own][slot == CONTEXTS]]
                sizes = np.diff(np.append(first, b - a))
                words = hashes[word[own[first]]].tobytes()
                rows.append((int(part[a]), chunk, words, pack(sizes), pack(slot), _short(rare), pack(trained[own])))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


_PARTS = (
    "part int, n_words int, words binary, contexts binary, counts binary, hot binary, names binary, "
    "chunks array<long>, places array<binary>"
)


def _gather(rows: pd.DataFrame, deal: Deal) -> pd.DataFrame:
    """A part's distinct cells with their training counts, and each chunk's places among them."""
    rows = rows.sort_values("chunk")
    hashes = np.concatenate([np.repeat(np.frombuffer(w, "<u8"), unpack(n)) for w, n in zip(rows["words"], rows["sizes"])])
    slots = [unpack(b).astype(np.int64) for b in rows["slots"]]
    sizes = np.cumsum([len(x) for x in slots])
    slots, trained = np.concatenate(slots), np.concatenate([unpack(b) for b in rows["trained"]])
    known = names_of(deal.frequent)
    names = known[np.where(slots < CONTEXTS, slots, 0)]
    names[slots == CONTEXTS] = np.concatenate([_long(b) for b in rows["names"]])
    words, word = np.unique(hashes, return_inverse=True)
    contexts, context = np.unique(names, return_inverse=True)
    cells, at = np.unique(word.astype(np.int64) * len(contexts) + context, return_inverse=True)
    counts = np.bincount(at, trained, len(cells)).astype(np.int64)
    number = deal.slots(contexts)
    rare = number == CONTEXTS
    number[rare] += np.arange(rare.sum())
    row = {
        "part": rows["part"].iloc[0],
        "n_words": len(words),
        "words": pack_rising(cells // len(contexts)),
        "contexts": pack(number[cells % len(contexts)]),
        "counts": pack(counts),
        "hot": pack(deal.hot_slots(words)),
        "names": pack_rising(contexts[rare]),
        "chunks": rows["chunk"].tolist(),
        "places": [pack_rising(x) for x in np.split(at, sizes[:-1])],
    }
    return pd.DataFrame([row])


def parts_of(chunks: DataFrame, deal: Deal | None = None) -> DataFrame:
    deal = deal or deal_of(chunks)
    asked = chunks.select("chunk", "held", "lengths", "tokens", "ranks", "hashes").mapInArrow(
        lambda batches: _split(batches, deal), _ASKED
    )
    return stored(asked.groupBy("part").applyInPandas(lambda rows: _gather(rows, deal), _PARTS), "parts")


# ---- seating ---------------------------------------------------------------------


def log_stirling(most: int, d: float) -> np.ndarray:
    """log S[c, t] of S[c + 1, t] = S[c, t - 1] + (c - d * t) * S[c, t], S[1, 1] = 1: the weight of all
    seatings of c customers at t tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(1, most + 1)
    for c in range(1, most):
        stay = np.where(c > d * t, np.log(np.maximum(c - d * t, 1e-300)), -np.inf) + out[c, 1:]
        out[c + 1, 1:] = np.logaddexp(out[c, :-1], stay)
    return out


def table_weights(c: int, others: np.ndarray, log_parent: np.ndarray, d: float, strength: float, stirling: np.ndarray) -> np.ndarray:
    """(cells, c): the log weight of 1 to c tables for c customers beside ``others`` tables."""
    opened = np.log(strength + d * (others[:, None] + np.arange(c))) + log_parent[:, None]
    return np.cumsum(opened, axis=1) + stirling[c, 1 : c + 1]


def seat(
    counts: np.ndarray, others: np.ndarray, parent: np.ndarray, d: float, strength: float, rng: np.random.Generator
) -> np.ndarray:
    """How many tables the customers of each cell take when they are seated anew."""
    tables = np.minimum(counts, 1)
    stirling = log_stirling(LISTED, d)
    listed = np.flatnonzero((counts > 1) & (counts <= LISTED))
    listed = listed[np.argsort(counts[listed], kind="stable")]
    sizes = counts[listed]
    for c in np.unique(sizes).tolist():
        group = listed[np.searchsorted(sizes, c) : np.searchsorted(sizes, c, "right")]
        step = max(1, (1 << 20) // c)
        for at in (group[i : i + step] for i in range(0, len(group), step)):
            w = table_weights(c, others[at], np.log(parent[at]), d, strength, stirling)
            w = np.cumsum(np.exp(w - w.max(axis=1, keepdims=True)), axis=1)
            tables[at] = 1 + (w < rng.random(len(at))[:, None] * w[:, -1:]).sum(axis=1).clip(max=c - 1)
    many = np.flatnonzero(counts > LISTED)
    if len(many):
        c, t, seated = counts[many], np.ones(len(many)), np.ones(len(many))
        for j in range(1, PARTIES + 1):
            now = c if j == PARTIES else np.floor(c ** (j / PARTIES))
            new = (strength + d * (others[many] + t)) * parent[many]
            share = new / (new + np.maximum((seated + now) / 2 - d * t, 1e-9))
            t = t + rng.binomial((now - seated).astype(np.int64), np.clip(share, 0, 1))
            seated = np.asarray(now, float)
        tables[many] = t.astype(np.int64)
    return tables


@dataclass(frozen=True)
class Totals:
    """What restaurants know of each other: tables per context that the driver keeps, customers and tables of the
    parent, and those of the hot words."""

    tables: np.ndarray
    root_customers: int
    root_tables: int
    hot_customers: np.ndarray
    hot_tables: np.ndarray


@dataclass(frozen=True)
class Rare:
    """What a part hears from owners of its other contexts: customers, and tables after each sweep."""

    customers: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    tables: tuple[np.ndarray, ...] = ()


@dataclass(frozen=True)
class Setting:
    """What does not change from sweep to sweep."""

    vocabulary: int
    tokens: int
    customers: np.ndarray  # per context that the driver keeps
    hot_known: np.ndarray  # training tokens of each hot word
    discount: float
    root_discount: float
    history: tuple[Totals, ...] = field(default_factory=tuple)

    def base(self, now: Totals) -> float:
        """What the uniform base adds to a word of the parent restaurant."""
        return (STRENGTH + self.root_discount * now.root_tables) / (self.vocabulary + 1)

    def root(self, customers: np.ndarray, tables: np.ndarray, now: Totals) -> np.ndarray:
        """The parent's probability of words with so many customers and tables."""
        return (customers - self.root_discount * tables + self.base(now)) / (STRENGTH + now.root_customers)


class Part:
    """The cells of one part and their tables; ``single`` counts cells of each word that are not listed and have one table."""

    def __init__(
        self, part: int, n_words: int, words: bytes, contexts: bytes, counts: bytes,
        hot: bytes | None = None, rare: Rare | None = None, single: bytes | None = None,
    ):
        self.part, self.n_words, self.rare = part, n_words, rare or Rare()
        self.words = unpack_rising(words)
        self.contexts = unpack(contexts).astype(np.int64)
        self.counts = unpack(counts).astype(np.int64)
        none = np.zeros(n_words, np.int64)
        self.hot = none if hot is None else unpack(hot).astype(np.int64)
        self.single = none if single is None else unpack(single).astype(np.int64)
        self.tables = np.minimum(self.counts, 1)
        self.root_tables = np.minimum(self.own(), 1)

    def served(self) -> np.ndarray:
        """Customers of each word in the parent restaurant, as far as they come from this part."""
        return self.single + np.bincount(self.words, self.tables, self.n_words).astype(np.int64)

    def own(self) -> np.ndarray:
        """``served`` of the words that are not dealt over all parts."""
        return np.where(self.hot > 0, 0, self.served())

    def rooted(self, now: Totals) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of each word in the parent restaurant."""
        hot = self.hot > 0
        return (
            np.where(hot, now.hot_customers[self.hot], self.served()),
            np.where(hot, now.hot_tables[self.hot], self.root_tables),
        )

    def context_tables(self, number: int, now: Totals) -> np.ndarray:
        """Tables of each context before sweep ``number``."""
        return np.concatenate([now.tables, self.rare.tables[number]]) if self.rare.tables else now.tables

    def sweep(self, number: int, setting: Setting, now: Totals) -> None:
        rng = np.random.default_rng([number, self.part])
        served, held = (n[self.words] for n in self.rooted(now))
        served = served - self.tables  # without the cell's own
        held = np.minimum(held, served)
        parent = setting.root(served, held, now)
        others = np.maximum(self.context_tables(number, now)[self.contexts] - self.tables, 0)
        self.tables = seat(self.counts, others, parent, setting.discount, STRENGTH, rng)
        base = np.full(self.n_words, 1 / (setting.vocabulary + 1))
        others = np.maximum(now.root_tables - self.root_tables, 0)
        self.root_tables = seat(self.own(), others, base, setting.root_discount, STRENGTH, rng)

    def sweeps(self, setting: Setting, last: int) -> Iterator[int]:
        """Runs sweeps 0 to ``last`` - 1; each starts from the totals that the one before it left."""
        for number in range(last):
            self.sweep(number, setting, setting.history[number])
            yield number

    def predict(self, setting: Setting) -> np.ndarray:
        """log10 of each cell's probability, averaged over the samples."""
        total = np.zeros(len(self.counts))
        size = STRENGTH + np.concatenate([setting.customers, self.rare.customers])
        for number in self.sweeps(setting, BURN_IN + SAMPLES):
            if number < BURN_IN:
                continue
            now = setting.history[number + 1]
            root = setting.root(*self.rooted(now), now)
            back = (STRENGTH + setting.discount * self.context_tables(number + 1, now)) / size
            own = (self.counts - setting.discount * self.tables) / size[self.contexts]
            total += own + back[self.contexts] * root[self.words]
        return np.log10(total / SAMPLES)

    def known(self, setting: Setting) -> np.ndarray:
        """Training tokens of each word."""
        here = np.bincount(self.words, self.counts, self.n_words).astype(np.int64)
        return np.where(self.hot > 0, setting.hot_known[self.hot], here)

    def of_contexts(self, values: np.ndarray) -> np.ndarray:
        """Sums of the cells' values per context that the driver keeps."""
        kept = self.contexts < CONTEXTS
        return np.bincount(self.contexts[kept], values[kept], CONTEXTS).astype(np.int64)

    def of_rare(self, values: np.ndarray, n: int) -> np.ndarray:
        """Sums of the cells' values per other context."""
        rare = self.contexts >= CONTEXTS
        return np.bincount(self.contexts[rare] - CONTEXTS, values[rare], n).astype(np.int64)

    def of_hot(self, values: np.ndarray) -> np.ndarray:
        """Sums of the words' values per hot word."""
        out = np.bincount(self.hot, values, CONTEXTS).astype(np.int64)
        out[0] = 0
        return out


_MODEL = ["part", "n_words", "words", "contexts", "counts", "hot"]


def _each_part(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[Part, tuple]]:
    for rows in batches:
        for row in rows.itertuples(index=False):
            yield Part(row.part, row.n_words, row.words, row.contexts, row.counts, row.hot), row


def _sums(sums: dict[str, np.ndarray]) -> pd.DataFrame:
    """The numbers other than 0 as rows (kind, at, n)."""
    rows = [(kind, at, int(n[at])) for kind, n in sums.items() for at in np.flatnonzero(n).tolist()]
    return pd.DataFrame(rows, columns=["kind", "at", "n"])


_KINDS = ("customers", "tables", "hot", "hot_known", "few", "root")


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over a task's parts: customers and cells per context; training tokens and contexts of hot words; cells and
    words with one and two customers, words, customers, and the names of other contexts."""
    sums = {k: np.zeros(CONTEXTS, np.int64) for k in _KINDS}
    for part, row in _each_part(batches):
        sums["customers"] += part.of_contexts(part.counts)
        sums["tables"] += part.of_contexts(part.tables)
        sums["hot"] += part.of_hot(part.served())
        sums["hot_known"] += part.of_hot(np.bincount(part.words, part.counts, part.n_words))
        served = part.own()
        few = [(part.counts == 1).sum(), (part.counts == 2).sum(), (served == 1).sum(), (served == 2).sum()]
        few += [(served > 0).sum(), part.counts.sum(), part.tables.sum(), len(unpack(row.names))]
        sums["few"][: len(few)] += np.array(few)
    yield _sums(sums)


def _totals(rows: DataFrame) -> dict[str, np.ndarray]:
    """Sums over parts; at most some 4 * ``CONTEXTS`` numbers."""
    out: dict[str, np.ndarray] = {k: np.zeros(CONTEXTS, np.int64) for k in _KINDS}
    for r in rows.groupBy("kind", "at").agg(F.sum("n").alias("n")).collect():
        out[r.kind][r["at"]] = r.n
    return out


# ---- contexts that owners keep -----------------------------------------------------


def _request(batches: Iterator[pd.DataFrame], owners: int) -> Iterator[pd.DataFrame]:
    """A part's other contexts with their customers and cells, to their owners."""
    for part, row in _each_part(batches):
        names = unpack_rising(row.names).astype(np.uint64)
        sums = [part.of_rare(v, len(names)) for v in (part.counts, part.tables)]
        edges = np.searchsorted(_range(names >> np.uint64(16), owners), np.arange(owners + 1)).tolist()
        rows = [
            (i, part.part, pack_rising(names[a:b]), *(pack(v[a:b]) for v in sums))
            for i, (a, b) in enumerate(zip(edges[:-1], edges[1:]))
            if a < b
        ]
        yield pd.DataFrame(rows, columns=["owner", "part", "names", "customers", "tables"])


_OWNERS = "owner int, parts array<int>, places array<binary>, customers binary, tables binary"


def _own(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part")
    names = [unpack_rising(b) for b in rows["names"]]
    found, at = np.unique(np.concatenate(names), return_inverse=True)
    customers, tables = (
        np.bincount(at, np.concatenate([unpack(b) for b in rows[c]]), len(found)).astype(np.int64)
        for c in ("customers", "tables")
    )
    places = [pack_rising(x) for x in np.split(at, np.cumsum([len(x) for x in names])[:-1])]
    row = [rows["owner"].iloc[0], rows["part"].tolist(), places, pack(customers), pack(tables)]
    return pd.DataFrame([row], columns=["owner", "parts", "places", "customers", "tables"])


_REPLIES = "part int, sweep int, owner int, customers binary, tables binary"
_REPLY = ["part", "sweep", "owner", "customers", "tables"]


def _first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """To each part customers and cells of its contexts over all parts."""
    for rows in batches:
        for row in rows.itertuples(index=False):
            customers, tables = unpack(row.customers), unpack(row.tables)
            for part, raw in zip(row.parts, row.places):
                at = unpack_rising(raw)
                yield pd.DataFrame([(part, 0, row.owner, pack(customers[at]), pack(tables[at]))], columns=_REPLY)


def _again(owner: pd.DataFrame, sent: pd.DataFrame, sweep: int) -> pd.DataFrame:
    """To each part the tables beyond the first of each cell of its contexts after a sweep, over all parts."""
    if not len(owner):
        return pd.DataFrame(columns=_REPLY)
    row = owner.iloc[0]
    places = {part: unpack_rising(raw) for part, raw in zip(row["parts"], row["places"])}
    total = np.zeros(len(unpack(row["tables"])), np.int64)
    for part, raw in zip(sent["part"], sent["data"]):
        total[places[part]] += unpack(raw)
    rows = [(part, sweep, row["owner"], None, pack(total[at])) for part, at in places.items()]
    return pd.DataFrame(rows, columns=_REPLY)


def _heard(replies: pd.DataFrame) -> tuple[Rare, list[tuple[int, int]]]:
    """What owners told a part, and how many contexts of it each of them has."""
    if not len(replies):
        return Rare(), []
    replies = replies.sort_values(["sweep", "owner"])
    first = replies[replies["sweep"] == 0]
    customers = [unpack(b).astype(np.int64) for b in first["customers"]]
    tables = [np.concatenate([unpack(b).astype(np.int64) for b in rows["tables"]]) for _, rows in replies.groupby("sweep")]
    tables[1:] = [tables[0] + more for more in tables[1:]]
    return Rare(np.concatenate(customers), tuple(tables)), list(zip(first["owner"].tolist(), map(len, customers)))


# ---- training --------------------------------------------------------------------

_CORE = "part int, n_words int, words binary, contexts binary, counts binary, hot binary, single binary"


def _core(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The cells whose tables are drawn, and the number of a word's other cells with customers."""
    for part, row in _each_part(batches):
        many = part.counts > 1
        single = np.bincount(part.words[part.counts == 1], minlength=part.n_words)
        kept = (pack_rising(part.words[many]), pack(part.contexts[many]), pack(part.counts[many]))
        yield pd.DataFrame([(row.part, row.n_words, *kept, row.hot, pack(single))], columns=[c.split()[0] for c in _CORE.split(", ")])


_SWEPT = "kind string, at int, n long, part int, data binary"


def _swept(core: pd.DataFrame, replies: pd.DataFrame, setting: Setting) -> pd.DataFrame:
    names = ["kind", "at", "n", "part", "data"]
    if not len(core):
        return pd.DataFrame(columns=names)
    row, (rare, owners) = core.iloc[0], _heard(replies)
    part = Part(row["part"], row["n_words"], row["words"], row["contexts"], row["counts"], row["hot"], rare, row["single"])
    for _ in part.sweeps(setting, len(setting.history)):
        pass
    root = np.array([part.root_tables.sum(), part.served().sum()])
    # tables beyond the first; the first ones were counted before any sweep
    more = part.tables - 1
    sums = {"tables": part.of_contexts(more), "hot": part.of_hot(part.served()), "root": root}
    found = {kind: [(at, int(n[at])) for at in np.flatnonzero(n).tolist()] for kind, n in sums.items()}
    rows = [(kind, at, n, part.part, None) for kind, v in found.items() for at, n in v]
    more, at = part.of_rare(more, len(rare.customers)), 0
    for owner, n in owners:
        rows.append(("rare", owner, 0, part.part, pack(more[at : at + n])))
        at += n
    return pd.DataFrame(rows, columns=names)


def _sweep(core: DataFrame, replies: DataFrame, setting: Setting) -> DataFrame:
    jobs = core.groupBy("part").cogroup(replies.groupBy("part"))
    return jobs.applyInPandas(lambda a, b: _swept(a, b, setting), _SWEPT)


def _told(owners: DataFrame, sent: DataFrame, sweep: int) -> DataFrame:
    jobs = owners.groupBy("owner").cogroup(sent.groupBy("owner"))
    return jobs.applyInPandas(lambda a, b: _again(a, b, sweep), _REPLIES)


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / max(1, once + 2 * twice)))


def _train(parts: DataFrame) -> tuple[Setting, DataFrame]:
    """The setting, and what owners tell the parts."""
    found = _totals(parts.select(*_MODEL, "names").mapInPandas(_measure, "kind string, at int, n long"))
    few, hot = found["few"], found["hot"]
    words = few[2:5] + np.array([(hot == 1).sum(), (hot == 2).sum(), (hot > 0).sum()])
    discounts = _discount(few[0], few[1]), _discount(words[0], words[1])
    fixed = (int(words[2]), int(few[5]), found["customers"], found["hot_known"], *discounts)
    history = [Totals(found["tables"], int(few[6]), int(words[2]), hot, np.minimum(hot, 1))]
    core = stored(parts.select(*_MODEL).mapInPandas(_core, _CORE), "core")
    n_owners = max(1, -(-int(few[7]) // PART))
    asked = parts.select(*_MODEL, "names").mapInPandas(
        lambda rows: _request(rows, n_owners), "owner int, part int, names binary, customers binary, tables binary"
    )
    owners = stored(asked.groupBy("owner").applyInPandas(_own, _OWNERS), "owners")
    replies = stored(owners.mapInPandas(_first, _REPLIES), "replies")
    for number in range(BURN_IN + SAMPLES):
        setting, before = Setting(*fixed, tuple(history)), history[-1]
        swept = stored(_sweep(core, replies, setting), "swept")
        got = _totals(swept.where("kind <> 'rare'"))
        base = np.full(CONTEXTS, 1 / (setting.vocabulary + 1))
        others = np.maximum(before.root_tables - before.hot_tables, 0)
        rng = np.random.default_rng([number, 1 << 32])
        hot_tables = seat(got["hot"], others, base, setting.root_discount, STRENGTH, rng)
        tables = history[0].tables + got["tables"]
        root_tables = int(got["root"][0] + hot_tables.sum())
        history.append(Totals(tables, int(got["root"][1]), root_tables, got["hot"], hot_tables))
        sent = swept.where("kind = 'rare'").select(F.col("at").alias("owner"), "part", "data")
        replies = replies.unionByName(stored(_told(owners, sent, number + 1), "replies"))
    return Setting(*fixed, tuple(history)), replies


def train(parts: DataFrame) -> Setting:
    """Samples the seating; the result names the totals after each sweep, from which parts repeat it."""
    return _train(parts)[0]


# ---- scores ----------------------------------------------------------------------


_ANSWER = "chunk long, part int, known binary, scores binary"


def _answer(parts: pd.DataFrame, replies: pd.DataFrame, setting: Setting) -> pd.DataFrame:
    """For each chunk the training counts of its words and the probabilities of its cells."""
    rows = []
    for row in parts.itertuples(index=False):
        part = Part(row.part, row.n_words, row.words, row.contexts, row.counts, row.hot, _heard(replies)[0])
        scores, known = part.predict(setting).astype("<f4"), part.known(setting)[part.words]
        for chunk, raw in zip(row.chunks, row.places):
            at = unpack_rising(raw)
            rows.append((chunk, row.part, pack(known[at]), pack(scores[at])))
    return pd.DataFrame(rows, columns=["chunk", "part", "known", "scores"])


_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _add_up(chunks: pd.DataFrame, answers: pd.DataFrame, setting: Setting, deal: Deal) -> pd.DataFrame:
    """The texts of one chunk."""
    names = [c.split()[0] for c in _SCORED.split(", ")]
    if not len(chunks):
        return pd.DataFrame(columns=names)
    row, answers = chunks.iloc[0], answers.sort_values("part")
    lengths = np.asarray(row["lengths"], np.int64)
    word, before, at = cells_of(unpack(row["tokens"]), lengths, unpack(row["ranks"]))
    _, order = deal.order(np.frombuffer(row["hashes"], "<u8"), word, before)
    known, scores = np.empty(len(word), np.int64), np.empty(len(word))
    known[order] = np.concatenate([unpack(b) for b in answers["known"]])
    scores[order] = np.concatenate([unpack(b) for b in answers["scores"]])
    base = np.log10((known + 1) / (setting.tokens + setting.vocabulary + 1))
    starts = np.cumsum(lengths) - lengths
    columns = [
        pd.array(list(row["ids"]), "Int64"),
        list(row["held"]),
        lengths,
        np.add.reduceat((known > 0).astype(np.int64)[at], starts),
        np.full(len(lengths), setting.tokens),
        np.add.reduceat(base[at], starts),
        np.add.reduceat(scores[at], starts),
    ]
    return pd.DataFrame(dict(zip(names, columns)))


def score(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its log10 probability (doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score), learned from the rows that are not held out."""
    chunks = chunks_of(docs)
    deal = deal_of(chunks)
    parts = parts_of(chunks, deal)
    setting, replies = _train(parts)
    jobs = parts.select(*_MODEL, "chunks", "places").groupBy("part").cogroup(replies.groupBy("part"))
    answers = jobs.applyInPandas(lambda a, b: _answer(a, b, setting), _ANSWER)
    texts = chunks.select("chunk", "ids", "held", "lengths", "tokens", "ranks", "hashes")
    return (
        texts.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInPandas(lambda a, b: _add_up(a, b, setting, deal), _SCORED)
    )


def perplexity(scored: DataFrame, column: str = "score") -> float:
    """Of the held-out texts."""
    held = scored.where("held_out").agg(F.sum(column).alias("s"), F.sum("n_tokens").alias("n")).first()
    return math.inf if not held.n else 10 ** (-held.s / held.n)
