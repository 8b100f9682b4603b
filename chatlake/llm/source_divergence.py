"""How much the sources of a language differ in their words, on run-length columns.

Terms are ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with only A-Z lower-cased. A language
keeps the V terms that at least ``MIN_DOCS`` of its documents hold. With a
term's count in a group and N, the group's count over kept terms, p = 1 +
floor(10**9 * (count + 2) / (N + 2 * V)); two groups differ at a term by f =
floor((p - q)**2 / (p + q)).

1. *Counts.* Each task counts its texts' terms by (lang, source); counts are summed by
   term, so a term's counts in all sources of a language lie in one row.
2. *Reordering.* The vocabulary is sorted by these rows of counts, across all tasks (by
   range), so that terms with equal counts in the first sources stand together.
3. *Run-length columns.* The sorted vocabulary is cut into blocks; in a block a
   source's counts become runs (where one starts, and its count).
4. *Pairs.* In each block the run boundaries of two sources are intersected, and f of
   a common run is multiplied by its length. What a pair differs by in all
   blocks is summed. Sources are dealt into tiles, so a task meets two tiles of a
   block, however many sources there are.
5. *Terms.* A group's ten largest f against its language are found by a window
   that keeps ten rows of a group per task before they travel.

All arithmetic is on integers: p on decimals in Spark and unbounded integers in Python,
f and sums on 64 bits (p <= 10**9 + 1; a pair's sum is below 3 * 10**9 + V).

A term's row has as many counts as its language has sources, of which the result holds
every pair. The list of groups is broadcast if it has at most ``BROADCAST_GROUPS`` rows.

Defined results: null text, lang and source are ''. Groups without terms and languages
without kept terms have all their pairs (p = q, or 0). Repeated rows count each. Equal
values rank by their item in UTF-8 order. A language with one source has no pairs. An empty
table gives an empty result. Other columns are not read; texts are read whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatlake.llm.common import stored

MIN_DOCS, TOP = 10, 10
#: Terms, and counts other than 0, after which a block is cut.
BLOCK_TERMS, BLOCK_CELLS = 1 << 15, 1 << 20
#: Sources in a tile.
TILE = 256
#: Terms that a task counts before it passes them on.
HELD = 1 << 19
BROADCAST_GROUPS = 100_000

#: Bytes of a term as they are, A-Z in lower case, all others white space.
_TERM = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


# ---- counts --------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, df): occurrences, and documents that hold the term."""
    groups: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, df) in groups.items():
            terms = pa.array(list(n), pa.binary()).cast(pa.string())
            columns = [
                pa.array([lang] * len(n), pa.string()),
                pa.array([source] * len(n), pa.string()),
                terms,
                pa.array(list(n.values()), pa.int64()),
                pa.array([df[t] for t in n], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "df"])

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            words = text.encode().translate(_TERM).split()
            if not words:
                continue
            n, df = groups.setdefault((lang, source), (Counter(), Counter()))
            held -= len(n)
            n.update(words)
            df.update(set(words))
            held += len(n)
            if held > most:
                yield from flush()
                groups, held = {}, 0
    yield from flush()


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def term_vectors(docs: DataFrame) -> DataFrame:
    """(lang, term, n, cells): each kept term's count, and its counts by source in the order of sources."""
    most = HELD
    counted = _read(docs).mapInArrow(lambda batches: _count(batches, most), "lang string, source string, term string, n long, df long")
    # one shuffle by term serves both aggregations; tasks have summed up their own texts
    by_source = (
        counted.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    )
    vectors = by_source.groupBy("lang", "term").agg(
        F.sum("df").alias("df"),
        F.sum("n").alias("n"),
        F.sort_array(F.collect_list(F.struct("source", "n"))).alias("cells"),
    )
    return stored(vectors.where(F.col("df") >= MIN_DOCS).drop("df"), "term_vectors")


def groups_of(docs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(lang, source, total, v, lang_total, tiles) of every group, with or without terms."""
    totals = (
        vectors.select("lang", F.explode("cells").alias("c"))
        .groupBy("lang", F.col("c.source").alias("source"))
        .agg(F.sum("c.n").alias("total"))
    )
    langs = vectors.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_total"))
    every = _read(docs).groupBy("lang", "source").agg(F.lit(True).alias("there")).drop("there")
    tiles = every.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    zero = F.lit(0).cast("long")
    out = every.join(tiles, "lang").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    return stored(out.withColumns({c: F.coalesce(c, zero) for c in ("total", "v", "lang_total")}), "groups")


# ---- run-length columns ---------------------------------------------------------


def runs_of(dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal values start, and their values."""
    starts = np.flatnonzero(np.concatenate([[True], dense[1:] != dense[:-1]]))
    return starts, dense[starts]


_RUNS = "lang string, block long, source string, n_terms int, starts array<int>, counts array<long>"


def _encode(batches: Iterator[pa.RecordBatch], most_terms: int, most_cells: int) -> Iterator[pa.RecordBatch]:
    """The sorted vocabulary of a task as blocks of run-length columns, one row per source that a block counts."""
    block = TaskContext.get().partitionId() << 32
    lang, terms, cells, held = None, 0, [], 0

    def done() -> pa.RecordBatch:
        at, names, n = (np.concatenate(x) for x in zip(*cells))
        sources, of = np.unique(names, return_inverse=True)
        order = np.argsort(of, kind="stable")
        edges = np.searchsorted(of[order], np.arange(len(sources) + 1))
        starts, counts = [], []
        for a, b in zip(edges[:-1], edges[1:]):
            dense = np.zeros(terms, np.int64)
            dense[at[order[a:b]]] = n[order[a:b]]
            s, c = runs_of(dense)
            starts.append(s.astype(np.int32))
            counts.append(c)
        k = len(sources)
        columns = [
            pa.array([lang] * k, pa.string()),
            pa.array([block] * k, pa.int64()),
            pa.array(list(sources), pa.string()),
            pa.array([terms] * k, pa.int32()),
            pa.array(starts, pa.list_(pa.int32())),
            pa.array(counts, pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "block", "source", "n_terms", "starts", "counts"])

    for batch in batches:
        langs = batch.column("lang").to_numpy(zero_copy_only=False)
        lists = batch.column("cells")
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        names = flat.field("source").to_numpy(zero_copy_only=False)
        n = flat.field("n").to_numpy(zero_copy_only=False)
        first = np.concatenate([[0], np.cumsum(sizes)])
        row = 0
        while row < len(langs):
            if langs[row] != lang or terms >= most_terms or held >= most_cells:
                if cells:
                    yield done()
                    block += 1
                lang, terms, cells, held = langs[row], 0, [], 0
            end = row + int(np.argmin(np.append(langs[row:] == lang, False)))
            end = min(end, row + most_terms - terms)
            end = max(row + 1, min(end, int(np.searchsorted(first, first[row] + most_cells - held))))
            a, b = first[row], first[end]
            cells.append((np.repeat(np.arange(terms, terms + end - row), sizes[row:end]), names[a:b], n[a:b]))
            terms, held, row = terms + end - row, held + int(b - a), end
    if cells:
        yield done()


def run_columns(vectors: DataFrame) -> DataFrame:
    """(lang, block, source, n_terms, starts, counts): the reordered vocabulary's run-length columns."""
    # equal rows of counts may be split between tasks, so the range keys end with the term
    keys = ["lang", F.slice("cells", 1, 4), F.xxhash64("cells"), F.xxhash64("term")]
    ordered = vectors.repartitionByRange(*keys).sortWithinPartitions("lang", "cells")
    most_terms, most_cells = BLOCK_TERMS, BLOCK_CELLS
    blocks = ordered.select("lang", "cells").mapInArrow(lambda rows: _encode(rows, most_terms, most_cells), _RUNS)
    return stored(blocks, "runs")


# ---- pairs -----------------------------------------------------------------------


def probability(count: int, total: int, v: int) -> int:
    return 1 + 1_000_000_000 * (count + 2) // (total + 2 * v)


def _values(counts: np.ndarray, total: int, v: int) -> np.ndarray:
    """p of each count, on unbounded integers."""
    seen, at = np.unique(counts, return_inverse=True)
    return np.array([probability(c, total, v) for c in seen.tolist()], np.int64)[at]


def divergence(a: tuple, b: tuple, n_terms: int) -> int:
    """Sum of f over the terms of a block, of two columns (starts of runs, their p)."""
    starts = np.union1d(a[0], b[0])
    p = a[1][np.searchsorted(a[0], starts, "right") - 1]
    q = b[1][np.searchsorted(b[0], starts, "right") - 1]
    return int(((p - q) ** 2 // (p + q) * np.diff(np.append(starts, n_terms))).sum())


def _pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """The pairs of two tiles of one block."""
    lang, n_terms = rows["lang"].iloc[0], int(rows["n_terms"].iloc[0])
    i, j = int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
    rows = rows.sort_values("source")
    columns = []
    for tile, source, total, v, starts, counts in zip(*(rows[c] for c in ("tile", "source", "total", "v", "starts", "counts"))):
        if n_terms:
            absent = starts is None
            starts = np.zeros(1, np.int64) if absent else np.asarray(starts, np.int64)
            counts = np.zeros(1, np.int64) if absent else np.asarray(counts, np.int64)
            columns.append((tile, source, (starts, _values(counts, total, v))))
        else:
            columns.append((tile, source, None))
    out = []
    for x, (s, name, own) in enumerate(columns):
        if s != i:
            continue
        for t, other, theirs in columns[x + 1 :] if i == j else columns:
            if t == j:
                out.append((lang, name, other, divergence(own, theirs, n_terms) if n_terms else 0))
    return pd.DataFrame(out, columns=["lang", "a", "b", "value"])


def pair_values(groups: DataFrame, runs: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language."""
    # a block of no terms per language, so that languages without kept terms have their pairs too
    none = groups.select("lang", F.lit(-1).cast("long").alias("block"), F.lit(0).alias("n_terms")).distinct()
    blocks = runs.select("lang", "block", "n_terms").distinct().unionByName(none)
    tiled = groups.withColumn("tile", F.pmod(F.xxhash64("source"), "tiles").cast("int"))
    columns = blocks.join(tiled, "lang").join(runs.drop("n_terms"), ["lang", "block", "source"], "left")
    met = columns.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumns(
        {"i": F.least("tile", "other"), "j": F.greatest("tile", "other")}
    )
    found = (
        met.groupBy("lang", "block", "i", "j")
        .applyInPandas(_pairs, "lang string, a string, b string, value long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
    )
    ends = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return found.select("lang", F.explode(ends).alias("e"), "value").select("lang", "e.*", "value")


# ---- terms -----------------------------------------------------------------------


def _p(count: str, total: str) -> Column:
    return F.expr(f"1 + (1000000000BD * CAST({count} + 2 AS DECIMAL(20, 0))) div CAST({total} + 2 * v AS DECIMAL(20, 0))")


def term_values(groups: DataFrame, vectors: DataFrame) -> DataFrame:
    """(lang, source, item, value) of the terms that a group has more of than its language."""
    listed = groups.select("lang", "source", "total", "v", "lang_total")
    if listed.count() <= BROADCAST_GROUPS:
        listed = F.broadcast(listed)
    each = vectors.select("lang", "term", F.col("n").alias("lang_n"), F.explode("cells").alias("c"))
    each = each.select("lang", "term", "lang_n", "c.source", "c.n").join(listed, ["lang", "source"])
    both = each.withColumns({"p": _p("n", "total"), "q": _p("lang_n", "lang_total")}).where("p > q")
    return both.select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(best).alias("rank"))


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of sources, and each group's most telling terms."""
    vectors = term_vectors(docs)
    groups = groups_of(docs, vectors)
    pairs = _ranked(pair_values(groups, run_columns(vectors)), "pair")
    terms = _ranked(term_values(groups, vectors), "term").where(F.col("rank") <= TOP)
    return pairs.unionByName(terms)
