"""How filters interact, by a Gray-code walk over their subsets.

Every filter is evaluated once per text, whatever the others say; what a document
fails is a bit mask. Documents are counted per part and mask (a *cell*), so at most
32 cells of a part travel. All subsets of the filters are then visited
in Gray-code order, in which one filter at a time is switched on or off. Each cell
has a counter of the active filters that it fails: a cell whose counter
leaves 0 is taken from the running survivors, one whose counter comes back to 0 is
added again. The survivors after each of the 32 states are stored; what a filter
removes at any step of any order is the difference of two of them.

Filters (a document fails when): A under 50 words; B 100 * distinct words < 65 *
words; C 100 * ``[A-Z]`` characters > 5 * code points; D any ``[#$%&*|]``; E its
text is that of a row with a smaller doc_id anywhere in the table. Words are
maximal ``[^\\x20\\x09-\\x0D]+``, case-sensitive.

E needs the smallest doc_id of each text: digests are grouped (map-side first)
and rows meet their group by (digest, doc_id), so however many copies a text
has, no task gets them all.

Defined results: a null text counts as empty; a null source is the part ''. A
row with a null doc_id has no smaller doc_id, makes no other row fail E, and has
no label. Repeated rows of one doc_id count each and don't make each other fail E.
A document is good (toxic) if any row of the labels says so. Every part has all
120 orders with 5 steps. An empty table gives an empty result. Other columns are
not read; very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import stored, text_or_empty

FILTERS = "ABCDE"
STATES = 1 << len(FILTERS)
#: What is counted in a cell.
COUNTS = ["n", "good", "toxic"]

_WORDS = r"[^\x20\x09-\x0D]+"


def _bit(condition: Column, name: str) -> Column:
    return F.when(condition, F.lit(1 << FILTERS.index(name))).otherwise(F.lit(0))


def masked(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask) of every row, with the bits of A to D."""
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text_or_empty().alias("text"),
    )
    words = read.withColumn("words", F.regexp_extract_all("text", F.lit(_WORDS), F.lit(0)))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    mask = (
        _bit(n < 50, "A")
        + _bit(F.lit(100).cast("long") * distinct < F.lit(65).cast("long") * n, "B")
        + _bit(F.lit(100).cast("long") * capitals > F.lit(5).cast("long") * F.length("text"), "C")
        + _bit(F.col("text").rlike(r"[#$%&*|]"), "D")
    )
    digest = F.unhex(F.sha2("text", 256))
    return stored(words.select("doc_id", "part", digest.alias("digest"), mask.alias("mask")), "masked")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part that fail exactly the filters of ``mask``."""
    rows = masked(docs)
    first = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    first = first.withColumn("first", F.lit(True))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    return (
        rows.join(first, ["digest", "doc_id"], "left")
        .select("doc_id", "part", (F.col("mask") + _bit(copy, "E")).alias("mask"))
        .join(known, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"),
            F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("toxic"),
        )
    )


def walk(counts: np.ndarray) -> np.ndarray:
    """Survivors (parts, states, counts) of every subset of filters, from cells (parts, masks, counts)."""
    out = np.empty_like(counts)
    failing = np.zeros(STATES, np.int64)  # active filters that a cell fails
    alive, state = counts.sum(axis=1), 0
    out[:, 0] = alive
    masks = np.arange(STATES)
    for step in range(1, STATES):
        bit = step & -step  # the one filter in which Gray codes step - 1 and step differ
        state ^= bit
        hit = masks[masks & bit > 0]
        if state & bit:
            alive = alive - counts[:, hit[failing[hit] == 0]].sum(axis=1)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            alive = alive + counts[:, hit[failing[hit] == 0]].sum(axis=1)
        out[:, state] = alive
    return out


def steps() -> pd.DataFrame:
    """Each step of each order: its filter, the state before it and the state after it."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for i, f in enumerate(order):
            rows.append(("".join(FILTERS[j] for j in order), i + 1, f, before, before | 1 << f))
            before |= 1 << f
    return pd.DataFrame(rows, columns=["filter_order", "step", "filter", "before", "after"])


def shapley(alive: np.ndarray) -> np.ndarray:
    """(parts, filters): what each filter removes, summed over all orders, from survivors (parts, states)."""
    k = len(FILTERS)
    out = np.zeros((len(alive), k), np.int64)
    for f in range(k):
        for state in range(STATES):
            if not state >> f & 1:
                size = state.bit_count()
                orders = factorial(size) * factorial(k - 1 - size)
                out[:, f] += orders * (alive[:, state] - alive[:, state | 1 << f])
    return out


_AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def _report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    plan = steps()
    f, before, after = (plan[c].to_numpy() for c in ("filter", "before", "after"))
    for parts in batches:
        counts = np.zeros((len(parts), STATES, len(COUNTS)), np.int64)
        for i, found in enumerate(parts["cells"]):
            for c in found:
                counts[i, c["mask"]] = [c[x] for x in COUNTS]
        states = walk(counts)
        alive = states[:, :, 0]
        lost = states[:, before] - states[:, after]
        fails = np.stack([alive[:, 0] - alive[:, 1 << j] for j in range(len(FILTERS))], axis=1)
        alone = np.stack([alive[:, (STATES - 1) ^ 1 << j] - alive[:, -1] for j in range(len(FILTERS))], axis=1)
        value = shapley(alive)
        for i, part in enumerate(parts["part"]):
            yield pd.DataFrame(
                {
                    "part": part,
                    "filter_order": plan["filter_order"],
                    "step": plan["step"].astype("int32"),
                    "kept": alive[i, after],
                    "removed": lost[i, :, 0],
                    "redundant": fails[i, f] - lost[i, :, 0],
                    "unique_fails": alone[i, f],
                    "good_lost": lost[i, :, 1],
                    "toxic_lost": lost[i, :, 2],
                    "shapley": value[i, f],
                }
            )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order and step: what the step's filter removes and what it costs."""
    # a part has at most 32 cells
    parts = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))
    return parts.mapInPandas(_report, _AUDIT)
