from __future__ import annotations

import random
from collections import defaultdict

import pandas as pd

from chatlake.llm import packing as P
from tests.llm.fixtures import LONG, TEXTS, documents


def naive(rows, capacity):
    """Best-fit decreasing by looking at every bin."""
    bins = []  # [room, sources, clusters]
    placed = {}
    full = sum(n // capacity for _, _, _, n in rows)
    for doc, source, cluster, n in sorted(rows, key=lambda r: (-(r[3] % capacity), r[0])):
        rest = n % capacity
        if not rest:
            continue
        fits = [
            (room, b) for b, (room, s, c) in enumerate(bins)
            if room >= rest and not (source is not None and source in s) and cluster not in c
        ]
        if fits:
            b = min(fits)[1]
        else:
            b = len(bins)
            bins.append([capacity, set(), set()])
        bins[b][0] -= rest
        bins[b][1].add(source)
        bins[b][2].add(cluster)
        placed[doc] = b + full
    return placed


def test_group_is_packed_like_the_naive_search():
    rng = random.Random(6)
    for _ in range(20):
        rows = [
            (f"{i:03}", rng.choice(["a", "b", "c", "d", "e", None]), f"c{rng.randrange(25)}", rng.randrange(1, 260))
            for i in range(120)
        ]
        frame = pd.DataFrame(rows, columns=["doc_id", "source", "cluster", "length"]).assign(grp=0)
        out = P.pack_group(frame, 100)
        pieces = out[out["residual"].notna() & (out["length"] < 100)]
        got = {d: int(b.split("-")[1]) for d, b in zip(pieces["doc_id"], pieces["bin"])}
        assert got == naive(rows, 100)


def check(docs, out, capacity):
    bins, whole = defaultdict(list), defaultdict(int)
    for r in out:
        bins[r.bin].append(r)
        whole[r.doc_id, r.cluster] += r.length
    for pieces in bins.values():
        used = sum(r.length for r in pieces)
        assert used <= capacity and all(r.residual == capacity - used for r in pieces)
        sources = [r.source for r in pieces if r.source is not None]
        clusters = [r.cluster for r in pieces]
        assert len(set(sources)) == len(sources) and len(set(clusters)) == len(clusters)
        at = 0
        for slot, r in enumerate(sorted(pieces, key=lambda r: r.start)):
            assert (r.start, r.slot) == (at, slot)
            at += r.length
    return whole


def test_awkward_rows(spark):
    out = P.pack(documents(spark), capacity=4096).collect()
    whole = check(TEXTS, out, 4096)
    assert sum(whole.values()) == sum(len((t or "").encode()) + 1 for _, t in TEXTS)
    assert sum(r.doc_id == 6 for r in out) == 2 * -(-(len(LONG) + 1) // 4096)
    assert sum(r.doc_id is None for r in out) == 2


def test_hot_source_many_groups_and_empty_table(spark):
    rng = random.Random(7)
    rows = [(i, "z" * rng.randrange(1, 900) + str(i)) for i in range(1500)]
    out = P.pack(documents(spark, rows), capacity=1000, group_rows=200).collect()
    whole = check(rows, out, 1000)
    assert len(whole) == 1500 and len({r.bin.split("-")[0] for r in out}) > 3
    assert P.pack(documents(spark, [])).count() == 0
