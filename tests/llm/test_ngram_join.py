from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatlake.llm import ngram_join as J
from chatlake.llm.common import table
from chatlake.llm.shingles import set_id, shingle_set, word_hashes
from tests.llm.fixtures import TEXTS, documents, prose


def sets(text, k):
    words = (text or "").translate({65 + i: 97 + i for i in range(26)}).encode().split()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute(rows, k, share):
    """{row: (shingles, smallest id of its component)} with (doc_id, row number) as ids."""
    num, den = share
    found = [sets(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(found):
        n = Counter(j for x in s for j in holders[x])
        for x in s:
            holders[x].append(i)
        for j, c in n.items():
            if den * c >= num * (len(s) + len(found[j]) - c):
                parent[root(i)] = root(j)
    low = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        if d is not None and (low[root(i)] is None or d < low[root(i)]):
            low[root(i)] = d
    return sorted(str((d, len(s), low[root(i)])) for i, ((d, _), s) in enumerate(zip(rows, found)))


def run(spark, rows, k, share):
    return sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in J.classes(documents(spark, rows), k, share).collect())


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10_000)}"
    return " ".join(words)


def near_copies(rng):
    """Chains, stars, shared passages, short texts and a dense group."""
    passage = prose(rng, 60, 5000)
    rows = [prose(rng, rng.randrange(1, 200), 5000) + " " + passage for _ in range(80)]
    for base in (prose(rng, 150, 5000), prose(rng, 40, 5000), prose(rng, 12, 5000)):
        rows += [edited(rng, base, rng.randrange(0, 6)) for _ in range(60)]
    chain = prose(rng, 200, 5000)
    for _ in range(20):
        chain = edited(rng, chain, 2)
        rows.append(chain)
    common = prose(rng, 300, 5000)
    deviant = edited(rng, common, 6)  # far from the rest, but these are near each other
    rows += [edited(rng, common, 1) for _ in range(30)] + [edited(rng, deviant, 1) for _ in range(8)]
    rows += [prose(rng, rng.randrange(1, 9), 6) for _ in range(150)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k, share", [(4, (85, 100)), (5, (80, 100)), (2, (1, 2))])
def test_matches_brute_force(spark, k, share):
    rows = near_copies(random.Random(k))
    assert run(spark, rows, k, share) == brute(rows, k, share)


def test_given_documents_match_brute_force(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in J.classes(docs).collect())
    assert got == brute(rows, 4, (85, 100))


def test_blocks_of_a_leader(spark, monkeypatch):
    monkeypatch.setattr(J, "SALTED", 5)
    monkeypatch.setattr(J, "BLOCK", 7)
    monkeypatch.setattr(J, "BROADCAST_ROWS", 0)
    rows = near_copies(random.Random(11))
    assert run(spark, rows, 4, (85, 100)) == brute(rows, 4, (85, 100))


def test_linked_sets_share_an_entry_or_have_one_leader():
    rng = np.random.default_rng(1)
    fragments = J.Fragments((85, 100))
    for n in [5, 7, 8, 13, 20, 50, 200, 900]:
        for _ in range(60):
            base = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
            most = 15 * 2 * len(base) // 185
            for added in range(0, most + 1, max(1, most // 4)):
                other = np.unique(np.concatenate([base, rng.integers(0, 2**64 - 1, added, dtype=np.uint64)]))
                common = len(np.intersect1d(base, other))
                if added and 100 * common >= 85 * (len(base) + len(other) - common):
                    assert np.intersect1d(fragments.entries(base), fragments.entries(other)).size


@pytest.mark.parametrize("share", [(85, 100), (80, 100), (9, 10)])
def test_linked_sets_share_more_entries_than_both_may_leave(share):
    rng = np.random.default_rng(3)
    fragments = J.Fragments(share)
    num, den = share
    left = 0
    for n in [20, 60, 200, 900]:
        for _ in range(30):
            base = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
            gone = rng.integers(0, (den - num) * n // (den + num) + 1)
            other = np.unique(np.concatenate([base[gone:], rng.integers(0, 2**64 - 1, gone, dtype=np.uint64)]))
            common = len(np.intersect1d(base, other))
            if den * common < num * (len(base) + len(other) - common):
                continue
            met = np.intersect1d(fragments.entries(base), fragments.entries(other)) % np.uint64(J.CLASSES)
            own, its = ({x % J.CLASSES: x // J.CLASSES for x in fragments.spares(s)} for s in (base, other))
            # the class of the larger set is the one in which the two must meet
            c = fragments.class_of(max(len(base), len(other)))
            assert (met == c).sum() > own.get(c, 0) + its.get(c, 0)
            left += own.get(c, 0) + its.get(c, 0)
    assert left


def test_sets_leave_leaders_of_few_common_buckets(spark):
    rng = random.Random(8)
    parts = [prose(rng, 100, 5000) for _ in range(6)]
    rows = [(i, prose(rng, 150, 5000) + " " + " ".join(rng.sample(parts, 2))) for i in range(120)]
    docs = documents(spark, rows)
    sets, buckets = J.sets_of(docs, 4, (85, 100)), J.buckets_of(docs, 4, (85, 100))
    all_met = J.leader_pairs(buckets, sets.withColumn("spares", F.array().cast("array<bigint>"))).count()
    assert J.leader_pairs(buckets, sets).count() < all_met / 2
    assert run(spark, rows, 4, (85, 100)) == brute(rows, 4, (85, 100))


def test_awkward_rows(spark):
    assert run(spark, TEXTS, 4, (85, 100)) == brute_with_empty_alone(TEXTS)
    assert J.classes(documents(spark, [])).count() == 0


def brute_with_empty_alone(rows):
    full = [(d, t) for d, t in rows if sets(t, 4)]
    return sorted(brute(full, 4, (85, 100)) + [str((d, 0, d)) for d, t in rows if not sets(t, 4)])


def test_keep_one(spark):
    docs = documents(spark)
    out = J.keep_one(docs)
    assert out.columns == docs.columns
    got = sorted(str((r.doc_id, len(r.text or ""))) for r in out.collect())
    expected = [(1, 27), (3, 0), (4, 0), (5, 4), (6, 240_000), (None, 0), (7, 5), (7, 27), (8, 31)]
    assert got == sorted(str((d, n if n != 31 else len(TEXTS[-1][1]))) for d, n in expected)
    assert J.keep_one(documents(spark, [])).count() == 0


def test_words_are_cut_at_ascii_white_space_only():
    assert len(word_hashes("a b\tc\nd\x0be\x0cf\rg\x1ch\x85i\xa0j")) == 7
    assert (shingle_set("A b C d", 4) == shingle_set("a B c D", 4)).all()
    assert set_id(shingle_set("É b c d", 4)) != set_id(shingle_set("é b c d", 4))
    assert len(shingle_set("a b", 4)) == 1 and not len(shingle_set(" \n", 4)) and not len(shingle_set(None, 4))


def test_pieces_of_a_long_text_do_not_matter(monkeypatch):
    from chatlake.llm import shingles

    text = " ".join(prose(random.Random(2), 2000).split()) + "\n" + "y" * 500 + " z"
    whole = word_hashes(text)
    monkeypatch.setattr(shingles, "PIECE", 64)
    assert (word_hashes(text) == whole).all()
