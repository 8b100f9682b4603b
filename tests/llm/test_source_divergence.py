from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from chatlake.llm import source_divergence as S
from tests.llm.fixtures import TEXTS, documents

LOWER = {65 + i: 97 + i for i in range(26)}


def brute(rows, top=10):
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in held[lang].items() if n >= 10]
        mine = {s: {t: counts[lang, s][t] for t in kept} for x, s in groups if x == lang}
        whole = {t: sum(c[t] for c in mine.values()) for t in kept}

        def p(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        ps, q = {s: p(c) for s, c in mine.items()}, p(whole)

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in mine:
            pairs = [(o, sum(f(ps[s][t], ps[o][t]) for t in kept)) for o in mine if o != s]
            terms = [(t, f(ps[s][t], q[t])) for t in kept if mine[s][t] and ps[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, *x, i) for i, x in enumerate(found[:most], 1)}
    return out


def run(spark, rows):
    full = [(i, *r, "x", "y") for i, r in enumerate(rows)]
    docs = spark.createDataFrame(full, "doc_id long, lang string, source string, text string, term string, value string")
    got = [tuple(r) for r in S.audit(docs).collect()]
    assert len(got) == len(set(got))
    return set(got)


def texts(rng, n):
    words = ["the", "The", "été", "Éte", "zwölf", "Zug", "a-b", "x1y", "\U0001f600", "don't", "ÀB"]
    words += ["".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 4))) for _ in range(60)]
    for _ in range(n):
        source = rng.choice([None, "", "s1", "s2", "s3", "ß", "z"])
        mine = words[: 20 + len(source or "") * 25]
        yield rng.choice(["en", "de", None]), source, rng.choice([" ", "\n", ", "]).join(rng.choice(mine) for _ in range(rng.randrange(60)))


def test_matches_brute_force(spark):
    rng = random.Random(8)
    rows = list(texts(rng, 400)) + [("fr", "a", "rare"), ("fr", "b", None), ("fr", "c", "1 2 3"), ("it", "one", "ciao")]
    assert run(spark, rows) == brute(rows)


def test_small_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_TERMS", 7)
    monkeypatch.setattr(S, "BLOCK_CELLS", 11)
    monkeypatch.setattr(S, "TILE", 2)
    monkeypatch.setattr(S, "BROADCAST_GROUPS", 0)
    monkeypatch.setattr(S, "HELD", 5)
    rows = list(texts(random.Random(9), 300))
    assert run(spark, rows) == brute(rows)


def test_runs_give_what_terms_give():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n = int(rng.integers(1, 60))
        a, b = (np.repeat(rng.integers(1, 4, n), rng.integers(1, 4, n))[:n] * 10**8 for _ in range(2))
        whole = int(((a - b) ** 2 // (a + b)).sum())
        assert S.divergence(S.runs_of(a), S.runs_of(b), n) == whole


def test_counts_beyond_64_bits():
    n = 10**15
    assert S._values(np.array([n, 0]), n, 5).tolist() == [1 + 10**9 * (n + 2) // (n + 10), 1 + 2 * 10**9 // (n + 10)]


def test_awkward_rows(spark):
    docs = documents(spark)
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    assert {tuple(r) for r in S.audit(docs).collect()} == brute(rows)
    assert S.audit(documents(spark, TEXTS[:0])).count() == 0
