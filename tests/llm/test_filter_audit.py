from __future__ import annotations

import random
import re
from itertools import permutations

from chatlake.llm import filter_audit as A
from tests.llm.fixtures import TEXTS, documents, prose


def failed(rows):
    """The filters that each (doc_id, text) fails."""
    out = []
    for i, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = "A" * (len(words) < 50)
        f += "B" * (100 * len(set(words)) < 65 * len(words))
        f += "C" * (100 * len(re.findall("[A-Z]", t)) > 5 * len(t))
        f += "D" * bool(re.search(r"[#$%&*|]", t))
        f += "E" * (i is not None and any(j is not None and j < i and (s or "") == t for j, s in rows))
        out.append(set(f))
    return out


def brute(rows, parts, good, toxic):
    """One filter after the other, on lists of documents."""
    out = {}
    fails = failed(rows)
    for part in set(parts):
        mine = [i for i, p in enumerate(parts) if p == part]
        lines, value = [], dict.fromkeys(A.FILTERS, 0)
        for order in permutations(A.FILTERS):
            alive = mine
            for step, f in enumerate(order, 1):
                gone = [i for i in alive if f in fails[i]]
                alive = [i for i in alive if f not in fails[i]]
                value[f] += len(gone)
                all_failing = sum(f in fails[i] for i in mine)
                unique = sum(fails[i] == {f} for i in mine)
                lost = (sum(rows[i][0] in good for i in gone), sum(rows[i][0] in toxic for i in gone))
                lines.append((("".join(order), step), f, (len(alive), len(gone), all_failing - len(gone), unique, *lost)))
        out |= {(part, *at): (*counts, value[f]) for at, f, counts in lines}
    return out


def run(spark, rows, parts, labels):
    full = [(i, t, p, "x", "y") for (i, t), p in zip(rows, parts)]
    docs = spark.createDataFrame(full, "doc_id long, text string, source string, part string, mask string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    columns = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in columns) for r in A.audit(docs, marks).collect()}


def test_matches_filtering_step_by_step(spark):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(30, 90), rng.choice([30, 3000]))) for i in range(120)]
    rows = [(i, t.upper() if i % 5 == 0 else t) for i, t in rows]
    rows = [(i, t + " a|b" if i % 4 == 0 else t) for i, t in rows]
    rows += [(200 + i, rows[rng.randrange(40)][1]) for i in range(60)]
    rows += [*TEXTS, (7, "short")]
    rng.shuffle(rows)
    parts = [rng.choice([None, "", "s1", "s2", "s3"]) for _ in rows]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 260, 2)] + [(None, 1, 1), (4, 1, 0), (4, 0, 1)]
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, x in labels if x == 1 and i is not None}
    got = run(spark, rows, parts, labels)
    assert got == brute(rows, [p or "" for p in parts], good, toxic)


def test_walk_visits_each_state_once():
    import numpy as np

    counts = np.random.default_rng(1).integers(0, 9, (3, A.STATES, 3))
    states = A.walk(counts)
    for s in range(A.STATES):
        alive = [m for m in range(A.STATES) if not m & s]
        assert (states[:, s] == counts[:, alive].sum(axis=1)).all()


def test_empty_table_and_one_text_everywhere(spark):
    assert A.audit(documents(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    got = run(spark, [(i, "same") for i in range(500)], ["a"] * 500, [])
    assert got["a", "ABCDE", 1][:2] == (0, 500) and got["a", "EABCD", 1][:2] == (1, 499)
