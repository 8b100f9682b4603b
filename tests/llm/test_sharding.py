from __future__ import annotations

import random
import zlib
from collections import defaultdict

from chatlake.llm import sharding as S
from tests.llm.fixtures import TEXTS, documents


def test_schedule_is_longest_first_to_the_least_loaded():
    rng = random.Random(1)
    sizes = [(rng.randrange(1, 50), f"k{i}") for i in range(200)]
    loads, expected = [0] * 7, {}
    for size, key in sorted(sizes, key=lambda x: (-x[0], x[1])):
        s = loads.index(min(loads))
        loads[s] += size
        expected[key] = s
    assert S.schedule(sizes, 7) == expected


def check(rows, out, shards=16):
    assert sorted((r.doc_id is not None, r.doc_id, r.size, r.text_crc32) for r in out) == sorted(
        (i is not None, i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots, homes = defaultdict(list), defaultdict(set)
    for r in out:
        slots[r.shard].append(r.slot)
        homes[r.group_key].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in homes.values()) and set(slots) <= set(range(shards))


def test_awkward_rows(spark):
    rows = [r for r in TEXTS if r[0] is not None]
    check(rows, S.shard(documents(spark, rows)).collect())
    assert S.shard(documents(spark)).count() == len(TEXTS)


def test_sizes_are_near_equal_with_bundles_and_with_a_hot_text(spark):
    rng = random.Random(2)
    rows = [(i, "y" * rng.randrange(20, 60) + str(i)) for i in range(4000)]
    out = S.shard(documents(spark, rows), bundles=512, big_share=64).collect()
    check(rows, out)
    loads = defaultdict(int)
    for r in out:
        loads[r.shard] += r.size
    assert max(loads.values()) - min(loads.values()) < 0.03 * sum(loads.values()) / 16
    hot = rows + [(10_000 + i, "hot " * 10) for i in range(2000)]
    out = S.shard(documents(spark, hot), bundles=512, big_share=64).collect()
    check(hot, out)


def test_empty_table(spark):
    assert S.shard(documents(spark, [])).count() == 0
