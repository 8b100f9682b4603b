from __future__ import annotations

import hashlib
from collections import defaultdict

from chatlake.llm import exact_dedup as D
from tests.llm.fixtures import TEXTS, documents


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def test_awkward_rows_match_brute_force(spark):
    out = D.exact_dedup(documents(spark)).collect()
    expected = brute(TEXTS)
    by_digest = {hashlib.sha256(t.encode()).digest(): v for t, v in expected.items()}
    assert len(out) == len(TEXTS)
    for r in out:
        assert (r.keep_id, r.group_size) == by_digest[bytes(r.digest)]
    assert sum(r.kept for r in out) == len(expected)
    assert all(r.doc_id == r.keep_id for r in out if r.kept)


def test_later_batches_meet_the_index(spark):
    index = D.create_index(spark, buckets=4)
    first = documents(spark, [(1, "a"), (2, "b")])
    D.exact_dedup(first, index, "b1")
    second = documents(spark, [(9, "a"), (3, "c"), (4, "c")])
    out = {r.doc_id: (r.keep_id, r.kept) for r in D.exact_dedup(second, index, "b2").collect()}
    assert out == {9: (1, False), 3: (4, False), 4: (4, True)}
    again = {r.doc_id: (r.keep_id, r.kept) for r in D.exact_dedup(second, index, "b2").collect()}
    assert again == out and spark.table(index).count() == 3


def test_batch_that_runs_again_in_another_order_keeps_the_same_texts(spark):
    index = D.create_index(spark, buckets=4)
    rows = [(i % 70, f"t{i % 50}") for i in range(300)] + [(5, "five")] * 3 + [(None, "none"), (None, "none")]
    docs = documents(spark, rows)

    def run(dealt):
        out = D.exact_dedup(dealt, index, "b").collect()
        return sorted((r.doc_id is None, r.doc_id or 0, bytes(r.digest), r.keep_id or 0, r.group_size, r.kept) for r in out)

    first = run(docs.repartition(8, "text"))
    assert sum(x[-1] for x in first) == 52
    assert run(docs.repartition(3)) == first == run(docs.orderBy("n_chars", "text").coalesce(1))
    assert spark.table(index).count() == 52


def test_small_batch_does_not_broadcast_the_index(spark):
    index = D.create_index(spark, buckets=4)
    D.exact_dedup(documents(spark, [(i, f"t{i}") for i in range(2000)]), index, "b1")
    docs = documents(spark, [(5000, "t7"), (5001, "new"), (5002, "new"), (5003, "new"), (5004, "t7")])
    rows = D.digests(docs)
    groups = D.groups_of(rows)
    D.add_batch(spark, groups, index, "b2")
    known = spark.table(index).select("digest", "keep_id")
    plan = groups.join(known.hint("merge"), "digest")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    out = {r.doc_id: (r.keep_id, r.kept, r.group_size) for r in D.resolve(spark, [(rows, groups, "b2")], index).collect()}
    assert out == {5000: (7, False, 2), 5004: (7, False, 2), 5001: (5003, False, 3), 5002: (5003, False, 3), 5003: (5003, True, 3)}


def test_text_that_is_hot_in_a_later_batch_only(spark):
    index = D.create_index(spark, buckets=4)
    D.exact_dedup(documents(spark, [(1, "hot"), (2, "b")]), index, "b1")
    later = documents(spark, [(10 + i, "hot") for i in range(2000)] + [(9000 + i, f"c{i}") for i in range(1500)])
    out = D.exact_dedup(later, index, "b2")
    assert out.where("kept").count() == 1500 and out.where("keep_id = 1 AND group_size = 2000").count() == 2000


def test_many_batches_equal_one(spark):
    rows = [(i, f"t{i * 7 % 40}") for i in range(200)]
    index = D.create_index(spark, buckets=4)
    for at in range(150, -1, -50):  # larger ids first
        D.exact_dedup(documents(spark, rows[at : at + 50]), index, f"b{at}")
    stays = {bytes(r.digest): r.keep_id for r in spark.table(index).collect()}
    assert stays == {bytes(r.digest): r.keep_id for r in D.exact_dedup(documents(spark, rows)).collect()}
    both = D.larger_ids_first(documents(spark, TEXTS)).select("doc_id", "digest", "keep_id", "group_size")
    alone = D.exact_dedup(documents(spark, TEXTS)).select("doc_id", "digest", "keep_id", "group_size")
    assert sorted(map(str, both.collect())) == sorted(map(str, alone.collect()))
    assert D.larger_ids_first(documents(spark, [])).count() == 0


def test_index_is_bucketed_and_joined_without_moving_it(spark):
    index = D.create_index(spark, buckets=4)
    groups = D.groups_of(D.digests(documents(spark)))
    D.add_batch(spark, groups, index, "b")
    plan = groups.join(spark.table(index).select("digest").hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in text and "SortMergeJoin" in text


def test_no_python_on_the_way(spark):
    index = D.create_index(spark, buckets=4)
    rows = D.digests(documents(spark))
    groups = D.groups_of(rows)
    D.add_batch(spark, groups, index, "b")
    plan = D.resolve(spark, [(rows, groups, "b")], index)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExternalRDD"))


def test_keeps_all_columns_and_one_row_of_each_text(spark):
    docs = documents(spark)
    out = D.drop_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted((r.text or "" for r in out.collect())) == sorted(brute(TEXTS))


def test_empty_table(spark):
    assert D.exact_dedup(documents(spark, [])).count() == 0
    assert D.drop_duplicates(documents(spark, [])).count() == 0


def test_hot_text_is_joined_like_any_other(spark):
    rows = [(i, "same") for i in range(3000)] + [(5000 + i, f"t{i}") for i in range(3000)]
    out = D.exact_dedup(documents(spark, rows))
    assert out.where("kept").count() == 3001
    assert out.where("group_size = 3000 AND keep_id = 2999").count() == 3000
