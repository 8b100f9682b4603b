"""Registered queries on a given scale factor: SQL where there is some, and the pipeline by hand."""

from __future__ import annotations

import hashlib
import zlib

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as E
import corpus_pipeline
from chatlake.llm import packing, quality_rules, queries, toxicity
from chatlake.llm.common import table
from tests.llm.test_ngram_join import sets
from tests.llm.test_packing import check
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")} == set(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries()) and set(queries.ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, sf_small, con, name):
    r = compare(spark, sf_small, name, queries.QUERIES[name], queries.ORACLE_SQL[name], con)
    assert r["status"] == "match", r


def test_token_query(spark, sf_small):
    from chatlake.llm.bpe import read_ranks

    ranks = dict(read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_small, "documents").collect()}
    for r in queries.op3_byte_bpe(spark, sf_small).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()


def test_toxicity_query(spark, sf_small):
    rows = queries.op8_toxicity(spark, sf_small).collect()
    assert len(rows) == table(spark, sf_small, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)


def test_pipeline_stages_by_hand(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    columns, kept = docs.columns, docs
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = {r.doc_id: r.text or "" for r in kept.collect()}, stage(spark, kept, sf_small).cache()
        assert kept.columns == columns
        after = {r.doc_id for r in kept.collect()}
        if name == "toxicity":
            model = toxicity.train(docs, table(spark, sf_small, "labels"))
            expected = {i for i, t in before.items() if model.scores([t])[0] < toxicity.THRESHOLD}
        elif name == "quality rules":
            entries = quality_rules.ledger(docs.where(docs.doc_id.isin(list(before))))
            expected = {r.doc_id for r in entries.collect() if not r.fail_bits & quality_rules.STANDARD.mask}
        elif name == "exact dedup":
            expected = set({t: i for i, t in sorted(before.items())}.values())
        else:
            found = {i: sets(t, 5) for i, t in before.items()}
            group = {i: i for i in found}
            for i in sorted(found):
                for j in sorted(found):
                    common = len(found[i] & found[j])
                    if j < i and 100 * common >= 80 * (len(found[i]) + len(found[j]) - common):
                        old, new = max(group[i], group[j]), min(group[i], group[j])
                        group = {k: new if g == old else g for k, g in group.items()}
            expected = {i for i, g in group.items() if g == i}
        assert after == expected, name
    out = corpus_pipeline.STAGES[-1][1](spark, kept, sf_small).collect()
    check([], out, packing.CAPACITY)
    whole = {}
    for r in out:
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
    assert whole == {i: len(rows[i].encode()) + 1 for i in after}
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf_small).collect()} == after


def test_pipeline_on_empty_documents(spark, sf_small):
    docs = table(spark, sf_small, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_small).columns == docs.columns and stage(spark, docs, sf_small).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).count() == 0
