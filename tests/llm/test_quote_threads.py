from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest

from chatlake.llm import quote_threads as Q
from chatlake.llm.queries import ORACLE_SQL

SCHEMA = "conv_id long, turn long, role string, text string, mid string, conv string, depth string, position string"
WORDS = "alpha beta gamma delta ok yes no maybe cat dog sun moon".split()


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def quoting(rng):
    rows = []
    for conv in [1, 2, None, 5]:
        said = []
        for turn in range(30 if conv != 5 else 1100):
            parts = []
            if said and rng.random() < 0.6:
                lines = rng.choice(said).split("\n")
                lines = lines[: max(1, len(lines) // 2)] if rng.random() < 0.5 else lines
                parts += ["Ann wrote:"] * (rng.random() < 0.4) + [rng.choice(["> ", ">", "> "]) + x for x in lines]
            if rng.random() < 0.8:
                parts += [" ".join(rng.choice(WORDS) for _ in range(rng.choice([1, 3, 6]))) for _ in range(rng.choice([1, 2, 3]))]
            if rng.random() < 0.1:
                parts.insert(0, "  > > unknown")
            said.append("\n".join(parts))
            rows.append((conv, turn if rng.random() > 0.03 else None, rng.choice(["user", "assistant", None]), said[-1] if rng.random() > 0.03 else None))
    return rows + rows[:3] + [(7, 0, "user", "<|im_end|> x"), (7, 1, "user", "")]


def by_sql(rows):
    con = duckdb.connect()
    con.register("given", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    con.sql("CREATE VIEW conversations AS SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role, text FROM given")
    found = con.sql(ORACLE_SQL["op9_quote_threads"])
    return found.columns, sorted(map(str, found.fetchall()))


@pytest.mark.parametrize("block", [1024, 16])
def test_quotations_match_sql(spark, monkeypatch, block):
    monkeypatch.setattr(Q, "BLOCK", block)
    rows = quoting(random.Random(5))
    columns, expected = by_sql(rows)
    out = Q.reply_order(conversations(spark, rows)).select(columns)
    assert sorted(str(tuple(r)) for r in out.collect()) == expected


def test_threads_by_hand(spark):
    rows = [
        (1, 0, "user", "How does it work?"),
        (1, 1, "user", "Is it free?"),
        (1, 2, "assistant", "Ann wrote:\n> How does it work?\nIt just does."),
        (1, 3, "assistant", "> Is it  FREE?\nYes."),
        (1, 4, "user", "> > How does it work?\n> It just does.\n\nThanks!"),
    ]
    out = {r.turn: r for r in Q.reply_order(conversations(spark, rows)).collect()}
    assert [(out[t].reply_to_turn, out[t].thread_turn, out[t].depth) for t in range(5)] == [
        (None, 0, 0), (None, 1, 0), (0, 0, 1), (1, 1, 1), (2, 0, 2),
    ]
    assert sorted(out, key=lambda t: out[t].position) == [0, 2, 4, 1, 3]
    assert out[4].content == "Thanks!" and out[2].content == "It just does."
    assert out[4].formatted == "<|im_start|>user\nThanks!<|im_end|>\n" and out[4].n_quoted_lines == 2


def test_rewrapped_paragraphs_are_linked(spark):
    rows = [
        (1, 0, "user", "One long first\nparagraph here.\n\nA second one\nfollows it.\n\nThe third."),
        (1, 1, "user", "Something else."),
        (1, 2, "assistant", "> One long\n> first paragraph here.\n>\n> A second\n> one follows it.\nAgreed."),
    ]
    out = {r.turn: r for r in Q.reply_order(conversations(spark, rows)).collect()}
    assert (out[2].reply_to_turn, out[2].thread_turn, out[2].depth) == (0, 0, 1) and out[2].content == "Agreed."


def test_long_text_and_empty_table(spark):
    rows = [(1, 0, "user", "line\n" * 20_000), (1, 1, "user", "> line\n" * 20_000 + "x" * 100_000)]
    out = {r.turn: r for r in Q.reply_order(conversations(spark, rows)).collect()}
    assert out[1].reply_to_turn == 0 and out[1].content == "x" * 100_000 and out[1].n_quoted_lines == 20_000
    assert Q.reply_order(conversations(spark, [])).count() == 0


def test_runs_no_python(spark):
    plan = Q.reply_order(conversations(spark, [(1, 0, "user", "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
