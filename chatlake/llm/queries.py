"""Registered queries of the operators (whole tables, production parameters) and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from chatlake.llm import exact_dedup as dedup
from chatlake.llm import (
    bpe,
    filter_audit,
    html_extract,
    ngram_join,
    packing,
    pitman_yor,
    quality_rules,
    quote_threads,
    sharding,
    source_divergence,
    toxicity,
    warc,
)
from chatlake.llm.common import ship, stored, table


def op1_html_extract(spark, sf):
    pages = html_extract.extract(table(spark, sf, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "host", "path")


def op2_quality_rules(spark, sf):
    entries = quality_rules.ledger(table(spark, sf, "documents"))
    judged = quality_rules.apply_policy(entries, quality_rules.STANDARD)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.rejected(quality_rules.BASE).alias("base_failed"), "kept", "fail_bits", "policy",
    )


def quality_ablations(spark, sf):
    """What each rule of both policies is responsible for, all from one stored ledger."""
    entries = stored(quality_rules.ledger(table(spark, sf, "documents")), "quality_ledger")
    standard, base = (quality_rules.ablations(entries, p) for p in (quality_rules.STANDARD, quality_rules.BASE))
    return standard.unionByName(base)


def op3_byte_bpe(spark, sf):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    vocabulary = bpe.Vocabulary(spark, path, public_tokenizers.PATTERN)
    digests = vocabulary.digests(F.col("text").cast("string"))
    return table(spark, sf, "documents").select("doc_id", digests.alias("d")).select("doc_id", "d.*")


def op4_exact_dedup(spark, sf):
    return dedup.larger_ids_first(table(spark, sf, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op5_warc(spark, sf):
    back = warc.roundtrip(table(spark, sf, "pages"))
    ids = {c: F.col(c).cast("long") for c in ("page_id", "refers_to")}
    return back.withColumns(ids)


def op6_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"))


def op7_ngram_join(spark, sf):
    return ngram_join.classes(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf, "labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_quote_threads(spark, sf):
    return quote_threads.reply_order(table(spark, sf, "conversations"))


def op10_sharding(spark, sf):
    return sharding.shard(table(spark, sf, "documents")).drop("group_key")


def op11_pitman_yor(spark, sf):
    return pitman_yor.score(table(spark, sf, "documents"))


def op12_source_divergence(spark, sf):
    return source_divergence.audit(table(spark, sf, "documents"))


def op13_filter_audit(spark, sf):
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


def _shipped(query):
    def run(spark, sf):
        ship(spark)
        return query(spark, sf)

    return run


QUERIES = {
    query.__name__: _shipped(query)
    for query in (
        op1_html_extract,
        op2_quality_rules,
        quality_ablations,
        op3_byte_bpe,
        op4_exact_dedup,
        op5_warc,
        op6_packing,
        op7_ngram_join,
        op8_toxicity,
        op9_quote_threads,
        op10_sharding,
        op11_pitman_yor,
        op12_source_divergence,
        op13_filter_audit,
    )
}

#: The ledger, as ``b``.
_LEDGER_SQL = r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
        lines AS (
          SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
        windows AS (
          SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n
          FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
        repeats AS (
          SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
          FROM windows, (VALUES (0), (1), (2)) AS v(k) WHERE n > 1 GROUP BY doc_id),
        m AS (
          SELECT w.doc_id, len(ws) AS n_words,
            length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
            length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
            coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
            coalesce(n_lines, 0) AS n_lines,
            length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
            length(t) - length(regexp_replace(t, '[a-z]', '', 'g')) AS n_lower
          FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
        b AS (
          SELECT *, (n_words < 50)::BIGINT
            + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
            + 4 * (100 * n_symbols > 12 * n_words)::BIGINT
            + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT
            + 16 * (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words))::BIGINT
            + 32 * (100 * n_upper > 50 * (n_upper + n_lower))::BIGINT AS fail_bits
          FROM m)"""

ORACLE_SQL = {
    "op2_quality_rules": _LEDGER_SQL
    + """
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
          fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits, 'standard-1' AS policy
        FROM b
    """,
    "quality_ablations": _LEDGER_SQL
    + """,
        rules(rule, bit) AS (VALUES ('too_few_words', 1), ('repeated_windows', 2), ('symbols', 4),
          ('repeated_lines', 8), ('word_length', 16), ('shouting', 32)),
        policies(policy, mask) AS (VALUES ('standard-1', 63), ('base-1', 3))
        SELECT policy, rule, count(*) FILTER (fail_bits & bit <> 0) AS n_failed,
          count(*) FILTER (fail_bits & mask = bit) AS n_failed_alone,
          count(*) FILTER (fail_bits & mask & ~bit = 0) AS n_kept_without
        FROM b, rules, policies WHERE mask & bit <> 0 GROUP BY policy, rule
    """,
    "op4_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op9_quote_threads": r"""
        WITH RECURSIVE m AS (
          SELECT row_number() OVER () AS mid, coalesce(conv_id::VARCHAR, chr(1)) AS conv, conv_id, turn::BIGINT AS turn,
            coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
          FROM conversations),
        raw AS (
          SELECT mid, conv, turn, generate_subscripts(ls, 1) AS pos, unnest(ls) AS line
          FROM (SELECT mid, conv, turn, string_split(text, chr(10)) AS ls FROM m
                WHERE regexp_matches(text, '(?m)^[ \t]*>'))),
        levels AS (
          SELECT *, length(regexp_replace(regexp_extract(line, '^((?:[ \t]*>)*)', 1), '[^>]', '', 'g')) AS level,
            regexp_replace(line, '^(?:[ \t]*>)*[ \t]*', '') AS content
          FROM raw),
        turns_of_level AS (
          SELECT *, (level <> lag(level, 1, -1) OVER w)::INT AS new, lead(level, 1, 0) OVER w AS next_level
          FROM levels WINDOW w AS (PARTITION BY mid ORDER BY pos)),
        lines AS (
          SELECT *, sum(new) OVER (PARTITION BY mid ORDER BY pos) AS run,
            level = 0 AND next_level > 0 AND regexp_matches(
              line, '(?i)(wrote|writes|said|schrieb|escribió|a écrit)[ \t]*:[ \t]*$') AS attribution
          FROM turns_of_level),
        passages AS (
          SELECT mid, conv, turn, level, string_agg(content, ' ' ORDER BY pos) AS passage
          FROM lines WHERE level > 0 GROUP BY mid, conv, turn, level, run
          UNION ALL SELECT mid, conv, turn, level, content FROM lines WHERE level > 0),
        q AS (
          SELECT DISTINCT mid, conv, turn, level, trim(regexp_replace(lower(passage), '[^\p{L}\p{N}]+', ' ', 'g')) AS key
          FROM passages WHERE turn IS NOT NULL),
        own AS (
          SELECT mid, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (level = 0 AND NOT attribution), '') AS rest,
            count(*) FILTER (level > 0) AS n_quoted_lines
          FROM lines GROUP BY mid),
        b AS (
          SELECT m.mid, conv, conv_id, turn, role, coalesce(n_quoted_lines, 0) AS n_quoted_lines,
            regexp_replace(CASE WHEN own.mid IS NULL THEN text ELSE rest END,
              '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g') AS content
          FROM m LEFT JOIN own ON m.mid = own.mid),
        parts AS (
          SELECT conv, turn, mid, content AS part FROM b WHERE conv IN (SELECT conv FROM q)
          UNION ALL SELECT conv, turn, mid, unnest(string_split(content, chr(10))) FROM b WHERE conv IN (SELECT conv FROM q)
          UNION ALL SELECT conv, turn, mid, unnest(regexp_split_to_array(content, '\n[ \t]*\n')) FROM b
          WHERE conv IN (SELECT conv FROM q)),
        o AS (
          SELECT DISTINCT conv, turn, mid, trim(regexp_replace(lower(part), '[^\p{L}\p{N}]+', ' ', 'g')) AS key FROM parts),
        links AS (
          SELECT q.mid, arg_max({'mid': o.mid, 'turn': o.turn},
            {'near': -level, 'chars': length(q.key), 'turn': o.turn, 'mid': o.mid}) AS p
          FROM q JOIN o ON q.conv = o.conv AND q.key = o.key AND o.turn < q.turn WHERE q.key <> '' GROUP BY q.mid),
        up AS (
          SELECT mid, p.mid AS root, p.turn AS root_turn, 1 AS depth FROM links
          UNION ALL SELECT up.mid, l.p.mid, l.p.turn, depth + 1 FROM up JOIN links l ON l.mid = up.root),
        tops AS (SELECT mid, arg_max(root_turn, depth) AS root_turn, max(depth) AS depth FROM up GROUP BY mid),
        placed AS (
          SELECT b.*, CASE WHEN tops.mid IS NULL THEN b.turn ELSE tops.root_turn END AS thread_turn,
            links.p.turn AS reply_to_turn, coalesce(tops.depth, 0)::BIGINT AS depth
          FROM b LEFT JOIN tops ON b.mid = tops.mid LEFT JOIN links ON b.mid = links.mid)
        SELECT conv_id, turn, role,
          row_number() OVER (PARTITION BY conv ORDER BY thread_turn NULLS FIRST, turn NULLS FIRST, role, md5(content), mid) - 1
            AS position,
          thread_turn, reply_to_turn, depth, n_quoted_lines, content,
          '<|im_start|>' || role || chr(10)
            || regexp_replace(content, '<\|(im_start|im_end)\|>', '<| \1 |>', 'g') || '<|im_end|>' || chr(10) AS formatted
        FROM placed
    """,
    "op12_source_divergence": r"""
        WITH d AS (
          SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
          FROM documents),
        w AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 10),
        c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
        l AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL),
        size AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM l GROUP BY lang),
        g AS (
          SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
          FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
        p AS (
          SELECT lang, source, term, coalesce(c.n, 0) AS n,
            1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * v) AS p
          FROM g JOIN size USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
        q AS (
          SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS q FROM l JOIN size USING (lang)),
        each AS (
          SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(x.value, 0) AS value
          FROM g JOIN g o ON g.lang = o.lang AND g.source <> o.source
          LEFT JOIN (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) x
          ON x.lang = g.lang AND x.source = g.source AND x.item = o.source
          UNION ALL
          SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q)
          FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM each)
        SELECT lang, source, part, item, value::BIGINT AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
    """,
    "op13_filter_audit": r"""
        WITH d AS (
          SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
            min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
          FROM documents),
        l AS (
          SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
        m AS (
          SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
            CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END
            || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
            || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) THEN 'C' ELSE '' END
            || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
            || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS failed
          FROM d LEFT JOIN l USING (doc_id)),
        cells AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
        f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
          SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
          WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
        hit AS (
          SELECT part, filter_order, step, n, good, toxic, failed, filter_order[step] AS x,
            contains(failed, filter_order[step]) AS fails,
            failed <> '' AND regexp_matches(failed, '[' || left(filter_order, step - 1) || '0]') AS gone,
            regexp_matches(failed, '[' || left(filter_order, step) || ']') AS gone_after
          FROM cells, steps),
        s AS (
          SELECT part, filter_order, step, x,
            coalesce(sum(n) FILTER (NOT gone_after), 0) AS kept,
            coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed,
            coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant,
            coalesce(sum(n) FILTER (failed = x), 0) AS unique_fails,
            coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS good_lost,
            coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS toxic_lost
          FROM hit GROUP BY ALL)
        SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
          redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
          toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
        FROM s
    """,
}
