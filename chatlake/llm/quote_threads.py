"""Conversations in reply order, linked through their quotations (DataFrame functions only).

1. Every line's quote level is the number of ``>`` that lead it. Neighbouring lines
   of one level form a passage. A message's own text is what has level 0,
   without lines such as ``Ann wrote:`` right before a quotation.
2. Passages, their paragraphs (parted by lines that are empty after their signs) and
   their lines are normalised (lower case, letters and digits
   only) and hashed; so are the lines, paragraphs and whole own texts of the
   messages of conversations that hold a quotation.
3. A quotation is joined to the latest earlier message of its conversation that
   has the same hash. Of a message's links the one of the lowest level counts,
   then the longest passage, then the latest message: that is what it replies to.
4. Replies lead to the message that began the thread (pointer jumping, so the
   number of rounds grows with the logarithm of the depth). A conversation is
   ordered by thread and, in a thread, by turn, so that each reply comes after what
   it replies to, and every message is formatted without its quotations.

A conversation may hold any share of all rows: it is never gathered in one place.
"Latest earlier" is found per block of ``BLOCK`` turns and carried on between
blocks; positions are numbered per range of the sorted keys, then shifted by the
sizes of the ranges before.

Defined results: a null text counts as empty, a null role as ``unknown``. Rows
with a null conv_id form one conversation. A message with a null turn comes first
and is not linked. Messages of one turn keep an order by role and text; repeated
rows get positions of their own. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatlake.llm.common import stored

BLOCK = 1024
QUOTED = r"(?m)^[ \t]*>"
ATTRIBUTION = r"(?i)(wrote|writes|said|schrieb|escribió|a écrit)[ \t]*:[ \t]*$"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _messages(conversations: DataFrame) -> DataFrame:
    """(mid, conv, conv_id, turn, role, text); ``mid`` numbers the rows once for all."""
    return stored(
        conversations.select(
            F.monotonically_increasing_id().alias("mid"),
            F.coalesce(F.col("conv_id").cast("string"), F.lit("\x00")).alias("conv"),
            "conv_id",
            F.col("turn").cast("long").alias("turn"),
            F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ),
        "messages",
    )


def _lines(quoting: DataFrame) -> DataFrame:
    """(mid, conv, turn, pos, line, level, content, run, attribution) of messages with quotations."""
    signs = F.regexp_extract("line", r"^((?:[ \t]*>)*)", 1)
    order = Window.partitionBy("mid").orderBy("pos")
    lines = quoting.select("mid", "conv", "turn", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return (
        lines.withColumn("level", F.length(F.regexp_replace(signs, "[^>]", "")))
        .withColumn("content", F.regexp_replace("line", r"^(?:[ \t]*>)*[ \t]*", ""))
        .withColumn("new", (F.col("level") != F.lag("level", 1, -1).over(order)).cast("int"))
        .withColumn("run", F.sum("new").over(order))
        .withColumn("paragraph", F.sum(F.col("content").rlike(r"^\s*$").cast("int")).over(order))
        .withColumn(
            "attribution",
            (F.col("level") == 0) & F.col("line").rlike(ATTRIBUTION) & (F.lead("level", 1, 0).over(order) > 0),
        )
    )


def _quotations(lines: DataFrame) -> DataFrame:
    """(mid, conv, turn, level, key, chars) of passages, of their paragraphs and of their lines."""
    quoted = lines.where("level > 0")
    in_order = F.array_sort(F.collect_list(F.struct("pos", "content")))  # the lines of one message at most
    passage = F.array_join(in_order["content"], " ").alias("passage")
    passages = quoted.groupBy("mid", "conv", "turn", "level", "run").agg(passage)
    paragraphs = quoted.groupBy("mid", "conv", "turn", "level", "run", "paragraph").agg(passage)
    each = quoted.select("mid", "conv", "turn", "level", F.col("content").alias("passage"))
    text = normalised(F.col("passage"))
    return (
        passages.drop("run")
        .unionByName(paragraphs.drop("run", "paragraph"))
        .unionByName(each)
        .select("mid", "conv", "turn", "level", F.md5(text).alias("key"), F.length(text).alias("chars"))
        .where("chars > 0 AND turn IS NOT NULL")
        .distinct()
    )


def _bodies(messages: DataFrame, lines: DataFrame) -> DataFrame:
    """``messages`` with their own text (``content``) and the number of quoted lines."""
    own = lines.where("level = 0 AND NOT attribution")
    in_order = F.array_sort(F.collect_list(F.struct("pos", "line")))
    texts = own.groupBy("mid").agg(F.array_join(in_order["line"], "\n").alias("rest"))
    counts = lines.groupBy("mid").agg(F.sum((F.col("level") > 0).cast("long")).alias("n_quoted_lines"))
    quoting = counts.join(texts, "mid", "left")
    return messages.join(quoting, "mid", "left").withColumns(
        {
            "content": F.regexp_replace(
                F.when(F.col("n_quoted_lines").isNull(), F.col("text")).otherwise(F.coalesce("rest", F.lit(""))),
                r"^[ \t\r\n]+|[ \t\r\n]+$",
                "",
            ),
            "n_quoted_lines": F.coalesce("n_quoted_lines", F.lit(0)).cast("long"),
        }
    ).drop("rest")


def _originals(bodies: DataFrame, quotations: DataFrame) -> DataFrame:
    """(conv, key, turn, mid) of the lines, paragraphs and whole texts that may have been quoted."""
    convs = quotations.select("conv").distinct()
    near = bodies.where("turn IS NOT NULL").join(convs, "conv", "left_semi")
    parts = F.concat(F.array("content"), F.split("content", "\n"), F.split("content", r"\n[ \t]*\n"))
    text = normalised(F.col("part"))
    units = near.select("conv", "turn", "mid", F.explode(F.array_distinct(parts)).alias("part"))
    return (
        units.select("conv", "turn", "mid", F.md5(text).alias("key"), F.length(text).alias("chars"))
        .where("chars > 0")
        .groupBy("conv", "key", "turn")
        .agg(F.max("mid").alias("mid"))
    )


def _latest_before(quotations: DataFrame, originals: DataFrame) -> DataFrame:
    """``quotations`` with (o_turn, o_mid) of the latest original before them; those without one are left out."""
    found = F.struct(F.col("turn").alias("o_turn"), F.col("mid").alias("o_mid"))
    nothing = F.lit(None).cast("struct<o_turn:bigint,o_mid:bigint>")
    events = quotations.select("conv", "key", "turn", F.lit(0).alias("kind"), nothing.alias("o"), "mid", "level", "chars")
    events = events.unionByName(
        originals.select("conv", "key", "turn", F.lit(1).alias("kind"), found.alias("o")), allowMissingColumns=True
    ).withColumn("block", F.floor(F.col("turn") / BLOCK))
    here = Window.partitionBy("conv", "key", "block").orderBy("turn", "kind").rowsBetween(Window.unboundedPreceding, 0)
    ends = events.where("kind = 1").groupBy("conv", "key", "block").agg(F.max("o").alias("end"))
    asked = events.where("kind = 0").select("conv", "key", "block").distinct()
    before = Window.partitionBy("conv", "key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        asked.join(ends, ["conv", "key", "block"], "full_outer")
        .withColumn("carried", F.max("end").over(before))
        .select("conv", "key", "block", "carried")
    )
    near = events.withColumn("near", F.last("o", ignorenulls=True).over(here)).where("kind = 0")
    joined = near.join(carried, ["conv", "key", "block"])
    return joined.withColumn("o", F.coalesce("near", "carried")).where("o IS NOT NULL").select(
        "mid", "level", "chars", "o.o_turn", "o.o_mid"
    )


def replies(quotations: DataFrame, originals: DataFrame) -> DataFrame:
    """(mid, parent, parent_turn): what each quoting message replies to."""
    best = F.max(F.struct((-F.col("level")).alias("near"), "chars", "o_turn", "o_mid"))
    chosen = _latest_before(quotations, originals).groupBy("mid").agg(best.alias("b"))
    return stored(chosen.select("mid", F.col("b.o_mid").alias("parent"), F.col("b.o_turn").alias("parent_turn")), "replies")


def threads(links: DataFrame) -> DataFrame:
    """(mid, root, root_turn, depth) of every message that replies to another."""
    now = links.select("mid", F.col("parent").alias("root"), F.col("parent_turn").alias("root_turn"), F.lit(1).cast("long").alias("depth"))
    while True:
        up = now.select(
            F.col("mid").alias("root"), F.col("root").alias("next"), F.col("root_turn").alias("next_turn"), F.col("depth").alias("more")
        )
        joined = now.join(up, "root", "left")
        now = stored(
            joined.select(
                "mid",
                F.coalesce("next", "root").alias("root"),
                F.coalesce("next_turn", "root_turn").alias("root_turn"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "threads",
        )
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def _positions(keys: DataFrame) -> DataFrame:
    """(mid, position) by thread, turn, role, text hash and row, numbered from 0 per conversation."""
    order = ["root_turn", "turn", "role", "tie", "mid"]
    ranged = stored(keys.repartitionByRange("conv", *order).withColumn("range", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("conv", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("conv", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("conv", "range").orderBy(*order)
    at = ranged.withColumn("at", F.row_number().over(within) - 1)
    return at.join(starts, ["conv", "range"]).select("mid", (F.col("start") + F.col("at")).cast("long").alias("position"))


def formatted(role: str = "role", content: str = "content") -> Column:
    """One message in chat markup; markers inside its text are broken up."""
    text = F.regexp_replace(content, r"<\|(im_start|im_end)\|>", "<| $1 |>")
    return F.concat(F.lit("<|im_start|>"), F.col(role), F.lit("\n"), text, F.lit("<|im_end|>\n"))


def reply_order(conversations: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, position, thread_turn, reply_to_turn, depth, n_quoted_lines,
    content, formatted."""
    messages = _messages(conversations)
    lines = _lines(messages.where(F.col("text").rlike(QUOTED)))
    bodies = stored(_bodies(messages, lines).drop("text"), "bodies")
    quotations = stored(_quotations(lines), "quotations")
    links = replies(quotations, _originals(bodies, quotations))
    roots = links.select("mid", "parent_turn").join(threads(links), "mid")
    placed = bodies.join(roots, "mid", "left").withColumns(
        {
            "root_turn": F.when(F.col("root").isNull(), F.col("turn")).otherwise(F.col("root_turn")),
            "depth": F.coalesce("depth", F.lit(0)).cast("long"),
        }
    )
    placed = stored(placed, "placed")
    keys = placed.select("mid", "conv", "root_turn", "turn", "role", F.md5("content").alias("tie"))
    return placed.join(_positions(keys), "mid").select(
        "conv_id",
        "turn",
        "role",
        "position",
        F.col("root_turn").alias("thread_turn"),
        F.col("parent_turn").alias("reply_to_turn"),
        "depth",
        "n_quoted_lines",
        "content",
        formatted().alias("formatted"),
    )
