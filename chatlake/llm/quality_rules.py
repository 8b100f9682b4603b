"""Quality rules as a bitmask ledger.

``ledger`` reads each whole text once: one vectorised pass measures it, then
every rule is evaluated on the measurements, whatever the outcome of the
others, and its failure becomes one bit of ``fail_bits``. Policies are versioned
sets of rules; applying one is a bit test on the stored ledger, so a new
version needs no second pass over texts. ``ablations`` counts what each rule
alone is responsible for: rows are grouped by their failure bits (partial
aggregation first; no more groups than bit patterns), and the counts per rule
follow from bit operations on the patterns.

Words are ``[^\\x20\\x09-\\x0D]+``. Measurements:

* ``n_words``, ``word_chars`` (code points in words), ``n_symbols`` (characters
  of ``[#*$%&|<>]``), ``n_upper`` and ``n_lower`` (ASCII letters);
* ``n_lines`` (lines with a word), ``n_dup_lines`` (those equal to an earlier
  line);
* ``n_repeat_words``: words in 3-word windows that the text holds twice or
  more, the first occurrence included.

Defined results: a null text counts as empty and fails ``too_few_words``;
rules that divide by the number of words pass on a text without words. Rows are
judged on their own, so repeated rows, ties and other columns don't matter; an
empty table gives an empty ledger. Very long texts are measured whole, with
memory in proportion to the one text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType, StructField, StructType

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower",
]

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _repeat_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(seen) + ids[2:]
    _, at, n = np.unique(windows, return_inverse=True, return_counts=True)
    twice = np.concatenate([n[at] > 1, [False, False]])
    twice[1:] |= twice[:-1].copy() | np.concatenate([[False], twice[:-2].copy()])
    return int(twice.sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The ``MEASURES`` of one text."""
    raw = (text or "").encode()
    words = raw.split()  # bytes split at exactly \x20 and \x09-\x0D
    at = np.frombuffer(raw, np.uint8)
    chars = int((~_SPACE[at] & ((at & 0xC0) != 0x80)).sum())
    seen: set[bytes] = set()
    n_lines = n_dup = 0
    for line in raw.split(b"\n"):
        if line.split(None, 1):
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    upper = int(((at >= 65) & (at <= 90)).sum())
    lower = int(((at >= 97) & (at <= 122)).sum())
    return len(words), chars, int(_SYMBOL[at].sum()), n_dup, _repeat_words(words), n_lines, upper, lower


@pandas_udf(StructType([StructField(m, LongType()) for m in MEASURES]))
def _measure(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure_text(t) for t in texts], columns=MEASURES)


@dataclass(frozen=True)
class Rule:
    name: str
    #: The condition of failure; gets the measurements by name. Integers only, so it is exact.
    fails: Callable[[Callable[[str], Column]], Column]


#: The order is the bit order and never changes; new rules go to the end.
RULES = (
    Rule("too_few_words", lambda m: m("n_words") < 50),
    Rule("repeated_windows", lambda m: 100 * m("n_repeat_words") > 50 * m("n_words")),
    Rule("symbols", lambda m: 100 * m("n_symbols") > 12 * m("n_words")),
    Rule("repeated_lines", lambda m: 100 * m("n_dup_lines") > 50 * m("n_lines")),
    Rule(
        "word_length",
        lambda m: (m("n_words") > 0)
        & ((m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 15 * m("n_words"))),
    ),
    Rule("shouting", lambda m: 100 * m("n_upper") > 50 * (m("n_upper") + m("n_lower"))),
)


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {r.name: 1 << i for i, r in enumerate(RULES)}
        return sum(bits[name] for name in self.rules)


BASE = Policy("base-1", ("too_few_words", "repeated_windows"))
STANDARD = Policy("standard-1", tuple(r.name for r in RULES))


def fail_bits(measures: str) -> Column:
    """One bit per failed rule, of the struct column that holds the measurements."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        failed = rule.fails(lambda name: F.col(f"`{measures}`.{name}"))
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << i)).otherwise(0).cast("long"))
    return bits


def ledger(docs: DataFrame) -> DataFrame:
    """(doc_id, the measurements, fail_bits) of every row of ``docs``."""
    measured = docs.select("doc_id", _measure(F.col("text").cast("string")).alias("m"))
    return measured.select("doc_id", "m.*", fail_bits("m").alias("fail_bits"))


def rejected(policy: Policy, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask)) != 0


def apply_policy(entries: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with the policy's version and verdict (``kept``)."""
    return entries.withColumns({"policy": F.lit(policy.version), "kept": ~rejected(policy)})


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of ``policy``: rows that fail it, fail it alone, and are kept if it is left out."""
    patterns = entries.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = [(r.name, 1 << i) for i, r in enumerate(RULES) if r.name in policy.rules]
    each = patterns.withColumn("rule", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(b).cast("long").alias("bit")) for n, b in rules])))
    bit, bits = F.col("rule.bit"), F.col("bits")
    count = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0).cast("long"))
    return each.groupBy(F.lit(policy.version).alias("policy"), F.col("rule.name").alias("rule")).agg(
        count(bits.bitwiseAND(bit) != 0).alias("n_failed"),
        count(bits == bit).alias("n_failed_alone"),
        count((bits == bit) | (bits == 0)).alias("n_kept_without"),
    )


def keep(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The rows of ``docs`` that pass ``policy``, with all their columns."""
    columns = docs.columns
    mark = "m"
    while mark in columns:
        mark += "_"
    measured = docs.withColumn(mark, _measure(F.col("text").cast("string")))
    return measured.where(fail_bits(mark).bitwiseAND(F.lit(policy.mask)) == 0).select(*[f"`{c}`" for c in columns])
