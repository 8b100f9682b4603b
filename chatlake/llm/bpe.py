"""Byte-level BPE by monoid tree reduction.

The encodings of adjacent byte strings form a monoid: ``Encoder.join`` makes the
encoding of ``uv`` from those of ``u`` and ``v``. It re-encodes a window of the
last tokens of one and the first tokens of the other and doubles the window
until its outermost tokens come back unchanged. Then the result is exact: the
merge loop always takes the lowest rank, leftmost first, so what happens inside
a stretch of bytes depends on that stretch alone until a merge crosses its end.
A token sequence is therefore the encoding of its bytes if and only if each
adjacent pair is the encoding of its own bytes, and outside the window, the
unchanged outermost tokens included, all adjacent pairs are as they were.

A text is halved where a letter meets white space, since no match of the
pre-tokenisation pattern holds a letter followed by white space, until a part is
small; parts are then joined by concatenation. A single match is looked up
whole first, as the vocabulary asks for; longer ones are encoded by halves.
Decoding goes up such a tree too: the bytes of each half, one after the other.

The vocabulary (a rank file, a parameter) is read on the driver and broadcast;
it is the only thing that is, and it does not depend on the corpus.

Defined results: a null text counts as empty and has no tokens. Every row stands
alone, so ties, repeated rows and other columns don't matter; an empty table
gives an empty result. Very long texts and very long matches are encoded whole.
"""

from __future__ import annotations

import array
import base64
import hashlib
import heapq
import uuid
from collections.abc import Iterable, Sequence

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

#: Characters of a text that are matched at once.
PART = 1 << 16
#: Ids that decoding looks up at once.
LEAF = 256
#: Bytes that are merged directly.
LEAF = 16
#: Stands for the rank of a pair that is no token.
NONE = 1 << 62
#: Bytes of a match or window whose tokens a worker remembers, and how many of them.
SHORT, CACHE = 48, 1 << 19


def read_ranks(path: str) -> list[tuple[bytes, int]]:
    with open(path, "rb") as lines:
        return [(base64.b64decode(token), int(rank)) for token, rank in map(bytes.split, lines)]


class Encoder:
    def __init__(self, ranks: Iterable[tuple[bytes, int]], pattern: str):
        self.ranks = dict(ranks)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.cut, self.cut_back = regex.compile(r"(?<=\p{L})\s"), regex.compile(r"(?r)(?<=\p{L})\s")
        self.cache: dict[str, list[int]] = {}
        self.windows: dict[bytes, list[int]] = {}

    # -- byte strings

    def merge(self, raw: bytes) -> list[int]:
        """The encoding by the merge loop: lowest rank first, leftmost of equals."""
        ranks = self.ranks
        if len(raw) > 64:
            return self._merge_long(raw)
        parts = [raw[i : i + 1] for i in range(len(raw))]
        pairs = [ranks.get(raw[i : i + 2], NONE) for i in range(len(raw) - 1)]
        while pairs and (best := min(pairs)) != NONE:
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], NONE)
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1], NONE)
        return [ranks[p] for p in parts]

    def _merge_long(self, raw: bytes) -> list[int]:
        """The same with a heap of (rank, position) over a linked list of parts."""
        ranks, n = self.ranks, len(raw)
        end = list(range(1, n + 1))  # end of the part that starts here; 0 once it is merged away
        before = list(range(-1, n))  # start of the part before
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if end[i] != j or j >= n or end[j] != k:
                continue  # one of the two has changed since
            end[i], end[j] = k, 0
            if k < n:
                before[k] = i
                if (r := ranks.get(raw[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, k, end[k]))
            if (h := before[i]) >= 0 and (r := ranks.get(raw[h:k])) is not None:
                heapq.heappush(heap, (r, h, i, k))
        out, i = [], 0
        while i < n:
            out.append(ranks[raw[i : end[i]]])
            i = end[i]
        return out

    def window(self, raw: bytes) -> list[int]:
        """``merge``, remembered for short strings."""
        if (ids := self.windows.get(raw)) is None:
            ids = self.merge(raw)
            if len(raw) <= SHORT:
                if len(self.windows) >= CACHE:
                    self.windows.clear()
                self.windows[raw] = ids
        return ids

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two adjacent byte strings from their encodings."""
        size, tokens = 1, self.tokens
        while left and right:
            a, b = min(size, len(left)), min(size, len(right))
            if size == 1:
                window = self.window(tokens[left[-1]] + tokens[right[0]])
            else:
                window = self.window(self.decode(left[len(left) - a :] + right[:b]))
            if (a == len(left) or window[0] == left[-a]) and (b == len(right) or window[-1] == right[b - 1]):
                return left[: len(left) - a] + window + right[b:]
            size *= 2
        return left + right

    def encode_bytes(self, raw: bytes) -> list[int]:
        """The encoding by halves."""
        if len(raw) <= LEAF:
            return self.window(raw)
        half = len(raw) // 2
        return self.join(self.encode_bytes(raw[:half]), self.encode_bytes(raw[half:]))

    # -- texts

    def _match(self, piece: str) -> list[int]:
        raw = piece.encode()
        whole = self.ranks.get(raw)
        ids = [whole] if whole is not None else self.encode_bytes(raw)
        if len(raw) <= SHORT:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[piece] = ids
        return ids

    def _parts(self, text: str) -> Iterable[str]:
        """``text`` in halves of halves, cut where a letter meets white space."""
        if len(text) <= PART:
            yield text
            return
        half = len(text) // 2
        found = self.cut.search(text, half) or self.cut_back.search(text, 0, half)
        if not found:
            yield text
            return
        yield from self._parts(text[: found.start()])
        yield from self._parts(text[found.start() :])

    def encode(self, text: str) -> array.array:
        """The ids of ``text`` as unsigned 32-bit integers."""
        ids, known, find = array.array("I"), self.cache, self.pattern.findall
        for part in self._parts(text):
            tokens: list[int] = []
            for piece in find(part):
                tokens += known.get(piece) or self._match(piece)
            ids.extend(tokens)
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes of ``ids``: those of both halves, one after the other; lists of up to ``LEAF`` ids are looked up."""
        ids = ids if hasattr(ids, "__getitem__") else list(ids)
        return self._decode(ids, 0, len(ids))

    def _decode(self, ids: Sequence[int], start: int, end: int) -> bytes:
        if end - start <= LEAF:
            return b"".join(map(self.tokens.__getitem__, ids[start:end]))
        half = (start + end) // 2
        return self._decode(ids, start, half) + self._decode(ids, half, end)


# ---- Spark --------------------------------------------------------------------

_ENCODERS: dict[str, Encoder] = {}  # of this worker, by vocabulary


class Vocabulary:
    """A rank file and its pattern, broadcast once; its methods are column functions."""

    def __init__(self, spark, path: str, pattern: str):
        self.shared = _Shared(spark.sparkContext.broadcast((read_ranks(path), pattern)))

    def encode(self, text):
        shared = self.shared

        @pandas_udf(ArrayType(IntegerType()))
        def run(texts: pd.Series) -> pd.Series:
            encoder = shared.encoder()
            return pd.Series([list(encoder.encode(t or "")) for t in texts], dtype=object)

        return run(text)

    def decode(self, ids):
        shared = self.shared

        @pandas_udf(BinaryType())
        def run(lists: pd.Series) -> pd.Series:
            encoder = shared.encoder()
            return pd.Series([encoder.decode([] if x is None else map(int, x)) for x in lists], dtype=object)

        return run(ids)

    def digests(self, text):
        """(n_tokens, ids_sha256, decoded_sha256): encodes, decodes again, and returns digests of both."""
        shared = self.shared
        fields = [StructField("n_tokens", LongType())]
        fields += [StructField(c, StringType()) for c in ("ids_sha256", "decoded_sha256")]

        @pandas_udf(StructType(fields))
        def run(texts: pd.Series) -> pd.DataFrame:
            encoder, rows = shared.encoder(), []
            for t in texts:
                ids = encoder.encode(t or "")
                decoded = encoder.decode(ids)
                rows.append((len(ids), _sha256(little_endian(ids)), _sha256(decoded)))
            return pd.DataFrame(rows, columns=[f.name for f in fields])

        return run(text)


class _Shared:
    """A broadcast vocabulary that makes one encoder per worker."""

    def __init__(self, broadcast):
        self.broadcast, self.key = broadcast, uuid.uuid4().hex

    def encoder(self) -> Encoder:
        if self.key not in _ENCODERS:
            _ENCODERS[self.key] = Encoder(*self.broadcast.value)
        return _ENCODERS[self.key]


def little_endian(ids: array.array) -> bytes:
    if array.array("H", [1]).tobytes() == b"\x01\x00":
        return ids.tobytes()
    swapped = array.array("I", ids)
    swapped.byteswap()
    return swapped.tobytes()


def _sha256(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def encode_documents(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids) of every row of ``docs``."""
    return docs.select("doc_id", vocabulary.encode(F.col("text").cast("string")).alias("ids"))


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, raw): the bytes of every row of ``encode_documents``."""
    return encoded.select("doc_id", vocabulary.decode(F.col("ids")).alias("raw"))
