"""N-gram Jaccard join by vertical partitioning.

The global order of shingles is that of their hashes; it is cut into fragments,
and what two texts share is counted fragment by fragment and summed per pair.

Texts with equal shingle sets are one node (``sid``) from the start. Then:

1. *Candidates.* Two linked sets of at most M shingles differ in at most
   D = (1 - t) * 2M / (1 + t) shingles. With F = D + 1 + s fragments, 1 + s of
   them or more hold the same shingles in both. So a set is entered under
   the content of each of its fragments, and linked sets meet in a bucket, unless
   all their equal fragments are empty; a set with more than s empty fragments
   is therefore also entered under its first shingles (prefix filter), where two
   such sets meet for certain. F depends on a size class; a set is entered in the
   classes of all sizes that a larger partner may have. Passages and lines that
   many texts share make no bucket, however frequent they are: a bucket
   needs a whole fragment to be the same.
2. *Leaders.* The set with the most company leads a bucket, and each member is
   compared with the leader, not with all others. A set with e empty fragments has
   (s - e) / 2 buckets of a class to spare: two linked sets that both leave so many
   still meet in another. So a set leaves the leaders that it shares the fewest
   buckets with, which are mostly not linked with it.
3. *Overlaps.* The shingles that a member and its leader both have are counted
   per fragment of the order and summed per pair.
4. *The rest.* If two members X and Y of a bucket are linked and their
   differences from the leader have no shingle in common, then
   |X ^ L| + |Y ^ L| = |X ^ Y|, so both are linked with the leader L already. A link
   that stars miss therefore has an end that is not linked with L, and the two
   share a part of their differences: members of such a leader are compared
   through their differences, where the leader is if it has few members, else in
   blocks of bounded size, and no more links are returned than keep them together.
5. Links become components (see ``components``).

No step emits all pairs of a group, and none holds more than a block of it.

Names of sets and buckets are 64-bit hashes; n sets share a name with a
probability of n * n / 2 ** 65. Overlaps are counted on 48 bits of the hashes; two
sets of n shingles seem to share one too many with a probability of n * n / 2 ** 48.

Defined results: a null text counts as empty; empty texts and texts without words
have no shingles and are linked with nothing. A text with fewer words than a
shingle has its whole word sequence as the one shingle. Repeated rows and equal
texts are one class. Null ids lose against all others as names of a component.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from chatlake.llm.common import BROADCAST_ROWS, drop_named, join_skewed, row_name, stored
from chatlake.llm.components import components
from chatlake.llm.shingles import mix, set_id, shingle_set

WORDS, SHARE = 4, (85, 100)
#: Fragments of the order in which overlaps are counted.
PARTS = 4
#: One fragment in so many differences is spare: linked sets have that many equal ones more than they need.
SPARE = 4
#: Size classes that a bucket's name can tell apart, in its lowest bits.
CLASSES = 64
#: Members that a leader meets at one salt, and members of a leader of more that are compared at once.
SALTED, BLOCK = 256, 512


# ---- candidates ----------------------------------------------------------------


class Fragments:
    """The size classes of a threshold and the fragments of each."""

    def __init__(self, share: tuple[int, int]):
        self.num, self.den = share
        self.bounds = [4]

    def class_of(self, n: int) -> int:
        while self.bounds[-1] < n:
            self.bounds.append(self.bounds[-1] * 3 // 2)
        return int(np.searchsorted(self.bounds, n))

    def differences(self, bound: int) -> int:
        """In how many shingles two linked sets of at most ``bound`` may differ."""
        return (self.den - self.num) * 2 * bound // (self.den + self.num)

    def cuts(self, shingles: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        """(class, each shingle's fragment, where the fragments begin, spare ones) of each class a set is entered in.

        Spare fragments without a shingle are taken off; where that leaves less than none, the set needs its prefix.
        """
        n = len(shingles)
        if not n:
            return
        for c in range(self.class_of(n), self.class_of(n * self.den // self.num) + 1):
            most = self.differences(self.bounds[c])
            if not most:
                continue  # linked sets of this class are equal
            spare = 1 + most // SPARE
            parts = most + 1 + spare
            part = ((shingles >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            yield c, part, first, spare - (parts - len(first))

    def entries(self, shingles: np.ndarray) -> np.ndarray:
        """The names of the buckets that a set is entered in; their lowest bits name the class."""
        n, out = len(shingles), []
        for c, part, first, spare in self.cuts(shingles):
            content = np.add.reduceat(mix(shingles), first)
            names = [mix(content + mix(part[first] + np.uint64(c << 40)))]
            if spare < 0:
                prefix = n - -(-self.num * n // self.den) + 1
                names.append(mix(shingles[:prefix] + np.uint64((c << 40) + (1 << 39))))
            out += [(x & ~np.uint64(CLASSES - 1)) | np.uint64(c % CLASSES) for x in names]
        return np.concatenate(out) if out else np.zeros(0, np.uint64)

    def spares(self, shingles: np.ndarray) -> list[int]:
        """class + CLASSES * buckets of that class that a set can leave, though its partners leave theirs too."""
        return [c % CLASSES + CLASSES * (spare // 2) for c, _, _, spare in self.cuts(shingles) if spare > 1]


def _entries(docs: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    """(bucket, sid) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fragments = Fragments(share)
        for batch in batches:
            buckets, sids, size, seen = [], [], 0, set()
            for text in batch.column(0).to_pylist():
                shingles = shingle_set(text, words)
                sid = set_id(shingles)
                if sid in seen:
                    continue
                seen.add(sid)
                names = fragments.entries(shingles)
                buckets.append(names)
                sids.append(np.full(len(names), sid))
                size += len(names)
                if size > 1 << 17:
                    yield _batch(buckets, sids)
                    buckets, sids, size = [], [], 0
            if size:
                yield _batch(buckets, sids)

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, sid long")


def _batch(buckets: list[np.ndarray], sids: list[np.ndarray]) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(buckets).view(np.int64)), pa.array(np.concatenate(sids).astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "sid"])


def sets_of(docs: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    """(uid, doc_id, n_shingles, sid, spares) of every row; ``uid`` names the row by its id and text."""

    @pandas_udf("n long, sid long, spares array<long>")
    def run(texts: pd.Series) -> pd.DataFrame:
        fragments = Fragments(share)
        sets = (shingle_set(t, words) for t in texts)
        return pd.DataFrame([(len(s), set_id(s), fragments.spares(s)) for s in sets], columns=["n", "sid", "spares"])

    named = _named(docs).withColumn("s", run(F.col("text")))
    return stored(named.select("uid", "doc_id", F.col("s.n").alias("n_shingles"), "s.sid", "s.spares"), "sets")


def _named(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    doc_id = F.col("doc_id").cast("long")
    return docs.select(row_name().alias("uid"), doc_id.alias("doc_id"), text.alias("text"))


def buckets_of(docs: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    """(bucket, sid) of the buckets that hold different sets."""
    alike = Window.partitionBy("bucket")
    met = _entries(docs, words, share).withColumns({"low": F.min("sid").over(alike), "high": F.max("sid").over(alike)})
    return stored(met.where("low < high").select("bucket", "sid").distinct(), "buckets")


def leader_pairs(buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """(sid, leader): each member of a bucket with the member that has the most company in all its buckets.

    A set leaves the leaders that it shares the fewest buckets with, for as long as it has spare ones in the class.
    """
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    company = buckets.join(sizes, "bucket").groupBy("sid").agg(F.sum("size").alias("company"))
    leaders = buckets.join(company, "sid").groupBy("bucket").agg(F.max(F.struct("company", "sid")).sid.alias("leader"))
    kind = F.col("bucket").bitwiseAND(CLASSES - 1).alias("class")
    met = buckets.join(leaders, "bucket").where("sid <> leader").groupBy("sid", "leader", kind).agg(F.count(F.lit(1)).alias("n"))
    one = sets.where(F.size("spares") > 0).groupBy("sid").agg(F.first("spares").alias("spares"))
    spare = one.select("sid", F.explode("spares").alias("s")).select(
        "sid", F.col("s").bitwiseAND(CLASSES - 1).alias("class"), F.shiftright("s", CLASSES.bit_length() - 1).alias("spare")
    )
    # a set has no more leaders than it has buckets
    fewest = Window.partitionBy("sid", "class").orderBy("n", "leader").rowsBetween(Window.unboundedPreceding, 0)
    left = met.join(spare, ["sid", "class"], "left").withColumn("left", F.sum("n").over(fewest))
    return stored(left.where("left > coalesce(spare, 0)").select("sid", "leader").distinct(), "pairs")


# ---- overlaps ------------------------------------------------------------------


def _chosen(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(uid, sid, rows, targets): one text of each set in ``pairs``, how many rows it is, and where it is compared.

    A target is a leader, a salt, and how many salts the leader has; a leader of many members stands at each.
    """
    size = pairs.groupBy("leader").agg(F.count(F.lit(1)).alias("n"))
    salts = size.select("leader", F.ceil(F.col("n") / SALTED).cast("int").alias("salts"))
    members = pairs.join(salts, "leader").withColumn("salt", F.pmod(F.xxhash64("sid"), "salts").cast("int"))
    leaders = salts.withColumn("sid", F.col("leader")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    # a set has no more leaders than it has buckets
    targets = members.unionByName(leaders).groupBy("sid").agg(
        F.collect_list(F.struct("leader", "salt", "salts")).alias("targets")
    )
    texts = sets.join(targets.select("sid"), "sid", "left_semi").groupBy("sid", "uid").agg(F.count(F.lit(1)).alias("rows"))
    one = texts.groupBy("sid").agg(F.min(F.struct("uid", "rows")).alias("t"))
    return stored(one.join(targets, "sid").select("t.uid", "sid", "t.rows", "targets"), "chosen")


_SEGMENT = ["leader", "salt", "salts", "member", "sid", "part", "n", "shingles"]


def pack(shingles: np.ndarray) -> bytes:
    """The upper 48 bits of each hash."""
    return (shingles >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel().astype(np.int64)


def _segments(docs: DataFrame, chosen: DataFrame, words: int) -> DataFrame:
    """The fragments of each chosen set at each of its targets."""
    size = chosen.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("targets")).alias("targets"), F.max("rows").alias("rows")).first()
    picked = F.broadcast(chosen) if max(size.n, size.targets or 0) <= BROADCAST_ROWS else chosen
    found = _named(docs).select("uid", "text").join(picked, "uid")
    if (size.rows or 0) > 1:
        found = found.where("rows = 1").unionByName(found.where("rows > 1").dropDuplicates(["uid"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.arange(1, PARTS, dtype=np.uint64) << np.uint64(64 - PARTS.bit_length() + 1)
        for batch in batches:
            rows, size = [], 0
            for text, sid, targets in zip(*(batch.column(c).to_pylist() for c in ("text", "sid", "targets"))):
                shingles = shingle_set(text, words)
                if set_id(shingles) != sid:
                    continue  # another text under the same name
                parts = [pack(p) for p in np.split(shingles, np.searchsorted(shingles, edges))]
                for t in targets:
                    at = (t["leader"], t["salt"], t["salts"], sid != t["leader"], sid)
                    rows += [(*at, part, len(shingles), p) for part, p in enumerate(parts)]
                    size += len(shingles)
                if size > 1 << 18:
                    yield _record_batch(rows)
                    rows, size = [], 0
            if rows:
                yield _record_batch(rows)

    schema = "leader long, salt int, salts int, member boolean, sid long, part int, n long, shingles binary"
    return found.select("text", "sid", "targets").mapInArrow(run, schema)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_SEGMENT)


def _overlap(own: np.ndarray, other: np.ndarray) -> tuple[int, np.ndarray]:
    """How many values two fragments share, and the values that only one has."""
    both = np.concatenate([own, other])
    both.sort()
    twice = both[1:] == both[:-1]
    alone = np.ones(len(both), bool)
    alone[1:] &= ~twice
    alone[:-1] &= ~twice
    return int(twice.sum()), both[alone]


_COMPARED = "leader long, sid long, other long, n long, star boolean, delta array<long>"


def _compare(batches: Iterator[pa.RecordBatch], share: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Compares the members at each (leader, salt) with the leader, whose fragments come first.

    The shared shingles of a pair are counted per fragment and summed. A leader at one salt has all its members here,
    at most some ``SALTED``: their links (sid, other) are found at once. Members of a leader at several salts are
    returned with their differences.
    """
    num, den = share

    def done(leader: int, salts: int, members: dict) -> pa.RecordBatch:
        rows = []
        for sid, (n, leader_n, common, apart) in members.items():
            star = den * common >= num * (n + leader_n - common)
            rows.append((leader, sid, leader if star else None, n, star, np.concatenate(apart)))
        if salts == 1:
            links = [r[:3] for r in rows if r[4]]
            if len(links) < len(rows):
                block = pd.DataFrame(rows, columns=["leader", "sid", "other", "n", "star", "delta"])
                block["side"] = np.where(block["star"], 1, 2)
                more = _links_of_block(block, share)
                links += [(leader, u, v) for u, v in zip(more["u"].tolist(), more["v"].tolist())]
            rows = [(*link, None, None, None) for link in links]
        else:
            rows = [(*r[:2], None, *r[3:]) for r in rows]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
        names = ["leader", "sid", "other", "n", "star", "delta"]
        columns = list(zip(*rows)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    at, own, own_n, members = None, {}, 0, {}
    for batch in batches:
        for leader, salt, salts, member, sid, part, n, raw in zip(*(batch.column(c).to_pylist() for c in _SEGMENT)):
            if at != (leader, salt, salts):
                if members:
                    yield done(at[0], at[2], members)
                at, own, members = (leader, salt, salts), {}, {}
            if not member:
                own[part], own_n = unpack(raw), n
                continue
            common, apart = _overlap(own[part], unpack(raw))
            _, _, before, pieces = members.get(sid, (n, own_n, 0, []))
            members[sid] = (n, own_n, before + common, [*pieces, apart])
    if members:
        yield done(at[0], at[2], members)


def compared(docs: DataFrame, sets: DataFrame, pairs: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    """Links (sid, other) of leaders with few members; the members of all other leaders, and their links with them."""
    segments = _segments(docs, _chosen(sets, pairs), words)
    met = segments.repartition("leader", "salt").sortWithinPartitions("leader", "salt", "member", "sid", "part")
    return stored(met.mapInArrow(lambda batches: _compare(batches, share), _COMPARED), "compared")


# ---- the rest ------------------------------------------------------------------


def _links_of_block(rows: pd.DataFrame, share: tuple[int, int]) -> pd.DataFrame:
    """Links between the members of two sides (0, 1; 2 is on both), as few as keep them together."""
    num, den = share
    left, right = rows[rows["side"] != 1], rows[rows["side"] != 0]
    n, ids = right["n"].to_numpy(), right["sid"].to_numpy()
    sizes = np.array([len(d) for d in right["delta"]])
    if not len(left) or not len(right):
        return pd.DataFrame({"u": [], "v": []}, dtype="int64")
    keys = np.concatenate(right["delta"].to_list())
    owners = np.repeat(np.arange(len(right)), sizes)
    order = np.argsort(keys, kind="stable")
    keys, owners = keys[order], owners[order]
    parent = {int(i): int(i) for i in [*ids, *left["sid"]]}

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for sid, m, delta in zip(left["sid"], left["n"], left["delta"]):
        lows, highs = np.searchsorted(keys, delta, "left"), np.searchsorted(keys, delta, "right")
        hits = [owners[a:b] for a, b in zip(lows, highs) if b > a]
        if not hits:
            continue
        shared = np.bincount(np.concatenate(hits), minlength=len(right))
        apart = sizes + len(delta) - 2 * shared
        for other in ids[(den * (n + m - apart) >= num * (n + m + apart)) & (shared > 0)].tolist():
            u, v = root(int(sid)), root(other)
            if u != v:
                parent[u] = v
                out.append((int(sid), other))
    return pd.DataFrame(out, columns=["u", "v"], dtype="int64")


def rest_links(members: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Links between members of one leader of which one at least isn't linked with it (``star``), block by block."""
    orbits = members.groupBy("leader").agg(F.count(F.lit(1)).alias("size"), F.sum((~F.col("star")).cast("int")).alias("rest"))
    orbits = stored(orbits.where("rest > 0"), "orbits").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    if orbits.count() <= BROADCAST_ROWS:
        orbits = F.broadcast(orbits)
    joined = members.join(orbits, "leader")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    own = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    fields = ["leader", "sid", "n", "delta"]
    left = joined.where(~F.col("star")).select(*fields, own.alias("i"), every.alias("j"), F.lit(0).alias("side"))
    right = joined.select(*fields, every.alias("i"), own.alias("j"), F.lit(1).alias("side"))
    return (
        left.unionByName(right)
        .groupBy("leader", "i", "j")
        .applyInPandas(lambda rows: _links_of_block(rows, share), "u long, v long")
    )


# ---- the operator --------------------------------------------------------------


def classes(docs: DataFrame, words: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """(uid, doc_id, n_shingles, component_id, class_size, root) of every row of ``docs``.

    ``component_id`` is the smallest doc_id that links lead to, ``root`` the class's name (null for texts
    without shingles).
    """
    sets = sets_of(docs, words, share)
    met = compared(docs, sets, leader_pairs(buckets_of(docs, words, share), sets), words, share)
    close = met.where("other IS NOT NULL").select(F.col("sid").alias("u"), F.col("other").alias("v"))
    many = met.where("delta IS NOT NULL")
    stars = many.where("star").select(F.col("sid").alias("u"), F.col("leader").alias("v"))
    links = close.unionByName(stars).unionByName(rest_links(many, share))
    roots = components(links).select(F.col("node").alias("sid"), "root")
    # sets first: texts with one set are counted before they meet their component
    own = sets.where("n_shingles > 0").groupBy("sid").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n"))
    rooted = stored(own.join(roots, "sid", "left").withColumn("root", F.coalesce("root", "sid")), "rooted")
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.sum("n").alias("class_size"))
    named = rooted.join(least, "root").select("sid", "n", "root", "component_id", "class_size")
    some = join_skewed(sets.where("n_shingles > 0"), named, "sid", "n", sets.count())
    columns = ["uid", "doc_id", "n_shingles", "component_id", "class_size", "root"]
    alone = {
        "component_id": F.col("doc_id"),
        "class_size": F.lit(1).cast("long"),
        "root": F.lit(None).cast("long"),
    }
    return some.select(*columns).unionByName(sets.where("n_shingles = 0").withColumns(alone).select(*columns))


def keep_one(docs: DataFrame, words: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """The rows of ``docs`` without all but one document of each class, with all their columns.

    The smallest doc_id of a class stays (null ids last). Texts without shingles stay.
    """
    found = stored(classes(docs, words, share).where("class_size > 1"), "classes")
    uids = found.groupBy("root", "uid", "doc_id").agg(F.count(F.lit(1)).alias("rows"))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")
    stays = uids.groupBy("root").agg(F.min(first).alias("stays"))
    kept = (F.col("uid") == F.col("stays.uid")) & F.col("doc_id").eqNullSafe(F.col("stays.doc_id"))
    judged = uids.join(stays, "root").select("uid", "doc_id", kept.alias("kept"), "rows")
    return drop_named(docs, stored(judged, "judged"))
