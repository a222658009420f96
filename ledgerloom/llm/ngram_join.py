"""Jaccard similarity join of word n-gram sets: rare-first prefixes, length, positional and suffix filters.

1. ``scanned``: each text becomes its set of 64-bit n-gram hashes. One pass over all documents writes, per document, id,
   set digest, set size and a profile (how many members fall into each of 64 ranges of the hash), and adds up in a table
   of ``SLOTS`` counters how often n-grams occur. Its size is fixed; n-grams that share a counter share its count, which
   moves them in the order and changes no result.
2. ``prefixes``: in the order of those counts, rare first, a set's first ``n - ceil(t * n) + 1`` n-grams are its keys: two
   sets of similarity ``t`` share one of them. Only keys of several different sets go on (``shared_keys``).
3. Two sets that share a key are candidates if sizes (length filter), places of the key in both (positional filter) and
   the profiles (suffix filter: what remains falls into ranges, and can agree in the smaller count of each at most) leave
   room for the similarity.
4. Links, not pairs: every member of a key first meets one leader of its key and size class. Candidates are verified
   once on both whole sets, where a leader's set is sent once for up to ``CHUNK`` members. Links meet in components.
   Keys whose sets are all in one component are done. The others go on in rounds over ever more distant members,
   candidates of different components alone, until none is left: no link between components is lost. Keys with more than
   ``BLOCK`` sets are dealt out in pairs of blocks.

A set without members (no word, null or empty text) is linked with nothing. Shorter texts than an n-gram are one n-gram.
Equal sets are one class, whatever their number; sets are told apart by a 64-bit digest, n-grams by a 64-bit hash.
Repeated rows and equal ids stay rows of their own. Rows without an id take the smallest id of their component, if there
is one. A batch of texts is held in memory, so a very long text needs some 60 bytes a word. An empty table gives an empty
result. Other columns than the two named ones aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import TASK_ROWS, Scratch, few, query, stored, table, utf8_values
from ledgerloom.llm.simhash_dedup import components

SLOTS = 1 << 22
RANGES = 64
CHUNK = 1000
BLOCK = 4096
NEAREST, GROWTH = 16, 1024
# A whole set and a row with its profile count as so many short rows.
SET_ROWS, PROFILE_ROWS = 16, 4
_SLOT_BLOCK = 1 << 12
_SLOT_TASKS = 32
_FEED = 1 << 17
_ID_BITS = 1 << 24
_MIX = np.uint64(0xD6E8FEB86659FD93)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ROW = "token bigint, node bigint, n int, at int"


@dataclass(frozen=True)
class Likeness:
    """N-grams of ``width`` words; sets are alike if ``whole * |both| >= part * |either|``."""

    width: int = 5
    part: int = 4
    whole: int = 5

    def keys(self, n):
        """How many n-grams of a set of ``n`` are keys."""
        return n - (self.part * n + self.whole - 1) // self.whole + 1

    def alike(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return self.whole * both >= self.part * (len(a) + len(b) - both)

    def room(self, n, at, m, to):
        """Length and positional filter for sets of ``n`` and ``m`` whose first common key is at these places."""
        return (self.whole * np.minimum(n, m) >= self.part * np.maximum(n, m)) & (
            (self.whole + self.part) * np.minimum(n - at, m - to) >= self.part * (n + m))

    def agree(self, n, one: np.ndarray, m, other: np.ndarray):
        """Suffix filter on profiles: at most the smaller count of each range can agree."""
        most = np.minimum(counts_of(one), counts_of(other)).sum(1)
        return (self.whole + self.part) * most >= self.part * (n + m)


# --- sets ------------------------------------------------------------------------------------------


def gram_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text one after the other, and how many each has."""
    split = [t.lower().split() for t in texts]  # A-Z only; ASCII white space
    size = np.fromiter(map(len, split), np.int64, len(split))
    word = np.fromiter((h for words in split for h in map(xxhash.xxh64_intdigest, words)), np.uint64, int(size.sum()))
    owner, begin = np.repeat(np.arange(len(texts)), size), np.cumsum(size) - size
    left = (begin + size)[owner] - np.arange(len(word))
    # A window starts at every word that has enough after it, or at the first word of a shorter text.
    at = np.flatnonzero((left >= width) | ((left == size[owner]) & (left > 0)))
    gram = np.minimum(left[at], width).astype(np.uint64)
    for k in range(width):
        inside = left[at] > k
        gram[inside] = (gram[inside] ^ word[at[inside] + k]) * _ODD
        gram[inside] ^= gram[inside] >> np.uint64(29)
    gram = (gram ^ (gram >> np.uint64(32))) * _MIX
    gram ^= gram >> np.uint64(29)
    owner = owner[at]
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    fresh = np.ones(len(gram), bool)
    fresh[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    return gram[fresh], np.bincount(owner[fresh], minlength=len(texts))


def digests(gram: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    raw = gram.tobytes()
    return np.fromiter((xxhash.xxh3_64_intdigest(raw[8 * (e - n):8 * e]) for e, n in zip(ends.tolist(), size.tolist())),
                       np.uint64, len(size)).view(np.int64)


def profiles(gram: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Counts by range of the hash in a byte each, rounded up to a multiple of a power of two that the first byte names."""
    owner = np.repeat(np.arange(len(size)), size)
    count = np.bincount(owner * RANGES + (gram >> np.uint64(58)).astype(np.int64), minlength=len(size) * RANGES).reshape(-1, RANGES)
    shift = np.zeros(len(size), np.int64)
    while (over := (count.max(1, initial=0) + (1 << shift) - 1) >> shift > 255).any():
        shift[over] += 1
    count = (count + ((1 << shift) - 1)[:, None]) >> shift[:, None]
    return [bytes(r) for r in np.concatenate([shift[:, None], count], 1).astype(np.uint8)]


def counts_of(profile: np.ndarray) -> np.ndarray:
    return profile[:, 1:].astype(np.int32) << profile[:, :1].astype(np.int32)


def _profile_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, RANGES + 1)


# --- passes over the documents ---------------------------------------------------------------------


def scanned(docs: DataFrame, like: Likeness) -> DataFrame:
    """Rows ``doc_id, node, n, profile`` of documents, and rows ``block, counts`` of the table of counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "node", "n", "profile", "block", "counts"]
        slots = np.zeros(SLOTS, np.int64)
        for batch in batches:
            gram, size = gram_sets(utf8_values(batch.column("text")), like.width)
            slots += np.bincount((gram & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(digests(gram, size)), pa.array(size.astype(np.int32)),
                 pa.array(profiles(gram, size), pa.binary()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names=names)
        slots = np.minimum(slots, 65535).astype("<u2").reshape(-1, _SLOT_BLOCK)
        used = np.flatnonzero(slots.any(1)).astype(np.int32)
        none = [pa.nulls(len(used), t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(used), pa.array([slots[b].tobytes() for b in used], pa.binary())], names=names)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, node bigint, n int, profile binary, block int, counts binary")


def rarity(scan: DataFrame) -> np.ndarray:
    """For each counter a byte that grows with the logarithm of its sum over all tasks; always as large."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None

        def told() -> pa.RecordBatch:
            weight = np.floor(8 * np.log2(1 + total)).astype(np.uint8)
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([weight.tobytes()], pa.binary())], names=["block", "weight"])

        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                if block != at:
                    if at is not None:
                        yield told()
                    at, total = block, np.zeros(_SLOT_BLOCK, np.int64)
                total += np.frombuffer(counts, "<u2")
        if at is not None:
            yield told()

    sums = scan.where("block IS NOT NULL").select("block", "counts").repartition("block").sortWithinPartitions("block")
    weights = np.zeros((SLOTS // _SLOT_BLOCK, _SLOT_BLOCK), np.uint8)
    for row in few(sums.mapInArrow(run, "block int, weight binary"), _SLOT_TASKS * TASK_ROWS).collect():
        weights[row["block"]] = np.frombuffer(row["weight"], np.uint8)
    return weights.ravel()


def prefixes(docs: DataFrame, like: Likeness, weights: Broadcast) -> DataFrame:
    """``token, node, n, at``: the keys of each set, rare first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram, size = gram_sets(utf8_values(batch.column("text")), like.width)
            node = digests(gram, size)
            begin = np.cumsum(size) - size
            _, first = np.unique(node, return_index=True)  # equal sets of a batch once
            first = first[size[first] > 0]
            owner = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((gram, weights.value[(gram & np.uint64(SLOTS - 1)).astype(np.int64)], owner))
            keys = np.where(np.isin(np.arange(len(size)), first), like.keys(size), 0)
            at = np.arange(len(gram)) - begin[owner]
            kept = at < keys[owner]
            owner = owner[kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram[order][kept].view(np.int64)), pa.array(node[owner]), pa.array(size[owner].astype(np.int32)),
                 pa.array(at[kept].astype(np.int32))], names=["token", "node", "n", "at"])

    return docs.select("text").mapInArrow(run, _ROW)


def shared_keys(keys: DataFrame) -> DataFrame:
    """Keys of more than one set; a key streams through, however many sets have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, told = None, False  # the last row, and whether it was given out
        for batch in batches:
            rows = _ints(batch)
            if before is not None:
                rows = np.concatenate([before, rows])
            rows = rows[np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)])[:len(rows)]]
            if not len(rows):
                continue
            same = rows[1:, 0] == rows[:-1, 0]
            shared = np.zeros(len(rows), bool)
            shared[1:] |= same
            shared[:-1] |= same
            give = shared.copy()
            give[0] &= not told
            told = bool(shared[-1]) or (len(rows) == 1 and told)
            before = rows[-1:]
            yield _row_batch(rows[give])

    return keys.repartition("token").sortWithinPartitions("token", "node").mapInArrow(run, _ROW)


def _ints(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], 1)


def _row_batch(rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(rows[:, 2].astype(np.int32)), pa.array(rows[:, 3].astype(np.int32))],
        names=["token", "node", "n", "at"])


def bodies(docs: DataFrame, like: Likeness, asked: DataFrame) -> DataFrame:
    """``node, body``: the whole sets of the asked nodes. ``asked`` has ``node`` and the id of a document of it.

    A bitmap of fixed size over ids keeps other texts from being hashed and moved; the join decides.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(_ID_BITS))
    marked = np.zeros(_ID_BITS // 8, np.uint8)
    for row in (
        asked.groupBy(F.floor(place / 32768).cast("int").alias("part"))
        .agg(F.bitmap_construct_agg(F.pmod(place, F.lit(32768))).alias("bits")).collect()
    ):
        marked[row["part"] * 4096:(row["part"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    held = docs.sparkSession.sparkContext.broadcast(marked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("place").to_numpy()
            batch = batch.filter(pa.array((held.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            gram, size = gram_sets(utf8_values(batch.column("text")), like.width)
            ends = np.cumsum(size)
            node, first = np.unique(digests(gram, size), return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array([gram[ends[k] - size[k]:ends[k]].tobytes() for k in first], pa.binary())], names=["node", "body"])

    made = docs.select(place.alias("place"), "text").mapInArrow(run, "node bigint, body binary")
    return made.join(asked.select("node"), "node", "left_semi").groupBy("node").agg(F.first("body").alias("body"))


# --- candidates ------------------------------------------------------------------------------------


def led(shared: DataFrame, profile: DataFrame, like: Likeness) -> DataFrame:
    """``u, v``: each member of a key with the leader of its key and size class, the one with the smallest digest."""
    step = np.log(like.whole / like.part)
    classed = shared.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.lit(float(step))))
    leader = classed.groupBy("token", "class").agg(F.min(F.struct("node", "n", "at")).alias("l"))
    n, at, m, to = (F.col(c).cast("bigint") for c in ("n", "at", "l.n", "l.at"))
    room = (like.whole * F.least(n, m) >= like.part * F.greatest(n, m)) & (
        (like.whole + like.part) * F.least(n - at, m - to) >= like.part * (n + m))
    met = classed.join(leader, ["token", "class"]).where((F.col("node") != F.col("l.node")) & room).select(
        F.col("node").alias("u"), F.col("l.node").alias("v")).distinct()
    return agreed(met, profile, like)


def agreed(pairs: DataFrame, profile: DataFrame, like: Likeness) -> DataFrame:
    """Those of ``u, v`` whose profiles leave room. ``profile``: ``node, n, profile``."""
    one, other = profile.toDF("u", "n", "p"), profile.toDF("v", "m", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "m"))
            fits = like.agree(n, _profile_rows(batch.column("p")), m, _profile_rows(batch.column("q")))
            yield batch.select(["u", "v"]).filter(pa.array(fits))

    return pairs.join(one, "u").join(other, "v").select("u", "v", "n", "m", "p", "q").mapInArrow(run, "u bigint, v bigint")


def blocked(rows: DataFrame) -> DataFrame:
    """Rows with ``x, y, own``: a key of many sets is dealt out in pairs of blocks; ``own`` is a row's own block.

    Few keys have more than one block, so that the rows needn't move to learn it.
    """
    many = rows.groupBy("token").agg(F.count("*").alias("sets")).where(F.col("sets") > BLOCK)
    many = many.select("token", F.ceil(F.col("sets") / F.lit(BLOCK)).cast("int").alias("blocks"))
    sized = rows.join(many, "token", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    return sized.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("token", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "root", "node", "n", "at", "profile")


def distant(rows: DataFrame, like: Likeness, low: int, high: int) -> DataFrame:
    """``u, v`` of different components that are more than ``low`` and at most ``high`` places apart by size in a key."""

    def pairs(rows: np.ndarray, profile: np.ndarray) -> Iterator[np.ndarray]:
        for d in range(low + 1, min(high, len(rows) - 1) + 1):
            a = np.flatnonzero((rows[d:, :3] == rows[:-d, :3]).all(1))
            if not len(a):
                return
            b = a + d
            x, y = rows[a], rows[b]
            # Within a block in its pair with itself; between two blocks in theirs.
            fits = (x[:, 4] != y[:, 4]) & ((x[:, 3] != y[:, 3]) | (x[:, 1] == x[:, 2])) & like.room(x[:, 6], x[:, 7], y[:, 6], y[:, 7])
            a, b = a[fits], b[fits]
            fits = like.agree(rows[a, 6], profile[a], rows[b, 6], profile[b])
            pair = rows[:, 5][np.stack([a[fits], b[fits]], 1)]
            if len(pair):
                yield np.stack([pair.max(1), pair.min(1)], 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_keys(batches):
            profile = _profile_rows(part.column("profile"))
            for found in pairs(_ints(part.drop_columns(["profile"])), profile):
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["u", "v"])

    dealt = rows.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y", "n", "node")
    return dealt.mapInArrow(run, "u bigint, v bigint").distinct()


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Many keys at once, each of them whole; no key has more rows than two blocks."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= _FEED:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            key = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("token", "x", "y")], 1)
            change = np.flatnonzero((key[1:] != key[:-1]).any(1))
            if len(change):
                cut = int(change[-1]) + 1
                yield rows.slice(0, cut)
                rows = rows.slice(cut)
            held, count = [rows], rows.num_rows
    if count:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


# --- verification ----------------------------------------------------------------------------------


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, like: Likeness, scratch: Scratch) -> DataFrame:
    """Those of the distinct ``u, v`` whose whole sets are alike: the set of ``v`` goes out once for a chunk of members.

    Only sets of candidates are made again from their texts and written down.
    """
    many = pairs.count()
    asked = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    asked = scratch.stored(few(nodes.select("node", "doc_id").join(asked, "node", "left_semi"), 2 * many), "asked")
    sets = scratch.stored(few(bodies(docs, like, asked), SET_ROWS * 2 * many), "sets")
    size = scratch.stored(few(pairs.groupBy("v").agg(F.ceil(F.count("*") / F.lit(CHUNK)).cast("int").alias("chunks")), many), "leaders")
    leader = size.join(sets, size["v"] == sets["node"]).select(
        "v", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(None).cast("bigint").alias("u"), "body")
    # Written down: joins of plain exchanges are those whose hot keys adaptive execution splits.
    placed = scratch.stored(pairs.join(size, "v").select("v", F.pmod(F.xxhash64("u"), "chunks").cast("int").alias("chunk"), "u"), "placed")
    member = placed.join(sets, placed["u"] == sets["node"]).select("v", "chunk", "u", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, body = None, None
        for batch in batches:
            us, vs = [], []
            for v, u, raw in zip(*(batch.column(c).to_pylist() for c in ("v", "u", "body"))):
                if u is None:
                    own, body = v, np.frombuffer(raw, np.uint64)
                elif v == own and like.alike(body, np.frombuffer(raw, np.uint64)):
                    us.append(u)
                    vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    together = leader.unionByName(member).repartition("v", "chunk").sortWithinPartitions("v", "chunk", F.asc_nulls_first("u"))
    return few(together.mapInArrow(run, "u bigint, v bigint"), SET_ROWS * 2 * many)


# --- the join --------------------------------------------------------------------------------------


def linked(docs: DataFrame, log: DataFrame, weights: np.ndarray, like: Likeness, scratch: Scratch,
           first: DataFrame | None = None) -> DataFrame:
    """``node, root`` for every set that is alike to another one. ``first``: ``u, v`` to be verified beside the leaders."""
    held = docs.sparkSession.sparkContext.broadcast(weights)
    nodes = scratch.stored(few(
        log.where("n > 0").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("profile").alias("profile")), log.count()), "nodes")
    shared = scratch.stored(shared_keys(prefixes(docs, like, held)), "shared")
    size = PROFILE_ROWS * shared.count()
    rows = shared.join(nodes.select("node", "profile"), "node").select("token", "node", "n", "at", "profile")
    rows = scratch.stored(few(rows, size), "rows")
    pairs = few(led(shared, nodes.select("node", "n", "profile"), like), size)
    if first is not None:
        pairs = pairs.unionByName(first).distinct()
    tried = scratch.stored(pairs, "pairs")
    links = scratch.stored(verified(tried, docs, nodes, like, scratch), "links")
    low, high, roots = 0, NEAREST, None
    while True:
        if roots is None:
            roots = scratch.stored(components(links, scratch.stored, written=True), "roots")
            named = scratch.stored(
                rows.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "named")
        # Open: several components, and members farther apart than was looked at. A pair of blocks has some
        # 2 * BLOCK sets, and never twice as many.
        seen = named.groupBy("token").agg(
            F.min("root").alias("least"), F.max("root").alias("most"), F.least(F.count("*"), F.lit(4 * BLOCK)).alias("size"))
        open_ = scratch.stored(few(
            seen.where((F.col("least") != F.col("most")) & (F.col("size") > low + 1)).select("token"), named.count()), "open")
        if not open_.take(1):
            return roots
        # Most keys are open at first, few later on; sets of one component don't meet in any case.
        rows = scratch.stored(named.join(open_, "token", "left_semi"), "rows") if low else named
        pairs = scratch.stored(distant(blocked(rows), like, low, high).join(tried, ["u", "v"], "left_anti"), "pairs")
        low, high, named = high, high * GROWTH, rows
        if pairs.take(1):
            tried = tried.unionByName(pairs)
            more = scratch.stored(verified(pairs, docs, nodes, like, scratch), "links")
            if more.take(1):
                links, roots = links.unionByName(more), None


def near_duplicates(
    docs: DataFrame, like: Likeness = Likeness(), first: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``doc_id, n_grams, component_id``: set size, and the smallest id that links reach.

    ``first`` makes ``u, v`` of set digests from the log of ``doc_id, node``, to be verified beside the leaders.
    """
    scratch = Scratch(docs.sparkSession, "ngram-join")
    docs = docs.select("doc_id", "text")
    scan = scratch.stored(scanned(docs, like), "scan")
    log = scan.where("block IS NULL").select("doc_id", "node", "n", "profile")
    roots = linked(docs, log, rarity(scan), like, scratch, first and first(log.where("n > 0").select("doc_id", "node")))
    count = log.count()
    least = scratch.stored(few(log.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least")), count), "least")
    rooted = least.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    rooted = scratch.stored(few(rooted, count), "rooted")
    named = scratch.stored(few(rooted.groupBy("root").agg(F.min("least").alias("component_id")), count), "components")
    named = scratch.stored(few(rooted.join(named, "root").select("node", "component_id"), count), "classes")
    told = log.where("n > 0").join(named, "node").select("doc_id", "n", "component_id")
    alone = log.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    result = told.unionByName(alone).select("doc_id", F.col("n").cast("long").alias("n_grams"), "component_id")
    result = stored(few(result, count), "ngram-joined")
    scratch.drop()
    return result


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents
), s AS (
  SELECT doc_id, row, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g FROM d
), sets AS (SELECT g, min(row) AS node, len(g) AS n FROM (SELECT row, list_sort(g) AS g FROM s) WHERE len(g) > 0 GROUP BY g),
grams AS (SELECT node, n, unnest(g) AS gram FROM sets),
links AS (
  SELECT a.node AS a, b.node AS b FROM grams a JOIN grams b ON a.gram = b.gram AND a.node <> b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT node AS a, node AS b FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), member AS (SELECT s.doc_id, s.row, sets.node FROM s JOIN sets ON list_sort(s.g) = sets.g),
least AS (SELECT node, min(doc_id) AS doc_id FROM member GROUP BY node),
class AS (SELECT reach.a AS node, min(least.doc_id) AS component_id FROM reach JOIN least ON reach.b = least.node GROUP BY reach.a)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles,
  CASE WHEN len(s.g) = 0 THEN s.doc_id ELSE class.component_id END AS component_id
FROM s LEFT JOIN member ON s.row = member.row LEFT JOIN class ON member.node = class.node
"""


@query("op13_ngram_join", SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), Likeness(4, 85, 100)).withColumnRenamed("n_grams", "n_shingles")
