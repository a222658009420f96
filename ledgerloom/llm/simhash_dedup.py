"""SimHash near-deduplication with a Gray-order hierarchical index.

1. One pass over whole texts gives a 64-bit fingerprint per document (word shingles, XXH64 with a seed;
   a bit is set if it is set in over half of the shingles, repeats included).
2. Only distinct fingerprints go on. Of ``most + j`` blocks of bits, two linked fingerprints agree in at
   least ``j``; every choice of ``j`` blocks is a key, so linked fingerprints share a bucket. ``j`` follows
   from the number of fingerprints so that buckets stay small; a bucket that is hot nevertheless is
   keyed again on blocks of its remaining bits. This is exact for every ``j``.
3. In a bucket, fingerprints are sorted by Gray rank. Groups of eight neighbours get a node that holds
   the bits they share (mask and pattern), groups of nodes likewise up to the root. Pairs of nodes
   are searched from the root: differing bits accumulate over what is newly shared at each level, and
   whole groups drop out beyond ``most`` differences, or when they are known to be linked already. A bucket
   gives a star of links, never all its pairs.
4. Stars meet in connected components (large star, small star), each round written to the shared
   folder. Nothing but counts reaches the driver.

A text without words has fingerprint zero and links like any other; null text counts as empty. Equal
rows share fingerprint and component. Rows without an id take the smallest id of their component, if
there is one. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import batches_with, few, query, stored, table

SEED = 42
BITS = 64
FAN = 8
BUCKET_GOAL = 64
# Fingerprints of one bucket that a task takes at once (some 100 bytes each).
HOT_BUCKET = 200_000
DEEPEST = 4
_FRONTIER = 1 << 19
_FEED = 1 << 17


def fingerprint(text: bytes, width: int) -> int:
    """The fingerprint of one text as a signed 64-bit integer."""
    words = text.lower().split()  # A-Z only; ASCII white space
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[:-width].tolist()]
        stops = (ends[width - 1:] - 1).tolist()
        shingles = [line[a:b] for a, b in zip(starts, stops)]
    count, ones = len(shingles), np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, 1 << 15):
        part = shingles[at:at + (1 << 15)]
        h = np.fromiter((digest(s, SEED) for s in part), np.uint64, len(part)).astype("<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 5) -> DataFrame:
    """``docs`` with ``fp``."""
    return batches_with(
        docs, "text", {"fp": pa.int64()}, {"fp": "bigint"},
        lambda texts: {"fp": [fingerprint(t, width) for t in texts]},
    )


# --- the index of one bucket, or of many at once -------------------------------------------------


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each word in the reflected Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


class Level:
    """Nodes over consecutive children: what all below share, and where the children are."""

    def __init__(self, pattern, mask, bucket, first, count):
        self.pattern, self.mask, self.bucket, self.first, self.count = pattern, mask, bucket, first, count

    def above(self) -> Level:
        begin = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        within = np.arange(len(self.bucket)) - np.repeat(begin, np.diff(begin, append=len(self.bucket)))
        first = np.flatnonzero(within % FAN == 0)
        count = np.diff(first, append=len(self.bucket))
        lead = np.repeat(self.pattern[first], count)
        mask = np.bitwise_and.reduceat(self.mask & ~(self.pattern ^ lead), first)
        return Level(self.pattern[first] & mask, mask, self.bucket[first], first, count)


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of ``a[i]`` and ``b[i]``; a label is always the smallest member."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        parent = np.arange(len(label))
        np.minimum.at(parent, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            higher = parent[parent]
            if (higher == parent).all():
                break
            parent = higher
        label[:] = parent[label]


def link(bucket: np.ndarray, fp: np.ndarray, most: int) -> np.ndarray:
    """Class of each fingerprint among those of its bucket, as the position of a member.

    Rows of a bucket stand together. Two are in one class if a chain of pairs with ``most`` or fewer
    differing bits leads from one to the other.
    """
    size = len(fp)
    order = np.lexsort((gray_rank(fp), bucket))
    fp, bucket = fp[order], np.cumsum(np.diff(bucket[order], prepend=bucket[order][0]) != 0)
    label = np.arange(size)
    near = (np.bitwise_count(fp[1:] ^ fp[:-1]) <= most) & (bucket[1:] == bucket[:-1])
    at = np.flatnonzero(near)
    _unite(label, at, at + 1)

    leaf = Level(fp, np.full(size, ~np.uint64(0)), bucket, np.arange(size), np.ones(size, np.int64))
    levels = [leaf]
    while len(levels[-1].bucket) > bucket[-1] + 1:
        levels.append(levels[-1].above())
    top = len(levels) - 1
    # Leaves below each node, to see whether they are linked already.
    below = [np.arange(size)]
    for level in levels[1:]:
        below.append(below[-1][level.first])
    ends = [np.append(b[1:], size) for b in below]

    roots = np.arange(len(levels[top].bucket))
    stack = [(top, roots, roots, np.zeros(len(roots), np.int16), np.zeros(len(roots), np.uint64))]
    while stack:
        depth, a, b, diff, shared = stack.pop()
        if len(a) > _FRONTIER:
            half = len(a) // 2
            stack.append((depth, a[half:], b[half:], diff[half:], shared[half:]))
            stack.append((depth, a[:half], b[:half], diff[:half], shared[:half]))
            continue
        level = levels[depth]
        both = level.mask[a] & level.mask[b]
        fresh = both & ~shared
        diff = diff + np.bitwise_count((level.pattern[a] ^ level.pattern[b]) & fresh)
        keep = diff <= most
        if depth == 0:
            keep &= a != b
            _unite(label, a[keep], b[keep])
            continue
        # Groups whose members all are in one class already have nothing to add.
        least = np.minimum.reduceat(label, below[depth])
        greatest = np.maximum.reduceat(label, below[depth])
        keep &= ~((least[a] == greatest[a]) & (least[b] == greatest[b]) & (least[a] == least[b]))
        a, b, diff, both = a[keep], b[keep], diff[keep], both[keep]
        if not len(a):
            continue
        per = level.count[a] * level.count[b]
        pair = np.repeat(np.arange(len(a)), per)
        step = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
        wide = level.count[b][pair]
        left = level.first[a][pair] + step // wide
        right = level.first[b][pair] + step % wide
        ordered = left <= right
        pair = pair[ordered]
        stack.append((depth - 1, left[ordered], right[ordered], diff[pair], both[pair]))
    found = np.empty(size, np.int64)
    found[order] = order[label]
    return found


# --- buckets ---------------------------------------------------------------------------------------


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def masks(bits: list[int], blocks: int, exact: int) -> list[int]:
    """Bit masks of every choice of ``exact`` out of ``blocks`` even blocks of the given bit positions."""
    cuts = [len(bits) * i // blocks for i in range(blocks + 1)]
    parts = [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:])]
    return [sum(parts[i] for i in chosen) for chosen in combinations(range(blocks), exact)]


def first_masks(count: int, most: int) -> list[int]:
    """Keys for so many fingerprints: the fewest agreeing blocks that keep even buckets small."""
    exact = 1
    while exact < 4 and count >> (BITS * exact // (most + exact)) > BUCKET_GOAL:
        exact += 1
    return masks(list(range(BITS)), most + exact, exact)


def bucketed(prints: DataFrame, count: int, most: int, hot: int = HOT_BUCKET, stored=stored) -> DataFrame:
    """``fp`` -> ``mask, key, fp``: a row for each bucket that a fingerprint belongs to."""
    rows = F.array(*[F.struct(F.lit(_signed(m)).alias("mask"),
                              F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for m in first_masks(count, most)])
    rows, done = prints.select("fp", F.inline(rows)).select("mask", "key", "fp"), None
    for _ in range(DEEPEST):
        full = stored(rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot), "simhash-hot")
        if not full.take(1):
            break
        calm = rows.join(full, ["mask", "key"], "left_anti")
        done = calm if done is None else done.unionByName(calm)
        # Members of a hot bucket differ in its remaining bits only: their blocks refine the key.
        finer = []
        for row in full.select("mask").distinct().collect():  # no more than there are choices of blocks
            free = [b for b in range(BITS) if not (row["mask"] >> b) & 1]
            own = row["mask"] & ((1 << BITS) - 1)
            more = masks(free, most + 1, 1) if len(free) > most else [0]
            finer += [(row["mask"], _signed(own | m)) for m in more]
        finer = prints.sparkSession.createDataFrame(finer, "mask bigint, finer bigint")
        rows = stored(
            rows.join(full, ["mask", "key"], "left_semi").join(F.broadcast(finer), "mask")
            .select(F.col("finer").alias("mask"), F.col("fp").bitwiseAND(F.col("finer")).alias("key"), "fp"),
            "simhash-finer",
        )
    return rows if done is None else done.unionByName(rows)


def bucket_links(buckets: DataFrame, most: int) -> DataFrame:
    """``u, v`` with ``v < u``: per bucket and class, each member and the smallest."""

    def linked(rows: np.ndarray) -> pa.RecordBatch:
        change = np.any(rows[1:, :2] != rows[:-1, :2], axis=1)
        bucket = np.concatenate([[0], np.cumsum(change)])
        size = np.bincount(bucket)
        rows, bucket = rows[size[bucket] > 1], bucket[size[bucket] > 1]
        if not len(rows):
            return None
        fp = np.ascontiguousarray(rows[:, 2])
        owner = link(bucket, fp.view(np.uint64), most)
        least = fp.copy()
        np.minimum.at(least, owner, fp)
        least = least[owner]
        edge = np.unique(np.stack([fp, least], 1)[fp != least], axis=0)
        return pa.RecordBatch.from_arrays([pa.array(edge[:, 0]), pa.array(edge[:, 1])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(np.stack([c.to_numpy() for c in batch.columns], 1))
            count += len(held[-1])
            if count >= _FEED:
                rows = np.concatenate(held)
                last = rows[-1, :2]
                cut = np.flatnonzero(np.any(rows[:, :2] != last, axis=1))
                cut = int(cut[-1]) + 1 if len(cut) else 0
                # The last bucket may go on in the next batch.
                if cut and (made := linked(rows[:cut])) is not None:
                    yield made
                held, count = [rows[cut:]], (len(rows) - cut if cut else 0)
        if held and len(rows := np.concatenate(held)) and (made := linked(rows)) is not None:
            yield made

    together = buckets.repartition("mask", "key").sortWithinPartitions("mask", "key")
    return together.select("mask", "key", "fp").mapInArrow(run, "u bigint, v bigint")


# --- components ------------------------------------------------------------------------------------


def components(links: DataFrame, stored=stored, written: bool = False) -> DataFrame:
    """``node, root`` for every node of the undirected ``u, v``: the smallest node it reaches.

    Rounds end as soon as the links are stars: no round is needed to see that nothing changes any more.
    ``written``: the links are a table already, and distinct.
    """
    edges = links if written else stored(links.distinct(), "components-edges")
    while True:
        # No round has more links than the one before but for a node's link to the smallest it sees.
        size = 2 * edges.count()
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written down: a join of plain exchanges is one whose hot node adaptive execution splits.
        low = stored(few(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), size), "components-low")
        large = stored(few(
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct(), size),
            "components-large",
        )
        # Every pair now points from the larger node to the smaller.
        low = stored(few(large.groupBy("u").agg(F.min("v").alias("m")), size), "components-low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = stored(few(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), size), "components-edges")
        if stars(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def stars(edges: DataFrame) -> bool:
    """Whether no ``u`` has several ``v`` or is a ``v`` itself. Rounds keep what is connected, so a star is a whole component."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in")))))
    seen = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return seen.agg(F.count_if(F.expr("out > 1 OR (out = 1 AND `in` = 1)"))).first()[0] == 0


def near_duplicates(docs: DataFrame, width: int = 5, most: int = 4, hot: int = HOT_BUCKET, stored=stored) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest id that links of ``most`` differing bits reach.

    ``stored`` writes the tables in between; the result still reads some of them.
    """
    log = stored(fingerprints(docs.select("doc_id", "text"), width).select("doc_id", "fp"), "simhash-log")
    prints = stored(log.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    count = prints.count()
    links = bucket_links(bucketed(prints.select("fp"), count, most, hot, stored), most)
    roots = components(links, stored).select(F.col("node").alias("fp"), "root")
    rooted = stored(
        few(prints.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), count),
        "simhash-rooted",
    )
    least = stored(few(rooted.groupBy("root").agg(F.min("least").alias("component_id")), count), "simhash-least")
    named = stored(few(rooted.join(least, "root").select("fp", "component_id"), count), "simhash-components")
    return log.join(named, "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, width: int = 5, most: int = 4) -> DataFrame:
    """One document of each group with all its columns: that with the smallest id.

    Rows that share an id count as one document; rows without an id stay if their whole group has none.
    """
    found = near_duplicates(docs, width, most).where("doc_id <=> component_id")
    keep = found.select(F.col("doc_id").alias("_keep")).distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(keep["_keep"]), "left_semi")


@query("op9_simhash_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates(docs, width=4, most=4).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
