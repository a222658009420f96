"""Compression of vectors to product codes, with Orchard's search for the nearest entry.

1. Components become integers, ``floor(scale * x)``. A vector is cut into equal consecutive parts, and each part
   position has a codebook of its own, which starts as that part of the vectors with the smallest ids.
2. A round of Lloyd's method assigns every part to its nearest entry and replaces each entry by the floor of its
   parts' mean. Tasks hand on sums and counts per entry and dimension, whose number doesn't grow with the table;
   Spark adds them up.
3. The nearest entry is found by Orchard's search: every entry has a list of all others by distance. From a current
   entry its list is walked; a nearer entry becomes the current one and its list goes on; entries seen before are
   marked and skipped; beyond twice the distance to the current entry nothing on the list can be nearer. All in
   integers, so that ties are ties: they go to the lower index.

Vectors that are null or have null or non-finite components are dropped. Vectors whose length isn't a multiple of
the number of parts, or shorter than the longest, are filled up with zeros (an empty vector is all zeros). Integers
are kept within 2**25 of zero, so that sums of squares fit 64 bits. Fewer vectors than entries give as many entries as
there are vectors; of several vectors with one id the order is that of their components, null ids come last. An unused
entry stays. Labels: nulls count as one. An empty table gives an empty result. ``encode`` replaces columns of the
input named ``code`` and ``error``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.common import query, table

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LARGEST = 1 << 25


@dataclass
class Codebooks:
    """``entries[part, entry, position]``, and for each entry of a part all entries by distance."""

    entries: np.ndarray
    length: int

    def __post_init__(self):
        gap = self.entries[:, :, None, :] - self.entries[:, None, :, :]
        gap = np.einsum("pijd,pijd->pij", gap, gap)
        self.order = np.argsort(gap, axis=2, kind="stable").astype(np.int64)
        self.gap = np.take_along_axis(gap, self.order, 2)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integers(column: pa.Array, length: int, scale: int = SCALE) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros to ``length``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    made = np.zeros((len(size), length), np.int64)
    made[np.arange(length) < size[:, None]] = np.clip(flat, -LARGEST, LARGEST).astype(np.int64)
    return made


def nearest(points: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every part of ``points[row, part, position]``."""
    rows, parts, width = points.shape
    count = books.entries.shape[1]
    points = points.reshape(rows * parts, width)
    part = np.tile(np.arange(parts), rows)
    now = np.zeros(len(points), np.int64)
    gap = points - books.entries[part, now]
    best = np.einsum("nd,nd->n", gap, gap)
    place = np.ones(len(points), np.int64)
    seen = np.zeros((len(points), count), bool)
    seen[:, 0] = True
    going = np.arange(len(points)) if count > 1 else np.empty(0, np.int64)
    while len(going):
        p, c, at = part[going], now[going], place[going]
        # Beyond twice the distance (four times the squared one) every entry is farther than the current one.
        open_ = books.gap[p, c, at] <= 4 * best[going]
        going, p, c, at = going[open_], p[open_], c[open_], at[open_]
        other = books.order[p, c, at]
        place[going] += 1
        fresh = ~seen[going, other]
        who, other, p = going[fresh], other[fresh], p[fresh]
        seen[who, other] = True
        gap = points[who] - books.entries[p, other]
        found = np.einsum("nd,nd->n", gap, gap)
        nearer = (found < best[who]) | ((found == best[who]) & (other < now[who]))
        who, other = who[nearer], other[nearer]
        now[who], best[who], place[who] = other, found[nearer], 0
        going = going[place[going] < count]
    return now.reshape(rows, parts), best.reshape(rows, parts)


def kept_rows(vectors: DataFrame, vector: str) -> DataFrame:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col(vector).isNotNull() & finite)


def start(vectors: DataFrame, ident: str, vector: str, parts: int, entries: int, scale: int) -> Codebooks:
    """Codebooks from the parts of the first vectors by id."""
    longest = vectors.agg(F.max(F.size(vector))).first()[0] or 0
    length = -(-max(longest, 1) // parts) * parts
    first = vectors.orderBy(F.col(ident).asc_nulls_last(), vector).select(vector).limit(entries).toArrow()
    made = integers(first[vector], length, scale).reshape(-1, parts, length // parts)
    return Codebooks(np.ascontiguousarray(made.transpose(1, 0, 2)), length)


def refined(vectors: DataFrame, vector: str, books: Codebooks, scale: int) -> Codebooks:
    """One round: every entry becomes the floor of the mean of the parts assigned to it."""
    parts, count, width = books.entries.shape
    held = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        total, size = np.zeros((parts, count, width), np.int64), np.zeros((parts, count), np.int64)
        for batch in batches:
            points = integers(batch.column(0), books.length, scale).reshape(-1, parts, width)
            entry, _ = nearest(points, books)
            where = np.broadcast_to(np.arange(parts), entry.shape)
            np.add.at(total, (where, entry), points)
            np.add.at(size, (where, entry), 1)
        part, entry = np.nonzero(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(part * count + entry, width)), pa.array(np.tile(np.arange(width), len(part))),
             pa.array(total[part, entry].ravel()), pa.array(np.repeat(size[part, entry], width))],
            names=["slot", "position", "total", "size"],
        )

    sums = (
        vectors.select(vector).mapInArrow(run, "slot bigint, position bigint, total bigint, size bigint")
        .groupBy("slot", "position").agg(F.sum("total").alias("total"), F.sum("size").alias("size")).toArrow()
    )
    slot, position, total, size = (sums[c].to_numpy() for c in ("slot", "position", "total", "size"))
    entries = books.entries.copy()
    entries[slot // count, slot % count, position] = total // size
    return Codebooks(entries, books.length)


def fit(
    vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> Codebooks | None:
    """Codebooks of a table of vectors; none for a table without any."""
    vectors = kept_rows(vectors, vector).select(ident, vector)
    if not vectors.take(1):
        return None
    books = start(vectors, ident, vector, parts, entries, scale)
    for _ in range(rounds):
        books = refined(vectors, vector, books, scale)
    return books


def encode(vectors: DataFrame, books: Codebooks | None, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The kept rows with ``code`` (two hex digits a part, or as many as an index needs) and ``error``."""
    columns = [c for c in vectors.columns if c not in ("code", "error")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema if f.name in columns]
                       + ["code string", "error bigint"])
    vectors = kept_rows(vectors.select(columns), vector)
    if books is None:
        return vectors.selectExpr("*", "string(null) AS code", "bigint(null) AS error").where("false")
    parts, count, width = books.entries.shape
    held = vectors.sparkSession.sparkContext.broadcast(books)
    digits = max(2, len(f"{count - 1:x}"))
    names = [f"{i:0{digits}x}" for i in range(count)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        for batch in batches:
            points = integers(batch.column(vector), books.length, scale).reshape(-1, parts, width)
            entry, gap = nearest(points, books)
            code = ["".join(names[e] for e in row) for row in entry.tolist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(code, pa.string()), pa.array(gap.sum(1))], names=[*columns, "code", "error"])

    return vectors.mapInArrow(run, schema)


def decode(code: str, books: Codebooks) -> list[int]:
    """The whole numbers that a code stands for."""
    parts, count, _ = books.entries.shape
    digits = len(code) // parts
    return np.concatenate([books.entries[p, int(code[p * digits:(p + 1) * digits], 16)] for p in range(parts)]).tolist()


def _assigned(k: int) -> str:
    return f"""
a{k} AS (
  SELECT p.row, p.part, any_value(p.s) AS s, min({{'gap': list_sum(list_transform(range(1, len(p.s) + 1),
    lambda i: (p.s[i] - b.s[i]) * (p.s[i] - b.s[i]))), 'entry': b.entry}}) AS best
  FROM p JOIN b{k} b ON p.part = b.part GROUP BY p.row, p.part
)"""


def _refined(k: int) -> str:
    return f"""
m{k} AS (
  SELECT part, best.entry AS entry, i, floor_div(sum(x), count(*)) AS x
  FROM (SELECT part, best, unnest(range(1, len(s) + 1)) AS i, unnest(s) AS x FROM a{k - 1}) GROUP BY ALL
), b{k} AS (
  SELECT b.part, b.entry, coalesce(m.s, b.s) AS s FROM b{k - 1} b
  LEFT JOIN (SELECT part, entry, list(x ORDER BY i) AS s FROM m{k} GROUP BY ALL) m ON b.part = m.part AND b.entry = m.entry
)"""


SQL = f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS row,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT row, part, v[part * len(v) // {PARTS} + 1:(part + 1) * len(v) // {PARTS}] AS s FROM kept, range({PARTS}) t(part)
), b0 AS (SELECT part, row - 1 AS entry, s FROM p WHERE row <= {ENTRIES}),
{",".join(_assigned(k) + "," + _refined(k + 1) for k in range(ROUNDS))},{_assigned(ROUNDS)}
, coded AS (
  SELECT row, string_agg(lower(lpad(hex(best.entry), 2, '0')), '' ORDER BY part) AS code, sum(best.gap)::BIGINT AS error
  FROM a{ROUNDS} GROUP BY row
)
SELECT k.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(s, ','), ',' ORDER BY part, entry)) FROM b{ROUNDS}) AS codebooks_sha256
FROM kept k JOIN coded c ON k.row = c.row
""".replace("floor_div(sum(x), count(*))", "((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT")


@query("op12_vector_codes", SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    books = fit(vectors)
    coded = encode(vectors, books).drop("embedding")
    # Summed before the shuffle; the join back meets one row a label, and adaptive execution splits a hot one.
    labels = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(labels, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256")
    )
