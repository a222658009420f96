"""Tables compared by commutative digests of key ranges, descended like a hash tree.

A range of the key's hash has the number of its rows and two sums over row hashes; sums don't depend on the order
of rows and count copies. Both sides add up per range where their rows lie, so tables of any size are
compared by what is at most ``1 << FAN`` rows a task and pass. Only ranges that differ are looked at again, in ranges
``1 << FAN`` times finer, until they are small; only the rows of those are exchanged and netted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.operators.compare import differing_rows
from ledgerloom.session import cut

FAN = 12
# Ranges that hold fewer rows than this on both sides together are not divided further.
SMALL_RANGE = 10_000
# So many differing ranges, and no more, go out to the tasks as a filter (16 bytes each).
MOST_RANGES = 1 << 16
DEEPEST = 60


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """A hash over values and over which of them are null: nulls alone would leave it as it was."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def range_of(key: Sequence[str], width: int) -> Column:
    """The first ``width`` bits of the key's hash."""
    return F.shiftrightunsigned(row_hash(key, 0), 64 - width)


def range_digests(frame: DataFrame, key: Sequence[str], width: int) -> DataFrame:
    """Rows and two row-hash sums of each range; they combine before the shuffle."""
    exact = [F.sum(row_hash(frame.columns, seed).cast("decimal(20,0)")).alias(name) for seed, name in ((1, "sum_a"), (2, "sum_b"))]
    return frame.groupBy(range_of(key, width).alias("range")).agg(F.count("*").alias("rows"), *exact)


def compared_ranges(left: DataFrame, right: DataFrame, key: Sequence[str], width: int) -> DataFrame:
    """``range, rows, differs`` for every range that either side has rows in."""
    a, b = range_digests(left, key, width), range_digests(right, key, width)
    same = F.lit(True)
    for c in ("rows", "sum_a", "sum_b"):
        same = same & a[c].eqNullSafe(b[c])
    return a.join(b, "range", "full_outer").select(
        "range", (F.coalesce(a["rows"], F.lit(0)) + F.coalesce(b["rows"], F.lit(0))).alias("rows"), (~same).alias("differs"))


def of_ranges(frame: DataFrame, key: Sequence[str], width: int, ranges: DataFrame) -> DataFrame:
    """Rows whose range is one of the given ones, which are few (``MOST_RANGES``)."""
    return frame.withColumn("_range", range_of(key, width)).join(
        F.broadcast(ranges.select(F.col("range").alias("_range"))), "_range", "left_semi").drop("_range")


def differing_ranges(
    left: DataFrame, right: DataFrame, key: Sequence[str], small: int = SMALL_RANGE,
) -> tuple[DataFrame, int, int]:
    """The finest ranges looked at that differ, their width in bits, and how many passes it took.

    Descends while ranges are large and few enough to be told to every task. Where most of the table differs, there is
    nothing to be gained, and it stops.
    """
    width, passes, chosen = FAN, 0, (left, right)
    while True:
        passes += 1
        seen = cut(compared_ranges(*chosen, key, width))
        wrong = seen.filter("differs")
        total, count, rows = seen.agg(
            F.coalesce(F.sum("rows"), F.lit(0)), F.count_if("differs"),
            F.coalesce(F.sum(F.when(F.col("differs"), F.col("rows"))), F.lit(0)),
        ).first()
        if not count or rows <= small * count or count > MOST_RANGES or 2 * rows > total or width + FAN > DEEPEST:
            return wrong.select("range", "rows"), width, passes
        chosen = tuple(of_ranges(frame, key, width, wrong) for frame in (left, right))
        width += FAN


def differing_rows_by_digest(
    left: DataFrame, right: DataFrame, key: Sequence[str] | None = None, small: int = SMALL_RANGE,
) -> DataFrame:
    """What ``differing_rows`` gives, exchanging the rows of differing ranges alone; of equal tables none.

    ``key`` names the columns whose hash makes the ranges: both versions of a changed row then fall into one.
    """
    right = right.select(*left.columns)
    key = list(key or left.columns)
    ranges, width, _ = differing_ranges(left, right, key, small)
    count = ranges.count()
    if not count:
        return differing_rows(left.limit(0), right.limit(0))
    if count > MOST_RANGES:
        return differing_rows(left, right)
    return differing_rows(of_ranges(left, key, width, ranges), of_ranges(right, key, width, ranges))


def same_by_digest(left: DataFrame, right: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """One row: rows of either side, and whether the two are equal as multisets."""
    right = right.select(*left.columns)
    key = list(key or left.columns)
    a, b = range_digests(left, key, FAN), range_digests(right, key, FAN)
    same = a["rows"].eqNullSafe(b["rows"]) & a["sum_a"].eqNullSafe(b["sum_a"]) & a["sum_b"].eqNullSafe(b["sum_b"])
    both = a.join(b, "range", "full_outer").select(a["rows"].alias("l"), b["rows"].alias("r"), same.alias("same"))
    return both.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"), F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
        (F.count_if(~F.col("same")) == 0).alias("equal"))
