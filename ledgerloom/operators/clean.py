"""Row-level cleaning: quarantine, flags, redelivery."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def quarantine(
    rows: DataFrame, required: dict[str, tuple[str, str]], corrupt: str | None = None
) -> DataFrame:
    """Parse required fields and say why a row is bad; the input is kept whole.

    ``required`` maps a new column to (source column, type). ``corrupt`` names the column that holds
    the text of a row that no reader could take apart; such a row has that one reason.
    ``bad_reason`` is null on good rows.
    """
    parsed = rows.withColumns(
        {new: F.col(source).try_cast(kind) for new, (source, kind) in required.items()}
    )
    reasons = [
        F.when(F.col(source).isNull(), F.lit(f"{source} is missing"))
        .when(F.col(new).isNull(), F.lit(f"{source} is not {kind}"))
        for new, (source, kind) in required.items()
    ]
    text = F.concat_ws("; ", *reasons)
    if corrupt:
        text = F.when(F.col(corrupt).isNotNull(), "row is corrupt").otherwise(text)
    return parsed.withColumn("bad_reason", F.nullif(text, F.lit("")))


def good_rows(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("bad_reason").isNull()).drop("bad_reason")


def bad_rows(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("bad_reason").isNotNull())


def flag(rows: DataFrame, **flags: Column) -> DataFrame:
    """Mark defects without dropping a row; an undecided flag is false."""
    return rows.withColumns({n: F.coalesce(c, F.lit(False)) for n, c in flags.items()})


# Whole rows that a task holds side by side when it looks for copies; larger tables of them miss the caches and spill.
ROWS_SIDE_BY_SIDE = 100_000
# Kinds that a grouping may not take as they are: a dealing by them would not be the grouping's.
NORMALISED = ("float", "double", "array", "map", "struct", "variant")


def dealt_out(rows: DataFrame, identity: Sequence[str], n_rows: int) -> DataFrame:
    """Rows in pieces of bounded size, all copies of an identity in one piece."""
    kinds = dict(rows.dtypes)
    keys = [c for c in identity if not kinds[c].startswith(NORMALISED)]
    return rows.repartition(max(-(-n_rows // ROWS_SIDE_BY_SIDE), 1), *keys) if keys else rows


def latest_delivery(
    rows: DataFrame, identity: Sequence[str], version: str, tiebreak: Sequence[str] = (),
    n_rows: int | None = None,
) -> DataFrame:
    """One row per identity, from its latest delivery.

    An aggregate and not ``row_number``: copies combine before the shuffle, so an identity that
    holds a large share of the rows never sits in one task.

    Where most rows have no copy, combining them first only fills a table of all rows of a file. With
    ``n_rows``, their number, they are dealt out by identity before; the pieces grow in number and not in size.
    Copies of one row then travel one by one, and their task keeps one of them.
    """
    if n_rows is not None:
        rows = dealt_out(rows, identity, n_rows)
    others = [c for c in rows.columns if c not in identity and c != version]
    if not others:
        return rows.groupBy(*identity).agg(F.max(version).alias(version))
    ranked = F.struct(version, *tiebreak, *[c for c in others if c not in tiebreak])
    best = rows.groupBy(*identity).agg(F.max(ranked).alias("_best"))
    return best.select(*identity, *[F.col(f"_best.{c}").alias(c) for c in [version, *others]])


def is_truthy(flags: Sequence[str]) -> Column:
    """All flags set, compared as booleans."""
    return reduce(lambda a, b: a & b, [F.col(f).cast("boolean") for f in flags])
