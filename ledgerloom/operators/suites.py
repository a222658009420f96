"""Contracts of one table, compiled into one aggregate.

A check says what violates it and how violations count; a suite puts all checks of a table, the count of its rows, the
uniqueness of a key and sums that other contracts need into a single pass. With a key the pass groups by it first, and
all partial counts combine before that shuffle; without one there is a shuffle of one row a task. The violating rows
themselves are read on demand, for one check at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

ROWS, ONCE, VALUES = "rows", "once", "values"


@dataclass(frozen=True)
class Check:
    """``bad`` tells violating rows. They count each (``rows``), once for all, or once for each of ``value``."""

    contract: str
    bad: Column
    counted: str = ROWS
    value: Column | None = None


def not_null(column: str) -> Check:
    return Check("not_null", F.col(column).isNull(), ONCE)


def accepted_values(column: str, values: Sequence[str]) -> Check:
    bad = F.col(column).isNotNull() & ~F.col(column).isin(list(values))
    return Check("accepted_values", bad, VALUES, F.col(column))


@dataclass(frozen=True)
class Suite:
    """All checks of one table. ``least_rows`` of None leaves ``not_empty`` out."""

    table: str
    frame: DataFrame
    checks: Sequence[Check] = ()
    key: Sequence[str] = ()
    not_empty: bool = False
    sums: Mapping[str, Column] = field(default_factory=dict)

    def __post_init__(self):
        for c in self.checks:
            if c.counted == VALUES and c.value is None:
                raise ValueError(f"{c.contract} of {self.table} counts values and names none")

    def evaluated(self) -> DataFrame:
        """One row: ``c0, c1, ...`` violations of each check, ``unique``, ``n_rows`` and the sums."""
        rows = self.frame.select(
            *[F.col(k) for k in self.key],
            *[F.coalesce(c.bad, F.lit(False)).alias(f"b{i}") for i, c in enumerate(self.checks)],
            *[c.value.alias(f"v{i}") for i, c in enumerate(self.checks) if c.counted == VALUES],
            *[s.alias(f"s_{name}") for name, s in self.sums.items()],
        )
        held = F.lit(1).cast("bigint")
        if self.key:
            # One row a key first. A value that is counted stands for its key where the key decides it.
            rows = rows.groupBy(*self.key).agg(
                F.count("*").alias("_held"),
                *[F.count_if(f"b{i}").alias(f"n{i}") for i in range(len(self.checks))],
                *[F.min(F.when(F.col(f"b{i}"), F.col(f"v{i}"))).alias(f"v{i}") for i, c in enumerate(self.checks) if c.counted == VALUES],
                *[F.sum(f"s_{name}").alias(f"s_{name}") for name in self.sums],
            )
            held = F.col("_held")
        else:
            rows = rows.withColumns({f"n{i}": F.col(f"b{i}").cast("bigint") for i in range(len(self.checks))} or {"n": F.lit(0)})
        zero = F.lit(0).cast("bigint")
        found = []
        for i, c in enumerate(self.checks):
            n = F.col(f"n{i}")
            made = {
                ROWS: lambda: F.sum(n), ONCE: lambda: F.max(F.when(n > 0, 1).otherwise(0)),
                VALUES: lambda: F.count_distinct(F.when(n > 0, F.coalesce(F.col(f"v{i}").cast("string"), F.lit("null")))),
            }[c.counted]()
            found.append(F.coalesce(made.cast("bigint"), zero).alias(f"c{i}"))
        return rows.agg(
            F.coalesce(F.sum(held), zero).alias("n_rows"), F.count_if(held > 1).alias("unique"), *found,
            *[F.sum(f"s_{name}").alias(name) for name in self.sums],
        )

    def violations(self, once: DataFrame | None = None) -> DataFrame:
        """``contract, table_name, violations``, a row for each check. ``once``: the evaluated row, if it is held already."""
        told = [("unique", F.col("unique"))] if self.key else []
        told += [("not_empty", F.when(F.col("n_rows") == 0, 1).otherwise(0).cast("bigint"))] if self.not_empty else []
        told += [(c.contract, F.col(f"c{i}")) for i, c in enumerate(self.checks)]
        listed = F.array(*[F.struct(F.lit(name).alias("contract"), n.alias("violations")) for name, n in told])
        one = self.evaluated() if once is None else once
        return one.select(F.inline(listed)).select("contract", F.lit(self.table).alias("table_name"), "violations")

    def violating(self, contract: str) -> DataFrame:
        """The rows that violate a contract of this table, with their columns."""
        if contract == "unique":
            twice = self.frame.groupBy(*self.key).agg(F.count("*").alias("_held")).where("_held > 1").drop("_held")
            same = [self.frame[k].eqNullSafe(twice[k]) for k in self.key]
            return self.frame.join(twice, same, "left_semi")
        bad = [c.bad for c in self.checks if c.contract == contract]
        if not bad:
            raise KeyError(f"{self.table} has no contract {contract} on its rows")
        any_ = F.lit(False)
        for b in bad:
            any_ = any_ | F.coalesce(b, F.lit(False))
        return self.frame.where(any_)


def report(names: Sequence[str], violations: Sequence[DataFrame]) -> DataFrame:
    """One row per published contract over all tables: its name, whether it holds, how many violations."""
    spark = violations[0].sparkSession
    published = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("contract"))
    found = violations[0].select("contract", "violations")
    for more in violations[1:]:
        found = found.unionByName(more.select("contract", "violations"))
    counted = found.groupBy("contract").agg(F.sum("violations").alias("n"))
    return published.join(counted, "contract", "left").select(
        "contract", F.when(F.col("n") > 0, "violated").otherwise("holds").alias("status"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("violations"),
    )
