"""Quality contracts. A contract returns its violating rows; it holds when there are none."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.fiscal import calendar_year_label
from ledgerloom.functions.money import TOTAL, total
from ledgerloom.operators.compare import refuse_all_zero
from ledgerloom.operators.metadata import row_counts
from ledgerloom.schemas import CHANNELS, FISCAL_START_MONTH


def _violations(rows: DataFrame, contract: str, detail: Column) -> DataFrame:
    return rows.select(F.lit(contract).alias("contract"), detail.cast("string").alias("detail"))


def channels_present(summary: DataFrame, expected: Sequence[str] = CHANNELS) -> DataFrame:
    """Each selling channel has rows in the summary."""
    listed = F.explode(F.array(*[F.lit(c) for c in expected])).alias("channel")
    wanted = summary.sparkSession.range(1).select(listed)
    seen = summary.select("channel").distinct()
    return _violations(
        wanted.join(seen, "channel", "left_anti"), "channels_present", F.col("channel")
    )


def country_resolves(facts: DataFrame, countries: DataFrame, key: str = "country") -> DataFrame:
    """Each country value of the facts has its dimension row. Reports distinct values."""
    used = facts.select(key).distinct()
    lost = used.join(countries.select(F.col("country").alias(key)), key, "left_anti")
    return _violations(lost, "country_resolves", F.col(key))


def calendar_label_held(day: str, label: str) -> Column:
    """Before the start month the fiscal label must be the calendar year, after it the next one."""
    expected = F.when(F.month(day) < FISCAL_START_MONTH, calendar_year_label(F.col(day))).otherwise(
        calendar_year_label(F.add_months(day, 12))
    )
    return ~F.col(label).eqNullSafe(expected)


def fiscal_is_not_calendar(rows: DataFrame, day: str, label: str) -> DataFrame:
    bad = rows.filter(calendar_label_held(day, label)).select(day, label).distinct()
    return _violations(
        bad, "fiscal_is_not_calendar",
        F.concat_ws(" ", F.col(day).cast("string"), F.coalesce(label, F.lit("null"))),
    )


def money_is_decimal(catalogue: DataFrame, money_columns: Sequence[str]) -> DataFrame:
    """No money column is stored in a floating type."""
    bad = catalogue.filter(
        F.col("column_name").isin(list(money_columns)) & F.col("type").isin("float", "double")
    )
    return _violations(bad, "money_is_decimal", F.concat_ws(".", "table_name", "column_name"))


def line_totals(enriched: DataFrame) -> DataFrame:
    """What the sale lines hold, sold and cancelled, in one row."""
    sold = F.when(~F.col("is_cancelled"), F.col("usd"))
    cancelled = F.when(F.col("is_cancelled"), F.col("usd"))
    return enriched.agg(
        total(sold).alias("revenue_usd"), total(cancelled).alias("cancelled_usd"),
        F.count("*").cast(TOTAL).alias("sale_lines"),
    )


def summary_conserves_revenue(summary: DataFrame, of_lines: DataFrame) -> DataFrame:
    """The summary holds exactly what the sale lines hold (``line_totals``)."""
    kept = summary.agg(
        total(F.col("revenue_usd")).alias("revenue_usd"),
        total(F.col("cancelled_usd")).alias("cancelled_usd"),
        F.coalesce(F.sum("sale_lines"), F.lit(0)).cast(TOTAL).alias("sale_lines"),
    )
    names = ["revenue_usd", "cancelled_usd", "sale_lines"]
    both = (
        of_lines.unpivot([], names, "measure", "in_lines")
        .join(kept.unpivot([], names, "measure", "in_summary"), "measure", "full_outer")
    )
    bad = both.filter(~F.col("in_lines").eqNullSafe(F.col("in_summary")))
    return _violations(
        bad, "summary_conserves_revenue",
        F.concat_ws(" ", "measure", F.col("in_lines").cast("string"),
                    F.col("in_summary").cast("string")),
    )


def not_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Each exported table has rows."""
    empty = row_counts(tables).filter(F.col("n_rows") == 0)
    return _violations(empty, "not_empty", F.col("table_name"))


def expected_counts(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """Counted rows equal numbers stated elsewhere. Both sides: table_name, n_rows."""
    told = expected.select("table_name", F.col("n_rows").alias("stated"))
    bad = counts.join(told, "table_name", "full_outer").filter(
        ~F.col("n_rows").eqNullSafe(F.col("stated"))
    )
    return _violations(
        bad, "expected_counts",
        F.concat_ws(" ", "table_name", F.coalesce(F.col("n_rows").cast("string"), F.lit("none")),
                    F.coalesce(F.col("stated").cast("string"), F.lit("none"))),
    )


def not_null(rows: DataFrame, column: str) -> DataFrame:
    """One violation per column, with the number of null rows."""
    counted = rows.agg(F.count_if(F.col(column).isNull()).alias("n")).filter(F.col("n") > 0)
    return _violations(
        counted, "not_null", F.concat(F.lit(f"{column}: "), F.col("n").cast("string"))
    )


def unique(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values held more than once."""
    twice = rows.groupBy(*columns).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    return _violations(
        twice, "unique", F.concat_ws(" ", *[F.col(c).cast("string") for c in columns],
                                     F.col("n").cast("string")),
    )


def accepted_values(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    odd = (
        rows.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
        .groupBy(column).agg(F.count("*").alias("n"))
    )
    return _violations(
        odd, "accepted_values", F.concat_ws(" ", F.lit(column), F.col(column),
                                            F.col("n").cast("string")),
    )


def relationship(rows: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Key values without a parent row."""
    keys = rows.select(F.col(column).alias("_key")).filter("_key is not null").distinct()
    lost = keys.join(parent.select(F.col(parent_column).alias("_key")), "_key", "left_anti")
    return _violations(
        lost, "relationship", F.concat_ws(" ", F.lit(column), F.col("_key").cast("string"))
    )


def no_orphan_lines(lines: DataFrame) -> DataFrame:
    """Each sale line has its order. One violation, with the number of lines that have none."""
    lost = lines.agg(F.count_if("is_orphan_order").alias("n")).filter(F.col("n") > 0)
    return _violations(lost, "no_orphan_lines", F.concat_ws(" ", F.lit("lines"), F.col("n").cast("string")))


def rate_is_known(lines: DataFrame) -> DataFrame:
    """Each priced line found a rate. One violation per currency, with its number of lines."""
    lost = lines.filter(F.col("rate_status") == "missing").groupBy("currency").agg(F.count("*").alias("n"))
    return _violations(
        lost, "rate_is_known",
        F.concat_ws(" ", F.coalesce("currency", F.lit("none")), F.col("n").cast("string")),
    )


def not_all_zero(snapshot: DataFrame) -> DataFrame:
    refused = refuse_all_zero(snapshot).filter("refused")
    return _violations(refused, "not_all_zero", F.lit("every total is zero"))


def report(names: Iterable[str], violations: DataFrame) -> DataFrame:
    """One row per published contract: its name, whether it holds, how many rows violate it."""
    listed = F.explode(F.array(*[F.lit(n) for n in names])).alias("contract")
    published = violations.sparkSession.range(1).select(listed)
    counted = violations.groupBy("contract").agg(F.count("*").alias("n"))
    return published.join(counted, "contract", "left").select(
        "contract",
        F.when(F.col("n") > 0, "violated").otherwise("holds").alias("status"),
        F.coalesce("n", F.lit(0)).alias("violations"),
    )
