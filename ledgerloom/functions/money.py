"""Exact money arithmetic: decimal first, arithmetic second."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(19,4)"
TOTAL = "decimal(38,4)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def line_amount(price: Column, discount: Column) -> Column:
    keep = F.lit(1).cast("decimal(5,4)") - discount.cast("decimal(5,4)")
    return money(money(price) * keep)


def convert(amount: Column, rate: Column) -> Column:
    """Local amount to the reporting currency, rounded half up to four places."""
    return money(F.round(amount * rate, 4))


def total(amount: Column) -> Column:
    """Exact sum; an empty input is zero, never null."""
    return F.coalesce(F.sum(amount), F.lit(0)).cast(TOTAL)


def total_where(flag: Column, amount: Column) -> Column:
    return total(F.when(flag, amount))


def total_text(amount: str, where: str | None = None) -> str:
    """The same total as SQL text, over the rows of a condition."""
    picked = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(coalesce(sum({amount}){picked}, 0) AS {TOTAL})"
