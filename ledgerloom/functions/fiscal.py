"""Fiscal calendar labels as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom.schemas import FISCAL_START_MONTH


def _shifted(day: Column, start_month: int) -> Column:
    # Moving the date back makes the fiscal year a calendar year of the moved date.
    return F.add_months(day, 1 - start_month)


def fiscal_year_number(
    day: Column, start_month: int = FISCAL_START_MONTH, label_by: str = "end"
) -> Column:
    if label_by not in ("start", "end"):
        raise ValueError("label_by is 'start' or 'end'")
    later = 1 if label_by == "end" and start_month > 1 else 0
    return F.year(_shifted(day, start_month)) + F.lit(later)


def fiscal_year(
    day: Column, start_month: int = FISCAL_START_MONTH, label_by: str = "end"
) -> Column:
    """``FY2024`` for 2023-04-01 to 2024-03-31 with the defaults."""
    return F.concat(F.lit("FY"), fiscal_year_number(day, start_month, label_by).cast("string"))


def fiscal_quarter(
    day: Column, start_month: int = FISCAL_START_MONTH, label_by: str = "end"
) -> Column:
    """``FY2024-Q1`` for April to June 2023 with the defaults."""
    quarter = F.quarter(_shifted(day, start_month)).cast("string")
    return F.concat(fiscal_year(day, start_month, label_by), F.lit("-Q"), quarter)


def calendar_year_label(day: Column) -> Column:
    return F.concat(F.lit("FY"), F.year(day).cast("string"))


def fiscal_index(day: Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """One small integer per fiscal quarter (end-year label); cheaper to group by than labels."""
    year = fiscal_year_number(day, start_month)
    return year * 4 + F.quarter(_shifted(day, start_month)) - 1


def year_of_index(index: Column) -> Column:
    return F.concat(F.lit("FY"), F.floor(index / 4).cast("string"))


def quarter_of_index(index: Column) -> Column:
    return F.concat(year_of_index(index), F.lit("-Q"), (index % 4 + 1).cast("string"))
