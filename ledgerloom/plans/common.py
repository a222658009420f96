"""Frames that several registered queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom import fixtures
from ledgerloom.fixtures import Tables
from ledgerloom.operators import fx, geography, identity, star
from ledgerloom.schemas import CHANNELS
from ledgerloom.session import new_folder
from ledgerloom.sources import landing, sinks


def sale_lines(t: Tables) -> DataFrame:
    return star.union_channels(fixtures.store_sales(t), fixtures.web_sales(t))


def rates(t: Tables) -> fx.Calendar:
    return fx.calendar(fixtures.fx_quotes(t))


def enriched(t: Tables) -> DataFrame:
    return star.enrich(sale_lines(t), fixtures.product_rollup(t.spark), rates(t))


def priced_channels(t: Tables) -> list[DataFrame]:
    """The channels apart, so that each keeps the partitioning of its own joins."""
    calendar = rates(t)
    return [star.price(s, calendar) for s in (fixtures.store_sales(t), fixtures.web_sales(t))]


def enriched_store(t: Tables) -> DataFrame:
    return star.enrich(fixtures.store_sales(t), fixtures.product_rollup(t.spark), rates(t))


def summary(t: Tables) -> DataFrame:
    return star.revenue_summary(enriched(t))


def daily(t: Tables) -> DataFrame:
    return star.daily_revenue(*priced_channels(t))


def people(t: Tables) -> DataFrame:
    return identity.resolve(
        fixtures.store_customers(t), fixtures.web_accounts(t), "cust_id", "user_id"
    )


def dim_customer(t: Tables) -> DataFrame:
    return identity.dim_customer(people(t), fixtures.conformed_customers(t))


def dim_country(t: Tables) -> DataFrame:
    return geography.dim_country(fixtures.country_aliases(t))


def written(frame: DataFrame, name: str) -> DataFrame:
    """A table of a build: written once to the shared folder, then read from there."""
    folder = sinks.write_table(frame, new_folder(frame.sparkSession, name))
    return landing.read_master(frame.sparkSession, folder, frame.schema)


def written_lines(t: Tables) -> DataFrame:
    """The enriched sale lines of a build; the fact join runs once, whatever reads them."""
    return written(enriched(t), "lines")


def facts(lines: DataFrame) -> dict[str, DataFrame]:
    """Both facts from the written lines."""
    channels = [lines.filter(F.col("channel") == c) for c in CHANNELS]
    return {
        "Revenue": written(star.daily_revenue(*channels), "daily"),
        "Reporting": written(star.revenue_summary(lines), "summary"),
    }


def star_tables(t: Tables, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four tables of the reporting model by their model names, as written by one build."""
    built = facts(written_lines(t) if lines is None else lines)
    return {
        "Revenue": built["Revenue"],
        "Customer": written(dim_customer(t), "customers"),
        "Country": written(dim_country(t), "countries"),
        "Reporting": built["Reporting"],
    }
