"""Country conformance: five spellings, one dimension row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.text import country_key
from ledgerloom.schemas import UNKNOWN


def alias_table(countries: DataFrame) -> DataFrame:
    """Folded spellings (name and code) of each country, one row per spelling.

    A spelling that two countries share goes to the first code, so a lookup never fans out.
    """
    spellings = F.array(country_key(F.col("country_name")), country_key(F.col("country")))
    pair = F.min(F.struct("country", "country_name")).alias("_first")
    return (
        countries.select(F.explode(spellings).alias("alias"), "country", "country_name")
        .groupBy("alias").agg(pair).select("alias", "_first.*")
    )


def conform_country(rows: DataFrame, aliases: DataFrame, text: str) -> DataFrame:
    """Add ``country``; a spelling nobody knows keeps its row under the unknown label.

    The alias side is unique per key, so the row count stays. It is a small dimension; whether it
    is small enough to broadcast is left to Catalyst's size threshold.
    """
    known = aliases.select("alias", F.col("country").alias("_country"))
    return rows.join(known, country_key(F.col(text)) == F.col("alias"), "left").select(
        *rows.columns, F.coalesce("_country", F.lit(UNKNOWN)).alias("country")
    )


def dim_country(aliases: DataFrame) -> DataFrame:
    return aliases.select("country", "country_name").distinct()


def orphans(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row."""
    return facts.join(dim.select(key), key, "left_anti")
