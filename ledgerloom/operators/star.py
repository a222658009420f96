"""From conformed sale lines to the two facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import fiscal
from ledgerloom.functions.money import total, total_text
from ledgerloom.operators import fx
from ledgerloom.schemas import SUMMARY_AXES, UNKNOWN


def union_channels(*channels: DataFrame) -> DataFrame:
    first, *others = channels
    for other in others:
        first = first.unionByName(other)
    return first


def with_products(lines: DataFrame, products: DataFrame) -> DataFrame:
    """SKU to department and segment; a SKU in no catalogue keeps its line and is flagged."""
    joined = lines.join(products.select("sku", "department", "product_segment"), "sku", "left")
    return joined.withColumns(
        {
            "is_unknown_sku": F.expr("department IS NULL"),
            "department": F.expr(f"coalesce(department, '{UNKNOWN}')"),
            "product_segment": F.expr(f"coalesce(product_segment, '{UNKNOWN}')"),
        }
    )


def with_fiscal(lines: DataFrame, day: str = "order_date") -> DataFrame:
    return lines.withColumns(
        {
            "fiscal_year": fiscal.fiscal_year(F.col(day)),
            "fiscal_quarter": fiscal.fiscal_quarter(F.col(day)),
        }
    )


def price(lines: DataFrame, rates: fx.Calendar) -> DataFrame:
    """Rate and USD amount of each line."""
    return fx.to_usd(fx.with_rate(lines, rates))


def enrich(lines: DataFrame, products: DataFrame, rates: fx.Calendar) -> DataFrame:
    """Everything the summary needs on each line: product, rate, USD amount, labels."""
    return price(with_products(lines, products), rates).withColumns(
        {
            "customer_segment": F.expr(f"coalesce(segment, '{UNKNOWN}')"),
            "country": F.expr(f"coalesce(country, '{UNKNOWN}')"),
        }
    )


# Measures of the summary: revenue is net of cancelled lines, which are summed apart.
LINE_MEASURES = {
    "sale_lines": "count(*)",
    "units": "sum(units)",
    "revenue_usd": total_text("usd", "NOT is_cancelled"),
    "cancelled_usd": total_text("usd", "is_cancelled"),
    "carried_rate_usd": total_text("usd", f"NOT is_cancelled AND rate_status = '{fx.CARRIED}'"),
}


def revenue_summary(enriched: DataFrame) -> DataFrame:
    """Seven axes and five measures. Grouped by quarter number; labels are made per group."""
    index = F.col("_quarter")
    axes = [a for a in SUMMARY_AXES if not a.startswith("fiscal")]
    grouped = enriched.groupBy(fiscal.fiscal_index(F.col("order_date")).alias("_quarter"), *axes)
    measured = grouped.agg(*[F.expr(e).alias(name) for name, e in LINE_MEASURES.items()])
    return measured.select(
        fiscal.year_of_index(index).alias("fiscal_year"),
        fiscal.quarter_of_index(index).alias("fiscal_quarter"),
        *axes,
        *LINE_MEASURES,
    )


def daily_revenue(*channels: DataFrame) -> DataFrame:
    """Orders, units and net USD revenue by day and country over the priced channels.

    Lines fold to one row per order first, channel by channel: behind a join on the order key that
    step needs no shuffle of its own, and it turns the distinct count of orders into a plain count.
    """
    orders = [
        lines.groupBy(
            "order_key", "order_date", F.expr(f"coalesce(country, '{UNKNOWN}')").alias("country")
        ).agg(
            F.sum("units").alias("units"),
            F.expr("sum(usd) FILTER (WHERE NOT is_cancelled)").alias("net"),
        )
        for lines in channels
    ]
    return union_channels(*orders).groupBy("order_date", "country").agg(
        F.count("*").alias("orders"), F.sum("units").alias("units"),
        F.expr(total_text("net")).alias("revenue"),
    )


def star_slice(daily: DataFrame, countries: DataFrame) -> DataFrame:
    """The daily fact by country name."""
    return (
        daily.groupBy("country")
        .agg(F.sum("orders").alias("orders"), total(F.col("revenue")).alias("revenue"))
        .join(countries, "country", "left")
        .select("country", F.coalesce("country_name", F.lit(UNKNOWN)).alias("country_name"),
                "orders", "revenue")
    )
