"""Exchange rates: carry-forward, as-of join on a calendar, as-of join of two large sides."""

from __future__ import annotations

import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.functions.money import convert

BROADCAST_ROWS = 2_000_000  # some fifty bytes each
QUOTED, CARRIED, MISSING = "quoted", "carried", "missing"


def carry_forward(
    quotes: DataFrame, key: str, day: str, value: str, last_day: Column | None = None
) -> DataFrame:
    """One row per key and calendar day from its first quote on; gaps take the last value.

    A key's window holds one row per calendar day, whatever the size of the quote table: ``quotes``
    is reduced to one row per key and day first.
    """
    daily = quotes.groupBy(key, day).agg(F.max(value).alias(value))
    end = F.max(day) if last_day is None else F.greatest(F.max(day), last_day)
    span = daily.groupBy(key).agg(F.min(day).alias("_from"), end.alias("_to"))
    grid = span.select(key, F.explode(F.sequence("_from", "_to")).alias(day))
    so_far = (
        Window.partitionBy(key).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return grid.join(daily, [key, day], "left").select(
        key,
        day,
        F.last(value, ignorenulls=True).over(so_far).alias(value),
        F.when(F.col(value).isNull(), CARRIED).otherwise(QUOTED).alias("status"),
    )


class Calendar(NamedTuple):
    """Rates for every day up to ``last``; ``last`` is None when there are no quotes.

    Lines stay where they are when they meet the rates of a calendar that is sent to them.
    """

    rates: DataFrame
    last: datetime.date | None
    is_sent: bool = False


def calendar(quotes: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> Calendar:
    """Quotes made dense: each is in force on its own day and up to the day before the next.

    An as-of join on dates thereby becomes an equi-join. The calendar is marked for broadcast only
    when currencies x days, counted here, is small; beyond that it is a shuffle join on
    (currency, day), whose hot keys AQE splits. A currency's window holds one row per day at most.
    """
    seen = quotes.selectExpr(
        "min(day) AS first", "max(day) AS last", "count(DISTINCT currency) AS currencies"
    ).first()
    last = seen["last"]
    until = f"DATE'{last}'" if last else "day"
    by_day = "OVER (PARTITION BY currency ORDER BY day)"
    rates = (
        quotes.groupBy("currency", "day").agg(F.max("rate").alias("rate"))
        .selectExpr(
            "currency", "rate", "day", f"coalesce(lead(day) {by_day} - 1, {until}) AS _until"
        )
        .selectExpr(
            "currency", "rate", "day AS rate_day", "explode(sequence(day, _until)) AS _on"
        )
    )
    is_sent = bool(last) and seen["currencies"] * ((last - seen["first"]).days + 1) <= broadcast_rows
    return Calendar(F.broadcast(rates) if is_sent else rates, last, is_sent)


def with_rate(lines: DataFrame, rates: Calendar, day: str = "order_date") -> DataFrame:
    """Each line with its currency's rate on the day, or the last earlier one.

    Days past the last quote look up the last calendar day; lines before the first quote keep a
    null rate.
    """
    on = f"CASE WHEN {day} > DATE'{rates.last}' THEN DATE'{rates.last}' ELSE {day} END"
    keyed = lines.withColumn("_on", F.expr(on if rates.last else day))
    status = f"""CASE WHEN rate IS NULL THEN '{MISSING}'
                      WHEN rate_day = {day} THEN '{QUOTED}' ELSE '{CARRIED}' END"""
    return (
        keyed.join(rates.rates, ["currency", "_on"], "left")
        .drop("_on")
        .withColumn("rate_status", F.expr(status))
    )


def to_usd(lines: DataFrame) -> DataFrame:
    return lines.withColumn("usd", convert(F.col("amount"), F.col("rate")))


def asof_join(
    probes: DataFrame,
    quotes: DataFrame,
    key: str,
    probe_ts: str,
    quote_ts: str,
    value: str,
    tiebreak: str,
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Last quote at or before each probe's instant, for two sides of any size.

    The answer depends on (key, instant) alone, so both sides are first reduced to distinct
    instants, with map-side combine. Time buckets then split a hot key over many tasks: within a
    bucket a running ``last`` finds the quote, and a short list of one row per bucket carries the
    latest quote of the earlier buckets in. Probes pick their answer up by an equi-join that AQE
    may split on the probe side. No pair of rows is ever compared.
    """
    quote = F.struct(F.col(tiebreak).alias("_tie"), F.col(value).alias("value"),
                     F.col(quote_ts).alias("at"))
    nothing = F.lit(None)
    points = (
        quotes.filter(F.col(key).isNotNull() & F.col(quote_ts).isNotNull())
        .select(F.col(key).alias("_key"), F.col(quote_ts).alias("_ts"), quote.alias("_quote"))
    )
    quote_type = points.schema["_quote"].dataType
    points = (
        points.unionByName(
            probes.filter(F.col(key).isNotNull() & F.col(probe_ts).isNotNull()).select(
                F.col(key).alias("_key"), F.col(probe_ts).alias("_ts"),
                nothing.cast(quote_type).alias("_quote"),
            )
        )
        .groupBy("_key", "_ts")
        .agg(F.max("_quote").alias("_quote"))
        .withColumn(
            "_bucket",
            F.floor(F.unix_seconds(F.col("_ts").cast("timestamp")) / bucket_seconds),
        )
    )
    within = (
        Window.partitionBy("_key", "_bucket").orderBy("_ts")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = (
        Window.partitionBy("_key").orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        points.groupBy("_key", "_bucket")
        .agg(F.max_by("_quote", F.when(F.col("_quote").isNotNull(), F.col("_ts"))).alias("_tail"))
        .select("_key", "_bucket",
                F.last("_tail", ignorenulls=True).over(earlier).alias("_carried"))
    )
    answers = (
        points.withColumn("_here", F.last("_quote", ignorenulls=True).over(within))
        .join(carried, ["_key", "_bucket"], "left")
        .select("_key", "_ts", F.coalesce("_here", "_carried").alias("_answer"))
    )
    hit = (F.col(key) == F.col("_key")) & (F.col(probe_ts) == F.col("_ts"))
    return probes.join(answers, hit, "left").select(
        *probes.columns,
        F.col("_answer.value").alias(f"asof_{value}"),
        F.col("_answer.at").alias("asof_at"),
    )
