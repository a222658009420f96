"""People known to two channels, matched on email."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.text import email_key
from ledgerloom.schemas import UNKNOWN


def _one_per_email(rows: DataFrame, key: str, side: str) -> DataFrame:
    # Partial aggregation folds duplicate emails before the shuffle; the join then sees unique keys.
    return (
        rows.filter(F.col("email_key").isNotNull())
        .groupBy("email_key")
        .agg(F.min(key).alias(f"{side}_id"), F.count("*").alias(f"{side}_rows"))
    )


def resolve(store: DataFrame, web: DataFrame, store_key: str, web_key: str) -> DataFrame:
    """One row per person: matched on email, or known to one channel only.

    Rows without an email match nothing. They bypass the join and are added back after it, so the
    missing key never becomes the hottest partition of a full outer join.
    """
    store_keyed = store.withColumn("email_key", email_key(F.col("email")))
    web_keyed = web.withColumn("email_key", email_key(F.col("email")))
    people = (
        _one_per_email(store_keyed, store_key, "store")
        .join(_one_per_email(web_keyed, web_key, "web"), "email_key", "full_outer")
        .select(
            F.concat(F.lit("E:"), "email_key").alias("person_id"),
            "email_key", "store_id", "web_id", "store_rows", "web_rows",
        )
    )

    def nameless(rows: DataFrame, key: str, side: str) -> DataFrame:
        other = "web" if side == "store" else "store"
        return rows.filter(F.col("email_key").isNull()).select(
            F.concat(F.lit(f"{side[0].upper()}:"), F.col(key).cast("string")).alias("person_id"),
            "email_key",
            F.col(key).alias(f"{side}_id"),
            F.lit(None).cast("bigint").alias(f"{other}_id"),
            F.lit(1).cast("bigint").alias(f"{side}_rows"),
            F.lit(None).cast("bigint").alias(f"{other}_rows"),
        )

    everyone = people.unionByName(nameless(store_keyed, store_key, "store")).unionByName(
        nameless(web_keyed, web_key, "web")
    )
    return everyone.withColumns(
        {
            "in_store": F.col("store_id").isNotNull(),
            "in_web": F.col("web_id").isNotNull(),
        }
    )


def duplicate_emails(people: DataFrame) -> DataFrame:
    """Emails that one side holds more than once."""
    twice = (F.coalesce("store_rows", F.lit(0)) > 1) | (F.coalesce("web_rows", F.lit(0)) > 1)
    return people.filter(twice)


def dim_customer(people: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per person with name and country; web-only people are labelled unknown.

    They have no store id and bypass the join: a missing key would gather them in one task.
    """
    master = customers.select(F.col("cust_id").alias("store_id"), "name", "country")
    of_store = people.filter(F.col("store_id").isNotNull()).join(master, "store_id", "left")
    web_only = people.filter(F.col("store_id").isNull())
    return of_store.unionByName(web_only, allowMissingColumns=True).select(
        F.col("person_id").alias("customer_id"),
        F.coalesce("name", F.lit(UNKNOWN)).alias("name"),
        F.coalesce("country", F.lit(UNKNOWN)).alias("country"),
    )
