"""Change-data capture in batch: unwrap, current state, history, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerloom.functions.encoding import BROKEN, parse_json
from ledgerloom.schemas import CHANGE_ENVELOPE, CHANGE_KEY, CHANGE_OPS, CHANGE_RECORD

ORIGIN = ["topic", "topic_partition", "topic_offset"]
GOOD, BAD, TOMBSTONE = "good", "broken", "tombstone"


def read_records(lines: DataFrame, text: str = "value") -> DataFrame:
    """Topic records from JSON lines; a line that is no record becomes a broken value."""
    record = lines.select(parse_json(F.col(text), CHANGE_RECORD).alias("r"))
    return record.select(
        *[F.col(f"r.{c}") for c in (*ORIGIN, "key")],
        F.coalesce(F.col("r.value"), F.col(f"r.{BROKEN}")).alias("value"),
    )


def _either(parsed: Column, field: str) -> Column:
    """A field of a plain document, or of one that comes wrapped in ``payload``."""
    return F.coalesce(parsed["payload"][field], parsed[field])


def _wrapped(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("payload", schema)])


def read_envelopes(records: DataFrame) -> DataFrame:
    """Every record with its origin, its envelope and its kind: good, broken or tombstone.

    A tombstone has no value. Broken is what does not parse, or lacks its key, log position, a
    known operation, or the row of a change that is no delete; ``value`` keeps its text.
    """
    # Generated and not projected: a filter on what was parsed would else be pushed below, and parse once per mention.
    parsed = records.select("*", F.inline(F.array(F.struct(
        parse_json(F.col("value"), _wrapped(CHANGE_ENVELOPE)).alias("_v"),
        parse_json(F.col("key"), _wrapped(CHANGE_KEY)).alias("_k"),
    ))))
    value, key = F.col("_v"), F.col("_k")
    flat = parsed.select(
        *ORIGIN, "value",
        F.coalesce(_either(key, "user_id"), F.col("key").try_cast("bigint")).alias("key"),
        _either(value, "source")["lsn"].alias("lsn"),
        F.timestamp_micros(_either(value, "ts_us")).cast("timestamp_ntz").alias("ts"),
        _either(value, "op").alias("op"),
        _either(value, "before").alias("before"), _either(value, "after").alias("after"),
        value[BROKEN].isNotNull().alias("_unread"),
    )
    whole = (
        ~F.col("_unread") & F.col("key").isNotNull() & F.col("lsn").isNotNull()
        & F.col("op").isin(CHANGE_OPS)
        & ((F.col("op") == "d") | F.col("after").isNotNull())
    )
    kind = F.when(F.col("value").isNull(), TOMBSTONE).when(whole, GOOD).otherwise(BAD)
    return flat.withColumn("kind", kind).drop("_unread")


def unwrap(envelopes: DataFrame, origin: bool = False) -> DataFrame:
    """One flat row per good change: the row after it, or before it for a delete.

    The others are in ``broken`` and ``tombstones``; the three together are the input.
    """
    row = F.coalesce("after", "before")
    flat = ["key", "lsn", "ts", "op", *[row[c].alias(c) for c in ("value", "event_type", "k")]]
    return envelopes.filter(F.col("kind") == GOOD).select(*(ORIGIN if origin else []), *flat)


def broken(envelopes: DataFrame) -> DataFrame:
    """What goes to quarantine: origin and text of each broken record."""
    return envelopes.filter(F.col("kind") == BAD).select(*ORIGIN, "value")


def tombstones(envelopes: DataFrame) -> DataFrame:
    return envelopes.filter(F.col("kind") == TOMBSTONE).select(*ORIGIN, "key")


def newest(changes: DataFrame, key: str = "key", lsn: str = "lsn") -> DataFrame:
    """The change with the highest lsn of each key, deletes included.

    ``max_by`` combines on the map side, so a key with a third of all changes costs its task one
    row per map partition.
    """
    rest = F.struct(*[c for c in changes.columns if c not in (key, lsn)])
    picked = changes.groupBy(key).agg(F.max(lsn).alias(lsn), F.max_by(rest, lsn).alias("_row"))
    return picked.select(key, lsn, "_row.*")


def current_state(changes: DataFrame, key: str = "key", lsn: str = "lsn") -> DataFrame:
    return newest(changes, key, lsn).filter(F.col("op") != "d")


def history(changes: DataFrame, chunk: int = 100_000) -> DataFrame:
    """Validity interval of each version of a key.

    A plain ``lead`` over a key would sort a hot key in one task. Runs of ``chunk`` log positions
    bound every window group; a second window over one row per (key, run) tells the last version
    of a run where the next one begins.
    """
    rest = [c for c in changes.columns if c not in ("key", "lsn")]
    in_runs = changes.withColumn("_run", F.floor(F.col("lsn") / chunk))
    once = in_runs.dropDuplicates(["key", "lsn"])
    in_run = Window.partitionBy("key", "_run").orderBy("lsn")
    by_run = Window.partitionBy("key").orderBy("_run")
    # A replayed change does not move the head of its run, so this side needs no deduplication.
    heads = (
        in_runs.groupBy("key", "_run")
        .agg(F.min_by("ts", "lsn").alias("_head"))
        .select("key", "_run", F.lead("_head").over(by_run).alias("_next_head"))
    )
    return (
        once.withColumn("_next", F.lead("ts").over(in_run))
        .join(heads, ["key", "_run"], "left")
        .withColumn("valid_to", F.coalesce("_next", "_next_head"))
        .filter(F.col("op") != "d")
        .select(
            "key", "lsn", *[c for c in rest if c != "ts"],
            F.col("ts").alias("valid_from"), "valid_to",
            F.col("valid_to").isNull().alias("is_current"),
        )
    )


def completeness(envelopes: DataFrame, expected: DataFrame) -> DataFrame:
    """Records read per topic partition beside the producer's numbers.

    ``expected``: topic_partition, expected_events, expected_last (offset). Tombstones are records
    too; a partition with a broken record is not complete.
    """
    seen = envelopes.groupBy("topic_partition").agg(
        F.count("*").alias("events_read"), F.max("topic_offset").alias("last_offset"),
        F.count_if(F.col("kind") == BAD).alias("broken"),
    )
    return (
        expected.join(seen, "topic_partition", "full_outer")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("events_read", "broken")})
        .withColumn(
            "complete",
            F.col("events_read").eqNullSafe(F.col("expected_events"))
            & F.col("last_offset").eqNullSafe(F.col("expected_last"))
            & (F.col("broken") == 0),
        )
    )
