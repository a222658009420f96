"""JSON in and out, and content digests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

BROKEN = "_broken"
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def parse_json(text: Column, schema: T.StructType) -> Column:
    """A struct that carries the original text in ``_broken`` when it does not parse."""
    wide = T.StructType(schema.fields + [T.StructField(BROKEN, T.StringType())])
    return F.from_json(
        text, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    )


def row_json(*columns: str) -> Column:
    """Columns as one JSON object; instants keep their microseconds."""
    return F.to_json(F.struct(*columns), {"timestampNTZFormat": MICROS})


def digest(content: Column) -> Column:
    return F.sha2(content, 256)
