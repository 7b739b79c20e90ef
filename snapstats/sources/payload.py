"""Raw response text to record arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def normalize_payload(text: Column, record: StructType | str) -> Column:
    """Response text as ``array<record>``: an array as it is, an object as its only element.

    Null, JSON ``null``, a bare scalar and unreadable text give the empty array: none of them is a record.
    """
    record_type = record.simpleString() if isinstance(record, StructType) else record
    return F.coalesce(F.from_json(text, f"array<{record_type}>"), F.array())


def normalize_variant(text: Column) -> Column:
    """The same for payloads of unknown shape, as ``array<variant>``; a bare scalar is wrapped too."""
    value = F.try_parse_json(text)
    kind = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | (kind == "VOID"), F.array().cast("array<variant>"))
        .when(kind.startswith("ARRAY<"), value.cast("array<variant>"))
        .otherwise(F.array(value))
    )
