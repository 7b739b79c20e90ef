"""Declared schemas.  Declaring one skips the inference pass over the whole history."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DecimalType, LongType, StringType, StructField, StructType

COUNTERS = ("wins", "losses", "matches")


def envelope_schema(record: StructType, *, legacy: bool = False) -> StructType:
    """The wrapper around ``record``; ``legacy`` adds the old payload field ``heroes``."""
    fields = [StructField("fetched_at", StringType()), StructField("data", ArrayType(record))]
    if legacy:
        fields.append(StructField("heroes", ArrayType(record)))
    return StructType(fields)


def counter_record(key: str) -> StructType:
    """The four record fields a win rate reads.

    As decimals, they also take numbers that arrive as text or with a fraction, which a declared bigint
    would lose; a value that is no number is null and leaves its neighbours alone.  Text columns would
    take anything, but reading a JSON number as text is some seventy times slower.
    """
    return StructType(
        [StructField(key, DecimalType(20, 0))] + [StructField(name, DecimalType(38, 6)) for name in COUNTERS]
    )


def bronze_counters(key: str) -> StructType:
    """Bronze columns a win rate reads, with the folder column."""
    longs = [StructField(name, LongType()) for name in (key, *COUNTERS, "fetched_us")]
    return StructType([*longs, StructField("fetch_date", StringType())])


HISTORY_RECORD = StructType(
    [StructField(name, LongType()) for name in ("account_id", "match_id", "hero_id")]
)

_PLAYERS = ArrayType(
    StructType([StructField("account_id", LongType()), StructField("hero_id", LongType())])
)

MATCH_RECORD = StructType(
    [
        StructField("match_id", LongType()),
        StructField("match_info", StructType([StructField("players", _PLAYERS)])),
        StructField("players", _PLAYERS),
    ]
)
