"""Win rates and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, IntegralType, NumericType, StructType

from snapstats.functions.stamps import iso_micros, micros_to_iso, utc_micros
from snapstats.operators.shape import NotRecords, payload_column, quoted
from snapstats.schemas import COUNTERS


def as_counter(value: Column, dtype: DataType) -> Column:
    """A counter as bigint.  Drifted fields (text, decimals) are converted; what is no number is null."""
    if isinstance(dtype, IntegralType):
        return value.cast("bigint")
    if isinstance(dtype, NumericType):
        return value.try_cast("bigint")
    return F.coalesce(value.try_cast("bigint"), value.try_cast("decimal(38,6)").try_cast("bigint"))


def counter_records(
    envelopes: DataFrame, key: str, legacy: str | None = None, stamps: str = "utc", carry: tuple[str, ...] = ()
) -> DataFrame:
    """The records of counter envelopes as ``key, wins, losses, matches`` and their stamp.

    ``legacy`` says what to do with the old payload column ``heroes``: None ignores it, ``"data_first"``
    uses it only when the frame has no ``data`` column at all, and ``"per_row"`` uses it for every
    envelope whose ``data`` is null.

    The stamp becomes ``fetched_us``, parsed once per envelope, before the records are exploded; with
    ``stamps="text"`` it stays ``fetched_at``.  A stamp that is not UTC is an error, or null with
    ``stamps="lenient"``, which counts its records all the same.  ``carry`` names columns of the envelope to keep.
    """
    parse = {"utc": iso_micros, "lenient": utc_micros, "text": lambda c: c}[stamps]
    stamp = parse(F.col("fetched_at")).alias("fetched_at" if stamps == "text" else "fetched_us")
    if legacy == "per_row" and {"data", "heroes"} <= set(envelopes.columns):
        records = F.coalesce(_lean(envelopes, "data", key), _lean(envelopes, "heroes", key))
    else:
        records = quoted(payload_column(envelopes, "heroes" if legacy else None))
    stamped = envelopes.select(stamp, records.alias("_records"), *carry)
    record = _record_type(stamped, "_records")
    rows = stamped.select(stamped.columns[0], F.explode("_records").alias("_record"), *carry)
    id_value = F.col("_record").getField(key)
    if isinstance(record[key].dataType, DecimalType):
        id_value = id_value.try_cast("bigint")
    return rows.select(
        id_value.alias(key),
        *[as_counter(F.col("_record").getField(c), record[c].dataType).alias(c) for c in COUNTERS],
        stamped.columns[0],
        *carry,
    )


def _record_type(envelopes: DataFrame, payload: str) -> StructType:
    dtype = envelopes.schema[payload].dataType
    if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, StructType):
        return dtype.elementType
    raise NotRecords(f"{payload!r} is {dtype.simpleString()}, not an array of records")


def _lean(envelopes: DataFrame, payload: str, key: str) -> Column:
    """The payload array cut down to the fields needed, so that old and new payloads have one type."""
    record = _record_type(envelopes, payload)
    types = {key: "bigint", **dict.fromkeys(COUNTERS, "string")}

    def lean(element: Column) -> Column:
        return F.struct(
            *[
                (element.getField(f).cast("string") if f in record.names else F.lit(None)).try_cast(t).alias(f)
                for f, t in types.items()
            ]
        )

    return F.transform(quoted(payload), lean)


def win_rate(records: DataFrame, key: str, *, overflow: str = "raise", stamps: str = "utc") -> DataFrame:
    """Totals, freshest stamp and win rate per key, over **all** snapshots.

    Counters are summed over every snapshot, not taken from the latest, so cumulative snapshots count
    repeatedly and the rate is weighted by snapshots.  A null key is a group of its own; keys without
    matches are left out.  The rate is the ratio of the sums, rounded half-up to four digits.

    ``records`` has ``key, wins, losses, matches`` and either ``fetched_us`` or ``fetched_at``.  With
    ``stamps="text"`` the freshest stamp is the greatest ``fetched_at`` text of whatever format, at the price
    of a sort of all records; with ``stamps="lenient"`` unreadable ones are passed over.  ``overflow="null"`` gives null where a 64-bit sum overflows.
    """
    total = {"raise": F.sum, "null": F.try_sum}[overflow]
    if stamps == "text":
        stamp, shown = F.col("fetched_at"), F.col("_latest")
    else:
        parse = utc_micros if stamps == "lenient" else iso_micros
        stamp = F.col("fetched_us") if "fetched_us" in records.columns else parse(F.col("fetched_at"))
        shown = micros_to_iso(F.col("_latest"))
    totals = (
        records.select(
            quoted(key).alias(key),
            *[as_counter(quoted(c), records.schema[c].dataType).alias(c) for c in COUNTERS],
            stamp.alias("_stamp"),
        )
        .groupBy(quoted(key))
        .agg(*[total(c).alias(f"total_{c}") for c in COUNTERS], F.max("_stamp").alias("_latest"))
    )
    return rates(totals, key, shown)


def rates(totals: DataFrame, key: str, shown: Column) -> DataFrame:
    """The collection of keys with matches out of their totals; ``shown`` is the freshest stamp as text."""
    return totals.where(F.col("total_matches") > 0).select(
        quoted(key),
        *[f"total_{c}" for c in COUNTERS],
        shown.alias("last_updated"),
        F.round(F.col("total_wins") / F.col("total_matches"), 4).alias("win_rate"),
    )


def rejected_counters(envelopes: DataFrame, payload: str = "data") -> DataFrame:
    """One row: how many counter values are present but are no numbers, per counter."""
    record = _record_type(envelopes, payload)
    rows = envelopes.select(F.explode(quoted(payload)).alias("_record"))
    return rows.agg(
        F.count(F.lit(1)).alias("records"),
        *[
            F.count_if(
                F.col("_record").getField(c).isNotNull()
                & as_counter(F.col("_record").getField(c), record[c].dataType).isNull()
            ).alias(f"rejected_{c}")
            for c in COUNTERS
        ],
    )


def with_record_count(envelopes: DataFrame, payload: str = "data") -> DataFrame:
    """Add the number of records of each envelope; a null payload has none."""
    return envelopes.withColumn("record_count", F.coalesce(F.array_size(quoted(payload)), F.lit(0)).cast("bigint"))


def non_empty(envelopes: DataFrame, payload: str = "data") -> DataFrame:
    """Only envelopes with at least one record."""
    return envelopes.where(F.size(quoted(payload)) > 0)


def tally(frame: DataFrame, by: str, name: str = "n") -> DataFrame:
    """Row count per value."""
    return frame.groupBy(by).agg(F.count(F.lit(1)).alias(name))
