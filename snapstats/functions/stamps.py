"""UTC ISO-8601 stamps.

A stamp is text such as ``2026-04-05T10:00:00+00:00``, with six fraction digits unless they are all
zero.  Aggregates work on its microseconds instead of the text: a fixed-width number can sit in a hash
aggregation buffer, whereas ``max`` of a string makes Spark sort every input row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY = 86_400_000_000
_UTC_STAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]00:00)$"


def micros_to_iso(micros: Column) -> Column:
    """Microseconds since 1970 as stamp text, whatever the session time zone is."""
    in_day = F.pmod(micros, F.lit(_DAY))
    day = F.date_add(F.lit("1970-01-01").cast("date"), ((micros - in_day) / _DAY).cast("int"))
    seconds = F.floor(in_day / 1_000_000)
    clock = F.format_string(
        "%02d:%02d:%02d",
        F.floor(seconds / 3600),
        F.pmod(F.floor(seconds / 60), F.lit(60)),
        F.pmod(seconds, F.lit(60)),
    )
    fraction = F.pmod(micros, F.lit(1_000_000))
    tail = F.when(fraction > 0, F.format_string(".%06d", fraction)).otherwise(F.lit(""))
    return F.when(
        micros.isNotNull(),
        F.concat(day.cast("string"), F.lit("T"), clock, tail, F.lit("+00:00")),
    )


def iso_utc(moment: Column) -> Column:
    """A timestamp (an instant) as stamp text."""
    return micros_to_iso(F.unix_micros(moment.cast("timestamp")))


def utc_micros(stamp: Column) -> Column:
    """Stamp text as microseconds; null for text that is not a UTC stamp."""
    return F.when(stamp.rlike(_UTC_STAMP), F.unix_micros(F.try_to_timestamp(stamp)))


def iso_micros(stamp: Column) -> Column:
    """Stamp text as microseconds; fails on text that is not a UTC stamp.

    A stamp's offset is zero, written in figures or as ``Z``, and its fraction has up to six digits.
    """
    return F.when(stamp.isNull(), F.lit(None).cast("bigint")).otherwise(
        F.coalesce(
            utc_micros(stamp), F.raise_error(F.concat(F.lit("not a UTC ISO-8601 stamp: "), stamp)).cast("bigint")
        )
    )


def stamp_path(moment: Column) -> Column:
    """The dated part of a landing path, e.g. ``2026/04/05/100000``."""
    return F.date_format(moment, "yyyy/MM/dd/HHmmss")


def landing_path(endpoint: Column, stamp: Column, suffix: Column) -> Column:
    """Path of a landed envelope below the root, from its stamp text."""
    day = F.translate(F.substring(stamp, 1, 10), "-", "/")
    clock = F.regexp_replace(F.substring(stamp, 12, 8), ":", "")
    return F.concat(F.lit("raw/"), endpoint, F.lit("/"), day, F.lit("/"), clock, suffix, F.lit(".json"))


def display_time(text: Column, pattern: str = "M/d/yyyy, h:mm:ss a", bad: str | None = "Invalid Date") -> Column:
    """Stamp text for people, in the session time zone.

    Text that is no time becomes ``bad``; with ``bad=None`` it stays as it is.
    """
    shown = F.date_format(F.try_to_timestamp(text), pattern)
    return F.when(text.isNotNull(), F.coalesce(shown, text if bad is None else F.lit(bad)))
