"""Cell text as a dashboard shows it."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstats.fixed_values import COLUMN_LABELS, ELLIPSIS, HIGH_BAND_FROM, MID_BAND_FROM, MISSING
from snapstats.functions.stamps import display_time

_NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, _NESTED)


def or_dash(text: Column) -> Column:
    """Null as a dash."""
    return F.coalesce(text, F.lit(MISSING))


def percent(ratio: Column) -> Column:
    """0.5234 as ``52.34%``."""
    return F.format_string("%.2f%%", ratio.cast("double") * 100)


def grouped_number(number: Column, dtype: T.DataType) -> Column:
    """Thousands separators and at most three decimals: 1234567.5 as ``1,234,567.5``."""
    if isinstance(dtype, T.IntegralType):
        return F.format_number(number, 0)
    # format_number rounds half-even, so round half-up first
    return F.call_function(
        "format_number", F.round(number.cast("double"), 3), F.lit("#,##0.###")
    )


def plain_number(number: Column, dtype: T.DataType) -> Column:
    """Shortest decimal text without exponent: 17.0 as ``17``, 1.0E-4 as ``0.0001``."""
    text = number.cast("string")
    if isinstance(dtype, T.IntegralType):
        return text
    whole = number == F.floor(number)
    if isinstance(dtype, T.DecimalType):
        return F.when(whole, F.floor(number).cast("string")).otherwise(_trimmed(text))
    size = F.abs(number)
    # the text of a double is already short between a thousandth and ten million
    return (
        F.when(whole & (size < 1e18), F.floor(number).cast("string"))
        .when((size >= 1e-3) & (size < 1e7), text)
        .when((size >= 1e-6) & (size < 1e16), _trimmed(text.cast("decimal(38,22)").cast("string")))
        .otherwise(text)
    )


def _trimmed(decimals: Column) -> Column:
    return F.regexp_replace(decimals, "0+$", "")


def short_count(count: Column) -> Column:
    """1.2M, 34k, or the plain count."""
    return (
        F.when(count >= 1_000_000, F.format_string("%.1fM", count / 1_000_000))
        .when(count >= 1_000, F.format_string("%.0fk", count / 1_000))
        .otherwise(count.cast("string"))
    )


def clipped_json(value: Column, width: int = 80) -> Column:
    """JSON text of a nested value, cut to ``width`` characters with an ellipsis."""
    text = F.to_json(value, {"ignoreNullFields": "false"})
    cut = F.concat(F.substring(text, 1, width), F.lit(ELLIPSIS))
    return F.when(F.length(text) > width, cut).otherwise(text)


def band(percentage: Column) -> Column:
    """Win-rate band of a percentage; null stays null."""
    return (
        F.when(percentage >= HIGH_BAND_FROM, F.lit("high"))
        .when(percentage >= MID_BAND_FROM, F.lit("mid"))
        .when(percentage.isNotNull(), F.lit("low"))
    )


def bar_width(percentage: Column) -> Column:
    """Bar length in percent, never above 100."""
    return F.least(percentage, F.lit(100.0))


def title_words(text: Column) -> Column:
    """``hero_counter_stats`` as ``Hero Counter Stats``; letters after the first stay as they are."""
    starts = F.split(F.replace(text, F.lit("_"), F.lit(" ")), r"(?<![A-Za-z0-9])(?=[A-Za-z0-9])")
    words = F.transform(
        starts,
        lambda word: F.when(
            word.rlike("^[a-z]"), F.concat(F.upper(F.left(word, F.lit(1))), F.substring(word, F.lit(2), F.length(word)))
        ).otherwise(word),
    )
    return F.array_join(words, "")


def column_label(name: str) -> str:
    """Display label of a column name."""
    if name in COLUMN_LABELS:
        return COLUMN_LABELS[name]
    return re.sub(r"(?<![A-Za-z0-9])[a-z]", lambda m: m[0].upper(), name.replace("_", " "))


def is_hero_column(name: str) -> bool:
    """Columns that hold hero ids, by name."""
    return f"_{name}".endswith("_hero_id")


def cell(name: str, dtype: T.DataType, value: Column) -> Column:
    """Text of one cell, chosen by column name and type.  Hero ids are resolved elsewhere, by a join."""
    if is_nested(dtype):
        shown = clipped_json(value)
    elif name == "win_rate" and is_number(dtype):
        shown = percent(value)
    elif is_number(dtype):
        shown = F.when(F.abs(value) >= 1000, grouped_number(value, dtype)).otherwise(
            plain_number(value, dtype)
        )
    elif name in ("last_updated", "fetched_at") and isinstance(dtype, T.StringType):
        shown = display_time(value)
    else:
        shown = value.cast("string")
    return or_dash(shown)
