"""Lenient integer parsing, for request parameters (on the driver) and for columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_DECIMAL = r"^\s*([+-]?[0-9]+)"
_HEX = r"^\s*([+-]?)0[xX]([0-9a-fA-F]+)"


def leading_int(value: object) -> int | None:
    """The integer that the text starts with, or None: ``"12abc"`` is 12, ``"abc"`` is None."""
    text = "" if value is None else str(value)
    if found := re.match(_HEX, text):
        return int(f"{found[1]}{found[2]}", 16)
    found = re.match(_DECIMAL, text)
    return int(found[1]) if found else None


def leading_int_col(text: Column) -> Column:
    """`leading_int` of a text column; null where there is none or it does not fit 64 bits."""
    found = F.ltrim(F.regexp_extract(text, _HEX, 2), F.lit("0"))
    # more than 16 digits cannot fit, and conv would raise
    digits = F.when(found == "", F.lit(0).cast("bigint")).when(F.length(found) <= 16, F.conv(found, 16, 10).try_cast("bigint"))
    signed = F.when(F.regexp_extract(text, _HEX, 1) == "-", -digits).otherwise(digits)
    return F.when(text.rlike(_HEX), signed).otherwise(
        F.regexp_extract(text, _DECIMAL, 1).try_cast("bigint")
    )


def page_number(value: object) -> int:
    """Page of a request: absent, zero or unreadable means 1, negative means 1."""
    return max(leading_int(value) or 1, 1)


def page_size(value: object, default: int, most: int) -> int:
    """Page size of a browse request, between 1 and ``most``."""
    return min(max(leading_int(value) or default, 1), most)


def top_size(value: object, default: int, most: int) -> int:
    """Row limit of a top-n request.  A negative limit asks for that many rows, as document stores do."""
    return abs(min(leading_int(value) or default, most))
