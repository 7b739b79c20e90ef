"""Filters with document-store meaning."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType

from snapstats.functions.display import is_nested, is_number, plain_number
from snapstats.functions.parsing import leading_int
from snapstats.operators.shape import quoted


def equals_id(frame: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose id equals the number in ``value``; no number means no filter.

    As in a document store, a frame without the column, or with a column of another type, has no such
    rows, and an array matches by any of its elements.
    """
    wanted = leading_int(value)
    if wanted is None:
        return frame
    if column not in frame.columns:
        return frame.where(F.lit(False))
    dtype = frame.schema[column].dataType
    if isinstance(dtype, NumericType):
        return frame.where(quoted(column) == wanted)
    if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, NumericType):
        return frame.where(F.exists(quoted(column), lambda e: e == wanted))
    return frame.where(F.lit(False))


def positive(frame: DataFrame, column: str) -> DataFrame:
    """Rows with a valid id: not null and above zero."""
    return frame.where(quoted(column) > 0)


def search_text(frame: DataFrame, column: str, nested: bool = False, nulls: bool = False) -> Column | None:
    """The lower-case text a search looks at, or None for a column it skips."""
    dtype, value = frame.schema[column].dataType, quoted(column)
    if is_nested(dtype):
        if not nested:
            return None
        text = F.lower(F.to_json(value))
    elif is_number(dtype):
        text = plain_number(value, dtype)
    else:
        text = F.lower(value.cast("string"))
    return F.coalesce(text, F.lit("null")) if nulls else text


def _may_be_number(query: str) -> bool:
    """Whether the text of a number can contain the query."""
    return set(query) <= set("0123456789.e+-") or query in "nan" or query in "infinity"


def search(frame: DataFrame, query: str | None, nested: bool = False, nulls: bool = False) -> DataFrame:
    """Rows with the text in any column, whatever its case.

    Apply it to a page for the dashboard's meaning, or to a whole table.  ``nested`` also looks into
    nested values, ``nulls`` lets a null match the word null.  Number columns are not even read when the
    query cannot be part of a number.
    """
    if not query:
        return frame
    query = query.lower()
    hits = []
    for field in sorted(frame.schema, key=lambda f: is_number(f.dataType)):
        if is_number(field.dataType) and not (_may_be_number(query) or (nulls and query in "null")):
            continue
        text = search_text(frame, field.name, nested, nulls)
        if text is not None:
            hits.append(F.coalesce(F.contains(text, F.lit(query)), F.lit(False)))
    return frame.where(functools.reduce(operator.or_, hits, F.lit(False)))
