"""Ids replaced or accompanied by names."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

from snapstats.fixed_values import MISSING, NAME_NOT_FOUND
from snapstats.functions.display import is_hero_column
from snapstats.operators.joins import is_small, lookup_join
from snapstats.operators.shape import fresh_name, quoted


class Names(NamedTuple):
    """One name per id, and whether that is little enough to send to every executor."""

    frame: DataFrame
    small: bool


def names_of(dimension: DataFrame, key: str, name: str) -> Names:
    """One row per id, so that a lookup never multiplies rows."""
    unique = (
        dimension.where(F.col(key).isNotNull())
        .groupBy(F.col(key).cast("bigint").alias("_id"))
        .agg(F.max(name).alias("_name"))
    )
    return Names(unique, is_small(dimension))


def _joined(frame: DataFrame, column: str, names: Names) -> tuple[DataFrame, Column]:
    """The frame with the looked-up name beside it, and that name."""
    dtype = frame.schema[column].dataType
    value = quoted(column)
    if isinstance(dtype, IntegralType):
        key = value.cast("bigint")
    elif isinstance(dtype, NumericType):
        key = F.when(value == F.floor(value), F.floor(value).cast("bigint"))
    else:
        key = value.cast("string").try_cast("bigint")
    on, name = fresh_name("_lookup_id", frame), fresh_name("_lookup_name", frame)
    return lookup_join(frame.withColumn(on, key), names.frame.toDF(on, name), [on], names.small), F.col(name)


def _resolve(frame: DataFrame, names: Names, column: str, out: str) -> DataFrame:
    """Put the resolved name of ``column`` into ``out``, which may be the column itself."""
    fallback = F.when(quoted(column).isNull(), F.lit(MISSING)).otherwise(
        F.concat(F.lit("Hero "), quoted(column).cast("string"))
    )
    joined, name = _joined(frame, column, names)
    found = F.coalesce(F.when(F.length(name) > 0, name), fallback).alias(out)
    if out in frame.columns:
        return joined.select(*[found if c == out else quoted(c) for c in frame.columns])
    return joined.select(*[quoted(c) for c in frame.columns], found)


def hero_name(frame: DataFrame, dimension: DataFrame, column: str = "hero_id", out: str = "hero_name") -> DataFrame:
    """Add the hero's name; an unknown id gives ``Hero <id>``, a null id a dash."""
    return _resolve(frame, names_of(dimension, "hero_id", "hero_name"), column, out)


def hero_columns(frame: DataFrame) -> list[str]:
    """Columns that hold hero ids, found by name."""
    return [c for c in frame.columns if is_hero_column(c)]


def name_all_heroes(frame: DataFrame, dimension: DataFrame) -> DataFrame:
    """Every hero-id column replaced by hero names."""
    columns = hero_columns(frame)
    if columns:
        names = names_of(dimension, "hero_id", "hero_name")
        for column in columns:
            frame = _resolve(frame, names, column, column)
    return frame


def name_or_not_found(
    frame: DataFrame, dimension: DataFrame, column: str, key: str, name: str, default: str = NAME_NOT_FOUND
) -> DataFrame:
    """Add ``name`` from a lookup table, or a default where the id is unknown."""
    joined, found = _joined(frame, column, names_of(dimension, key, name))
    return joined.select(*[quoted(c) for c in frame.columns], F.coalesce(found, F.lit(default)).alias(name))
