"""Records out of envelopes, and nested fields out of records."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


class MissingPayload(ValueError):
    """The envelopes have no usable payload column."""


class NotRecords(TypeError):
    """The payload is not an array of records."""


class ColumnCollision(ValueError):
    """Two output columns would have the same name."""


def quoted(*path: str) -> Column:
    """A column by its exact (nested) name, dots and backticks included."""
    return F.col(".".join("`" + part.replace("`", "``") + "`" for part in path))


def fresh_name(name: str, *frames: DataFrame) -> str:
    """A name that no column of the frames has, whatever its case."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _named(pairs: Iterator[tuple[str, Column]], on_collision: str) -> list[Column]:
    """Alias the columns; Spark names ignore case, so ``A`` and ``a`` collide."""
    if on_collision not in ("error", "suffix"):
        raise ValueError("on_collision is 'error' or 'suffix'")
    taken: set[str] = set()
    out = []
    for name, column in pairs:
        unique, n = name, 2
        while unique.lower() in taken:
            if on_collision == "error":
                raise ColumnCollision(f"more than one column would be called {name!r}")
            unique, n = f"{name}_{n}", n + 1
        taken.add(unique.lower())
        out.append(column.alias(unique))
    return out


def payload_column(envelopes: DataFrame, legacy: str | None = None) -> str:
    """``data``, else the legacy payload column when the frame has only that."""
    for name in ("data", legacy):
        if name is not None and name in envelopes.columns:
            return name
    raise MissingPayload("envelopes have no payload column")


def explode_records(
    envelopes: DataFrame,
    payload: str = "data",
    carry: tuple[str, ...] = ("fetched_at",),
    on_collision: str = "error",
) -> DataFrame:
    """One row per element of the payload array, its fields as columns after the carried ones.

    Null and empty arrays give no rows.  A record field named like a carried column is an error, or gets
    a numbered suffix.
    """
    if payload not in envelopes.columns:
        raise MissingPayload(f"envelopes have no {payload!r} column")
    dtype = envelopes.schema[payload].dataType
    if not (isinstance(dtype, ArrayType) and isinstance(dtype.elementType, StructType)):
        raise NotRecords(f"{payload!r} is {dtype.simpleString()}, not an array of records")
    rows = envelopes.select(*carry, F.explode(quoted(payload)).alias("_record"))

    def columns() -> Iterator[tuple[str, Column]]:
        for name in carry:
            yield name, F.col(name)
        for name in dtype.elementType.names:
            yield name, F.col("_record").getField(name)

    return rows.select(*_named(columns(), on_collision))


def flatten(frame: DataFrame, on_collision: str = "error") -> DataFrame:
    """Each struct column replaced, in place, by its fields as ``{column}_{field}``.

    One level only: arrays and deeper structs stay.
    """

    def columns() -> Iterator[tuple[str, Column]]:
        for outer in frame.schema:
            if isinstance(outer.dataType, StructType):
                for inner in outer.dataType:
                    yield f"{outer.name}_{inner.name}", quoted(outer.name, inner.name)
            else:
                yield outer.name, quoted(outer.name)

    return frame.select(*_named(columns(), on_collision))


def shallow(envelopes: DataFrame, on_collision: str = "error", carry: tuple[str, ...] = ("fetched_at",)) -> DataFrame:
    """Records as rows, nested fields left nested: for deep or large records."""
    return explode_records(envelopes, carry=carry, on_collision=on_collision)


def generic(envelopes: DataFrame, on_collision: str = "error", carry: tuple[str, ...] = ("fetched_at",)) -> DataFrame:
    """Records as rows, struct fields flattened one level."""
    return flatten(shallow(envelopes, on_collision, carry), on_collision)


def inject_key(
    responses: DataFrame, key: str, payload: str = "data", carry: tuple[str, ...] = ("fetched_at",)
) -> DataFrame:
    """Records as rows, each with the key of the request that returned it.

    The request's value replaces a record field of that name.
    """
    request_key = f"_request_{key}"
    rows = explode_records(
        responses.withColumnRenamed(key, request_key), payload, (*carry, request_key)
    )
    return rows.withColumn(key, F.col(request_key)).drop(request_key)


def array_of(frame: DataFrame, *path: str) -> StructType | None:
    """Element struct of the array at a nested path, or None when the schema has no such array."""
    dtype = frame.schema
    for step in path:
        if not isinstance(dtype, StructType) or step not in dtype.names:
            return None
        dtype = dtype[step].dataType
    if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, StructType):
        return dtype.elementType
    return None
