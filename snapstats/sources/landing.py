"""Scan of landed JSON envelopes, and the bronze table that spares later runs that scan."""

from __future__ import annotations

import functools
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from snapstats.functions.stamps import iso_micros
from snapstats.operators.shape import MissingPayload, explode_records, quoted


CORRUPT = "_corrupt_record"


class Scan(NamedTuple):
    """What became of an endpoint scan: ``frame`` is None unless ``status`` is OK."""

    frame: DataFrame | None
    status: str
    message: str


def endpoint_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/raw/{name}"


def scan_endpoint(
    spark: SparkSession,
    root: str,
    name: str,
    schema: StructType | None = None,
    corrupt: bool = False,
) -> Scan:
    """All envelopes of an endpoint, at any folder depth, one JSON object per file.

    Every date and every batch part is one input; fields that differ between files are merged.  Without
    ``schema`` Spark infers one from all of the files.
    With ``corrupt`` the text of what could not be read, in whole or in part, is a column ``_corrupt_record``
    (without ``schema`` there is one only if there is such text).
    An absent or empty folder is skipped; any other error is reported and skipped.
    """
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(StructType([*schema, StructField(CORRUPT, StringType())]) if corrupt else schema)
    try:
        frame = reader.json(endpoint_path(root, name))
        if frame.isEmpty():
            return Scan(None, "SKIP", "folder has no data")
        return Scan(frame, "OK", "")
    except AnalysisException:
        return Scan(None, "SKIP", "folder not found or empty")
    except Exception as error:
        return Scan(None, "SKIP", f"scan failed: {error}")


def read_endpoint(spark: SparkSession, root: str, name: str, **how) -> DataFrame | None:
    """The frame of `scan_endpoint`, or None."""
    return scan_endpoint(spark, root, name, **how).frame


def read_envelope_lines(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Envelopes stored as JSON lines, which Spark can split within a file."""
    reader = spark.read.option("recursiveFileLookup", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def union_snapshots(frames: list[DataFrame]) -> DataFrame:
    """Snapshots with differing columns as one bag of rows; missing columns are null.

    A column that is text in one snapshot and another plain type elsewhere becomes text, as JSON inference does.
    """
    kinds: dict[str, set[str]] = {}
    for frame in frames:
        for name, kind in frame.dtypes:
            kinds.setdefault(name, set()).add(kind)
    text = {name for name, found in kinds.items() if "string" in found and not any("<" in k for k in found)}
    frames = [f.withColumns({c: F.col(f"`{c}`").cast("string") for c in f.columns if c in text}) for f in frames]
    return functools.reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), frames)


def bronze_records(envelopes: DataFrame, payload: str = "data") -> DataFrame:
    """Exploded records with their date, and with their stamp also as microseconds.

    ``fetched_us`` spares later aggregates the parsing of text.
    """
    if payload not in envelopes.columns:
        raise MissingPayload(f"envelopes have no {payload!r} column")
    made = ("fetched_us", "fetch_date")  # once per envelope, below the explode
    stamped = envelopes.select(
        "fetched_at",
        iso_micros(F.col("fetched_at")).alias(made[0]),
        F.substring("fetched_at", 1, 10).alias(made[1]),
        quoted(payload).alias(payload),
    )
    records = explode_records(stamped, payload, ("fetched_at", *made))
    return records.select(*[quoted(c) for c in records.columns if c not in made], *made)


def land_bronze(
    envelopes: DataFrame, path: str, endpoint: str, *, payload: str = "data", mode: str = "overwrite"
) -> None:
    """Write records as Parquet below ``<path>/<endpoint>/fetch_date=``; the dates written are replaced.

    JSON envelopes cannot be split, cannot skip columns and carry no statistics; this is the one pass
    that reads them.  The rebalance hint evens out files: small dates share a task, a hot date is split.
    """
    (
        bronze_records(envelopes, payload)
        .hint("rebalance", "fetch_date")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("fetch_date")
        .parquet(f"{path.rstrip('/')}/{endpoint}")
    )


def read_bronze(
    spark: SparkSession,
    path: str,
    endpoint: str,
    first_date: str | None = None,
    last_date: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Records of one endpoint; the date range prunes folders.

    Without ``schema`` the schemas of all files are merged, so that fields that came or went over time are
    kept; declaring one spares that pass over the file footers.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    frame = reader.parquet(f"{path.rstrip('/')}/{endpoint}")
    day = F.col("fetch_date").cast("string")
    if first_date is not None:
        frame = frame.where(day >= first_date)
    if last_date is not None:
        frame = frame.where(day <= last_date)
    return frame
