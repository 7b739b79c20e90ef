"""Result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapstats.sinks.versions import Version, fresh_folder, publish, read_published, write_index

FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")


def write_counted(frame: DataFrame, path: str, fmt: str = "parquet", options: dict[str, str] | None = None) -> int:
    """Write to a new folder and return the number of rows, counted by the write itself."""
    written = Observation()
    counted = frame.observe(written, F.count(F.lit(1)).alias("rows"))
    counted.write.format(fmt).mode("overwrite").options(**(options or {})).option("partitionOverwriteMode", "static").save(path)
    return written.get["rows"]


def write_collection(
    frame: DataFrame, target: str, collection: str, fmt: str = "parquet", options: dict[str, str] | None = None
) -> int:
    """Replace a collection by the frame, also when it is empty, and return the number of rows written.

    File formats write a new version below ``target/collection`` and publish it when it is whole; `read_collection`
    finds it.  A write that fails leaves the published one as it is.  For any other Spark sink pass its ``fmt`` and
    ``options``; how that replaces is up to the sink.
    """
    if fmt not in FILE_FORMATS:
        written = Observation()
        frame.observe(written, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode("overwrite").options(**(options or {})).save()
        return written.get["rows"]
    place, folder = f"{target.rstrip('/')}/{collection}", fresh_folder()
    rows = write_counted(frame, f"{place}/{folder}", fmt, options)
    publish_folders(frame.sparkSession, place, [folder], rows, fmt=fmt)
    return rows


def publish_folders(
    spark: SparkSession, place: str, folders: list[str], rows: int | None = None, hidden: tuple[str, ...] = (), note: dict | None = None,
    fmt: str = "parquet",
) -> Version:
    """Publish folders as the collection; Parquet ones with an index of their files."""
    index = None
    if fmt == "parquet":
        index, rows = write_index(spark, place, folders)
    return publish(spark, place, Version(folders, rows, index, hidden, note))


def read_collection(spark: SparkSession, target: str, collection: str, fmt: str = "parquet") -> DataFrame:
    """The collection as it was last published; a plain table if it never was."""
    return read_published(spark, f"{target.rstrip('/')}/{collection}", fmt=fmt)
