"""Helpers that the operators share: row identity, staging, reading, words."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstats.session import scratch_path

SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_TEXTS = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(frame: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write below the shared folder and read back: cuts the lineage, survives a lost executor."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    writer = frame.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, a null as the empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two longs that tell apart rows of different id or text, nulls included; equal rows share them."""
    return [
        F.xxhash64(F.col(doc_id), F.lit(0), F.col(text), F.col(text).isNull()).alias("_k1"),
        F.xxhash64(F.lit(1), F.col(text), F.col(doc_id), F.col(doc_id).isNull()).alias("_k2"),
    ]


def crc_mod(column: str, n: int) -> Column:
    """crc32 of a value's text, modulo ``n``; null (never a remainder) for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only.  Where every character is one byte, the built-in lower does the same."""
    plain = F.octet_length(column) == F.char_length(column)
    return F.when(plain, F.lower(column)).otherwise(F.translate(column, UPPER, UPPER.lower()))


def byte_words(text: str | None) -> list[bytes]:
    """Words between blanks of [space, tab to carriage return]; ``bytes.split`` uses just these six."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def labelled(docs: DataFrame, labels: DataFrame, usable: Column, mark: str, max_rows: int, max_bytes: int) -> list[tuple[str, int]]:
    """(text, label) of at most ``max_rows`` rows labelled 0 or 1 in the column ``mark``; ``usable`` is a condition on doc_id.

    Sizes are looked at before any text moves: a text above ``max_bytes / LEAST_TEXTS`` teaches nothing, and one that
    no longer fits into ``max_bytes`` is passed over for those behind it.  Equal rows teach once.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(mark).cast("int").alias("label")).where(
        usable & F.col("label").isin(0, 1)).withColumn("h", F.xxhash64("doc_id"))
    few = rows.orderBy("h", "doc_id", "label").limit(4 * max_rows)  # some have no text, or one too large
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    order = ["h", "doc_id", "label", "t"]
    sized = texts.select("doc_id", F.xxhash64("text").alias("t"), F.octet_length("text").alias("size"))
    fit = sized.where(F.col("size") <= max_bytes // LEAST_TEXTS).join(F.broadcast(few), "doc_id").distinct()
    room, chosen = max_bytes, []
    for r in fit.orderBy(*order).limit(max_rows).collect():  # numbers only
        if r["size"] <= room:
            room -= r["size"]
            chosen.append((r["doc_id"], r["t"], r["label"], len(chosen)))
    spark = docs.sparkSession
    wanted = spark.createDataFrame(chosen, "doc_id long, t long, label int, place int")
    found = texts.withColumn("t", F.xxhash64("text")).join(F.broadcast(wanted), ["doc_id", "t"]).dropDuplicates(["place"])
    return [tuple(r) for r in found.orderBy("place").select("text", "label").collect()]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
