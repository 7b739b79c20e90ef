"""Numbered blocks of items, so that each landed file stays bounded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapstats.fixed_values import BLOCK_ITEMS
from snapstats.operators.joins import even_join

BUCKET_DIGITS = 3


def item_bucket(item: Column) -> Column:
    """One of 4,096 even buckets of distinct items (the first hex digits of their MD5)."""
    return F.left(F.md5(item.cast("string")), F.lit(BUCKET_DIGITS))


def number_blocks(items: DataFrame, key: str, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Distinct items as ``key, block, suffix``: blocks of ``block_items``, numbered from 1.

    All blocks but the last are full.  The suffix is empty when everything fits one block.  Items are
    ranked by bucket and, within it, by value: each bucket is ranked by its own task, and only the 4,096
    bucket sizes are summed up in one place.  A plain rank would pass all items through one task.
    """
    known = items.select(key).where(F.col(key).isNotNull())
    bucketed = known.withColumn("_bucket", item_bucket(F.col(key))).distinct()
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    everything = Window.partitionBy(F.lit(0))
    before = everything.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(everything).alias("_items"),
    )
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    block = F.floor((rank - 1) / block_items) + 1
    suffix = F.when(F.col("_items") > block_items, F.concat(F.lit("_batch"), F.col("block").cast("string")))
    # at most 4,096 offset rows
    return (
        bucketed.join(F.broadcast(offsets), "_bucket")
        .select(key, block.alias("block"), "_items")
        .select(key, "block", F.coalesce(suffix, F.lit("")).alias("suffix"))
    )


def attach_blocks(records: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """Records with the block and suffix of their item."""
    return even_join(records, blocks, [key], "inner")


def block_totals(records_with_blocks: DataFrame) -> DataFrame:
    """Records per block.  An empty block keeps its number but has no row here."""
    return records_with_blocks.groupBy("block", "suffix").agg(F.count(F.lit(1)).alias("records"))
