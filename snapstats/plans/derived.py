"""Envelopes, payloads and records derived from the benchmark tables, as inputs of the queries.

Grouping into arrays is bounded by construction: an envelope covers one month and a range of
``KEYS_PER_ENVELOPE`` keys, each of which it holds once.  Everything else is one input row per record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS_PER_ENVELOPE = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counter_snapshots(lines: DataFrame, source: str, key: str) -> DataFrame:
    """Monthly counters per key: ``fetched_at, <key>, wins, losses, matches``."""
    counted = lines.groupBy(F.trunc("l_shipdate", "month").alias("_month"), F.col(source).alias(key)).agg(
        F.count_if(F.col("l_returnflag") == "A").alias("wins"),
        F.count_if(F.col("l_returnflag") == "R").alias("losses"),
    )
    return counted.select(
        F.concat(F.col("_month").cast("string"), F.lit("T00:00:00+00:00")).alias("fetched_at"),
        key,
        "wins",
        "losses",
        (F.col("wins") + F.col("losses")).alias("matches"),
    )


def counter_envelopes(lines: DataFrame, source: str, key: str, endpoint: str) -> DataFrame:
    """The monthly counters wrapped as envelopes, records in key order."""
    record = F.struct(key, "wins", "losses", "matches")
    return (
        counter_snapshots(lines, source, key)
        .groupBy("fetched_at", F.floor(F.col(key) / KEYS_PER_ENVELOPE).alias("_range"))
        .agg(F.sort_array(F.collect_list(record)).alias("data"))
        .select("fetched_at", F.lit(endpoint).alias("endpoint"), F.size("data").cast("bigint").alias("record_count"), "data")
    )


def hero_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counter_snapshots(table(spark, sf_dir, "lineitem"), "l_suppkey", "hero_id")


def item_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counter_snapshots(table(spark, sf_dir, "lineitem"), "l_orderkey", "item_id")


def hero_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counter_envelopes(table(spark, sf_dir, "lineitem"), "l_suppkey", "hero_id", "hero_stats")


def item_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counter_envelopes(table(spark, sf_dir, "lineitem"), "l_orderkey", "item_id", "item_stats")


def mixed_hero_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hero envelopes of which those of even months have the old payload column."""
    old = F.substring("fetched_at", 6, 2).cast("int") % 2 == 0
    return hero_envelopes(spark, sf_dir).select(
        "fetched_at", F.when(~old, F.col("data")).alias("data"), F.when(old, F.col("data")).alias("heroes")
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a nested struct, stamped by day."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.col("ts").cast("date").cast("string"), F.lit("T00:00:00+00:00")).alias("fetched_at"),
        "event_id",
        "event_type",
        "value",
        F.from_json("props", "k bigint").alias("props"),
    )


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_records(spark, sf_dir).select(
        "fetched_at", F.array(F.struct("event_id", "event_type", "value", "props")).alias("data")
    )


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw response text of all kinds: arrays for views, null for errors, numbers for logins, else objects."""
    kind, props = F.col("event_type"), F.col("props")
    text = (
        F.when(kind == "view", F.concat(F.lit("["), props, F.lit(","), props, F.lit("]")))
        .when(kind == "error", F.lit("null"))
        .when(kind == "click", F.col("user_id").cast("string"))
        .otherwise(props)
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("payload"))


def match_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A match fetched once per order line; odd lines hold nested players, even lines flat ones.

    Every record has a valid and an invalid account.
    """
    odd = F.col("l_linenumber") % 2 == 1
    players = F.array(
        F.struct(F.col("l_suppkey").alias("account_id"), F.col("l_partkey").alias("hero_id")),
        F.struct((-F.col("l_partkey")).alias("account_id"), F.col("l_suppkey").alias("hero_id")),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.col("l_shipdate").cast("date").cast("string"), F.lit("T00:00:00+00:00")).alias("fetched_at"),
        F.col("l_orderkey").alias("match_id"),
        F.when(odd, F.struct(players.alias("players"))).alias("match_info"),
        F.when(~odd, players).alias("players"),
    )


def match_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_records(spark, sf_dir).select(
        "fetched_at", F.array(F.struct("match_id", "match_info", "players")).alias("data")
    )


def history_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match histories as returned per requested account; the records themselves carry a wrong account."""
    record = F.struct(
        F.lit(-1).cast("bigint").alias("account_id"),
        F.col("l_orderkey").alias("match_id"),
        F.col("l_suppkey").alias("hero_id"),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.col("l_shipdate").cast("date").cast("string"), F.lit("T00:00:00+00:00")).alias("fetched_at"),
        F.col("l_partkey").alias("account_id"),
        F.array(record).alias("data"),
    )


def history_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match histories with their account."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("account_id"),
        F.col("l_orderkey").alias("match_id"),
        F.col("l_suppkey").alias("hero_id"),
        F.col("l_linenumber").alias("line"),
    )


def nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name dimension that knows only some of the hero ids."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("hero_id"), F.col("n_name").alias("hero_name")
    )
