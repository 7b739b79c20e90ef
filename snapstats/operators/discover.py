"""Ids found inside records, and the joins that follow from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstats.functions.stamps import iso_micros, micros_to_iso
from snapstats.operators.filters import positive
from snapstats.operators.joins import even_join
from snapstats.operators.shape import array_of, quoted

_POSITIONS = 1 << 32


def distinct_ids(records: DataFrame, key: str) -> DataFrame:
    """The ids that occur, without null."""
    return records.select(quoted(key).alias(key)).where(F.col(key).isNotNull()).distinct()


def distinct_in_order(envelopes: DataFrame, key: str, payload: str = "data") -> DataFrame:
    """The ids that occur, with the stamp and array position of their first occurrence.

    Stamp and position are folded into one decimal, whose ``min`` fits a hash aggregation buffer; the
    minimum of a struct would sort all rows instead.
    """
    stamped = envelopes.select(iso_micros(F.col("fetched_at")).alias("_us"), quoted(payload).alias("_records"))
    rows = stamped.select(
        F.col("_us").cast("decimal(38,0)").alias("_us"), F.posexplode("_records").alias("_position", "_record")
    )
    seen = rows.select(
        F.col("_record").getField(key).alias(key),
        (F.col("_us") * _POSITIONS + F.col("_position")).cast("decimal(38,0)").alias("_seen"),
    ).where(F.col(key).isNotNull())
    first = seen.groupBy(key).agg(F.min("_seen").alias("_seen"))
    position = F.pmod(F.col("_seen"), F.lit(_POSITIONS).cast("decimal(38,0)"))
    return first.select(
        key,
        micros_to_iso(((F.col("_seen") - position) / _POSITIONS).cast("bigint")).alias("first_fetched_at"),
        position.cast("int").alias("first_position"),
    )


def _player_ids(frame: DataFrame, *path: str) -> Column:
    """Account ids of a nested player array; the empty array where it is absent."""
    nothing = F.array().cast("array<bigint>")
    element = array_of(frame, *path)
    if element is None or "account_id" not in element.names:
        return nothing
    return F.coalesce(quoted(*path, "account_id").cast("array<bigint>"), nothing)


def distinct_accounts(matches: DataFrame) -> DataFrame:
    """Valid account ids of all players, below ``match_info.players`` and top-level ``players`` alike.

    One scan serves both places; it reads nothing of a player but the id.
    """
    ids = F.concat(_player_ids(matches, "match_info", "players"), _player_ids(matches, "players"))
    found = matches.select(F.explode(ids).alias("account_id"))
    return positive(found, "account_id").distinct()


def of_discovered(records: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Records whose id was discovered.  ``ids`` has each id once."""
    return even_join(records, ids.select(key), [key], "left_semi")


def undiscovered(ids: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """Discovered ids that no record has yet."""
    return ids.join(distinct_ids(records, key), [key], "left_anti")


def request_grid(ids: DataFrame, endpoints: list[str]) -> DataFrame:
    """One request per id and endpoint name."""
    return ids.withColumn("endpoint", F.explode(F.array(*[F.lit(e) for e in endpoints])))


def tracked_totals(matches: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row: exact numbers of distinct matches and of distinct accounts."""
    n_matches = distinct_ids(matches, "match_id").agg(F.count(F.lit(1)).alias("matches"))
    n_accounts = accounts.agg(F.count(F.lit(1)).alias("accounts"))
    counts = n_matches.withColumn("accounts", F.lit(None).cast("bigint")).unionByName(
        n_accounts.withColumn("matches", F.lit(None).cast("bigint"))
    )
    return counts.agg(F.max("matches").alias("matches"), F.max("accounts").alias("accounts"))
