"""Joins that stay even when one key holds much of the data."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import AtomicType

from snapstats.operators.shape import fresh_name, quoted

SALTS = 16
BROADCAST_ROWS = 100_000
HEAVY_ROWS = 100_000
TRACKED_KEYS = 8_192
MOST_HEAVY = 1_024
MOST_SHARES = 1_024

#: Types whose equal values have equal hashes (collated text and floating zeros may not).
_HASHED = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType)


def row_salt(frame: DataFrame, salts: int = SALTS) -> Column:
    """A number below ``salts`` that spreads the rows of one key.

    It hashes the row and its input partition, so it spreads even identical copies, and a task that runs
    again gives its rows the same salts (a random number would not).
    """
    atoms = [F.col(f"`{f.name}`") for f in frame.schema if isinstance(f.dataType, AtomicType)]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *atoms), F.lit(salts)).cast("int")


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str, salts: int = SALTS) -> DataFrame:
    """Equi-join of a large, possibly skewed left side with a right side of one row per key.

    The left rows of a key spread over ``salts`` tasks; the right rows are repeated that often.  When the
    right side turns out small, adaptive execution still turns this into a broadcast join.
    """
    _check_side(how)
    salt = fresh_name("_salt", left, right)
    salted = left.withColumn(salt, row_salt(left, salts))
    repeated = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, salt], how).drop(salt)


def heavy_keys(frame: DataFrame, on: list[str], heavy_rows: int = HEAVY_ROWS) -> dict[int, int]:
    """Into how many tasks to split each heavy key, by the hash of its values; most tables have none.

    A key is heavy when it has more rows than a shuffle task's fair share, and more than ``heavy_rows``.  One
    pass over the key columns fills a mergeable sketch of frequent items: its counts are off by a few times
    rows / ``TRACKED_KEYS`` at most, so no key that fills a task of its own on up to a thousand tasks escapes.
    At most ``MOST_HEAVY`` pairs of numbers reach the driver.  Splitting is a matter of speed alone.
    """
    hashed = frame.select(_key_hash(frame, on).alias("h"))
    top = F.expr(f"approx_top_k(h, {MOST_HEAVY}, {TRACKED_KEYS})")
    found = hashed.agg(F.count(F.lit(1)).alias("rows"), top.alias("top")).first()
    width = frame.sparkSession.conf.get("spark.sql.shuffle.partitions")
    fair = max(found["rows"] / min(max(int(width), 2) if width.isdigit() else 200, MOST_SHARES), heavy_rows)
    shares = {item["item"]: 1 << math.ceil(math.log2(2 * item["count"] / fair)) for item in found["top"] or () if item["count"] > fair}
    return {h: min(n, MOST_SHARES) for h, n in shares.items()}


def even_join(left: DataFrame, right: DataFrame, on: list[str], how: str, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Equi-join of a possibly skewed left side with a right side of one row per key, split only where keys are heavy.

    `heavy_keys` of the left side are found first.  Without any this is Spark's plain join, which may be a
    broadcast; else only the rows of heavy keys are spread, in as many shares as their size asks for, and only
    the right rows of those keys are repeated.  Keys of unlike or loosely compared types go to `salted_join`.
    A null key may be heavy, too: a left or anti join keeps its rows.
    """
    _check_side(how)
    if not all(_hashes_alike(left.schema[k].dataType, right.schema[k].dataType) for k in on):
        return salted_join(left, right, on, how)
    heavy = heavy_keys(left, on, heavy_rows)
    if not heavy:
        return left.join(right, on, how)
    salt = fresh_name("_salt", left, right)
    spread = left.withColumn(salt, F.pmod(row_salt(left, MOST_SHARES), _shares(left, on, heavy)))
    repeated = right.withColumn(salt, F.explode(F.sequence(F.lit(0), _shares(right, on, heavy) - 1)))
    return spread.join(repeated, [*on, salt], how).drop(salt)


def _check_side(how: str) -> None:
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")


def _hashes_alike(one: T.DataType, other: T.DataType) -> bool:
    return one == other and (isinstance(one, _HASHED) or one == T.StringType())


def _key_hash(frame: DataFrame, on: list[str]) -> Column:
    return F.xxhash64(*[quoted(k) for k in on])


def _shares(frame: DataFrame, on: list[str], heavy: dict[int, int]) -> Column:
    """The number of shares of a row's key; one set lookup per power of two, as shares are powers."""
    key, shares = _key_hash(frame, on), F.lit(1)
    for n in sorted(set(heavy.values())):
        shares = F.when(key.isin([h for h, m in heavy.items() if m == n]), n).otherwise(shares)
    return shares


def is_small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether the frame has at most ``rows`` rows; counting stops there."""
    return frame.limit(rows + 1).count() <= rows


def lookup_join(left: DataFrame, lookup: DataFrame, on: list[str], small: bool, how: str = "left") -> DataFrame:
    """Join with a lookup table of one row per key: broadcast if counted to be small, else salted."""
    if small:
        return left.join(F.broadcast(lookup), on, how)
    return salted_join(left, lookup, on, how)
