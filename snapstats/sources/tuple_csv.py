"""Spreadsheet export whose cells are text such as ``('wins', 136685)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from snapstats.fixed_values import NAME_NOT_FOUND

# 21 counter cells, one empty cell, one name cell; names and order of the counters.
TUPLE_FIELDS = (
    "bucket", "hero_id", "losses", "matches", "matches_per_bucket", "players", "total_assists",
    "total_boss_damage", "total_creep_damage", "total_deaths", "total_denies", "total_kills",
    "total_last_hits", "total_max_health", "total_net_worth", "total_neutral_damage",
    "total_player_damage", "total_player_damage_taken", "total_shots_hit", "total_shots_missed", "wins",
)

_CELL = r"^\('([^']*)',\s*(-?[0-9]+)\)$"


def tuple_cell(cell: Column) -> Column:
    """``struct(name, value)`` of a cell; both null when the text is no tuple."""
    name = F.nullif(F.regexp_extract(cell, _CELL, 1), F.lit(""))
    return F.struct(name.alias("name"), F.regexp_extract(cell, _CELL, 2).try_cast("bigint").alias("value"))


def read_tuple_csv(
    spark: SparkSession,
    path: str,
    fields: tuple[str, ...] = TUPLE_FIELDS,
    name_column: str = "hero_name",
) -> DataFrame:
    """One row per filled line: the named counters as bigint plus the name; padding lines are left out.

    A value belongs to the field that its own cell names, whatever the cell's position.
    """
    cells = [f"cell_{n}" for n in range(1, len(fields) + 3)]
    schema = StructType([StructField(c, StringType()) for c in cells])
    lines = spark.read.option("header", False).schema(schema).csv(path)
    pairs = F.filter(
        F.array(*[tuple_cell(F.col(c)) for c in cells[: len(fields)]]), lambda p: p["name"].isNotNull()
    )
    parsed = lines.select(F.map_from_entries(pairs).alias("pairs"), F.col(cells[-1]).alias(name_column))
    return parsed.where(F.size("pairs") > 0).select(
        *[F.col("pairs")[f].alias(f) for f in fields],
        F.coalesce(F.col(name_column), F.lit(NAME_NOT_FOUND)).alias(name_column),
    )
