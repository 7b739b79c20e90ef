"""Queries over collections: top rows, sorted pages, and the list of collections."""

from __future__ import annotations

import functools
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapstats.fixed_values import MAX_PAGE_SIZE, MAX_TOP_SIZE, PAGE_SIZE, TOP_SIZE
from snapstats.functions.display import short_count, title_words
from snapstats.functions.parsing import leading_int, page_number, page_size, top_size
from snapstats.operators.filters import equals_id
from snapstats.operators.paging import (
    DIRECT_ROWS,
    SortKey,
    fetch_page,
    page_rows,
    resolve_field,
    row_hash,
    sort_rows,
    with_positions,
)
from snapstats.operators.shape import fresh_name, quoted
from snapstats.sinks.versions import rows_between
from snapstats.sources.collections import Collections


class Page(NamedTuple):
    """A page of rows, in order, and one row describing it."""

    rows: DataFrame
    meta: DataFrame


class Top(NamedTuple):
    rows: DataFrame
    meta: DataFrame


def _sorted_rows(
    found: DataFrame,
    stored: bool,
    sort: str | None,
    order: str | None,
    tie_break: tuple[str, ...],
    offset: int,
    count: int,
    direct: int = DIRECT_ROWS,
) -> DataFrame:
    """Rows ``offset`` to ``offset + count``.  An unknown sort field sorts nothing.

    A page border is only defined when ties are broken: by the named columns, and by the place of the row
    in its file for a stored table, else by a hash of the row.
    """
    field = resolve_field(found, sort) if sort else None
    keys = [] if field is None else [SortKey(field, order == "asc")]
    keys += [SortKey(quoted(c)) for c in tie_break]
    if stored:
        placed, file, row = with_positions(found)
        keys += [SortKey(F.col(file)), SortKey(F.col(row))]
        return fetch_page(placed, file, row, keys, offset, count, direct).drop(file, row)
    name = fresh_name("_hash", found)
    hashed = found.withColumn(name, row_hash(found))
    return page_rows(hashed, [*keys, SortKey(F.col(name))], offset, count, direct, _width(found)).drop(name)


def _width(frame: DataFrame) -> int:
    """About how many tasks a frame has whose plan is not run to find out."""
    spark = frame.sparkSession
    width = spark.conf.get("spark.sql.shuffle.partitions")
    return max(int(width) if width.isdigit() else 0, spark.sparkContext.defaultParallelism)


def top_rows(
    frame: DataFrame,
    sort: str | None = None,
    order: str | None = None,
    limit: object = None,
    tie_break: tuple[str, ...] = (),
    stored: bool = False,
) -> Top:
    """The first rows by a field, with their count and the ``last_updated`` of the very first."""
    wanted = top_size(limit, TOP_SIZE, MAX_TOP_SIZE)
    rows = _sorted_rows(frame, stored, sort or "win_rate", order, tie_break, 0, wanted)
    stamp = F.first("last_updated") if "last_updated" in frame.columns else F.lit(None).cast("string")
    return Top(rows, rows.agg(F.count(F.lit(1)).alias("count"), stamp.alias("last_updated")))


def top_heroes(
    collections: Collections,
    sort: str | None = None,
    order: str | None = None,
    limit: object = None,
    tie_break: tuple[str, ...] = (),
    collection: str = "hero_stats",
) -> Top:
    """Heroes by win rate, best first, unless asked otherwise."""
    stored = collections.is_stored(collection)
    return top_rows(collections.open(collection), sort, order, limit, tie_break, stored)


def scoreboard(frame: DataFrame, by: str = "wins", limit: int = TOP_SIZE, tie_break: tuple[str, ...] = ()) -> DataFrame:
    """The rows with the highest counter."""
    return sort_rows(frame, [SortKey(F.col(by), False), *[SortKey(F.col(c)) for c in tie_break]]).limit(limit)


class HeroRequired(ValueError):
    """The collection is too large to show without a hero filter."""


def browse(
    collections: Collections,
    collection: str,
    page: object = None,
    limit: object = None,
    sort: str | None = None,
    order: str | None = None,
    hero_id: object = None,
    tie_break: tuple[str, ...] = (),
    gate: bool = False,
    direct: int = DIRECT_ROWS,
) -> Page:
    """One page of a listed collection, optionally for one hero.

    Parameters are lenient like those of a query string: an unreadable page is 1, an unreadable limit 50,
    an unreadable hero no filter; the order is descending unless it is exactly ``asc``.  ``gate`` refuses a
    collection that is flagged as requiring a hero when none is given.  A page starting after ``direct`` rows
    is located by counting before anything is sorted.  An unsorted page of a whole published collection is looked up
    in its index of files, and its total in the pointer: nothing else is opened.
    """
    entry = collections.entry(collection)
    if gate and entry.requires_hero and leading_int(hero_id) is None:
        raise HeroRequired(f"choose a hero to see {collection}")
    number = page_number(page)
    size = page_size(limit, PAGE_SIZE, MAX_PAGE_SIZE)
    offset = (number - 1) * size
    version = collections.version(collection)
    table = collections.open(collection, version)
    found = equals_id(table, "hero_id", hero_id)
    whole = version is not None and version.rows is not None and leading_int(hero_id) is None
    counted = _one_number(collections, version.rows) if whole else None
    if whole and version.index and not tie_break and (not sort or resolve_field(table, sort) is None):
        rows = rows_between(collections.spark, collections.place(collection), version, offset, size)
    else:
        rows = _sorted_rows(
            found, collections.is_stored(collection), sort, order, tie_break, offset, size, direct
        )
    return Page(rows.drop("_id"), page_meta(found, collection, number, size, counted))


def _one_number(collections: Collections, total: int) -> DataFrame:
    return collections.spark.createDataFrame([(total,)], "total bigint")


def page_meta(found: DataFrame, collection: str, page: int, limit: int, counted: DataFrame | None = None) -> DataFrame:
    """One row: total, page count and rows on this page.  Counting reads no column; ``counted`` spares it."""
    total = F.col("total")
    left = total - (page - 1) * limit
    return (found.agg(F.count(F.lit(1)).alias("total")) if counted is None else counted).select(
        F.lit(True).alias("ok"),
        F.lit(collection).alias("collection"),
        total,
        F.lit(page).alias("page"),
        F.ceil(total / limit).cast("int").alias("pages"),
        F.lit(limit).alias("limit"),
        F.greatest(F.least(left, F.lit(limit)), F.lit(0)).cast("int").alias("count"),
    )


def list_collections(collections: Collections) -> DataFrame:
    """Every listed collection with its row count; one that cannot be read counts 0.

    A published collection is not opened: its number of rows stands in the pointer.  A count of a plain Parquet table
    reads no column, but opens every file.
    """
    registry = collections.registry_frame()
    counts, known = [], []
    for entry in collections.registry:
        try:
            version = collections.version(entry.name)
            if version is not None and version.rows is not None:
                known.append((entry.name, version.rows))
                continue
            table = collections.open(entry.name)
        except PySparkException:
            continue
        counts.append(table.agg(F.count(F.lit(1)).alias("count")).select(F.lit(entry.name).alias("name"), "count"))
    if known:
        counts.append(collections.spark.createDataFrame(known, "name string, count bigint"))
    if not counts:
        return registry.withColumn("count", F.lit(0).cast("bigint"))
    counted = functools.reduce(DataFrame.unionByName, counts)
    # one row per registry entry
    return registry.join(F.broadcast(counted), "name", "left").select(
        "position", "name", "category", "requires_hero", F.coalesce("count", F.lit(0)).alias("count")
    )


def collections_nav(listed: DataFrame) -> DataFrame:
    """The navigation: non-empty collections by category, categories in order of first appearance."""
    shown = listed.where(F.col("count") != 0)
    # one window row per registry entry
    group = F.min("position").over(Window.partitionBy("category"))
    return shown.select(
        group.alias("category_position"),
        "position",
        "category",
        "name",
        title_words(F.col("name")).alias("label"),
        short_count(F.col("count")).alias("count_label"),
    ).orderBy("category_position", "position")


def nav_groups(nav: DataFrame) -> DataFrame:
    """The navigation with one row per category; its lists are as long as the registry at most."""
    entry = F.struct("position", "name", "label", "count_label")
    return (
        nav.groupBy("category_position", "category")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .orderBy("category_position")
    )
