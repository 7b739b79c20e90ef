"""Pages as people read them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.functions.display import band, bar_width, cell, column_label, is_hero_column, percent
from snapstats.operators.filters import search
from snapstats.operators.lookup import hero_name, name_all_heroes
from snapstats.operators.shape import quoted
from snapstats.plans.browse import Page, browse
from snapstats.sources.collections import Collections


def display_cells(page: DataFrame, dimension: DataFrame) -> DataFrame:
    """Every cell as text: heroes by name, rates in percent, large numbers grouped, nested values clipped."""
    named = name_all_heroes(page, dimension)
    return named.select(
        *[
            (quoted(f.name) if is_hero_column(f.name) else cell(f.name, f.dataType, quoted(f.name))).alias(f.name)
            for f in named.schema
        ]
    )


def column_labels(frame: DataFrame) -> dict[str, str]:
    """Display label per column; two columns with one label keep apart by their names."""
    labels: dict[str, str] = {}
    for name in frame.columns:
        label = column_label(name)
        labels[name] = label if label not in labels.values() else f"{label} ({name})"
    return labels


def sort_choices(frame: DataFrame) -> list[tuple[str, str]]:
    """Columns offered for sorting, as ``(name, label)``, from the schema."""
    return [(name, column_label(name)) for name in frame.columns if name != "_id"]


def with_band(frame: DataFrame, column: str = "win_rate") -> DataFrame:
    """Add text, band and bar width of a win rate."""
    percentage = quoted(column) * 100
    return frame.select(
        "*",
        percent(quoted(column)).alias(f"{column}_text"),
        band(percentage).alias(f"{column}_band"),
        bar_width(percentage).alias(f"{column}_width"),
    )


def report_view(
    collections: Collections, dimension: DataFrame, collection: str, search_for: str | None = None, **request
) -> Page:
    """A page for display: searched within the page, cells as text, columns renamed to their labels.

    Collections flagged as requiring a hero are refused without one, unless ``gate=False``.
    """
    page = browse(collections, collection, **{"gate": True, **request})
    rows = page.rows.drop("_id")
    cells = display_cells(search(rows, search_for), dimension)
    labels = column_labels(cells)
    return Page(cells.toDF(*[labels.get(c, c) for c in cells.columns]), page.meta)


def hero_picker(heroes: DataFrame, dimension: DataFrame) -> DataFrame:
    """The heroes present, as ``(hero_id, hero_name)`` in alphabetical order."""
    named = hero_name(heroes.select("hero_id"), dimension)
    return named.orderBy(F.collate("hero_name", "UNICODE"), "hero_id")


