"""Queryable collections: a registry of names and a way to open each as a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from snapstats.fixed_values import HERO_NAMES, QUERYABLE_COLLECTIONS
from snapstats.sinks.versions import Version, read_published, read_version


@dataclass(frozen=True)
class CollectionEntry:
    name: str
    category: str
    requires_hero: bool = False


DEFAULT_REGISTRY = tuple(CollectionEntry(*row) for row in QUERYABLE_COLLECTIONS)


@dataclass(frozen=True)
class Collections:
    """Tables by collection name.

    ``root`` holds one Parquet folder per collection, published in versions or plain; ``tables`` gives single
    collections another path, or a frame.  With neither, names are tables of the session catalog.
    """

    spark: SparkSession
    root: str | None = None
    tables: dict[str, str | DataFrame] = field(default_factory=dict)
    registry: tuple[CollectionEntry, ...] = DEFAULT_REGISTRY

    def entry(self, name: str) -> CollectionEntry:
        """The registry entry; only listed names may be queried."""
        for entry in self.registry:
            if entry.name == name:
                return entry
        raise ValueError(f"Unknown collection: {name}")

    def is_stored(self, name: str) -> bool:
        """Whether the collection is a Parquet folder, so that its rows have positions."""
        return isinstance(self.tables.get(name), str) or (name not in self.tables and self.root is not None)

    def place(self, name: str) -> str | None:
        """The folder of a stored collection."""
        table = self.tables.get(name)
        if isinstance(table, str):
            return table
        return f"{self.root.rstrip('/')}/{name}" if table is None and self.root is not None else None

    def version(self, name: str) -> Version | None:
        """What is published of a stored collection; None for plain tables and frames."""
        place = self.place(name)
        return read_version(self.spark, place) if place is not None else None

    def open(self, name: str, version: Version | None = None) -> DataFrame:
        place = self.place(name)
        if place is not None:
            return read_published(self.spark, place, version)
        table = self.tables.get(name)
        return table if table is not None else self.spark.table(name)

    def registry_frame(self) -> DataFrame:
        rows = [(n, e.name, e.category, e.requires_hero) for n, e in enumerate(self.registry)]
        return self.spark.createDataFrame(
            rows, "position int, name string, category string, requires_hero boolean"
        )


def hero_dimension(spark: SparkSession) -> DataFrame:
    """The fixed hero names as ``(hero_id, hero_name)``."""
    return spark.createDataFrame(list(HERO_NAMES.items()), "hero_id bigint, hero_name string")
