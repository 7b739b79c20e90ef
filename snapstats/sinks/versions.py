"""Collections as versions: data folders below the collection, and a pointer that says which of them it consists of.

A writer fills new folders and then publishes them; until then, and if it fails, readers keep what was published last.
Pointers are numbered files that come into being by a rename, so a reader sees a whole one or none.  The folders of the
version before stay, for readers that have it open; older ones are deleted.  A folder without a pointer is a plain table.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapstats.operators.shape import fresh_name

POINTERS = "_versions"
MADE = ("data-", "index-")  # what a version may consist of, and cleaning up may delete
INDEX_SCHEMA = "file string, rows bigint, before bigint"


class Version(NamedTuple):
    """``folders`` are names below the collection, ``rows`` their number, ``hidden`` columns that readers do not see.

    ``note`` is what the writer keeps for itself, ``kept`` further folders that stay with the version.
    """

    folders: list[str]
    rows: int | None = None
    index: str | None = None
    hidden: tuple[str, ...] = ()
    note: dict | None = None
    kept: list[str] = []
    number: int = 0
    before: list[str] = []

    def all_folders(self) -> list[str]:
        return [*self.folders, *self.kept, *([self.index] if self.index else [])]


def file_system(spark: SparkSession, *parts: str):
    """Hadoop's file system of a path, and the path."""
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def file_names(spark: SparkSession, *parts: str) -> list[str]:
    """What a folder holds, sorted; nothing if there is none."""
    fs, top = file_system(spark, parts[0])
    if not (fs.exists(top) and fs.getFileStatus(top).isDirectory()):  # a table may be a single file
        return []
    _, path = file_system(spark, *parts)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def discard(spark: SparkSession, place: str, folder: str) -> None:
    """Delete a folder that was made here and never published."""
    fs, path = file_system(spark, place, folder)
    fs.delete(path, True)


def fresh_folder(kind: str = "data") -> str:
    return f"{kind}-{uuid.uuid4().hex}"


def read_version(spark: SparkSession, place: str) -> Version | None:
    """What is published at ``place``, or None."""
    numbers = [n for n in file_names(spark, place, POINTERS) if n.endswith(".json") and not n.startswith((".", "_"))]
    if not numbers:
        return None
    fs, path = file_system(spark, place, POINTERS, numbers[-1])
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    kept = json.loads(text)
    return Version(**{**kept, "hidden": tuple(kept["hidden"])})


def publish(spark: SparkSession, place: str, version: Version) -> Version:
    """Make ``version`` what readers see, and delete the folders that only versions before the last one had."""
    last = read_version(spark, place)
    own, before = version.all_folders(), last.all_folders() if last else []
    version = version._replace(number=last.number + 1 if last else 1, before=before)
    name = f"{version.number:012d}.json"
    fs, draft = file_system(spark, place, POINTERS, f"_{name}-{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(version._asdict()).encode()))
    out.close()
    if not fs.rename(draft, file_system(spark, place, POINTERS, name)[1]):
        fs.delete(draft, False)
        raise RuntimeError(f"another writer published version {version.number} of {place}")
    for child in file_names(spark, place):
        plain = last is None and (child.startswith("part-") or child == "_SUCCESS")  # a table before it had versions
        if plain or (child.startswith(MADE) and child not in own and child not in before):
            fs.delete(file_system(spark, place, child)[1], True)
    for pointer in file_names(spark, place, POINTERS):
        if pointer < f"{version.number - 1:012d}":
            fs.delete(file_system(spark, place, POINTERS, pointer)[1], False)
    return version


def read_published(spark: SparkSession, place: str, version: Version | None = None, fmt: str = "parquet") -> DataFrame:
    """The collection as it is published, or the plain table at ``place``."""
    version = version or read_version(spark, place)
    if version is None:
        return spark.read.format(fmt).load(place)
    return spark.read.format(fmt).load([f"{place.rstrip('/')}/{f}" for f in version.folders]).drop(*version.hidden)


def write_index(spark: SparkSession, place: str, folders: list[str]) -> tuple[str, int]:
    """Rows per file of Parquet folders and rows before it, in the order of paths; returns the folder and all rows.

    Counting reads no column: the numbers come from the footers.  One row per file, so one task may add them up.
    """
    table = spark.read.parquet(*[f"{place.rstrip('/')}/{f}" for f in folders])
    counted = table.groupBy(F.substring_index("_metadata.file_path", "/", -2).alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")
    name = fresh_folder("index")
    counted.select("file", "rows", before.alias("before")).coalesce(1).write.parquet(f"{place.rstrip('/')}/{name}")
    total = spark.read.schema(INDEX_SCHEMA).parquet(f"{place.rstrip('/')}/{name}").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return name, total


def rows_between(spark: SparkSession, place: str, version: Version, offset: int, count: int) -> DataFrame:
    """Rows ``offset`` to ``offset + count`` in the order of files and places in them, opening only the files that hold them."""
    root = place.rstrip("/")
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{root}/{version.index}")
    held = index.where((F.col("before") < offset + count) & (F.col("before") + F.col("rows") > offset)).orderBy("file").collect()
    whole = read_published(spark, place, version)
    if not held:
        return whole.limit(0)
    table = spark.read.schema(whole.schema).parquet(*[f"{root}/{r['file']}" for r in held])
    file, row = fresh_name("_file", table), fresh_name("_row", table)
    placed = table.select("*", F.substring_index("_metadata.file_path", "/", -2).alias(file), F.col("_metadata.row_index").alias(row))
    here = F.lit(False)
    for r in held:  # at most ``count`` files
        here |= (F.col(file) == r["file"]) & F.col(row).between(offset - r["before"], offset + count - r["before"] - 1)
    return placed.where(here).orderBy(file, row).limit(count).drop(file, row)
