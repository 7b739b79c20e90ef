"""Search over a published collection that opens only the files which can hold the text.

A sidecar keeps a Bloom filter of the three-character pieces of each file's searched text, cut into bitmaps of
``BITMAP`` bits, one row each; empty ones are left out.  It belongs to the version it was made for: a collection that is
published anew has none until it is indexed again, and is then searched by a scan.  A file is opened unless a piece of
the query is surely not in it, so the rows are those of the scan.  Queries of fewer than three characters, and those that
the sidecar does not cover (nested values, nulls by name), scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstats.operators.filters import search, search_text
from snapstats.sinks.versions import Version, fresh_folder, publish, read_published, read_version

GRAM = 3
BITMAP = 1 << 15  # bits of what bitmap_construct_agg makes
BITS = 1 << 20  # of one file: 128 kB at most
HASHES = 2
MAX_FILES = 20_000  # files that are named to the reader one by one; a query that more could match scans
SIDECAR = "file string, part int, bits binary"


def _places(gram: Column) -> list[Column]:
    """The bits of a piece: disjoint parts of one hash."""
    return [F.pmod(F.shiftright(F.xxhash64(gram), 24 * n), F.lit(BITS)).cast("int") for n in range(HASHES)]


def _pieces(text: Column) -> Column:
    """All pieces of a text, in one pass over it."""
    return F.regexp_extract_all(text, F.lit("(?s)(?=(" + "." * GRAM + "))"), F.lit(1))


def _files(spark: SparkSession, place: str, version: Version, paths: list[str]) -> DataFrame:
    schema = read_published(spark, place, version).schema
    return spark.read.schema(schema).parquet(*[f"{place.rstrip('/')}/{p}" for p in paths])


def index_search(spark: SparkSession, target: str, collection: str, nested: bool = False) -> Version:
    """Make the sidecar of the collection's published version; ``nested`` also covers nested values.

    The text is read once.  What moves are distinct bits per file, of which there are at most ``BITS``.
    """
    place = f"{target.rstrip('/')}/{collection}"
    version = read_version(spark, place)
    if version is None or version.index is None:
        raise ValueError(f"{collection} is not a published Parquet collection")
    table = _files(spark, place, version, version.folders)
    texts = [t for t in (search_text(table, c, nested) for c in table.columns) if t is not None]
    grams = F.flatten(F.array_compact(F.array(*map(_pieces, texts)))) if texts else F.array().cast("array<string>")
    file = F.substring_index("_metadata.file_path", "/", -2).alias("file")
    rows = table.select(file, F.explode(F.array_distinct(grams)).alias("gram"))
    bits = rows.select("file", F.explode(F.array(*_places(F.col("gram")))).alias("bit")).distinct()
    parts = bits.groupBy("file", F.shiftright("bit", BITMAP.bit_length() - 1).alias("part")).agg(
        F.bitmap_construct_agg(F.col("bit").cast("long") % BITMAP).alias("bits"))
    name = fresh_folder("index")
    parts.repartitionByRange("part", "file").sortWithinPartitions("part", "file").write.parquet(f"{place}/{name}")
    note = {**(version.note or {}), "search": {"folder": name, "nested": nested}}
    old = (version.note or {}).get("search", {}).get("folder")
    return publish(spark, place, version._replace(kept=[*(k for k in version.kept if k != old), name], note=note))


def _wanted(spark: SparkSession, query: str) -> list[int]:
    """The bits that a file with the query's text has."""
    grams = sorted({query[i : i + GRAM] for i in range(len(query) - GRAM + 1)})
    frame = spark.createDataFrame([(g,) for g in grams], "gram string")  # of the query, nothing of the table
    return sorted({bit for row in frame.select(*_places(F.col("gram"))).collect() for bit in row})


def candidate_files(spark: SparkSession, place: str, version: Version, query: str) -> DataFrame:
    """Files that can hold the query; only the bitmaps in which it has a bit are read."""
    by_part: dict[int, list[int]] = {}
    for bit in _wanted(spark, query):
        by_part.setdefault(bit // BITMAP, []).append(bit % BITMAP)

    def has(bit: int) -> Column:
        byte = F.conv(F.hex(F.substring("bits", bit // 8 + 1, 1)), 16, 10).cast("int")
        return F.getbit(byte, F.lit(bit % 8)) == 1

    sidecar = spark.read.schema(SIDECAR).parquet(f"{place.rstrip('/')}/{version.note['search']['folder']}")
    whole = F.lit(False)
    for part, bits in by_part.items():
        fits = F.lit(True)
        for bit in bits:
            fits &= has(bit)
        whole |= (F.col("part") == part) & fits
    held = sidecar.where(F.col("part").isin(list(by_part))).where(whole)
    return held.groupBy("file").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(by_part)).select("file")


def search_collection(
    spark: SparkSession, target: str, collection: str, query: str | None, nested: bool = False, nulls: bool = False
) -> DataFrame:
    """`search` over a whole collection, through its sidecar where that covers the query."""
    place = f"{target.rstrip('/')}/{collection}"
    version = read_version(spark, place)
    whole = read_published(spark, place, version)
    made = ((version.note if version else None) or {}).get("search")
    text = (query or "").lower()
    if made is None or len(text) < GRAM or (nested and not made["nested"]) or (nulls and text in "null"):
        return search(whole, query, nested, nulls)
    files = [r["file"] for r in candidate_files(spark, place, version, text).limit(MAX_FILES + 1).collect()]
    if len(files) > MAX_FILES:
        return search(whole, query, nested, nulls)
    if not files:
        return whole.limit(0)
    return search(_files(spark, place, version, sorted(files)), query, nested, nulls)
