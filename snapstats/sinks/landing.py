"""Envelopes out of records, landed as one JSON object per file."""

from __future__ import annotations

import math
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstats.functions.stamps import landing_path
from snapstats.operators.joins import BROADCAST_ROWS, even_join
from snapstats.operators.shape import quoted
from snapstats.session import shuffles_released
from snapstats.sinks.versions import file_names, file_system
from snapstats.sources.landing import endpoint_path

MAX_RECORDS = 50_000
MAX_BYTES = 64 << 20
#: Shares of a stamp for each envelope that it fills, so that few shares need a second envelope.
SLACK = 1.25
#: Bytes of JSON that a task of the landing write is given, so that wider tables mean more tasks, not larger ones.
TASK_BYTES = 32 << 20
#: Hash of stamp, suffix and share, by which records move.  Stamp and suffix may be constants, which Spark strikes from
#: the keys of a grouping but not from those of a partitioning: by them the records would move twice.
PLACE = "fetched_at_place"
RENAMES = 16
#: Of a landed file, with that of its codec.
ENDING = r"\.json(\.[a-z0-9]+)?$"


def jsonable(value: Column, dtype: T.DataType) -> Column:
    """Values that JSON has no type for as text, at any depth."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        return F.when(F.date_format(value, "SSSSSS") == "000000", whole).otherwise(
            F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        )
    if isinstance(dtype, (T.StringType, T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType)):
        return value
    if isinstance(dtype, T.StructType):
        fields = [jsonable(value.getField(f.name), f.dataType).alias(f.name) for f in dtype]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda e: jsonable(e, dtype.elementType))
    if isinstance(dtype, (T.MapType, T.VariantType, T.NullType)):
        return value
    return value.cast("string")


def build_envelopes(
    records: DataFrame,
    endpoint: str,
    suffix: str | None = None,
    max_records: int = MAX_RECORDS,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """Records with a ``fetched_at`` column as envelopes ``fetched_at, endpoint, suffix, record_count, data``.

    One envelope per stamp and value of the ``suffix`` column, without empty ones.  Counts and bytes are summed
    first: a stamp beyond ``max_records`` records or ``max_bytes`` bytes of JSON spreads over several envelopes;
    readers take all parts of a stamp as one input.  None holds more records, nor more bytes than ``max_bytes``
    and one record.

    The records move once.  The hash of its content and input partition deals a record to a share of its stamp, so a
    task that runs again deals alike, and equal records of many partitions spread.  In its share a record goes to
    the envelope that the running sums of records and bytes before it name, in order of content.
    """
    group = ["fetched_at", "_suffix"]
    fields = [f for f in records.schema if f.name not in ("fetched_at", suffix)]
    rows = records.select(
        "fetched_at",
        (F.col(suffix) if suffix else F.lit("")).alias("_suffix"),
        F.struct(*[jsonable(quoted(f.name), f.dataType).alias(f.name) for f in fields]).alias("_record"),
    )
    # the hash stands for stamp and suffix, nulls included; groups of equal hash only get more shares
    keyed = rows.withColumns({"_key": F.xxhash64(*group), "_json": _json()})
    filled = F.greatest(F.sum(F.octet_length("_json")) / max_bytes, F.count(F.lit(1)) / max_records)
    sizes = keyed.groupBy("_key").agg(filled.alias("_filled"), F.sum(F.octet_length("_json")).alias("_size"))
    # one row per stamp beyond a limit, and one of null for all others; nothing is persisted, for the files of the
    # shuffles in ``records`` would stay on disk with it
    large = sizes.groupBy(F.when(F.col("_filled") > 1, F.col("_key")).alias("_key")).agg(
        F.ceil(F.max("_filled") * SLACK).alias("_shares"), F.sum("_size").alias("_size"))
    found = large.orderBy(F.col("_key").asc_nulls_first()).limit(BROADCAST_ROWS + 2).collect()
    few = len(found) < BROADCAST_ROWS + 2
    width = _width(rows, sum(r["_size"] for r in found) if few else sizes.agg(F.sum("_size")).first()[0])
    oversize = [(r["_key"], r["_shares"]) for r in found if r["_key"] is not None]
    if not oversize:
        parts, whole = [], rows.withColumn(PLACE, F.xxhash64(*group)).repartition(width, PLACE)
    else:
        hashed = keyed.withColumns(_content()).drop("_json")
        if few:
            shares = rows.sparkSession.createDataFrame(oversize, "_key bigint, _shares bigint")
            known = hashed.join(F.broadcast(shares), "_key", "left")
        else:
            known = even_join(hashed, large.where(F.col("_key").isNotNull()).drop("_size"), ["_key"], "left")
        parts, whole = ["_share", "_by_rows", "_by_bytes"], _split(known, group, max_records, max_bytes, width)
    return (
        whole.groupBy(PLACE, *group, *parts)
        .agg(F.collect_list("_record").alias("data"))
        .select(
            "fetched_at",
            F.lit(endpoint).alias("endpoint"),
            F.col("_suffix").alias("suffix"),
            F.size("data").cast("bigint").alias("record_count"),
            "data",
        )
    )


def _width(frame: DataFrame, size: int) -> int:
    """Tasks of the landing write: the session's shuffle width, at least one per core and per ``TASK_BYTES``.

    Files cost time by number rather than by size, so small partitions must not be merged into few tasks.
    """
    spark = frame.sparkSession
    width = spark.conf.get("spark.sql.shuffle.partitions")
    return max(int(width) if width.isdigit() else 0, spark.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))


def _json() -> Column:
    return F.to_json("_record", {"ignoreNullFields": "false"})


def _content() -> dict[str, Column]:
    return {"_h1": F.xxhash64("_json"), "_h2": F.xxhash64(F.lit(1), "_json")}


def _split(known: DataFrame, group: list[str], max_records: int, max_bytes: int, width: int) -> DataFrame:
    """The records, moved to their shares, with the numbers that name their envelope there.

    Hashes and bytes of a record are made on both sides of the move: hashes do not compress, and would take as much of the
    shuffle files as many a record.
    """
    content = list(_content())
    share = F.pmod(F.xxhash64(F.spark_partition_id(), *content), F.coalesce("_shares", F.lit(1)))
    dealt = known.select(*group, share.alias("_share"), "_record")
    moved = dealt.withColumn(PLACE, F.xxhash64(*group, "_share")).repartition(width, PLACE)
    again = moved.withColumn("_json", _json())
    sized = again.withColumns({"_bytes": F.octet_length("_json").cast("bigint"), **_content()}).drop("_json")
    # an order in which only equal records of one stamp can change places
    ahead = Window.partitionBy(PLACE, *group, "_share").orderBy(*content)
    before = F.sum("_bytes").over(ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_bytes")
    return sized.withColumns(
        {"_by_bytes": F.floor(before / max_bytes), "_by_rows": F.floor((F.row_number().over(ahead) - 1) / max_records)}
    )


def dated_name(stamp: Column, suffix: Column) -> Column:
    """Where an envelope goes below its endpoint, without ``.json``: dated like its stamp, or else named by it."""
    dated = F.regexp_extract(landing_path(F.lit("e"), stamp, suffix), r"^raw/e/(.*)\.json$", 1)
    other = F.concat(F.lit("undated/"), F.md5(F.coalesce(stamp, F.lit(""))), suffix)
    return F.when(stamp.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"), dated).otherwise(other)


def write_envelopes(envelopes: DataFrame, root: str, endpoint: str, compression: str = "none") -> None:
    """Land envelopes as ``raw/<endpoint>/YYYY/MM/DD/HHMMSS<suffix>.json``, each in a file of its own.

    Further parts of a split stamp are called ``..._part2.json`` and on.  Tasks write to a hidden folder; when all is
    written the driver renames the files, one rename an envelope, so readers see whole envelopes only.  A run with the
    same stamps replaces their files, and those of a landing in the older layout of folders.
    With ``compression`` (a codec of Spark's JSON writer, such as ``gzip``) its ending follows, as in ``HHMMSS.json.gz``;
    Spark's readers go by the ending, and either kind replaces the other.
    """
    spark, place = envelopes.sparkSession, endpoint_path(root, endpoint)
    draft = f"_landing-{uuid.uuid4().hex}"
    (
        envelopes.select("fetched_at", "endpoint", "record_count", "data", dated_name(F.col("fetched_at"), F.col("suffix")).alias("_to"))
        .write.option("maxRecordsPerFile", 1)
        .option("ignoreNullFields", "false")
        .option("compression", compression)
        .partitionBy("_to")
        .json(f"{place}/{draft}")
    )
    names = {n: unquote(n.split("=", 1)[1]) for n in file_names(spark, place, draft) if n.startswith("_to=")}
    folders = sorted({name.rsplit("/", 1)[0] for name in names.values()})
    with ThreadPoolExecutor(max_workers=RENAMES) as pool:
        there = dict(zip(folders, pool.map(lambda f: _landed(spark, place, f), folders), strict=True))
        list(pool.map(lambda n: _commit(spark, place, f"{draft}/{n}", names[n], there[names[n].rsplit("/", 1)[0]]), names))
    fs, path = file_system(spark, place, draft)
    fs.delete(path, True)


def _landed(spark: SparkSession, place: str, folder: str) -> dict[str, list[str]]:
    """What a day's folder holds, by the name that it was landed as; folders of the older layout by their own.

    Listed once for all envelopes of the day: they may be many, and so may be the files.
    """
    fs, path = file_system(spark, place, folder)
    fs.mkdirs(path)
    found: dict[str, list[str]] = {}
    for file in file_names(spark, place, folder):
        base = re.sub(ENDING, "", file)
        if base != file:
            for name in {base, re.sub(r"_part\d+$", "", base)}:
                found.setdefault(name, []).append(file)
    for older in file_names(spark, place, f"fetch_date={folder.replace('/', '-')}"):
        found[older] = []
    return found


def _commit(spark: SparkSession, place: str, draft: str, name: str, landed: dict[str, list[str]]) -> None:
    """Move the files of one name to where they belong, in place of those there."""
    folder, base = name.rsplit("/", 1)
    fs = file_system(spark, place)[0]
    if f"file={base}" in landed:
        fs.delete(file_system(spark, place, f"fetch_date={folder.replace('/', '-')}", f"file={base}")[1], True)
    there = landed.get(base, [])
    for number, file in enumerate((n for n in file_names(spark, place, draft) if n.startswith("part-")), 1):
        ending = re.search(ENDING, file)[0]
        to = f"{base}{ending}" if number == 1 else f"{base}_part{number}{ending}"
        target = file_system(spark, place, folder, to)[1]
        if to in there:
            fs.delete(target, False)
        if not fs.rename(file_system(spark, place, draft, file)[1], target):
            raise OSError(f"cannot rename {draft}/{file} to {folder}/{to}")
        there = [n for n in there if n != to]
    for left in there:  # parts of an earlier landing with more of them
        fs.delete(file_system(spark, place, folder, left)[1], False)


def land_records(
    records: DataFrame,
    root: str,
    endpoint: str,
    suffix: str | None = None,
    max_records: int = MAX_RECORDS,
    max_bytes: int = MAX_BYTES,
    compression: str = "none",
) -> None:
    """`build_envelopes` and `write_envelopes` in one step, without leaving shuffle files; nothing is written for no records."""
    with shuffles_released(records.sparkSession):
        write_envelopes(build_envelopes(records, endpoint, suffix, max_records, max_bytes), root, endpoint, compression)
