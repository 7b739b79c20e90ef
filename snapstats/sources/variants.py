"""Bronze without a schema: records landed as VARIANT values, and typed by what the landing itself saw.

JSON is read once.  The write that lands an endpoint's records also merges their types, so there is no inference pass,
neither over JSON nor over the bronze table.  A field whose kind differs between records (number and text, object and
number) becomes text and keeps all of its values, objects and arrays as JSON; whole numbers beyond 64 bits, or mixed with
numbers written like ``1.0``, become decimals; other mixed numbers doubles; a field that is only ever null becomes text.

Landings can be added to: each is a folder of a published version whose note holds the merged type.
"""

from __future__ import annotations

import json
import re
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    LongType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from snapstats.operators.shape import MissingPayload
from snapstats.sinks.versions import Version, fresh_folder, publish, read_published, read_version
from snapstats.sources.landing import CORRUPT, endpoint_path

ENVELOPE = f"fetched_at string, data variant, {CORRUPT} string"


class Landed(NamedTuple):
    """The published bronze version, and what of the envelopes read could not be taken.

    ``rejected`` envelopes have a payload that is no array, ``corrupt`` files are no envelope.
    """

    version: Version
    records: int
    rejected: int
    corrupt: int


def plain_type(kind: DataType) -> DataType:
    """What a merged variant type is read as."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, plain_type(f.dataType)) for f in kind]) if kind.fields else StringType()
    if isinstance(kind, ArrayType):
        return ArrayType(plain_type(kind.elementType))
    if isinstance(kind, DecimalType):
        return DecimalType(38, 0) if kind.scale == 0 and kind.precision >= 19 else DoubleType()
    if isinstance(kind, FloatType):
        return DoubleType()
    return StringType() if isinstance(kind, (NullType, VariantType)) else kind


def described_type(text: str | None) -> DataType:
    """The type that ``schema_of_variant_agg`` describes; names in backticks may hold anything."""
    if text is None:
        return NullType()
    ddl = re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda m: m[1] or "STRUCT<", text)
    return StructType.fromDDL(f"record {ddl}")["record"].dataType


def wider(one: DataType, two: DataType) -> DataType:
    """The merged type of two landings, by the rule that merges the records of one."""
    if one == two or isinstance(two, NullType):
        return one
    if isinstance(one, NullType):
        return two
    if isinstance(one, StructType) and isinstance(two, StructType):
        names = sorted({*one.names, *two.names})
        return StructType([StructField(n, wider(*(t[n].dataType if n in t.names else NullType() for t in (one, two)))) for n in names])
    if isinstance(one, ArrayType) and isinstance(two, ArrayType):
        return ArrayType(wider(one.elementType, two.elementType))
    numbers = (LongType, DecimalType, DoubleType)
    if not (isinstance(one, numbers) and isinstance(two, numbers)):
        return VariantType()
    if isinstance(one, DoubleType) or isinstance(two, DoubleType):
        return DoubleType()
    sizes = [(20, 0) if isinstance(t, LongType) else (t.precision, t.scale) for t in (one, two)]
    scale = max(s for _, s in sizes)
    whole = max(p - s for p, s in sizes)
    return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()


def _envelopes(spark: SparkSession, where: str | list[str]) -> DataFrame:
    return spark.read.option("multiLine", True).option("recursiveFileLookup", True).schema(ENVELOPE).json(where)


def land_variants(
    spark: SparkSession, root: str, path: str, endpoint: str, files: list[str] | None = None, append: bool = False
) -> Landed:
    """Read an endpoint's envelopes (or only the ``files`` named) and publish their records below ``path/endpoint``.

    ``append`` keeps what earlier landings published.  An absent or empty folder is an `AnalysisException`.
    """
    place, folder = f"{path.rstrip('/')}/{endpoint}", fresh_folder()
    envelopes, records = Observation(), Observation()
    read = _envelopes(spark, files or endpoint_path(root, endpoint))
    arrays = read.select(
        "fetched_at", F.try_variant_get("data", "$", "array<variant>").alias("data"),
        (F.col("data").isNull() & F.col(CORRUPT).isNotNull()).alias("corrupt"),
        (F.col("data").isNotNull() & ~F.is_variant_null("data")).alias("payload"))
    stamped = arrays.observe(
        envelopes, F.count_if("corrupt").alias("corrupt"), F.count_if(F.col("payload") & F.col("data").isNull()).alias("rejected"))
    exploded = stamped.select("fetched_at", F.explode("data").alias("record"))
    seen = exploded.observe(records, F.count(F.lit(1)).alias("n"), F.schema_of_variant_agg("record").alias("kind"))
    seen.write.parquet(f"{place}/{folder}")
    last = read_version(spark, place) if append else None
    kind, n = described_type(records.get["kind"]), records.get["n"]
    if last:
        kind = wider(described_type_of(last), kind)
    version = Version([*(last.folders if last else []), folder], n + (last.rows if last else 0), note={"records": StructType([StructField("record", kind)]).json()})
    return Landed(publish(spark, place, version), n, envelopes.get["rejected"], envelopes.get["corrupt"])


def described_type_of(version: Version) -> DataType:
    """The merged type that a bronze version notes."""
    return StructType.fromJson(json.loads(version.note["records"]))["record"].dataType


def variant_envelopes(spark: SparkSession, path: str, endpoint: str, record: StructType | None = None) -> DataFrame:
    """Landed records, each in an envelope of its own, for the functions that take envelopes.

    ``record`` declares fields to read instead of all; a value that does not fit its field is null.
    """
    place = f"{path.rstrip('/')}/{endpoint}"
    version = read_version(spark, place)
    if version is None:
        raise MissingPayload(f"nothing is landed for {endpoint!r}")
    kind = record if record is not None else described_type_of(version)
    if not isinstance(kind, StructType):
        raise MissingPayload("no envelope has an array of records")
    typed = F.try_variant_get("record", "$", _ddl(plain_type(kind) if record is None else kind))
    return read_published(spark, place, version).select("fetched_at", F.array(typed).alias("data"))


def _ddl(kind: DataType) -> str:
    """The type as text, with every name quoted."""
    if isinstance(kind, StructType):
        return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:{_ddl(f.dataType)}" for f in kind) + ">"
    if isinstance(kind, ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    return kind.simpleString()
