"""The refresh that reads only what landed since the last one.

Per endpoint a ledger in the ``state`` folder names each file taken with its size and time.  A run lists the landing
folder and compares: files not in the ledger are read, whatever their age; of files that were replaced under their own
name, or removed, what they had given is taken back first, so that the collection is always that of a full scan.

A counter endpoint keeps partial totals per file and key: those of old files are subtracted, those of new ones added.
The freshest stamp cannot be subtracted; for keys of files taken back it is looked up in the partial totals that remain.
A record endpoint keeps the file of each row in a hidden column; data folders that hold rows to be taken back are written
anew without them.  Where the schema grows (a field came up, a type widened) the endpoint is built anew from all files.

Collection and ledger are published as versions, the collection first: a run that fails midway leaves the old table
readable, and the next run takes the same files again.
"""

from __future__ import annotations

import re
import time
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, LongType, StringType, StructField, StructType

from snapstats.fixed_values import ENDPOINT_MODES
from snapstats.functions.stamps import micros_to_iso
from snapstats.operators.aggregate import counter_records, rates
from snapstats.operators.shape import generic, quoted, shallow
from snapstats.plans.refresh import COUNTER_KEYS
from snapstats.schemas import COUNTERS, counter_record, envelope_schema
from snapstats.sinks.tables import publish_folders, write_counted
from snapstats.sinks.versions import Version, discard, fresh_folder, publish, read_published, read_version
from snapstats.sources.landing import CORRUPT, endpoint_path

REPORT_SCHEMA = ("endpoint string, mode string, status string, how string, envelopes bigint, rows bigint, message string, seconds double, "
                 "replaced bigint, removed bigint, rejected bigint, corrupt bigint")
LEDGER = "path string, raw string, modified timestamp, length bigint, folder string"
SOURCE = "_source_file"
MAX_PATHS = 20_000  # files that are named to the reader one by one; more are found by a scan of the folder
MAX_FOLDERS = 64  # of partial totals, before they are written together


def covers(known: DataType, new: DataType) -> bool:
    """Whether JSON of the type ``new`` can be read as ``known`` without losing a field or a value."""
    if isinstance(known, StructType) and isinstance(new, StructType):
        return all(f.name in known.names and covers(known[f.name].dataType, f.dataType) for f in new)
    if isinstance(known, ArrayType) and isinstance(new, ArrayType):
        return covers(known.elementType, new.elementType)
    return known == new or isinstance(known, StringType) or (isinstance(known, DoubleType) and isinstance(new, LongType))


def landed_files(spark: SparkSession, root: str, endpoint: str) -> DataFrame:
    """Every landed file with its time and size; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(endpoint_path(root, endpoint))
    meta = F.col("_metadata")
    return listed.select(
        meta["file_path"].alias("path"), F.col("path").alias("raw"), meta["file_modification_time"].alias("modified"), meta["file_size"].alias("length"))


class Difference(NamedTuple):
    """The landing folder against the ledger.  ``ledger`` is the next one, new files in the folder ``fresh``."""

    name: str
    ledger: DataFrame
    fresh: str
    new: int
    replaced: int
    removed: int


class Run:
    """One endpoint's run: its places and its last state."""

    def __init__(self, spark: SparkSession, root: str, target: str, state: str, endpoint: str):
        self.spark, self.root, self.endpoint = spark, root, endpoint
        self.place, self.state = (f"{p.rstrip('/')}/{endpoint}" for p in (target, state))
        self.known: Version | None = read_version(spark, self.state)
        last = read_version(spark, self.place)
        if self.known and (last is None or (last.note or {}).get("run") != self.known.note["run"]):
            # the collection is not what the ledger says: lost, or published by a run that ended before its ledger
            present = set(last.all_folders() + last.before) if last else set()
            if not present.issuperset(self.known.note["data"]):
                self.known = None

    def forget(self) -> None:
        self.known = None

    def read(self, place: str, folders: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{place}/{f}" for f in folders])

    def taken(self) -> DataFrame:
        if self.known is None:
            return self.spark.createDataFrame([], LEDGER)
        return self.read(self.state, self.known.folders)

    def compare(self, listed: DataFrame) -> Difference:
        """Write the next ledger and count what differs."""
        old = self.taken().select("path", *[F.col(c).alias(f"old_{c}") for c in ("modified", "length", "folder")])
        same = F.coalesce((F.col("modified") == F.col("old_modified")) & (F.col("length") == F.col("old_length")), F.lit(False))
        fresh, name = fresh_folder(), fresh_folder()
        joined = listed.join(old, "path", "left").withColumn("folder", F.when(same, F.col("old_folder")).otherwise(F.lit(fresh)))
        joined.select(*[f.split()[0] for f in LEDGER.split(", ")]).write.parquet(f"{self.state}/{name}")
        ledger = self.read(self.state, [name])
        new = ledger.where(F.col("folder") == fresh).join(old.select("path", "old_folder"), "path", "left").agg(
            F.count(F.lit(1)).alias("n"), F.count("old_folder").alias("again")).first()
        removed = old.join(ledger, "path", "left_anti").count() if self.known else 0
        return Difference(name, ledger, fresh, new["n"], new["again"], removed)

    def dropped(self, change: Difference) -> DataFrame:
        """(path, folder) of what is to be taken back."""
        return self.taken().select("path", "folder").join(change.ledger.select("path", "folder"), ["path", "folder"], "left_anti")

    def json(self, paths: list[str] | None, schema: StructType | None = None) -> DataFrame:
        """The envelopes of files, or of the folder.  (Spark cannot infer a schema from names with brackets or stars.)"""
        reader = self.spark.read.option("multiLine", True)
        if schema is not None:
            reader = reader.schema(schema)
        if paths is None:
            return reader.option("recursiveFileLookup", True).json(endpoint_path(self.root, self.endpoint))
        return reader.json([re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths])

    def new_paths(self, change: Difference) -> list[str] | None:
        """The new files by name, None if they are too many."""
        if change.new > MAX_PATHS:
            return None
        return [r["raw"] for r in change.ledger.where(F.col("folder") == change.fresh).select("raw").collect()]

    def envelopes(self, paths: list[str] | None, change: Difference, schema: StructType) -> DataFrame:
        """The envelopes of new files, with their file; files that landed after the listing are left for the next run."""
        rows = self.json(paths, StructType([*schema, StructField(CORRUPT, StringType())])).withColumn(SOURCE, F.col("_metadata.file_path"))
        if paths is None:
            rows = rows.join(change.ledger.where(F.col("folder") == change.fresh).select(F.col("path").alias(SOURCE)), SOURCE, "left_semi")
        return rows

    def publish(self, change: Difference, ledger: str, data: list[str], schema: StructType, hidden: tuple[str, ...], kept: list[str], note: dict) -> int:
        """The collection, then the ledger; returns the rows of the collection."""
        number = (self.known.note["run"] if self.known else 0) + 1
        rows = publish_folders(self.spark, self.place, data, None, hidden, {"run": number}).rows
        note = {"run": number, "schema": schema.jsonValue(), "data": data, **note}
        publish(self.spark, self.state, Version([ledger], None, None, (), note, kept))
        return rows


def _partials(records: DataFrame, key: str) -> DataFrame:
    """Totals per file and key, with the number of values in each, so that they can be taken back."""
    stamp = "fetched_us" if "fetched_us" in records.columns else "fetched_at"
    return records.groupBy(F.col(SOURCE).alias("path"), quoted(key).alias("key")).agg(
        F.count(F.lit(1)).alias("records"), F.max(stamp).alias("stamp"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS], *[F.count(c).alias(f"n_{c}") for c in COUNTERS])


def _continue_counters(run: Run, change: Difference, envelopes: DataFrame, schema: StructType, key: str, stamps: str) -> int:
    spark, sums = run.spark, ["records", *COUNTERS, *[f"n_{c}" for c in COUNTERS]]
    note = run.known.note if run.known else {"partials": [], "totals": None}
    records = counter_records(envelopes, key, "per_row", stamps, (SOURCE,))
    _partials(records, key).write.parquet(f"{run.state}/{change.fresh}")
    folders, parts = [*note["partials"], change.fresh], []
    added = run.read(run.state, [change.fresh]).select("key", "stamp", *sums)
    parts.append(added)
    if note["totals"]:
        totals = run.read(run.state, [note["totals"]])
        if change.replaced or change.removed:
            folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
            held = run.read(run.state, note["partials"]).withColumn("folder", folder)
            gone = held.join(run.dropped(change), ["path", "folder"], "left_semi")
            keys = gone.select(F.col("key").alias("gone_key")).distinct()
            hit = F.col("key").eqNullSafe(F.col("gone_key"))
            rest = held.join(change.ledger.select("path", "folder"), ["path", "folder"], "left_semi").join(keys, hit, "left_semi")
            none = [F.lit(0).cast("bigint").alias(c) for c in sums]
            parts += [
                gone.select("key", F.lit(None).cast(gone.schema["stamp"].dataType).alias("stamp"), *[(-F.col(c)).alias(c) for c in sums]),
                rest.groupBy("key").agg(F.max("stamp").alias("stamp")).select("key", "stamp", *none),
                totals.join(keys, hit, "left_semi").withColumn("stamp", F.lit(None).cast(totals.schema["stamp"].dataType)),
                totals.join(keys, hit, "left_anti")]
        else:
            parts.append(totals)
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part.select(every.columns))
    made = fresh_folder()
    totals = every.groupBy("key").agg(F.max("stamp").alias("stamp"), *[F.sum(c).alias(c) for c in sums]).where(F.col("records") > 0)
    totals.write.parquet(f"{run.state}/{made}")
    ledger, kept = change.name, [*folders, made]
    if len(folders) > MAX_FOLDERS:
        ledger, folders = _compacted(run, change, folders)
        kept = [*folders, made]
    written = run.read(run.state, [made]).select(
        F.col("key").alias(key), "stamp", *[F.when(F.col(f"n_{c}") > 0, F.col(c)).alias(f"total_{c}") for c in COUNTERS])
    shown = F.col("stamp") if stamps == "text" else micros_to_iso(F.col("stamp"))
    result = fresh_folder()
    write_counted(rates(written, key, shown), f"{run.place}/{result}")
    return run.publish(change, ledger, [result], schema, (), kept, {"partials": folders, "totals": made})


def _compacted(run: Run, change: Difference, folders: list[str]) -> tuple[str, list[str]]:
    """One folder of the partial totals that still count, and the ledger that refers to it."""
    folder, one, ledger = F.element_at(F.split("_metadata.file_path", "/"), -2), fresh_folder(), fresh_folder()
    held = run.read(run.state, folders).withColumn("folder", folder)
    held.join(change.ledger.select("path", "folder"), ["path", "folder"], "left_semi").drop("folder").write.parquet(f"{run.state}/{one}")
    change.ledger.withColumn("folder", F.lit(one)).write.parquet(f"{run.state}/{ledger}")
    return ledger, [one]


def _continue_records(run: Run, change: Difference, envelopes: DataFrame, schema: StructType, mode: str) -> int:
    carry = ("fetched_at", SOURCE)
    rows = shallow(envelopes, carry=carry) if mode == "shallow" else generic(envelopes, carry=carry)
    rows.write.parquet(f"{run.place}/{change.fresh}")
    folders, ledger = [*(run.known.note["data"] if run.known else []), change.fresh], change.name
    if change.replaced or change.removed:
        gone = run.dropped(change)
        touched = [r[0] for r in gone.select("folder").distinct().collect()]  # as many as there were runs, at most
        rest, ledger = fresh_folder(), fresh_folder()
        held = run.read(run.place, touched)
        held.join(gone.select(F.col("path").alias(SOURCE)), SOURCE, "left_anti").select(held.columns).write.parquet(f"{run.place}/{rest}")
        folder = F.when(F.col("folder").isin(touched), F.lit(rest)).otherwise(F.col("folder"))
        change.ledger.withColumn("folder", folder).write.parquet(f"{run.state}/{ledger}")
        folders = [*[f for f in folders if f not in touched], rest]
    return run.publish(change, ledger, folders, schema, (SOURCE,), [], {})


def continue_endpoint(
    spark: SparkSession,
    root: str,
    target: str,
    state: str,
    endpoint: str,
    mode: str,
    schema: StructType | None = None,
    stamps: str = "utc",
) -> tuple:
    """One endpoint, as a report row.  ``schema`` is that of the envelopes; with it nothing is inferred."""
    started = time.monotonic()

    def row(status: str, how: str | None = None, envelopes: int | None = None, rows: int | None = None, message: str = "", *counts):
        found = [*counts, *[None] * (4 - len(counts))]
        return endpoint, mode, status, how, envelopes, rows, message, round(time.monotonic() - started, 3), *found

    try:
        run = Run(spark, root, target, state, endpoint)
        try:
            listed = landed_files(spark, root, endpoint)
        except AnalysisException:
            return row("SKIP", message="folder not found or empty")
        if mode in COUNTER_KEYS:
            schema = envelope_schema(counter_record(COUNTER_KEYS[mode]), legacy=True)
        kept = StructType.fromJson(run.known.note["schema"]) if run.known else None
        if schema is not None and kept != schema:
            run.forget()
        change = run.compare(listed)
        replaced, removed = change.replaced, change.removed
        if run.known and not (change.new or change.removed):
            discard(spark, run.state, change.name)
            return row("OK", "continued", 0, read_version(spark, run.place).rows, "", 0, 0, 0, 0)
        paths = run.new_paths(change)
        wanted = schema or kept
        if schema is None and change.new:
            found = _without_corrupt(run.json(paths).schema)
            if kept is None or not covers(kept, found):
                if run.known:
                    run.forget()
                    discard(spark, run.state, change.name)
                    change = run.compare(listed)
                    paths = run.new_paths(change)
                    found = _without_corrupt(run.json(paths).schema)
                wanted = found
        if wanted is None or "data" not in wanted.names:
            discard(spark, run.state, change.name)
            return row("SKIP", message="no landed records")
        how, seen = "continued" if run.known else "built", Observation()
        bad, lost = F.col(CORRUPT).isNotNull(), F.col("data").isNull()
        scanned = run.envelopes(paths, change, wanted) if change.new else _no_envelopes(spark, wanted)
        counts = [F.count(F.lit(1)).alias("n"), F.count_if(bad & ~lost).alias("rejected"), F.count_if(bad & lost).alias("corrupt")]
        counted = scanned.observe(seen, *counts) if change.new else scanned
        if mode in COUNTER_KEYS:
            rows = _continue_counters(run, change, counted, wanted, COUNTER_KEYS[mode], stamps)
        else:
            rows = _continue_records(run, change, counted, wanted, mode)
        got = seen.get if change.new else {}
        return row("OK", how, got.get("n", 0), rows, "", replaced, removed, got.get("rejected", 0), got.get("corrupt", 0))
    except Exception as error:
        return row("FAIL", message=str(error).splitlines()[0] if str(error) else type(error).__name__)


def _without_corrupt(schema: StructType) -> StructType:
    return StructType([f for f in schema if f.name != CORRUPT])


def _no_envelopes(spark: SparkSession, schema: StructType) -> DataFrame:
    names = [StructField(CORRUPT, StringType()), StructField(SOURCE, StringType())]
    return spark.createDataFrame([], StructType([*schema, *names]))


def continue_collections(
    spark: SparkSession,
    root: str,
    target: str,
    state: str,
    endpoints: dict[str, str] | None = None,
    schemas: dict[str, StructType] | None = None,
    parallel: int = 4,
    stamps: str = "utc",
) -> DataFrame:
    """Take up what landed since the last run with this ``state``, and return the run report.

    ``envelopes`` counts what this run read, ``rows`` the collection as it is now, ``replaced`` and ``removed`` the
    files taken back, ``rejected`` and ``corrupt`` what could not be read, as in the plain refresh.  A hero history counts
    its old payload column for every envelope that has no ``data``.  Runs with one ``state`` must not overlap.  A file
    that is replaced by one of the same size within the clock's tick of its store cannot be told from the old one.
    """
    endpoints = ENDPOINT_MODES if endpoints is None else endpoints
    schemas = schemas or {}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = list(pool.map(
            lambda e: continue_endpoint(spark, root, target, state, *e, schemas.get(e[0]), stamps), endpoints.items()))
    return spark.createDataFrame(rows, REPORT_SCHEMA)
