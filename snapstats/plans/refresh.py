"""The processing job: every endpoint's landed history to one replaced collection."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapstats.fixed_values import ENDPOINT_MODES
from snapstats.operators.aggregate import counter_records, win_rate
from snapstats.operators.shape import MissingPayload, generic, shallow
from snapstats.schemas import counter_record, envelope_schema
from snapstats.sinks.tables import write_collection
from snapstats.sources.landing import CORRUPT, scan_endpoint
from snapstats.sources.variants import land_variants, variant_envelopes

REPORT_SCHEMA = "endpoint string, mode string, status string, rows bigint, message string, seconds double, rejected bigint, corrupt bigint"
COUNTER_KEYS = {"hero": "hero_id", "item": "item_id"}


def process(envelopes: DataFrame, mode: str, stamps: str = "utc") -> DataFrame:
    """Envelopes with their payload in ``data`` to the result of their mode; an unknown mode is treated as generic."""
    if mode in COUNTER_KEYS:
        key = COUNTER_KEYS[mode]
        return win_rate(counter_records(envelopes, key, stamps=stamps), key, stamps=stamps)
    return shallow(envelopes) if mode == "shallow" else generic(envelopes)


def _with_payload(envelopes: DataFrame) -> DataFrame:
    """Envelopes whose payload column is ``data``.

    With a declared schema the payload columns always exist, so which of them the history has is asked of
    the rows; the question ends at the first envelope that has one.
    """
    for name in ("data", "heroes"):
        if name in envelopes.columns and not envelopes.where(F.col(name).isNotNull()).isEmpty():
            kept = [c for c in (CORRUPT,) if c in envelopes.columns]
            return envelopes.select("fetched_at", F.col(name).alias("data"), *kept)
    raise MissingPayload("no envelope has a payload")


def _observed(envelopes: DataFrame) -> tuple[DataFrame, Observation | None]:
    """The envelopes, with a count of those that could be read in part only, and not at all, by whoever reads them."""
    if CORRUPT not in envelopes.columns or "data" not in envelopes.columns:
        return envelopes, None
    bad, lost, seen = F.col(CORRUPT).isNotNull(), F.col("data").isNull(), Observation()
    counts = [F.count_if(bad & ~lost).alias("rejected"), F.count_if(bad & lost).alias("corrupt")]
    return envelopes.observe(seen, *counts), seen


def refresh_endpoint(
    spark: SparkSession,
    root: str,
    target: str,
    endpoint: str,
    mode: str,
    schema: StructType | None = None,
    stamps: str = "utc",
    bronze: str | None = None,
    **sink,
) -> tuple:
    """One endpoint from landing to collection, as a report row.  Errors end up in the row.

    Stamps that are not in UTC ISO format are an error, unless ``stamps`` is ``"text"`` or ``"lenient"``.
    The row also tells how many envelopes held a value that does not fit its declared type (``rejected``; the value
    counts as null), and how many files were no readable envelope at all (``corrupt``).
    With ``bronze``, an endpoint without a schema is first landed there as VARIANT records: its JSON is read once, and no
    schema is inferred.
    """
    started = time.monotonic()

    def row(status: str, rows: int | None = None, message: str = "", bad: dict | None = None) -> tuple:
        found = [None, None] if bad is None else [bad.get("rejected", 0), bad.get("corrupt", 0)]
        return endpoint, mode, status, rows, message, round(time.monotonic() - started, 3), *found

    try:
        if schema is None and mode in COUNTER_KEYS:
            schema = envelope_schema(counter_record(COUNTER_KEYS[mode]), legacy=mode == "hero")
        if schema is None and bronze is not None:
            try:
                landed = land_variants(spark, root, bronze, endpoint)
                result = process(variant_envelopes(spark, bronze, endpoint), mode)
            except AnalysisException:
                return row("SKIP", message="folder not found or empty")
            except MissingPayload as missing:
                return row("SKIP", message=str(missing))
            return row("OK", write_collection(result, target, endpoint, **sink), bad=landed._asdict())
        scan = scan_endpoint(spark, root, endpoint, schema, corrupt=True)
        if scan.frame is None:
            return row(scan.status, message=scan.message)
        try:
            payloads = _with_payload(scan.frame) if mode in COUNTER_KEYS else scan.frame
            envelopes, seen = _observed(payloads)
            result = process(envelopes, mode, stamps)
        except MissingPayload as missing:
            return row("SKIP", message=str(missing))
        rows = write_collection(result, target, endpoint, **sink)
        return row("OK", rows, bad={} if seen is None else seen.get)
    except Exception as error:
        return row("FAIL", message=str(error).splitlines()[0] if str(error) else type(error).__name__)


def refresh_collections(
    spark: SparkSession,
    root: str,
    target: str,
    endpoints: dict[str, str] | None = None,
    schemas: dict[str, StructType] | None = None,
    parallel: int = 4,
    stamps: str = "utc",
    bronze: str | None = None,
    **sink,
) -> DataFrame:
    """Refresh all endpoints and return the run report, one row per endpoint in registry order.

    Endpoints are independent: one that fails does not stop the others, and ``parallel`` of them share
    the cluster, so that a small endpoint does not leave it idle.
    """
    endpoints = ENDPOINT_MODES if endpoints is None else endpoints
    schemas = schemas or {}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = list(
            pool.map(
                lambda item: refresh_endpoint(spark, root, target, *item, schemas.get(item[0]), stamps, bronze, **sink),
                endpoints.items(),
            )
        )
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def report_tallies(report: DataFrame) -> DataFrame:
    """Endpoints and rows per status."""
    return report.groupBy("status").agg(
        F.count(F.lit(1)).alias("endpoints"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    )


def exit_code(report: DataFrame) -> int:
    """1 if any endpoint failed."""
    return 0 if report.where(F.col("status") == "FAIL").isEmpty() else 1
