"""Incremental win rates and incremental record tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from snapstats.operators.aggregate import counter_records, win_rate
from snapstats.operators.shape import generic, shallow
from snapstats.schemas import counter_record, envelope_schema
from snapstats.sources.landing import endpoint_path


def stream_endpoint(
    spark: SparkSession, root: str, endpoint: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """The envelopes of an endpoint as a stream.

    A stream needs a declared schema, and does not notice a file that is replaced under its own name.
    """
    reader = spark.readStream.schema(schema).option("multiLine", True).option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(endpoint_path(root, endpoint))


def _start(writer, trigger: dict | None) -> StreamingQuery:
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_win_rate(
    spark: SparkSession,
    root: str,
    endpoint: str,
    key: str,
    target: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    trigger: dict | None = None,
    legacy: str | None = None,
    stamps: str = "utc",
) -> StreamingQuery:
    """Keep the win-rate collection at ``target`` up to date from newly landed files.

    ``legacy`` and ``stamps`` mean what they do in `counter_records`.  With ``stamps="utc"`` a stamp that is not UTC
    stops the stream at its file for good; ``"lenient"`` counts the records and passes the stamp over.

    The state is one row of running totals per key, so late files need no watermark: sums and the freshest
    stamp do not depend on order.  Each batch replaces the collection, which makes a repeated batch harmless.
    """
    schema = envelope_schema(counter_record(key), legacy=legacy is not None)
    envelopes = stream_endpoint(spark, root, endpoint, schema, files_per_batch)
    totals = win_rate(counter_records(envelopes, key, legacy, stamps), key, stamps=stamps)

    def replace(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)

    writer = totals.writeStream.outputMode("complete").foreachBatch(replace)
    return _start(writer.option("checkpointLocation", checkpoint), trigger)


def stream_records(
    spark: SparkSession,
    root: str,
    endpoint: str,
    record: StructType,
    target: str,
    checkpoint: str,
    mode: str = "generic",
    files_per_batch: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append the records of newly landed files to the collection at ``target``.

    Records are independent of each other, so appending equals rewriting the whole history.
    """
    envelopes = stream_endpoint(spark, root, endpoint, envelope_schema(record), files_per_batch)
    rows = shallow(envelopes) if mode == "shallow" else generic(envelopes)
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", target)
    return _start(writer.option("checkpointLocation", checkpoint), trigger)
