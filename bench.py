"""Headline timings on one machine.

Prints one JSON line.  Landing zone, bronze table and stored collection are made first; what is timed is
the query alone, from plan to the last row (written to Spark's ``noop`` sink), as the median of a few runs
after a warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from snapstats.operators import aggregate, blocks, discover, filters, shape  # noqa: E402
from snapstats.plans import browse, continued, derived, refresh, report  # noqa: E402
from snapstats.schemas import bronze_counters, counter_record, envelope_schema  # noqa: E402
from snapstats.session import build_session, scratch_path  # noqa: E402
from snapstats.sinks.landing import land_records  # noqa: E402
from snapstats.sources import landing  # noqa: E402
from snapstats.sources.collections import CollectionEntry, Collections  # noqa: E402
from snapstats.streaming import stream_win_rate  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def consume(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "snapstats-bench",
        master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("OFF")

    root, bronze, target = (scratch_path(spark, n) for n in ("landing", "bronze", "collections"))
    land_records(derived.hero_snapshots(spark, sf_dir), root, "hero_stats")
    land_records(derived.item_snapshots(spark, sf_dir), root, "item_stats")
    history = derived.history_records(spark, sf_dir)
    stamped = history.withColumn("fetched_at", F.lit("2026-04-05T10:00:00+00:00"))
    land_records(stamped, root, "match_history")
    counters = {"hero_stats": "hero_id", "item_stats": "item_id"}
    for endpoint, key in counters.items():
        envelopes = landing.read_endpoint(spark, root, endpoint, schema=envelope_schema(counter_record(key)))
        records = F.transform(
            "data", lambda r: F.struct(*[r[c].cast("bigint").alias(c) for c in (key, "wins", "losses", "matches")])
        )
        landing.land_bronze(envelopes.withColumn("data", records), bronze, endpoint)

    registry = tuple(CollectionEntry(n, "bench") for n in ("lineitem", "orders", "part", "supplier", "nation"))
    collections = Collections(spark, tables={e.name: f"{sf_dir}/{e.name}.parquet" for e in registry}, registry=registry)

    def from_json(endpoint, key):
        envelopes = landing.read_endpoint(spark, root, endpoint, schema=envelope_schema(counter_record(key)))
        return aggregate.win_rate(aggregate.counter_records(envelopes, key), key)

    def from_bronze(endpoint, key):
        return aggregate.win_rate(landing.read_bronze(spark, bronze, endpoint, schema=bronze_counters(key)), key)

    def page(number, **how):
        return browse.browse(collections, "lineitem", number, 200, "l_extendedprice", "desc", **how).rows

    def stream():
        out = scratch_path(spark, "stream")
        stream_win_rate(spark, root, "hero_stats", "hero_id", out, scratch_path(spark, "checkpoint")).awaitTermination()
        return spark.read.parquet(out)

    def plain_win_rate(endpoint, key):
        """The same totals as one would first write them: schema inferred, latest stamp as text."""
        raw = spark.read.option("multiLine", True).option("recursiveFileLookup", True).json(f"{root}/raw/{endpoint}")
        rows = raw.select("fetched_at", F.explode("data").alias("r")).select("fetched_at", "r.*")
        totals = rows.groupBy(key).agg(
            *[F.sum(c).alias(f"total_{c}") for c in ("wins", "losses", "matches")], F.max("fetched_at").alias("last_updated"))
        return totals.where("total_matches > 0").withColumn("win_rate", F.round(F.expr("total_wins / total_matches"), 4))

    def plain_refresh():
        """Each endpoint counted, then written."""
        rows = []
        for endpoint in ("hero_stats", "item_stats", "match_history"):
            key = counters.get(endpoint)
            frame = plain_win_rate(endpoint, key) if key else shape.shallow(landing.read_endpoint(spark, root, endpoint))
            rows.append((endpoint, frame.count()))
            frame.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{target}-plain/{endpoint}")
        return spark.createDataFrame(rows, "endpoint string, rows bigint")

    def landed():
        path = scratch_path(spark, "landed")
        land_records(stamped, path, "match_history")
        return spark.read.text(path, recursiveFileLookup=True).select(F.lit(1))

    endpoints = {"hero_stats": "hero", "item_stats": "item", "match_history": "shallow"}
    state = scratch_path(spark, "state")
    matches = derived.match_records(spark, sf_dir)
    queries = {
        "json_hero_win_rate": lambda: from_json("hero_stats", "hero_id"),
        "json_item_win_rate": lambda: from_json("item_stats", "item_id"),
        "bronze_hero_win_rate": lambda: from_bronze("hero_stats", "hero_id"),
        "bronze_item_win_rate": lambda: from_bronze("item_stats", "item_id"),
        "json_shallow": lambda: shape.shallow(landing.read_endpoint(spark, root, "match_history")),
        "generic_flatten": lambda: shape.generic(derived.event_envelopes(spark, sf_dir)),
        "discover_accounts": lambda: discover.distinct_accounts(matches),
        "history_of_discovered": lambda: discover.of_discovered(
            history, discover.distinct_accounts(matches), "account_id"
        ),
        "chunk_totals": lambda: blocks.block_totals(
            blocks.attach_blocks(history, blocks.number_blocks(history, "account_id"), "account_id")
        ),
        "browse_page_1": lambda: page(1),
        "browse_page_100": lambda: page(100),
        "browse_page_2500_located": lambda: page(2500),
        "browse_meta": lambda: browse.browse(collections, "lineitem", 1).meta,
        "report_page": lambda: report.report_view(
            collections, derived.nation_names(spark, sf_dir), "lineitem", sort="l_extendedprice", limit=200
        ).rows,
        "search_table": lambda: filters.search(derived.table(spark, sf_dir, "lineitem"), "1998"),
        "list_collections": lambda: browse.list_collections(collections),
        "refresh_job": lambda: refresh.refresh_collections(spark, root, target, endpoints),
        "refresh_nothing_new": lambda: continued.continue_collections(spark, root, f"{target}-continued", state, endpoints),
        "land_history": landed,
        "streamed_win_rate": stream,
    }
    plain = {
        "json_hero_win_rate": lambda: plain_win_rate("hero_stats", "hero_id"),
        "json_item_win_rate": lambda: plain_win_rate("item_stats", "item_id"),
        "refresh_job": plain_refresh,
    }

    def timed(query) -> float:
        runs = []
        for _ in range(RUNS + 1):
            started = time.perf_counter()
            consume(query())
            runs.append(time.perf_counter() - started)
        return round(statistics.median(runs[1:]), 3)

    timings = {name: timed(query) for name, query in queries.items()}
    line = {
        "metric": "total of median query times",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "plain": {name: timed(query) for name, query in plain.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
