"""The registered queries: each operator over the whole benchmark tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstats.functions.display import cell, clipped_json, grouped_number, plain_number, short_count, title_words
from snapstats.functions.parsing import leading_int_col
from snapstats.functions.stamps import display_time, iso_micros, iso_utc, landing_path, stamp_path
from snapstats.operators import aggregate, blocks, discover, filters, lookup, paging, shape
from snapstats.plans import browse, continued, derived, discovery, refresh, report
from snapstats.schemas import bronze_counters, counter_record, envelope_schema
from snapstats.session import scratch_path
from snapstats.sinks.landing import build_envelopes, jsonable, land_records
from snapstats.sinks.search_index import index_search, search_collection
from snapstats.sinks.tables import read_collection, write_collection
from snapstats.sources import landing, payload
from snapstats.sources.collections import CollectionEntry, Collections, hero_dimension
from snapstats.sources.tuple_csv import read_tuple_csv
from snapstats.streaming import stream_records, stream_win_rate

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOTALS = ["total_wins", "total_losses", "total_matches"]
LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _hero_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.counter_records(derived.hero_envelopes(spark, sf_dir), "hero_id")


def _stored_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hero collection as the processing job leaves it: written, and read back for querying."""
    target = scratch_path(spark, "collections")
    write_collection(hero_win_rate(spark, sf_dir), target, "hero_stats")
    return read_collection(spark, target, "hero_stats")


# --- win rates ---------------------------------------------------------------------------------------


@query
def hero_win_rate(spark, sf_dir):
    return aggregate.win_rate(_hero_records(spark, sf_dir), "hero_id")


@query
def item_win_rate(spark, sf_dir):
    records = aggregate.counter_records(derived.item_envelopes(spark, sf_dir), "item_id")
    return aggregate.win_rate(records, "item_id")


@query
def hero_win_rate_legacy(spark, sf_dir):
    records = aggregate.counter_records(derived.mixed_hero_envelopes(spark, sf_dir), "hero_id", legacy="per_row")
    return aggregate.win_rate(records, "hero_id")


@query
def hero_win_rate_data_first(spark, sf_dir):
    records = aggregate.counter_records(derived.mixed_hero_envelopes(spark, sf_dir), "hero_id", legacy="data_first")
    return aggregate.win_rate(records, "hero_id")


@query
def hero_win_rate_text_stamps(spark, sf_dir):
    records = derived.counter_snapshots(derived.table(spark, sf_dir, "lineitem"), "l_suppkey", "hero_id")
    return aggregate.win_rate(records, "hero_id", overflow="null", stamps="text")


@query
def hero_win_rate_from_files(spark, sf_dir):
    root = scratch_path(spark, "landing")
    land_records(derived.hero_snapshots(spark, sf_dir), root, "hero_stats")
    landed = landing.read_endpoint(spark, root, "hero_stats", schema=envelope_schema(counter_record("hero_id")))
    return aggregate.win_rate(aggregate.counter_records(landed, "hero_id"), "hero_id")


@query
def hero_win_rate_bronze(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    landing.land_bronze(derived.hero_envelopes(spark, sf_dir), path, "hero_stats")
    return aggregate.win_rate(landing.read_bronze(spark, path, "hero_stats"), "hero_id")


@query
def bronze_date_range(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    landing.land_bronze(derived.hero_envelopes(spark, sf_dir), path, "hero_stats")
    columns = bronze_counters("hero_id")
    year = landing.read_bronze(spark, path, "hero_stats", "1997-01-01", "1997-12-31", columns)
    return aggregate.win_rate(year, "hero_id")


@query
def counter_drift(spark, sf_dir):
    """Counters and keys that are numbers in the old payload, and text, partly unreadable, in the new one."""
    events = derived.event_records(spark, sf_dir)
    kind = F.col("event_type")
    key = F.col("event_id") % 50
    new = F.struct(
        F.when(kind == "error", F.lit("nobody")).otherwise(key.cast("string")).alias("hero_id"),
        F.when(kind == "click", F.lit("many")).otherwise(F.lit("1")).alias("wins"),
        F.lit("0.0").alias("losses"),
        F.lit("2").alias("matches"),
    )
    number = F.lit(3).cast("bigint")
    old = F.struct(key.alias("hero_id"), number.alias("wins"), number.alias("losses"), (number * 2).alias("matches"))
    is_old = F.col("event_id") % 3 == 0
    envelopes = events.select(
        "fetched_at", F.when(~is_old, F.array(new)).alias("data"), F.when(is_old, F.array(old)).alias("heroes")
    )
    return aggregate.win_rate(aggregate.counter_records(envelopes, "hero_id", legacy="per_row"), "hero_id")


@query
def rejected_counters(spark, sf_dir):
    """Counters that drifted to text, some of them unreadable."""
    record = F.struct(
        F.col("event_id").alias("hero_id"),
        F.col("value").cast("string").alias("wins"),
        F.col("event_type").alias("losses"),
        F.col("user_id").alias("matches"),
    )
    envelopes = derived.table(spark, sf_dir, "events").select(F.array(record).alias("data"))
    return aggregate.rejected_counters(envelopes)


# --- records -----------------------------------------------------------------------------------------


@query
def generic_flatten(spark, sf_dir):
    return shape.generic(derived.event_envelopes(spark, sf_dir))


@query
def shallow_explode(spark, sf_dir):
    rows = shape.shallow(derived.match_envelopes(spark, sf_dir))
    return rows.select(
        "fetched_at",
        "match_id",
        F.coalesce(F.array_size("match_info.players"), F.lit(0)).alias("nested_players"),
        F.coalesce(F.array_size("players"), F.lit(0)).alias("flat_players"),
        F.coalesce(F.col("match_info.players")[0]["account_id"], F.col("players")[0]["account_id"]).alias("first_account"),
    )


@query
def normalize_payload(spark, sf_dir):
    records = derived.event_payloads(spark, sf_dir).select(
        "event_id", payload.normalize_payload(F.col("payload"), "struct<k:bigint>").alias("data")
    )
    return records.select("event_id", F.explode("data").alias("r")).select("event_id", F.col("r.k").alias("k"))


@query
def payload_sizes(spark, sf_dir):
    records = derived.event_payloads(spark, sf_dir).select(
        "event_id", payload.normalize_variant(F.col("payload")).alias("data")
    )
    return aggregate.with_record_count(records).select("event_id", "record_count")


@query
def non_empty_payloads(spark, sf_dir):
    records = derived.event_payloads(spark, sf_dir).select(
        "event_id", payload.normalize_payload(F.col("payload"), "struct<k:bigint>").alias("data")
    )
    return aggregate.with_record_count(aggregate.non_empty(records)).select("event_id", "record_count")


@query
def inject_key(spark, sf_dir):
    rows = shape.inject_key(derived.history_responses(spark, sf_dir), "account_id")
    return rows.select("fetched_at", "account_id", "match_id", "hero_id")


@query
def record_counts(spark, sf_dir):
    envelopes = derived.hero_envelopes(spark, sf_dir).drop("record_count")
    counted = aggregate.with_record_count(envelopes)
    return counted.groupBy("fetched_at").agg(F.sum("record_count").alias("record_count"))


@query
def envelope_paths(spark, sf_dir):
    envelopes = derived.hero_envelopes(spark, sf_dir).where("record_count > 0")
    return envelopes.select(landing_path(F.col("endpoint"), F.col("fetched_at"), F.lit("")).alias("path")).distinct()


@query
def landed_paths(spark, sf_dir):
    """The files that landing has written, one to an envelope."""
    root = scratch_path(spark, "landing")
    snapshots = derived.hero_snapshots(spark, sf_dir)
    land_records(snapshots.withColumn("batch", F.concat(F.lit("_batch"), F.col("hero_id") % 2 + 1)), root, "hero_stats", suffix="batch")
    land_records(snapshots, root, "hero_stats")
    return continued.landed_files(spark, root, "hero_stats").select(F.regexp_extract("path", "raw/.*$", 0).alias("path"))


@query
def stamps(spark, sf_dir):
    """Time of every event in the formats in use."""
    events = derived.table(spark, sf_dir, "events")
    iso = iso_utc(F.col("ts"))
    return events.select(
        "event_id",
        iso.alias("stamp"),
        iso_micros(iso).alias("micros"),
        stamp_path(F.col("ts")).alias("path"),
        display_time(iso).alias("shown"),
    )


@query
def jsonable_values(spark, sf_dir):
    """Dates and decimals as the text they have in a landed file."""
    orders = derived.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice")
    )
    return orders.select(*[jsonable(F.col(f.name), f.dataType).alias(f.name) for f in orders.schema])


@query
def union_drift(spark, sf_dir):
    customers = derived.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_custkey").alias("code"),
    )
    suppliers = derived.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
        F.col("s_name").alias("code"),
    )
    return landing.union_snapshots([customers, suppliers])


@query
def leading_integers(spark, sf_dir):
    """The number in front of each part name and size text."""
    part = derived.table(spark, sf_dir, "part")
    text = F.concat(F.lit("  -"), F.col("p_size").cast("string"), F.lit("cm "), F.col("p_name"))
    return part.select(
        "p_partkey",
        leading_int_col(text).alias("signed"),
        leading_int_col(F.col("p_name")).alias("none"),
        leading_int_col(F.concat(F.lit("0x"), F.hex("p_partkey"))).alias("hex"),
        leading_int_col(F.concat(F.lit("-0X"), F.repeat(F.lit("f"), F.col("p_size")))).alias("long_hex"),
    )


@query
def tuple_csv(spark, sf_dir):
    """Suppliers exported as a tuple-cell sheet; those in debt become padding lines."""
    supplier = derived.table(spark, sf_dir, "supplier")
    filled = F.col("s_acctbal") >= 0

    def tuple_of(name, value):
        return F.when(filled, F.concat(F.lit(f"('{name}', "), value.cast("string"), F.lit(")")))

    path = scratch_path(spark, "sheet")
    supplier.select(
        tuple_of("hero_id", F.col("s_suppkey")),
        tuple_of("players", F.col("s_nationkey")),
        tuple_of("wins", F.floor(F.col("s_acctbal") * 1_000_000)),
        F.lit(None).cast("string").alias("gap"),
        F.when(filled, F.col("s_name")).otherwise(F.lit("ID Not Found")).alias("name"),
    ).write.csv(path)
    return read_tuple_csv(spark, path, ("hero_id", "players", "wins"))


# --- discovery ---------------------------------------------------------------------------------------


@query
def discover_heroes(spark, sf_dir):
    return discover.distinct_in_order(derived.hero_envelopes(spark, sf_dir), "hero_id")


@query
def discover_matches(spark, sf_dir):
    return discover.distinct_ids(derived.match_records(spark, sf_dir), "match_id")


@query
def discover_accounts(spark, sf_dir):
    return discover.distinct_accounts(derived.match_records(spark, sf_dir))


@query
def discovery_totals(spark, sf_dir):
    matches = derived.match_records(spark, sf_dir)
    return discover.tracked_totals(matches, discover.distinct_accounts(matches))


@query
def history_of_discovered(spark, sf_dir):
    accounts = discover.distinct_accounts(derived.match_records(spark, sf_dir))
    return discover.of_discovered(derived.history_records(spark, sf_dir), accounts, "account_id")


def _listed_matches(spark, sf_dir):
    orders = derived.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "match_id")
    return discover.distinct_ids(orders, "match_id")


@query
def details_of_discovered(spark, sf_dir):
    finished = derived.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    ids = discover.distinct_ids(finished.withColumnRenamed("o_orderkey", "match_id"), "match_id")
    details = discover.of_discovered(derived.match_records(spark, sf_dir), ids, "match_id")
    return aggregate.tally(details, "match_id", "records")


@query
def details_missing(spark, sf_dir):
    return discover.undiscovered(_listed_matches(spark, sf_dir), derived.match_records(spark, sf_dir), "match_id")


@query
def request_grid(spark, sf_dir):
    heroes = discover.distinct_ids(_hero_records(spark, sf_dir), "hero_id")
    return discover.request_grid(heroes, discovery.PER_HERO_ENDPOINTS)


@query
def discovered(spark, sf_dir):
    """How many ids and follow-up requests a whole discovery run finds."""
    orders = derived.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "match_id")
    found = discovery.discover(
        derived.hero_envelopes(spark, sf_dir), orders, derived.match_records(spark, sf_dir)
    )
    counts = [
        frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
        for name, frame in found._asdict().items()
    ]
    return landing.union_snapshots(counts)


@query
def chunk_numbers(spark, sf_dir):
    return blocks.number_blocks(derived.history_records(spark, sf_dir), "account_id")


@query
def chunk_totals(spark, sf_dir):
    history = derived.history_records(spark, sf_dir)
    numbered = blocks.number_blocks(history, "account_id")
    return blocks.block_totals(blocks.attach_blocks(history, numbered, "account_id"))


@query
def landed_history(spark, sf_dir):
    """Match history landed in blocks of accounts, one envelope per file, and read back."""
    history = derived.history_records(spark, sf_dir)
    numbered = blocks.number_blocks(history, "account_id")
    stamped = blocks.attach_blocks(history, numbered, "account_id").drop("block")
    root = scratch_path(spark, "landing")
    stamped = stamped.withColumn("fetched_at", F.lit("2026-04-05T10:00:00+00:00"))
    land_records(stamped, root, "match_history", suffix="suffix", max_records=5_000)
    return shape.shallow(landing.read_endpoint(spark, root, "match_history"))


@query
def split_envelopes(spark, sf_dir):
    """Every day of events as envelopes of at most 100 records: sizes and their check."""
    envelopes = build_envelopes(derived.event_records(spark, sf_dir), "events", max_records=100)
    return envelopes.groupBy("fetched_at").agg(
        F.sum("record_count").alias("records"), (F.max("record_count") <= 100).alias("bounded")
    )


@query
def envelopes_by_bytes(spark, sf_dir):
    """Documents at one stamp, and equal large records at another, in envelopes bounded by bytes: sizes and their check."""
    most, day = 20_000, "2026-04-0{}T10:00:00+00:00"
    docs = derived.table(spark, sf_dir, "documents")
    whole = docs.select(F.lit(day.format(5)).alias("fetched_at"), "text")
    equal = docs.select(F.lit(day.format(6)), F.expr("repeat('same', 500)"))
    envelopes = build_envelopes(whole.union(equal), "documents", max_bytes=most)
    sizes = F.transform("data", lambda r: F.octet_length(F.to_json(r)))
    sized = envelopes.select("*", F.aggregate(sizes, F.lit(0), lambda a, b: a + b).alias("bytes"), F.array_max(sizes).alias("largest"))
    return sized.groupBy("fetched_at").agg(
        F.sum("record_count").alias("records"), F.max(F.col("bytes") < most + F.col("largest")).alias("bounded"),
        (F.count(F.lit(1)) <= 8 * F.sum("bytes") / most + 8).alias("filled"),
    )


# --- names -------------------------------------------------------------------------------------------


@query
def hero_names(spark, sf_dir):
    return lookup.hero_name(hero_win_rate(spark, sf_dir), derived.nation_names(spark, sf_dir))


@query
def all_hero_columns_named(spark, sf_dir):
    pairs = derived.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_suppkey").alias("hero_id"),
        F.col("l_partkey").alias("counter_hero_id"),
        F.when(F.col("l_returnflag") == "R", F.col("l_linenumber")).alias("synergy_hero_id"),
    )
    return lookup.name_all_heroes(pairs, derived.nation_names(spark, sf_dir))


@query
def names_or_not_found(spark, sf_dir):
    parts = derived.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    suppliers = derived.table(spark, sf_dir, "supplier")
    return lookup.name_or_not_found(parts, suppliers, "l_partkey", "s_suppkey", "s_name")


@query
def fixed_hero_names(spark, sf_dir):
    return lookup.hero_name(hero_win_rate(spark, sf_dir), hero_dimension(spark))


@query
def hero_picker(spark, sf_dir):
    return report.hero_picker(hero_win_rate(spark, sf_dir), derived.nation_names(spark, sf_dir))


# --- collections -------------------------------------------------------------------------------------


def _collections(spark: SparkSession, sf_dir: str) -> Collections:
    registry = (
        CollectionEntry("nation", "Geo"),
        CollectionEntry("region", "Geo"),
        CollectionEntry("supplier", "Trade"),
        CollectionEntry("part", "Trade"),
        CollectionEntry("lineitem", "Trade", requires_hero=True),
        CollectionEntry("missing", "Trade"),
    )
    tables = {e.name: f"{sf_dir}/{e.name}.parquet" for e in registry}
    return Collections(spark, tables=tables, registry=registry)


def _in_order(page: DataFrame) -> DataFrame:
    """A page, which a top-k leaves in one partition, with the place of each row in it."""
    return page.withColumn("position", F.monotonically_increasing_id())


@query
def top_heroes(spark, sf_dir):
    return _in_order(browse.top_rows(_stored_totals(spark, sf_dir), limit="25", tie_break=("hero_id",)).rows)


@query
def top_heroes_stored(spark, sf_dir):
    """The same from the collection that the refresh wrote."""
    target = scratch_path(spark, "collections")
    write_collection(hero_win_rate(spark, sf_dir), target, "hero_stats")
    return _in_order(browse.top_heroes(Collections(spark, target), "total_wins", "asc", "40", ("hero_id",)).rows)


@query
def top_heroes_meta(spark, sf_dir):
    top = browse.top_rows(_stored_totals(spark, sf_dir), "total_wins", "asc", "25", tie_break=("hero_id",))
    return top.meta


@query
def scoreboard(spark, sf_dir):
    totals = hero_win_rate(spark, sf_dir)
    return _in_order(browse.scoreboard(totals, "total_wins", 30, tie_break=("hero_id",)))


@query
def browse_page(spark, sf_dir):
    page = browse.browse(
        _collections(spark, sf_dir), "lineitem", "3", "200", "l_extendedprice", "desc", tie_break=LINE_KEYS
    )
    return _in_order(page.rows)


@query
def browse_deep_page(spark, sf_dir):
    """A page behind 49,800 rows, located by counting."""
    page = browse.browse(
        _collections(spark, sf_dir), "lineitem", 250, 200, "l_extendedprice", "asc", tie_break=LINE_KEYS, direct=5_000
    )
    return page.rows


def _nested_page(spark: SparkSession, sf_dir: str, value: Column, order: str) -> DataFrame:
    lines = derived.table(spark, sf_dir, "lineitem").withColumn("nested", value)
    tables = Collections(spark, tables={"lines": lines}, registry=(CollectionEntry("lines", "Trade"),))
    page = browse.browse(tables, "lines", 25, 200, "nested", order, tie_break=LINE_KEYS, direct=2_000)
    return _in_order(page.rows).drop("nested")


@query
def browse_struct_page(spark, sf_dir):
    """A page, located by counting, of rows sorted by a struct with nulls."""
    value = F.struct("l_returnflag", F.when(F.col("l_linenumber") > 1, F.col("l_shipdate")).alias("day"))
    return _nested_page(spark, sf_dir, value, "asc")


@query
def browse_array_page(spark, sf_dir):
    """A page, located by counting, of rows sorted by an array of one or two numbers."""
    discount = F.array("l_discount")
    value = F.when(F.col("l_linenumber") > 2, F.concat(discount, F.array("l_tax"))).otherwise(discount)
    return _nested_page(spark, sf_dir, value, "desc")


@query
def browse_all_pages(spark, sf_dir):
    """Rows that differ in a map only, in five located pages: each row is on one of them."""
    part = derived.table(spark, sf_dir, "part")
    rows = part.select(F.lit("hot").alias("kind"), F.create_map(F.lit("key"), F.col("p_partkey")).alias("detail"))
    keys = [paging.SortKey(F.col("kind")), paging.SortKey(paging.row_hash(rows))]
    size = part.count() // 5 + 1
    pages = [paging.page_rows(rows, keys, size * n, size, direct=10, tasks=8) for n in range(5)]
    return landing.union_snapshots(pages).groupBy(F.col("detail")["key"].alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("times"))


@query
def browse_hot_value_page(spark, sf_dir):
    """A deep page inside the rows of one frequent sort value."""
    page = browse.browse(
        _collections(spark, sf_dir),
        "lineitem",
        200,
        150,
        "l_returnflag",
        "desc",
        tie_break=(*LINE_KEYS, "l_extendedprice"),
        direct=2_000,
    )
    return page.rows


@query
def browse_meta(spark, sf_dir):
    return browse.browse(_collections(spark, sf_dir), "lineitem", "7", "0").meta


@query
def browse_past_end_meta(spark, sf_dir):
    return browse.browse(_collections(spark, sf_dir), "part", "100000", "500").meta


@query
def browse_hero_filter(spark, sf_dir):
    history = Collections(
        spark,
        tables={"match_history": derived.history_records(spark, sf_dir)},
        registry=(CollectionEntry("match_history", "Matches"),),
    )
    page = browse.browse(
        history, "match_history", 1, 200, "match_id", "asc", hero_id="7x", tie_break=("account_id", "line")
    )
    return page.rows


@query
def browse_gate(spark, sf_dir):
    """A collection that asks for a hero, with and without one, and one that is not listed: what each answers."""
    history = derived.history_records(spark, sf_dir)
    tables = {"match_history": history, "secret": history}
    known = Collections(spark, tables=tables, registry=(CollectionEntry("match_history", "Matches", requires_hero=True),))
    answers = []
    for name, hero in (("match_history", None), ("match_history", "x"), ("match_history", "7"), ("secret", "7")):
        try:
            rows = browse.browse(known, name, hero_id=hero, gate=True).meta.select(F.lit("shown").alias("answer"), "total")
        except ValueError as refusal:
            rows = history.agg(F.lit(type(refusal).__name__).alias("answer"), F.lit(None).cast("bigint").alias("total"))
        answers.append(rows.select(F.lit(name).alias("collection"), F.lit(hero or "").alias("hero"), "answer", "total"))
    return landing.union_snapshots(answers)


@query
def column_choices(spark, sf_dir):
    """The columns offered for sorting, with their labels and how many orders have a value there."""
    orders = derived.table(spark, sf_dir, "orders").withColumn("_id", F.col("o_orderkey").cast("string"))
    filled = orders.agg(*[F.count(c).alias(c) for c in orders.columns])
    choices = [F.struct(F.lit(label).alias("label"), F.col(name).alias("filled"), F.lit(name).alias("name"))
               for name, label in report.sort_choices(orders)]
    return filled.select(F.explode(F.array(*choices)).alias("c")).select("c.*")


@query
def browse_missing_column(spark, sf_dir):
    return browse.browse(_collections(spark, sf_dir), "part", hero_id="7", tie_break=("p_partkey",)).rows


@query
def browse_unknown_sort(spark, sf_dir):
    return browse.browse(_collections(spark, sf_dir), "part", 2, 30, "no_such_field", tie_break=("p_partkey",)).rows


@query
def search_page(spark, sf_dir):
    page = browse.browse(_collections(spark, sf_dir), "part", 2, 200, "p_partkey", "asc", tie_break=("p_partkey",))
    return filters.search(page.rows, "RED")


@query
def search_table(spark, sf_dir):
    return filters.search(derived.table(spark, sf_dir, "part"), "19")


@query
def search_documents(spark, sf_dir):
    return filters.search(derived.table(spark, sf_dir, "documents"), "data").select("doc_id", "lang", "n_chars")


def _indexed_search(spark: SparkSession, frame: DataFrame, text: str, nested: bool = False) -> DataFrame:
    """The frame stored in several files with a sidecar, and searched through it."""
    target = scratch_path(spark, "collections")
    write_collection(frame, target, "searched", options={"maxRecordsPerFile": "20000"})
    index_search(spark, target, "searched", nested)
    return search_collection(spark, target, "searched", text, nested)


@query
def search_indexed(spark, sf_dir):
    return _indexed_search(spark, derived.table(spark, sf_dir, "part"), "199")


@query
def search_indexed_documents(spark, sf_dir):
    found = _indexed_search(spark, derived.table(spark, sf_dir, "documents"), "Data")
    return found.select("doc_id", "lang", "n_chars")


@query
def search_indexed_nested(spark, sf_dir):
    found = _indexed_search(spark, derived.event_records(spark, sf_dir), '"k":12', nested=True)
    return found.select("event_id", F.col("props.k").alias("k"))


@query
def list_collections(spark, sf_dir):
    return browse.list_collections(_collections(spark, sf_dir))


@query
def collections_nav(spark, sf_dir):
    return browse.collections_nav(browse.list_collections(_collections(spark, sf_dir)))


# --- display -----------------------------------------------------------------------------------------


@query
def report_view(spark, sf_dir):
    totals = _stored_totals(spark, sf_dir).withColumn(
        "detail", F.struct("total_wins", F.repeat(F.lit("x"), F.col("total_losses").cast("int") % 70).alias("note"))
    )
    heroes = Collections(
        spark, tables={"hero_stats": totals}, registry=(CollectionEntry("hero_stats", "Heroes"),)
    )
    page = report.report_view(
        heroes,
        derived.nation_names(spark, sf_dir),
        "hero_stats",
        sort="total_matches",
        limit=200,
        tie_break=("hero_id",),
    )
    return page.rows


@query
def report_of_odd_names(spark, sf_dir):
    """A searched page of a stored table whose column names the library also uses itself."""
    totals = hero_win_rate(spark, sf_dir)
    named = {c: F.concat(F.lit(f"{c} "), F.col("hero_id")) for c in ("_id", "_name", "_hash", "_file", "_row", "_salt")}
    rows = totals.select("hero_id", "total_wins", F.col("total_losses").alias("wins")).withColumns(named)
    target = scratch_path(spark, "collections")
    write_collection(rows, target, "hero_stats")
    page = report.report_view(
        Collections(spark, target), derived.nation_names(spark, sf_dir), "hero_stats", "1", sort="total_wins", limit=200,
        tie_break=("hero_id",))
    return page.rows


@query
def win_rate_band(spark, sf_dir):
    return report.with_band(hero_win_rate(spark, sf_dir))


@query
def display_numbers(spark, sf_dir):
    """Numbers of every order as text, and nested values as clipped JSON."""
    orders = derived.table(spark, sf_dir, "orders")
    price = orders.schema["o_totalprice"].dataType
    key = orders.schema["o_orderkey"].dataType
    return orders.select(
        "o_orderkey",
        cell("o_custkey", key, F.col("o_custkey")).alias("custkey"),
        grouped_number(F.col("o_totalprice"), price).alias("price"),
        plain_number(F.col("o_totalprice"), price).alias("plain"),
        short_count(F.floor(F.col("o_totalprice")) * 7).alias("short"),
        title_words(F.lower(F.regexp_replace("o_orderpriority", "[ -]", "_"))).alias("title"),
        clipped_json(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority"), 60).alias("nested"),
    )


# --- jobs --------------------------------------------------------------------------------------------


def _together(*tasks: Callable[[], None]) -> None:
    """Independent writes that share the cluster, so that none leaves it idle while its last tasks and renames run."""
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        for done in [pool.submit(task) for task in tasks]:
            done.result()


def _land_all(spark: SparkSession, sf_dir: str) -> str:
    """Four endpoints, landed compressed: as plain text the records are several times the tables that they come from."""
    root = scratch_path(spark, "landing")
    history = derived.history_records(spark, sf_dir).withColumn("fetched_at", F.lit("2026-04-05T10:00:00+00:00"))
    land = functools.partial(land_records, root=root, compression="snappy")
    _together(
        lambda: land(derived.hero_snapshots(spark, sf_dir), endpoint="hero_stats"),
        lambda: land(derived.item_snapshots(spark, sf_dir), endpoint="item_stats"),
        lambda: land(derived.event_records(spark, sf_dir), endpoint="badge_distribution"),
        lambda: land(history, endpoint="match_history", max_records=20_000),
    )
    return root


REFRESHED = {
    "hero_stats": "hero",
    "item_stats": "item",
    "badge_distribution": "generic",
    "bulk_metadata": "shallow",
    "match_history": "shallow",
}


@query
def run_report(spark, sf_dir):
    """All endpoints from landed files to collections; one of them was never landed."""
    root = _land_all(spark, sf_dir)
    for endpoint, text in (
        ("badge_distribution", '{"fetched_at": "2026-04-05T10:00:00Z", "data": [{'),
        ("hero_stats", '{"fetched_at": "1990-01-01T00:00:00.000Z", "data": [{"hero_id": 1, "wins": "many", "matches": 0}]}'),
        ("leaderboards", '{"fetched_at": "2026-04-05T10:00:00Z", "note": "nothing yet"}'),
    ):  # a cut file, a counter that is no number, and an envelope without records
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(f"{root}/raw/{endpoint}/odd")
    target = scratch_path(spark, "collections")
    done = refresh.refresh_collections(spark, root, target, {**REFRESHED, "leaderboards": "generic"})
    return done.select("endpoint", "mode", "status", "rows", "rejected", "corrupt")


@query
def run_report_tallies(spark, sf_dir):
    root = _land_all(spark, sf_dir)
    target = scratch_path(spark, "collections")
    return refresh.report_tallies(refresh.refresh_collections(spark, root, target, REFRESHED))


@query
def refreshed_history(spark, sf_dir):
    """The collection that the processing job wrote."""
    root = _land_all(spark, sf_dir)
    target = scratch_path(spark, "collections")
    refresh.refresh_endpoint(spark, root, target, "match_history", "shallow")
    return read_collection(spark, target, "match_history")


def _refreshed_twice(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """A landing that is refreshed, gets more files, one of them with a new field, and is refreshed again."""
    root, target, state = (scratch_path(spark, label) for label in ("landing", "collections", "state"))
    names = {"hero_stats": "hero", "badge_distribution": "generic", "match_history": "shallow"}
    heroes, events = derived.hero_snapshots(spark, sf_dir), derived.event_records(spark, sf_dir)
    history = derived.history_records(spark, sf_dir)
    reports = []
    for run, day in enumerate(("2026-04-05", "2026-04-06")):
        months = heroes.where(F.substring("fetched_at", 6, 2).cast("int") % 2 == run)
        some = history.where(F.col("line") % 2 == run).withColumn("fetched_at", F.lit(f"{day}T10:00:00+00:00"))
        kept = events.where(F.col("event_id") % 2 == run).withColumn("fetched_at", F.lit(f"{day}T10:00:00+00:00"))
        kept = kept.drop("value") if run == 0 else kept
        _together(
            functools.partial(land_records, months, root, "hero_stats"),
            functools.partial(land_records, some, root, "match_history", max_records=10_000_000),
            functools.partial(land_records, kept, root, "badge_distribution", max_records=10_000_000),
        )
        done = continued.continue_collections(spark, root, target, state, names)
        reports.append(done.select(F.lit(run).alias("run"), "endpoint", "status", "how", "envelopes", "rows"))
    return landing.union_snapshots(reports), target


@query
def refreshed_twice(spark, sf_dir):
    """What two runs report: the second reads new files only, but all of the endpoint that got a new field."""
    return _refreshed_twice(spark, sf_dir)[0]


@query
def refreshed_twice_heroes(spark, sf_dir):
    return read_collection(spark, _refreshed_twice(spark, sf_dir)[1], "hero_stats")


@query
def refreshed_twice_events(spark, sf_dir):
    return read_collection(spark, _refreshed_twice(spark, sf_dir)[1], "badge_distribution")


def _refreshed_variants(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """A refresh through variants; the values of errors are text, later files have a further field."""
    root, target, bronze = (scratch_path(spark, label) for label in ("landing", "collections", "bronze"))
    events, failed = derived.event_records(spark, sf_dir), F.col("event_type") == "error"
    stamp = F.lit("2026-04-0{}T10:00:00+00:00")
    numbers = events.where(~failed).withColumn("fetched_at", F.replace(stamp, F.lit("{}"), F.lit("5")))
    texts = events.where(failed).withColumns({
        "fetched_at": F.replace(stamp, F.lit("{}"), F.lit("6")), "value": F.concat(F.lit("none for "), "event_id"), "late": F.col("event_id") % 3})
    for part in (numbers.withColumn("value", F.col("event_id") % 100), texts):
        land_records(part, root, "badge_distribution", max_records=100_000)
    land_records(derived.history_records(spark, sf_dir).withColumn("fetched_at", F.lit("2026-04-05T10:00:00+00:00")), root, "match_history")
    names = {"badge_distribution": "generic", "match_history": "shallow", "player_scoreboards": "shallow"}
    report = refresh.refresh_collections(spark, root, target, names, bronze=bronze)
    return report.select("endpoint", "mode", "status", "rows", "message", "rejected", "corrupt"), target


@query
def refreshed_variants(spark, sf_dir):
    return _refreshed_variants(spark, sf_dir)[0]


@query
def refreshed_variants_drift(spark, sf_dir):
    """Numbers and text of one field, all kept."""
    return read_collection(spark, _refreshed_variants(spark, sf_dir)[1], "badge_distribution")


def _months(spark: SparkSession, sf_dir: str, condition: str) -> DataFrame:
    """Hero envelopes of the months for which ``condition`` holds of year ``y`` and month ``m``."""
    envelopes = derived.hero_envelopes(spark, sf_dir)
    year, month = F.substring("fetched_at", 1, 4).cast("int").alias("y"), F.substring("fetched_at", 6, 2).cast("int").alias("m")
    return envelopes.select("*", year, month).where(condition).drop("y", "m")


def _one_file_each(frame: DataFrame, path: str, mode: str = "append") -> None:
    frame.write.mode(mode).option("partitionOverwriteMode", "static").option("maxRecordsPerFile", 1).json(path)


def _refreshed_backfill(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Years refreshed newest first, so that each run finds older files only; the oldest ones bring a new field."""
    root, target, state = (scratch_path(spark, label) for label in ("landing", "collections", "state"))
    names = {"hero_stats": "hero", "badge_distribution": "generic"}
    events, reports = derived.event_records(spark, sf_dir), []
    for run, (years, kept) in enumerate((("y >= 1997", "event_id % 3 = 2"), ("y in (1995, 1996)", "event_id % 3 = 1"), ("y < 1995", "event_id % 3 = 0"))):
        _one_file_each(_months(spark, sf_dir, years), f"{root}/raw/hero_stats/run{run}")
        some = events.where(kept).withColumn("fetched_at", F.lit(f"200{9 - run}-04-05T10:00:00+00:00"))
        land_records(some if run == 2 else some.drop("value"), root, "badge_distribution", max_records=10_000_000)
        done = continued.continue_collections(spark, root, target, state, names)
        reports.append(done.select(F.lit(run).alias("run"), "endpoint", "status", "how", "envelopes", "rows", "replaced", "removed"))
    return landing.union_snapshots(reports), target


@query
def refreshed_backfill(spark, sf_dir):
    """What three runs report that each find older files, the last of them with a new field."""
    return _refreshed_backfill(spark, sf_dir)[0]


@query
def refreshed_backfill_heroes(spark, sf_dir):
    return read_collection(spark, _refreshed_backfill(spark, sf_dir)[1], "hero_stats")


@query
def refreshed_backfill_events(spark, sf_dir):
    return read_collection(spark, _refreshed_backfill(spark, sf_dir)[1], "badge_distribution")


def _refreshed_replaced(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Files that are replaced under their own names, or removed, between two runs."""
    root, target, state = (scratch_path(spark, label) for label in ("landing", "collections", "state"))
    names = {"hero_stats": "hero", "match_history": "shallow"}
    history = derived.history_records(spark, sf_dir).withColumn("fetched_at", F.lit("2026-04-05T10:00:00+00:00"))
    reports = []
    for run in range(3):
        if run == 0:
            later = history.where("line % 2 = 1").withColumn("fetched_at", F.lit("2026-04-06T10:00:00+00:00"))
            _together(
                lambda: _one_file_each(_months(spark, sf_dir, "m <= 6"), f"{root}/raw/hero_stats/first"),
                lambda: _one_file_each(_months(spark, sf_dir, "m > 6 and y >= 1995"), f"{root}/raw/hero_stats/second"),
                lambda: land_records(history.where("line % 2 = 0"), root, "match_history", max_records=10_000_000),
                lambda later=later: land_records(later, root, "match_history", max_records=10_000_000),
            )
        elif run == 1:  # every file of the second folder goes, others come; one stamp's file is replaced
            _together(
                lambda: _one_file_each(_months(spark, sf_dir, "m = 7"), f"{root}/raw/hero_stats/second", "overwrite"),
                lambda: land_records(history.where("line % 4 = 2"), root, "match_history", max_records=10_000_000),
            )
        done = continued.continue_collections(spark, root, target, state, names)
        reports.append(done.select(F.lit(run).alias("run"), "endpoint", "status", "how", "rows"))
    return landing.union_snapshots(reports), target


@query
def refreshed_replaced(spark, sf_dir):
    """What runs report between which files were replaced and removed; the last one finds nothing new."""
    return _refreshed_replaced(spark, sf_dir)[0]


@query
def refreshed_replaced_heroes(spark, sf_dir):
    return read_collection(spark, _refreshed_replaced(spark, sf_dir)[1], "hero_stats")


@query
def refreshed_replaced_history(spark, sf_dir):
    return read_collection(spark, _refreshed_replaced(spark, sf_dir)[1], "match_history")


def _published(spark: SparkSession, sf_dir: str) -> Collections:
    """Collections as the library publishes them, orders in files by range of their key."""
    target = scratch_path(spark, "collections")
    names = ("nation", "supplier", "orders", "events")
    for name in names:
        frame = derived.table(spark, sf_dir, name)
        if name == "orders":
            frame = frame.repartitionByRange(16, "o_orderkey").sortWithinPartitions("o_orderkey")
        write_collection(frame, target, name)
    return Collections(spark, target, registry=tuple(CollectionEntry(n, "Published") for n in (*names, "missing")))


@query
def list_published(spark, sf_dir):
    """Row counts that the writes left behind: no table is opened."""
    return browse.list_collections(_published(spark, sf_dir))


@query
def browse_published_pages(spark, sf_dir):
    """Unsorted pages, looked up in the index of files: near the top, deep inside, the last and one past the end."""
    tables, pages = _published(spark, sf_dir), []
    for number in (1, 7, 70, 75, 76, 10_000_000):
        page = browse.browse(tables, "orders", number, 200)
        rows = _in_order(page.rows).select("position", "o_orderkey", "o_custkey", "o_totalprice")
        pages.append(rows.join(page.meta.select("page", "total", "pages"), how="cross"))  # one row
    return landing.union_snapshots(pages)


@query
def streamed_win_rate(spark, sf_dir):
    root, target = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    land_records(derived.hero_snapshots(spark, sf_dir), root, "hero_stats")
    stream_win_rate(
        spark, root, "hero_stats", "hero_id", target, scratch_path(spark, "checkpoint")
    ).awaitTermination()
    return spark.read.parquet(target)


@query
def streamed_win_rate_legacy(spark, sf_dir):
    """The stream over envelopes of which some have the old payload column, and one an unreadable stamp."""
    root, target = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    envelopes = derived.mixed_hero_envelopes(spark, sf_dir)
    last = envelopes.agg(F.min("fetched_at").alias("m")).scalar()
    stamp = F.when(F.col("fetched_at") == last, F.lit("some time ago")).otherwise(F.col("fetched_at"))
    envelopes.withColumn("fetched_at", stamp).write.option("maxRecordsPerFile", 1).json(f"{root}/raw/hero_stats")
    stream_win_rate(
        spark, root, "hero_stats", "hero_id", target, scratch_path(spark, "checkpoint"), legacy="per_row", stamps="lenient"
    ).awaitTermination()
    return spark.read.parquet(target)


@query
def streamed_flatten(spark, sf_dir):
    root, target = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    records = derived.event_records(spark, sf_dir)
    land_records(records, root, "badge_distribution")
    record = records.drop("fetched_at").schema
    stream_records(
        spark, root, "badge_distribution", record, target, scratch_path(spark, "checkpoint")
    ).awaitTermination()
    return spark.read.parquet(target)
