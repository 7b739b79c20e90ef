import json
import os
import re
import threading

import pytest
from pyspark.sql import functions as F

from frames import physical_plan, values
from snapstats.operators import aggregate, shape
from snapstats.plans import catalogue
from snapstats.schemas import HISTORY_RECORD, counter_record, envelope_schema
from snapstats.session import RELEASE_SHUFFLES, shuffles_released
from snapstats.sinks import landing as sink
from snapstats.sources import landing
from snapstats.sources.tuple_csv import read_tuple_csv

STAMP = "2026-04-05T10:00:00+00:00"


def put(root, endpoint, path, content):
    target = root / "raw" / endpoint / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(content if isinstance(content, str) else json.dumps(content, indent=1))


def envelope(data, stamp=STAMP):
    return {"fetched_at": stamp, "endpoint": "e", "record_count": len(data or []), "data": data}


def test_scan_reads_all_dates_and_batches(spark, tmp_path):
    put(tmp_path, "e", "2026/04/05/100000_batch1.json", envelope([{"a": 1}]))
    put(tmp_path, "e", "2026/04/05/100000_batch2.json", envelope([{"a": 2}, {"a": 3, "b": "x"}]))
    put(tmp_path, "e", "2026/04/06/100000.json", envelope([{"a": 4}]))
    frame = landing.read_endpoint(spark, str(tmp_path), "e")
    assert frame.count() == 3
    assert values(shape.generic(frame), "a", "b") == [(1, None), (2, None), (3, "x"), (4, None)]


def test_absent_empty_and_broken_folders(spark, tmp_path):
    assert landing.scan_endpoint(spark, str(tmp_path), "nowhere").status == "SKIP"
    (tmp_path / "raw" / "empty").mkdir(parents=True)
    assert landing.read_endpoint(spark, str(tmp_path), "empty") is None
    declared = envelope_schema(counter_record("hero_id"))
    assert landing.read_endpoint(spark, str(tmp_path), "empty", schema=declared) is None
    put(tmp_path, "broken", "a.json", '{"fetched_at": "x", "data": [{"a"')
    put(tmp_path, "broken", "b.json", envelope([{"a": 1}]))
    assert values(shape.shallow(landing.read_endpoint(spark, str(tmp_path), "broken")), "a") == [(1,)]


def test_types_drift_to_text(spark, tmp_path):
    for n, value in enumerate([1, 1.5, "s", None]):
        put(tmp_path, "e", f"{n}.json", envelope([{"v": value}]))
    frame = landing.read_endpoint(spark, str(tmp_path), "e")
    assert values(shape.generic(frame), "v") == [("1",), ("1.5",), ("s",), (None,)]


def test_declared_counters_survive_drift(spark, tmp_path):
    rows = [{"hero_id": 1, "wins": 2, "losses": 1, "matches": 3}, {"hero_id": "1", "wins": "4", "losses": [1], "matches": 5.0}]
    put(tmp_path, "e", "a.json", envelope(rows))
    frame = landing.read_endpoint(spark, str(tmp_path), "e", schema=envelope_schema(counter_record("hero_id")))
    rate = aggregate.win_rate(aggregate.counter_records(frame, "hero_id"), "hero_id")
    assert values(rate) == [(1, 6, 1, 8, STAMP, 0.75)]
    assert rate.schema["hero_id"].dataType.simpleString() == "bigint"


def test_round_trip_through_files(spark, tmp_path):
    records = spark.range(25).select(
        F.lit(STAMP).alias("fetched_at"),
        (F.col("id") % 3).alias("hero_id"),
        F.lit(2).alias("wins"),
        F.lit(None).cast("int").alias("gap"),
        F.struct(F.to_date(F.lit("2026-01-02")).alias("day")).alias("nested"),
        F.expr("timestamp_ntz'2026-01-02 03:04:05.5'").alias("at"),
        F.lit("1.50").cast("decimal(5,2)").alias("price"),
    )
    sink.land_records(records, str(tmp_path), "e")
    files = [f for _, _, names in os.walk(tmp_path) for f in names if f.endswith(".json")]
    assert len(files) == 1
    back = landing.read_endpoint(spark, str(tmp_path), "e")
    head = back.select("fetched_at", "endpoint", "record_count").collect()
    assert [tuple(r) for r in head] == [(STAMP, "e", 25)]
    row = shape.shallow(back).collect()[0]
    assert row["nested"]["day"] == "2026-01-02" and row["gap"] is None
    assert row["at"] == "2026-01-02 03:04:05.500000" and row["price"] == "1.50"


def test_large_snapshots_are_split(spark, tmp_path):
    records = spark.range(1000).select(F.lit(STAMP).alias("fetched_at"), F.lit(1).alias("same"))
    small = spark.range(3).select(F.lit("2026-04-06T10:00:00+00:00").alias("fetched_at"), F.lit(1).alias("same"))
    envelopes = sink.build_envelopes(records.union(small), "e", max_records=64)
    sizes = [r["record_count"] for r in envelopes.where(F.col("fetched_at") == STAMP).collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 64
    sink.write_envelopes(envelopes, str(tmp_path), "e")
    back = landing.read_endpoint(spark, str(tmp_path), "e")
    assert back.count() == len(sizes) + 1
    assert shape.shallow(back).count() == 1003


def test_envelopes_are_bounded_by_bytes(spark):
    same = spark.range(400).select(F.lit(STAMP).alias("fetched_at"), F.lit("x" * 1000).alias("v"), F.lit(None).cast("int").alias("_key"))
    mixed = spark.range(300).select(F.lit(None).cast("string"), F.repeat(F.lit("y"), (F.col("id") * 7 % 900).cast("int")), F.lit(1))
    one = spark.range(1).select(F.lit("2026-04-06T10:00:00+00:00"), F.repeat(F.lit("z"), F.lit(50_000)), F.lit(2))
    records = same.union(mixed).union(one)
    envelopes = sink.build_envelopes(records, "e", max_records=30, max_bytes=20_000)
    assert physical_plan(envelopes).count("Exchange hashpartitioning(fetched_at") == 1
    seen = [(r["fetched_at"], [x["v"] for x in r["data"]]) for r in envelopes.collect()]
    assert sorted((f or "", v) for f, vs in seen for v in vs) == sorted((f or "", v) for f, v, _ in values(records))
    for _, vs in seen:
        sizes = [len(v) + 20 for v in vs]
        assert len(vs) <= 30 and sum(sizes) < 20_000 + max(sizes)
    parts = [len(vs) for f, vs in seen if f == STAMP]
    assert len(parts) >= 20 and max(parts) <= 20  # equal records too


def test_same_stamp_replaces(spark, tmp_path):
    def land(n):
        records = spark.range(n).select(F.lit(STAMP).alias("fetched_at"), F.col("id").alias("v"))
        sink.land_records(records, str(tmp_path), "e", max_records=10)

    land(30)
    other = spark.range(1).select(F.lit("2026-04-05T11:00:00+00:00").alias("fetched_at"), F.lit(-1).alias("v"))
    sink.land_records(other, str(tmp_path), "e")
    land(2)
    assert values(shape.shallow(landing.read_endpoint(spark, str(tmp_path), "e")), "v") == [(-1,), (0,), (1,)]


def test_envelopes_land_at_their_dated_paths(spark, tmp_path):
    def land(n, suffix, most=10):
        records = spark.range(n).select(F.lit(STAMP).alias("fetched_at"), F.col("id").alias("v"), F.lit(suffix).alias("s"))
        sink.land_records(records, str(tmp_path), "e", suffix="s", max_records=most)

    folder = tmp_path / "raw" / "e"
    names = lambda: sorted(str(p.relative_to(folder)) for p in folder.rglob("*.json") if not p.name.startswith("."))
    day = STAMP[:10].replace("-", "/")
    clock = STAMP[11:19].replace(":", "")
    land(25, "")
    parts = names()
    assert parts[0] == f"{day}/{clock}.json" and len(parts) >= 3
    assert set(parts[1:]) == {f"{day}/{clock}_part{n}.json" for n in range(2, len(parts) + 1)}
    land(3, "_batch1")
    land(2, "")
    assert names() == [f"{day}/{clock}.json", f"{day}/{clock}_batch1.json"]
    odd = spark.createDataFrame([("yesterday / noon", 1), (None, 2)], "fetched_at string, v int")
    sink.land_records(odd, str(tmp_path), "e")
    assert len(names()) == 4 and sum(n.startswith("undated/") for n in names()) == 2
    assert not [p for p in folder.iterdir() if p.name.startswith("_")]
    assert values(shape.shallow(landing.read_endpoint(spark, str(tmp_path), "e")), "v") == [(0,), (0,), (1,), (1,), (1,), (2,), (2,)]


def test_no_records_write_no_file(spark, tmp_path):
    records = spark.range(0).select(F.lit(STAMP).alias("fetched_at"), F.col("id").alias("v"))
    sink.land_records(records, str(tmp_path), "e")
    assert landing.read_endpoint(spark, str(tmp_path), "e") is None


def test_bronze_prunes_and_reads_few_columns(spark, tmp_path):
    record = "struct<hero_id:bigint, wins:bigint, losses:bigint, matches:bigint, extra:string>"
    rows = [(f"2026-04-0{d}T00:00:00+00:00", [(1, 1, 1, 2, "x"), (2, 0, 3, 3, "y")]) for d in range(1, 6)]
    envelopes = spark.createDataFrame(rows, f"fetched_at string, data array<{record}>")
    path = str(tmp_path / "bronze")
    landing.land_bronze(envelopes, path, "hero_stats")
    other = spark.createDataFrame([("2026-04-02T00:00:00+00:00", [(1,)])], "fetched_at string, data array<struct<x:int>>")
    landing.land_bronze(other, path, "other")
    frame = landing.read_bronze(spark, path, "hero_stats", "2026-04-02", "2026-04-03")
    rate = aggregate.win_rate(frame, "hero_id")
    assert values(rate) == [
        (1, 2, 2, 4, "2026-04-03T00:00:00+00:00", 0.5),
        (2, 0, 6, 6, "2026-04-03T00:00:00+00:00", 0.0),
    ]
    plan = rate._jdf.queryExecution().executedPlan().toString()
    assert "extra" not in plan and "PartitionFilters: [isnotnull(fetch_date" in plan


def test_bronze_equals_json_and_refreshes_dates(spark, tmp_path):
    record = "struct<hero_id:bigint, wins:bigint, losses:bigint, matches:bigint>"

    def day(d, wins):
        return spark.createDataFrame([(f"2026-04-0{d}T00:00:00+00:00", [(1, wins, 0, wins)])], f"fetched_at string, data array<{record}>")

    path = str(tmp_path / "bronze")
    landing.land_bronze(day(1, 5), path, "hero_stats")
    landing.land_bronze(day(2, 6), path, "hero_stats")
    landing.land_bronze(day(2, 7), path, "hero_stats")
    assert aggregate.win_rate(landing.read_bronze(spark, path, "hero_stats"), "hero_id").collect()[0]["total_wins"] == 12


def test_bronze_keeps_fields_of_all_dates(spark, tmp_path):
    path = str(tmp_path / "bronze")
    for day, record, row in ((1, "struct<a:int>", (1,)), (2, "struct<a:int, b:string>", (2, "x"))):
        frame = spark.createDataFrame([(f"2026-04-0{day}T00:00:00+00:00", [row])], f"fetched_at string, data array<{record}>")
        landing.land_bronze(frame, path, "e")
    assert values(landing.read_bronze(spark, path, "e"), "a", "b") == [(1, None), (2, "x")]


def test_union_of_differing_snapshots(spark):
    one = spark.createDataFrame([(1, "a")], "id int, x string")
    two = spark.createDataFrame([(2, 5)], "id int, y int")
    assert values(landing.union_snapshots([one, two, one])) == [(1, "a", None), (1, "a", None), (2, None, 5)]


def test_envelope_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text("\n".join(json.dumps(envelope([{"match_id": n}])) for n in range(3)))
    frame = landing.read_envelope_lines(spark, str(tmp_path), envelope_schema(HISTORY_RECORD))
    assert values(shape.shallow(frame), "match_id") == [(0,), (1,), (2,)]


def test_tuple_csv(spark, tmp_path):
    lines = [
        "\"('wins', 22446392790)\",\"('hero_id', 3)\",,Vindicta",
        "\"('hero_id', 4)\",\"('wins', -1)\",,",
        ",,,ID Not Found",
    ]
    (tmp_path / "sheet.csv").write_text("\n".join(lines))
    out = read_tuple_csv(spark, str(tmp_path), ("hero_id", "wins"))
    assert values(out) == [(3, 22446392790, "Vindicta"), (4, -1, "ID Not Found")]


def test_supplied_schema_or_inferred(spark, tmp_path):
    put(tmp_path, "e", "a.json", envelope([{"match_id": 1, "other": 2}]))
    inferred = landing.read_endpoint(spark, str(tmp_path), "e")
    assert set(shape.shallow(inferred).columns) == {"fetched_at", "match_id", "other"}
    declared = landing.read_endpoint(spark, str(tmp_path), "e", schema=envelope_schema(HISTORY_RECORD))
    assert values(shape.shallow(declared)) == [(STAMP, None, 1, None)]


def test_a_day_is_listed_once_for_all_its_envelopes(spark, tmp_path, monkeypatch):
    def land(n):
        records = spark.range(n).select(F.lit(STAMP).alias("fetched_at"), F.col("id").alias("v"), F.concat(F.lit("_batch"), F.col("id") % 20).alias("s"))
        sink.land_records(records, str(tmp_path), "e", suffix="s", max_records=10)

    land(400)
    before = tmp_path / "raw" / "e" / f"fetch_date={STAMP[:10]}" / "file=100000_batch3"
    before.mkdir(parents=True)
    (before / "part-0.json").write_text(json.dumps(envelope([{"v": -1}])))  # the older layout
    listed, real = [], sink.file_names
    monkeypatch.setattr(sink, "file_names", lambda s, *parts: listed.append(parts[-1]) or real(s, *parts))
    land(100)
    assert listed.count(STAMP[:10].replace("-", "/")) == 1
    assert sorted(values(shape.shallow(landing.read_endpoint(spark, str(tmp_path), "e")), "v")) == [(n,) for n in range(100)]
    assert not before.exists()


def test_wider_tables_land_in_more_tasks_of_one_size(spark, monkeypatch):
    monkeypatch.setattr(sink, "TASK_BYTES", 10_000)
    records = spark.range(20_000).select((F.col("id") % 40).cast("string").alias("fetched_at"), F.col("id").alias("v"))
    for most in (100, 50_000):  # stamps of many envelopes, and of one
        plan = physical_plan(sink.build_envelopes(records, "e", max_records=most))
        width, below = re.search(r"Exchange hashpartitioning\(fetched_at[^)]*, (\d+)\)(.*)", plan, re.DOTALL).groups()
        assert int(width) >= 20_000 * 8 // 10_000 and plan.count("Exchange hashpartitioning(fetched_at") == 1
        assert "Sort" not in below  # whole input partitions are not sorted


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")}


def test_landing_leaves_no_shuffle_files(spark, tmp_path):
    counted = spark.range(2_000).groupBy((F.col("id") % 500).alias("v")).count()  # an input with a shuffle of its own
    for most in (50, 50_000):  # a stamp of many envelopes, and of one
        before = shuffle_files(spark)
        sink.land_records(counted.withColumn("fetched_at", F.lit(STAMP)), str(tmp_path), "e", max_records=most)
        assert not shuffle_files(spark) - before
        assert shape.shallow(landing.read_endpoint(spark, str(tmp_path), "e")).count() == 500


def test_the_session_keeps_its_own_setting_of_shuffle_files(spark):
    own, seen, inside, leave = spark.conf.get(RELEASE_SHUFFLES), [], threading.Event(), threading.Event()

    def longer():
        with shuffles_released(spark):
            inside.set()
            leave.wait(60)

    other = threading.Thread(target=longer)
    with shuffles_released(spark):
        other.start()
        assert inside.wait(60)
        seen.append(spark.conf.get(RELEASE_SHUFFLES))
    seen.append(spark.conf.get(RELEASE_SHUFFLES))  # the other thread is still inside
    leave.set()
    other.join()
    assert seen == ["true", "true"] and spark.conf.get(RELEASE_SHUFFLES) == own


def test_records_move_without_hashes_of_their_content(spark):
    records = spark.range(1000).select(F.lit(STAMP).alias("fetched_at"), F.col("id").alias("v"))

    def moved(plan):
        names = [plan.output().apply(n).name() for n in range(plan.output().size())]
        below = [moved(plan.children().apply(n)) for n in range(plan.children().size())]
        return [names] * (plan.nodeName() == "RepartitionByExpression") + sum(below, [])

    envelopes = sink.build_envelopes(records, "e", max_records=64)
    (names,) = moved(envelopes._jdf.queryExecution().optimizedPlan())
    assert "_record" in names and not {"_json", "_bytes", "_h1", "_h2"} & set(names)


def test_very_many_large_stamps_are_not_collected(spark, monkeypatch):
    records = spark.range(900).select((F.col("id") % 4).cast("string").alias("fetched_at"), F.col("id").alias("v"))
    few = spark.range(3).select(F.lit(None).cast("string").alias("fetched_at"), F.col("id").alias("v"))
    for most in (sink.BROADCAST_ROWS, 1):
        monkeypatch.setattr(sink, "BROADCAST_ROWS", most)
        seen = sink.build_envelopes(records.union(few), "e", max_records=40).collect()
        assert max(r["record_count"] for r in seen) <= 40
        found = sorted((r["fetched_at"] or "", x["v"]) for r in seen for x in r["data"])
        assert found == sorted((f or "", v) for f, v in values(records.union(few)))


@pytest.mark.parametrize("codec, ending", [("gzip", ".gz"), ("snappy", ".snappy")])
def test_compressed_envelopes_land_and_replace_plain_ones(spark, tmp_path, codec, ending):
    def land(n, compression):
        records = spark.range(n).select(F.lit(STAMP).alias("fetched_at"), F.col("id").alias("v"))
        sink.land_records(records, str(tmp_path), "e", max_records=10, compression=compression)

    folder = tmp_path / "raw" / "e" / STAMP[:10].replace("-", "/")
    names = lambda: sorted(p.name for p in folder.iterdir() if not p.name.startswith("."))
    clock = STAMP[11:19].replace(":", "")
    land(25, "none")
    land(35, codec)
    parts = names()
    assert len(parts) >= 4 and set(parts) == {f"{clock}.json{ending}", *(f"{clock}_part{n}.json{ending}" for n in range(2, len(parts) + 1))}
    for back in (landing.read_endpoint(spark, str(tmp_path), "e"), landing.read_endpoint(spark, str(tmp_path), "e", schema=envelope_schema(HISTORY_RECORD))):
        assert shape.shallow(back).count() == 35
    land(5, codec)
    assert names() == [f"{clock}.json{ending}"]
    land(3, "none")
    assert names() == [f"{clock}.json"]
    assert values(shape.shallow(landing.read_endpoint(spark, str(tmp_path), "e")), "v") == [(0,), (1,), (2,)]


def test_refreshed_history_takes_less_disk_than_plain_records(spark, sf_dir):
    root = catalogue._land_all(spark, sf_dir)
    held = lambda files: sum(os.path.getsize(f) for f in files)
    for endpoint in ("hero_stats", "item_stats", "badge_distribution", "match_history"):
        files = [os.path.join(d, f) for d, _, names in os.walk(f"{root}/raw/{endpoint}") for f in names if ".json" in f and not f.startswith(".")]
        back = landing.read_endpoint(spark, root, endpoint)
        plain = back.select(F.sum(F.octet_length(F.to_json(F.struct(*back.columns), {"ignoreNullFields": "false"})))).first()[0]
        assert back.select(F.sum("record_count")).first()[0] == shape.shallow(back).count() > 0
        assert held(files) < 0.9 * plain
