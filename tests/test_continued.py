"""The continued refresh against a full rescan, whatever happens to the landed files."""

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from frames import values
from snapstats.plans import continued, refresh
from snapstats.sinks import versions
from snapstats.sinks.tables import read_collection, write_collection

RNG = random.Random(7)


class Landing:
    def __init__(self, root, endpoint):
        self.folder = root / "raw" / endpoint
        self.clock = time.time() - 10_000

    def put(self, name, records, stamp="2026-04-05T10:00:00+00:00", age_days=0, payload="data"):
        path = self.folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps({"fetched_at": stamp, payload: records}))
        self.clock += 2
        os.utime(path, (self.clock - 86_400 * age_days,) * 2)

    def remove(self, name):
        (self.folder / name).unlink()


def heroes(n):
    keys = [None, 1, 2, 3, 4]
    return [{"hero_id": RNG.choice(keys), "wins": RNG.choice([None, 0, 3]), "losses": RNG.randint(0, 3), "matches": RNG.choice([None, 0, 2, 5])} for _ in range(n)]


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path), str(tmp_path / "out"), str(tmp_path / "state")]


def both(spark, places, endpoint, mode):
    """The continued collection and that of a full rescan."""
    row = continued.continue_endpoint(spark, *places, endpoint, mode)
    assert row[2] == "OK", row[6]
    plain = f"{places[0]}/plain"
    # the rescan prefers one payload column for a whole history, the continued one decides per envelope: tests use one
    assert refresh.refresh_endpoint(spark, places[0], plain, endpoint, mode)[2] == "OK"
    got, want = read_collection(spark, places[1], endpoint), read_collection(spark, plain, endpoint)
    assert sorted(got.columns) == sorted(want.columns)
    assert values(got, *sorted(got.columns)) == values(want, *sorted(want.columns))
    assert row[5] == got.count()
    return row


def test_counters_equal_a_rescan_whatever_happens_to_files(spark, tmp_path, places):
    land = Landing(tmp_path, "hero_stats")
    for i in range(4):
        land.put(f"2026/04/0{i + 1}/100000.json", heroes(6), f"2026-04-0{i + 1}T10:00:00+00:00")
    assert both(spark, places, "hero_stats", "hero")[3:5] == ("built", 4)
    land.put("2020/01/01/000000.json", heroes(5), "2020-01-01T00:00:00+00:00", age_days=900)  # a backfill of old files
    assert both(spark, places, "hero_stats", "hero")[3:5] == ("continued", 1)
    land.put("2026/04/04/100000.json", heroes(7), "2026-03-04T10:00:00+00:00")  # replaced by an older stamp
    land.put("2026/04/05/100000.json", heroes(3), "2026-04-05T10:00:00+00:00")
    row = both(spark, places, "hero_stats", "hero")
    assert row[3:5] == ("continued", 2) and row[8:10] == (1, 0)
    land.remove("2026/04/01/100000.json")
    assert both(spark, places, "hero_stats", "hero")[8:10] == (0, 1)
    assert both(spark, places, "hero_stats", "hero")[3:5] == ("continued", 0)


def test_partial_totals_are_written_together(spark, tmp_path, places, monkeypatch):
    monkeypatch.setattr(continued, "MAX_FOLDERS", 2)
    land = Landing(tmp_path, "item_stats")
    for i in range(5):
        land.put(f"{i}.json", [{**r, "item_id": r["hero_id"]} for r in heroes(4)], f"2026-04-0{i + 1}T10:00:00+00:00")
        if i == 3:
            land.put("1.json", [{"item_id": 9, "wins": 1, "losses": 1, "matches": 2}])
        both(spark, places, "item_stats", "item")
    assert len(versions.read_version(spark, f"{places[2]}/item_stats").note["partials"]) <= 2


def test_records_equal_a_rescan_and_old_files_bring_new_fields(spark, tmp_path, places):
    land = Landing(tmp_path, "builds")
    for i in range(3):
        land.put(f"a {i}.json", [{"id": i, "hero": {"n": i}}, {"id": i, "hero": {"n": i}}])
    assert both(spark, places, "builds", "generic")[3:5] == ("built", 3)
    land.put("old.json", [{"id": 7, "hero": {"n": 1, "more": "x"}}], age_days=400)
    assert both(spark, places, "builds", "generic")[3:5] == ("built", 4)
    assert "hero_more" in read_collection(spark, places[1], "builds").columns
    land.put("a 1.json", [{"id": 100, "hero": {"n": 5}}])
    land.put("b.json", [{"id": 101, "hero": None}])
    row = both(spark, places, "builds", "generic")
    assert row[3:5] == ("continued", 2) and row[8:10] == (1, 0)
    land.remove("b.json")
    land.remove("old.json")
    row = continued.continue_endpoint(spark, *places, "builds", "generic")
    assert row[2:4] == ("OK", "continued") and row[8:10] == (0, 2)
    assert values(read_collection(spark, places[1], "builds"), "id", "hero_n") == [(0, 0), (0, 0), (100, 5), (2, 2), (2, 2)]


def test_many_files_are_found_by_a_scan(spark, tmp_path, places, monkeypatch):
    monkeypatch.setattr(continued, "MAX_PATHS", 1)
    land = Landing(tmp_path, "match_history")
    for i in range(4):
        land.put(f"{i}.json", [{"match_id": i, "info": {"a": [i]}}])
        if i % 2:
            assert both(spark, places, "match_history", "shallow")[4] == 2


def test_unreadable_files_are_counted(spark, tmp_path, places):
    land = Landing(tmp_path, "hero_stats")
    land.put("a.json", heroes(3))
    land.put("b.json", [{"hero_id": 1, "wins": "many", "losses": 1, "matches": 1}])
    (land.folder / "c.json").write_text('{"fetched_at": "2026-04-05T10:00:00Z", "data": [{')
    row = continued.continue_endpoint(spark, *places, "hero_stats", "hero")
    assert row[2:5] == ("OK", "built", 3) and row[10:12] == (1, 1)


def test_a_run_that_fails_midway_leaves_the_old_table(spark, tmp_path, places, monkeypatch):
    land = Landing(tmp_path, "hero_stats")
    land.put("a.json", heroes(9))
    both(spark, places, "hero_stats", "hero")
    before = values(read_collection(spark, places[1], "hero_stats"))
    land.put("b.json", heroes(9), "yesterday")  # no stamp: the run fails while it writes
    assert continued.continue_endpoint(spark, *places, "hero_stats", "hero")[2] == "FAIL"
    assert values(read_collection(spark, places[1], "hero_stats")) == before
    land.put("b.json", heroes(9))
    real = versions.publish

    def torn(spark, place, version):
        if place.startswith(places[2]):
            raise OSError("lost")
        return real(spark, place, version)

    monkeypatch.setattr(continued, "publish", torn)  # the collection is published, its ledger is not
    assert continued.continue_endpoint(spark, *places, "hero_stats", "hero")[2] == "FAIL"
    monkeypatch.undo()
    assert both(spark, places, "hero_stats", "hero")[3:5] == ("continued", 1)
    for _ in range(2):  # a lost collection is built anew
        write_collection(spark.range(3), places[1], "hero_stats")
    assert both(spark, places, "hero_stats", "hero")[3:5] == ("built", 2)


def test_plain_writes_are_published_whole(spark, tmp_path):
    target = str(tmp_path)
    spark.range(4).write.parquet(f"{target}/c")  # a plain table of before
    assert write_collection(spark.range(5), target, "c") == 5
    assert read_collection(spark, target, "c").count() == 5 and not list((tmp_path / "c").glob("part-*"))
    open_reader = read_collection(spark, target, "c")
    with pytest.raises(Exception, match="broken"):
        write_collection(spark.range(9).withColumn("x", F.when(F.col("id") == 8, F.raise_error(F.lit("broken")))), target, "c")
    assert read_collection(spark, target, "c").count() == 5
    for n in (6, 7):
        assert open_reader.count() == 5 if n == 6 else True
        assert write_collection(spark.range(n), target, "c") == n
    assert read_collection(spark, target, "c").count() == 7
    assert len(list((tmp_path / "c").glob("data-*"))) == 2 and len(list((tmp_path / "c" / "_versions").glob("0*.json"))) == 2
    version = versions.read_version(spark, f"{target}/c")
    assert (version.number, version.rows) == (3, 7)
    assert write_collection(spark.range(2), target, "j", fmt="json") == 2
    assert read_collection(spark, target, "j", fmt="json").count() == 2
