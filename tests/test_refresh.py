
import pytest


from frames import values
from snapstats.fixed_values import ENDPOINT_MODES
from snapstats.plans import refresh
from snapstats.schemas import HISTORY_RECORD, envelope_schema
from snapstats.session import scratch_path
from snapstats.sinks.landing import land_records
from snapstats.sinks.tables import read_collection, write_collection
from snapstats.streaming import stream_records, stream_win_rate
from test_landing import envelope, put

S = ["2026-04-05T10:00:00+00:00", "2026-04-06T10:00:00+00:00", "2026-04-07T10:00:00.000001+00:00"]


def hero(i, wins, losses):
    return {"hero_id": i, "wins": wins, "losses": losses, "matches": wins + losses}


@pytest.fixture
def landed(tmp_path):
    put(tmp_path, "hero_stats", "2026/04/05/100000.json", {"fetched_at": S[0], "heroes": [hero(1, 9, 9)]})
    put(tmp_path, "hero_stats", "2026/04/06/100000.json", envelope([hero(1, 3, 1), hero(2, 0, 0)], S[1]))
    put(tmp_path, "hero_stats", "2026/04/07/100000.json", envelope([hero(1, 1, 3)], S[2]))
    put(tmp_path, "item_stats", "a.json", {"fetched_at": S[0], "other": 1})
    put(tmp_path, "search_builds", "a.json", envelope([{"hero": {"id": 1}, "x": 1}], S[0]))
    put(tmp_path, "match_history", "a_batch1.json", envelope([{"match_id": 1, "info": {"a": 1}}], S[0]))
    put(tmp_path, "match_history", "a_batch2.json", envelope([{"match_id": 1, "info": {"a": 1}}], S[0]))
    put(tmp_path, "badge_distribution", "a.json", envelope([1, 2], S[0]))
    put(tmp_path, "bulk_metadata", "a.json", {"fetched_at": S[0], "nothing": True})
    return tmp_path


def test_run(spark, landed):
    target = str(landed / "out")
    report = refresh.refresh_collections(spark, str(landed), target)
    rows = {r["endpoint"]: r for r in report.collect()}
    assert list(rows) == list(ENDPOINT_MODES)
    status = {e: (r["status"], r["rows"]) for e, r in rows.items() if r["status"] != "SKIP"}
    assert status == {
        "hero_stats": ("OK", 1), "search_builds": ("OK", 1), "match_history": ("OK", 2), "badge_distribution": ("FAIL", None),
    }
    assert "not an array of records" in rows["badge_distribution"]["message"]
    assert rows["item_stats"]["message"] == "no envelope has a payload"
    assert rows["kill_death_stats"]["message"] == "folder not found or empty"
    assert values(read_collection(spark, target, "hero_stats")) == [(1, 4, 4, 8, S[2], 0.5)]
    assert read_collection(spark, target, "search_builds").columns == ["fetched_at", "hero_id", "x"]
    assert read_collection(spark, target, "match_history").columns == ["fetched_at", "info", "match_id"]
    assert values(refresh.report_tallies(report)) == [("FAIL", 1, 0), ("OK", 3, 4), ("SKIP", 13, 0)]
    assert refresh.exit_code(report) == 1
    assert refresh.exit_code(report.where("status <> 'FAIL'")) == 0


def test_old_payload_only(spark, tmp_path):
    put(tmp_path, "hero_stats", "a.json", {"fetched_at": S[0], "heroes": [hero(1, 9, 1)]})
    row = refresh.refresh_endpoint(spark, str(tmp_path), str(tmp_path / "out"), "hero_stats", "hero")
    assert row[2:4] == ("OK", 1)


def test_unknown_mode_is_generic_and_schema_may_be_given(spark, landed):
    target = str(landed / "out")
    assert refresh.refresh_endpoint(spark, str(landed), target, "search_builds", "???")[2:4] == ("OK", 1)

    row = refresh.refresh_endpoint(spark, str(landed), target, "match_history", "shallow", envelope_schema(HISTORY_RECORD))
    assert row[2:4] == ("OK", 2)
    assert read_collection(spark, target, "match_history").columns == ["fetched_at", "account_id", "match_id", "hero_id"]


def test_foreign_stamps_fail_or_pass_as_text(spark, tmp_path):
    put(tmp_path, "hero_stats", "a.json", envelope([hero(1, 1, 1)], "5 April"))
    target = str(tmp_path / "out")
    assert refresh.refresh_endpoint(spark, str(tmp_path), target, "hero_stats", "hero")[2] == "FAIL"
    assert refresh.refresh_endpoint(spark, str(tmp_path), target, "hero_stats", "hero", stamps="text")[2] == "OK"


def test_empty_result_replaces(spark, tmp_path):
    assert write_collection(spark.range(5), str(tmp_path), "c") == 5
    assert write_collection(spark.range(0), str(tmp_path), "c") == 0
    assert read_collection(spark, str(tmp_path), "c").count() == 0


def test_write_to_other_sinks(spark, tmp_path):
    assert write_collection(spark.range(3), str(tmp_path), "c", fmt="json") == 3
    assert write_collection(spark.range(3), str(tmp_path), "c", fmt="noop") == 3


def land(spark, root, stamp, rows):
    records = spark.createDataFrame([(stamp, *r) for r in rows], "fetched_at string, hero_id bigint, wins bigint, losses bigint, matches bigint")
    land_records(records, root, "hero_stats")


def test_streamed_totals_equal_the_batch(spark, tmp_path):
    root, target, checkpoint = (str(tmp_path / n) for n in ("root", "target", "checkpoint"))
    batch = str(tmp_path / "batch")
    for stamp, rows in [(S[1], [(1, 3, 1, 4), (2, 0, 0, 0)]), (S[2], [(1, 1, 3, 4), (3, 2, 0, 2)]), (S[0], [(2, 1, 1, 2)])]:
        land(spark, root, stamp, rows)
        stream_win_rate(spark, root, "hero_stats", "hero_id", target, checkpoint).awaitTermination()
        refresh.refresh_endpoint(spark, root, batch, "hero_stats", "hero")
        assert values(spark.read.parquet(target)) == values(read_collection(spark, batch, "hero_stats"))


def test_streamed_records_append_once(spark, tmp_path):
    root, target, checkpoint = (str(tmp_path / n) for n in ("root", "target", "checkpoint"))
    record = spark.createDataFrame([], "hero_id bigint, wins bigint, losses bigint, matches bigint").schema
    for n, stamp in enumerate(S):
        land(spark, root, stamp, [(n, 1, 1, 2), (n, 1, 1, 2)])
        for mode in ("shallow", "generic"):
            stream_records(spark, root, "hero_stats", record, f"{target}-{mode}", f"{checkpoint}-{mode}", mode, 1).awaitTermination()
            assert spark.read.parquet(f"{target}-{mode}").count() == 2 * (n + 1)


def test_streamed_generic_flattens(spark, tmp_path):
    put(tmp_path, "e", "a.json", envelope([{"a": {"b": 1}, "c": 2}], S[0]))
    record = spark.createDataFrame([], "a struct<b:int>, c int").schema
    target = str(tmp_path / "t")
    stream_records(spark, str(tmp_path), "e", record, target, str(tmp_path / "c")).awaitTermination()
    assert values(spark.read.parquet(target)) == [(S[0], 1, 2)]


class Session:
    """A session as far as `scratch_path` looks at it."""

    def __init__(self, **conf):
        self.conf = self
        self.values = {k.replace("__", "."): v for k, v in conf.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_scratch_folder():
    shared = Session(spark__checkpoint__dir="hdfs://shared/", spark__master="yarn")
    assert scratch_path(shared, "x").startswith("hdfs://shared/x-")
    assert scratch_path(shared, "x") != scratch_path(shared, "x")
    assert "/x-" in scratch_path(Session(spark__master="local[2]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(spark__master="yarn"), "x")


def test_job_from_the_command_line(spark, landed, capsys, monkeypatch):
    from snapstats import refresh_job

    monkeypatch.setattr(refresh_job, "build_session", lambda name: spark)
    target = str(landed / "out")
    assert refresh_job.main([str(landed), target, "--endpoints", "hero_stats,unheard_of", "--parallel", "1"]) == 0
    shown = capsys.readouterr().out
    assert "hero_stats" in shown and "SKIP" in shown
    assert refresh_job.main([str(landed), target, "--endpoints", "badge_distribution"]) == 1
