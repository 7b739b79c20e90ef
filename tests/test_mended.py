"""Faults of the first round, each in its smallest form."""

from pyspark.sql import functions as F

from snapstats.functions.display import column_label, title_words
from snapstats.functions.parsing import leading_int_col
from snapstats.functions import stamps
from snapstats.operators import aggregate, lookup, paging
from snapstats.plans import browse, continued, refresh
from snapstats.sinks.tables import read_collection
from snapstats.sources.collections import CollectionEntry, Collections
from snapstats.sources.landing import union_snapshots
from frames import values


def test_rows_that_differ_in_a_map_only_are_all_paged(spark):
    frame = spark.range(600).select(F.lit(1).alias("k"), F.create_map(F.lit("n"), F.col("id")).alias("m"))
    keys = [paging.SortKey(F.col("k"), True), paging.SortKey(paging.row_hash(frame), True)]
    seen = []
    for page in range(6):
        rows = paging.page_rows(frame, keys, page * 100, 100, 50, 1)
        seen += [r["m"]["n"] for r in rows.collect()]
    assert sorted(seen) == list(range(600))


def test_lookup_keeps_columns_of_its_own_names(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("b", None, "y")], "_id string, hero_id long, _name string")
    heroes = spark.createDataFrame([(1, "Abel")], "hero_id long, hero_name string")
    out = lookup.hero_name(frame, heroes)
    assert out.columns == ["_id", "hero_id", "_name", "hero_name"]
    assert [r[:3] for r in values(out)] == [("a", 1, "x"), ("b", None, "y")]
    assert values(lookup.name_or_not_found(frame, heroes, "hero_id", "hero_id", "hero_name"), "_id", "hero_name")[0] == ("a", "Abel")


def test_types_that_differ_between_snapshots_become_text(spark):
    one = spark.createDataFrame([(1, 2)], "id long, n long")
    two = spark.createDataFrame([(2, "x")], "id long, n string")
    assert values(union_snapshots([one, two])) == [(1, "2"), (2, "x")]


def test_long_hex_text_is_null_and_words_are_capitalised(spark):
    rows = spark.createDataFrame([("0x" + "f" * 40,), ("0x1f",), ("-0x00000000000000000a",)], "t string")
    assert values(rows.select(leading_int_col(F.col("t")).alias("n"))) == [(-10,), (31,), (None,)]
    assert column_label("match.info_total-of x") == "Match.Info Total-Of X"
    shown = spark.createDataFrame([("match.info_total-of x",)], "t string").select(title_words(F.col("t")).alias("t"))
    assert shown.first()[0] == "Match.Info Total-Of X"


def pages_of(frame, sort, order, direct):
    tables = Collections(frame.sparkSession, tables={"t": frame}, registry=(CollectionEntry("t", "T"),))
    return [[r["id"] for r in browse.browse(tables, "t", n, 50, sort, order, tie_break=("id",), direct=direct).rows.collect()]
            for n in range(1, 8)]


def test_nested_sort_fields_page_alike_near_and_deep(spark):
    frame = spark.range(300).selectExpr(
        "id", "if(id % 7 = 0, null, struct(id % 3 as a, if(id % 5 = 0, null, cast(id % 11 as decimal(5,2))) as b)) as pair",
        "if(id % 6 = 0, null, transform(sequence(1, id % 4), x -> timestamp_seconds(x * id))) as list",
        "unhex(hex(id % 13 + 240)) as raw", "struct(map('a', id) as m) as held", "id as _hash", "id as _file")
    for sort in ("pair", "list", "raw", "pair.b"):
        for order in ("asc", "desc"):
            near, deep = pages_of(frame, sort, order, 10_000), pages_of(frame, sort, order, 20)
            assert near == deep and sorted(sum(deep, [])) == list(range(300))
    assert pages_of(frame, "held", "asc", 10_000) == [list(range(n, n + 50)) for n in range(0, 300, 50)] + [[]]


def test_pages_keep_columns_that_have_internal_names(spark, tmp_path):
    spark.range(5).selectExpr("id", "id as _hash", "id as _file", "id as _row").write.parquet(str(tmp_path / "t"))
    tables = Collections(spark, str(tmp_path), registry=(CollectionEntry("t", "T"),))
    rows = browse.browse(tables, "t", sort="_file", order="asc").rows
    assert rows.columns == ["id", "_hash", "_file", "_row"] and [r["id"] for r in rows.collect()] == list(range(5))


def test_stamps_of_zero_offset(spark):
    texts = ["2026-04-05T10:00:00Z", "2026-04-05T10:00:00.120+00:00", "2026-04-05T10:00:00-00:00", "2026-04-05T10:00:00+01:00", None]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    shown = rows.where("n <> 3").select("n", stamps.micros_to_iso(stamps.iso_micros(F.col("t"))).alias("t"))
    ten = "2026-04-05T10:00:00"
    assert values(shown) == [(0, f"{ten}+00:00"), (1, f"{ten}.120000+00:00"), (2, f"{ten}+00:00"), (4, None)]
    assert values(rows.where("n = 3").select(stamps.utc_micros(F.col("t")))) == [(None,)]


def test_lenient_stamps_count_their_records(spark):
    frame = spark.createDataFrame(
        [("yesterday", [(1, 1, 0, 1)]), ("2026-04-05T10:00:00Z", [(1, 0, 1, 1)])],
        "fetched_at string, data array<struct<hero_id:long,wins:long,losses:long,matches:long>>")
    records = aggregate.counter_records(frame, "hero_id", stamps="lenient")
    out = aggregate.win_rate(records, "hero_id", stamps="lenient")
    assert values(out, "total_matches", "last_updated") == [(2, "2026-04-05T10:00:00+00:00")]


def test_report_counts_unreadable_files(spark, tmp_path):
    folder = tmp_path / "raw" / "builds"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"fetched_at": "2026-04-05T10:00:00Z", "data": [{"id": 1}]}')
    (folder / "b.json").write_text('{"fetched_at": "2026-04-05T10:00:00Z", "data": [{"id"')
    row = refresh.refresh_endpoint(spark, str(tmp_path), str(tmp_path / "out"), "builds", "generic")
    assert row[2:4] == ("OK", 1) and row[-2:] == (0, 1)


def test_continued_refresh_takes_new_files_and_new_fields(spark, tmp_path):
    folder, args = tmp_path / "raw" / "builds", [str(tmp_path), str(tmp_path / "out"), str(tmp_path / "state"), "builds", "generic"]
    assert continued.continue_endpoint(spark, *args)[2] == "SKIP"
    folder.mkdir(parents=True)
    found = []
    for name, record in (("a", '{"id": 1}'), ("b", '{"id": 2}'), ("c", '{"id": "x", "more": {"n": 1}}')):
        (folder / f"{name}.json").write_text(f'{{"fetched_at": "2026-04-05T10:00:00Z", "data": [{record}]}}')
        found.append(continued.continue_endpoint(spark, *args)[2:6])
    found.append(continued.continue_endpoint(spark, *args)[2:6])
    assert found == [("OK", "built", 1, 1), ("OK", "continued", 1, 2), ("OK", "built", 3, 3), ("OK", "continued", 0, 3)]
    out = read_collection(spark, str(tmp_path / "out"), "builds")
    assert values(out, "id", "more_n") == [("1", None), ("2", None), ("x", 1)]
