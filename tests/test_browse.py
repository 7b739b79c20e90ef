import random
import re

import pytest
from pyspark.sql import functions as F

from frames import physical_plan, values
from snapstats.operators import paging
from snapstats.operators.paging import SortKey
from snapstats.plans import browse, report
from snapstats.sources.collections import DEFAULT_REGISTRY, CollectionEntry, Collections, hero_dimension


def keys(*pairs):
    return [SortKey(F.col(c), asc) for c, asc in pairs]


def expected_page(rows, order, offset, count):
    """Python's answer; null is the lowest value."""
    out = list(rows)
    for position, ascending in reversed(order):
        out.sort(key=lambda r: (r[position] is not None, r[position] if r[position] is not None else 0), reverse=not ascending)
    return out[offset : offset + count]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one sort value, some are null, the rest spread; ids are unique."""
    rng = random.Random(5)
    rows = []
    for n in range(6000):
        kind = rng.random()
        value = 500 if kind < 0.33 else None if kind < 0.4 else rng.randrange(1000)
        rows.append((n, value))
    return rows, spark.createDataFrame(rows, "id int, v int").repartition(8).cache()


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("offset", [90, 420, 2600, 5990, 9999])
def test_deep_pages(skewed, ascending, offset):
    rows, frame = skewed
    page = paging.page_rows(frame, keys(("v", ascending), ("id", True)), offset, 37, direct=100)
    want = expected_page(rows, [(1, ascending), (0, True)], offset, 37)
    assert [tuple(r) for r in page.collect()] == want


@pytest.mark.parametrize("shown, passes", [("bigint", 1), ("double", 1), ("date", 1), ("string", 2)])
def test_a_deep_page_takes_few_passes(spark, shown, passes, monkeypatch):
    counted, real = [], paging._count_spans

    def count_spans(frame, key, splits):
        out = real(frame, key, splits)
        counted.append((len(splits), out[0]))
        return out

    monkeypatch.setattr(paging, "_count_spans", count_spans)
    value = "date_add(date'2020-01-01', cast((id * 7919) % 20011 AS int))" if shown == "date" else f"cast((id * 7919) % 20011 AS {shown})"
    frame = spark.range(20_000).select("id", F.expr(value).alias("v"))
    for ascending in (True, False):
        counted.clear()
        page = paging.page_rows(frame, keys(("v", ascending), ("id", True)), 12_345, 50, direct=200)
        plain = paging.sort_rows(frame, keys(("v", ascending), ("id", True))).offset(12_345).limit(50)
        assert page.collect() == plain.collect()
        assert 1 <= len(counted) <= passes and all(n <= 20 for n, _ in counted)


def test_nan_and_infinity_are_paged(spark):
    values = [(n, float("nan") if n % 3 == 0 else float("inf") if n % 7 == 0 else None if n % 5 == 0 else n * 31 % 800 / 2) for n in range(900)]
    frame = spark.createDataFrame(values, "id int, v double").repartition(4)
    for ascending in (True, False):
        for offset in (250, 600):
            order = keys(("v", ascending), ("id", True))
            page = paging.page_rows(frame, order, offset, 30, direct=20)
            plain = paging.sort_rows(frame, order).offset(offset).limit(30)
            assert [r["id"] for r in page.collect()] == [r["id"] for r in plain.collect()]


def test_the_fetch_names_a_range_of_the_sort_column(store):
    collections, _ = store
    placed, file, row = paging.with_positions(collections.open("hero_stats"))
    page = paging.fetch_page(placed, file, row, keys(("win_rate", True)), 250, 10, 100)
    assert "GreaterThanOrEqual(win_rate" in physical_plan(page) and page.count() == 10


@pytest.mark.parametrize("offset", [0, 10, 2590, 5990])
def test_pages_of_a_table_with_very_many_tasks(skewed, offset, monkeypatch):
    monkeypatch.setattr(paging, "MERGED_ROWS", 300)
    rows, frame = skewed
    page = paging.page_rows(frame, keys(("v", False), ("id", True)), offset, 25, direct=100, tasks=10_000)
    assert [tuple(r) for r in page.collect()] == expected_page(rows, [(1, False), (0, True)], offset, 25)


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("shown", ["int", "string"])
def test_large_pages_are_whole_and_take_few_passes(skewed, shown, ascending, monkeypatch):
    monkeypatch.setattr(paging, "DIRECT_ROWS", 40)
    monkeypatch.setattr(paging, "QUANTILES", 100)
    counted, real = [], paging._count_spans
    monkeypatch.setattr(paging, "_count_spans", lambda *a: counted.append(1) or real(*a))
    rows, frame = skewed
    frame = frame.withColumn("v", F.col("v").cast(shown))
    rows = [tuple(r) for r in frame.collect()]
    for offset, count in ((1300, 1900), (3700, 9000)):
        counted.clear()
        page = paging.page_rows(frame, keys(("v", ascending), ("id", True)), offset, count, direct=10)
        assert [tuple(r) for r in page.collect()] == expected_page(rows, [(1, ascending), (0, True)], offset, count)
        assert len(counted) <= 12  # narrowing a large page by itself takes forty and more
        # no task takes the page: limits are for its ends
        assert all(int(n) <= 110 for n in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", physical_plan(page)))


def test_page_across_the_edges_of_a_hot_value(spark):
    rows = [(n, 1 if n < 50 else 2 if n < 950 else 3) for n in range(1000)]
    frame = spark.createDataFrame(rows, "id int, v int").repartition(4)
    for offset in (30, 45, 700, 935, 949, 951):
        page = paging.page_rows(frame, keys(("v", True), ("id", False)), offset, 30, direct=20)
        assert [tuple(r) for r in page.collect()] == expected_page(rows, [(1, True), (0, False)], offset, 30)


def test_identical_copies(spark):
    frame = spark.createDataFrame([(1, "x")] * 500 + [(0, "a")] * 10, "v int, t string").repartition(4)
    page = paging.page_rows(frame, keys(("v", True), ("t", True)), 300, 20, direct=50)
    assert [tuple(r) for r in page.collect()] == [(1, "x")] * 20


@pytest.mark.parametrize("dtype", ["double", "string", "timestamp", "timestamp_ntz", "date", "decimal(20,3)", "boolean", "float"])
def test_deep_pages_by_type(spark, dtype):
    base = spark.range(800).select(
        F.col("id"),
        F.when(F.col("id") % 11 == 0, None).otherwise((F.col("id") * 7919) % 503).alias("n"),
    )
    by = {
        "double": F.col("n") / 7, "float": (F.col("n") / 7).cast("float"), "string": F.concat(F.lit("é"), F.col("n").cast("string")),
        "timestamp": F.timestamp_micros(F.col("n") * 3_600_000_001), "date": F.date_add(F.lit("2020-01-01"), F.col("n").cast("int")),
        "timestamp_ntz": F.timestamp_micros(F.col("n") * 1_000_001).cast("timestamp_ntz"),
        "decimal(20,3)": (F.col("n") / 8).cast("decimal(20,3)"), "boolean": F.col("n") % 2 == 0,
    }[dtype]
    frame = base.select("id", by.cast(dtype).alias("v")).cache()
    for ascending in (True, False):
        order = keys(("v", ascending), ("id", True))
        plain = paging.sort_rows(frame, order).offset(555).limit(20)
        page = paging.page_rows(frame, order, 555, 20, direct=40)
        assert [r["id"] for r in page.collect()] == [r["id"] for r in plain.collect()]


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Collections as Parquet folders of several files."""
    root = str(tmp_path_factory.mktemp("store"))
    rows = [(n, n % 7, float((n * 37) % 100), {"a": n}, [n], f"2026-04-{1 + n % 28:02d}T00:00:00+00:00") for n in range(300)]
    columns = "id int, hero_id int, win_rate double, info struct<a:int>, many array<int>, last_updated string"
    spark.createDataFrame(rows, columns).repartition(6).write.parquet(f"{root}/hero_stats")
    spark.createDataFrame([(1, "x")], "id int, _id string").write.parquet(f"{root}/item_stats")
    spark.createDataFrame([], "id int, hero_id int").write.parquet(f"{root}/build_item_stats")
    return Collections(spark, root), rows


def test_pages_concatenate_to_the_sorted_table(store):
    collections, rows = store
    seen = []
    for page in range(1, 8):
        out = browse.browse(collections, "hero_stats", page, 50, "win_rate", "asc")
        seen += [(r["win_rate"], r["id"]) for r in out.rows.collect()]
    assert [w for w, _ in seen] == sorted(r[2] for r in rows)
    assert sorted(i for _, i in seen) == list(range(300))


def test_unsorted_pages_are_disjoint_and_complete(store):
    collections, _ = store
    ids = [r["id"] for p in range(1, 3) for r in browse.browse(collections, "hero_stats", p, 200).rows.collect()]
    assert sorted(ids) == list(range(300))
    deep = browse.browse(collections, "hero_stats", 3, 100, direct=10).rows.collect()
    plain = browse.browse(collections, "hero_stats", 3, 100).rows.collect()
    assert deep == plain and len(deep) == 100


def test_meta(store):
    collections, _ = store
    meta = browse.browse(collections, "hero_stats", "2", "250").meta.collect()[0]
    assert tuple(meta) == (True, "hero_stats", 300, 2, 2, 200, 100)
    past = browse.browse(collections, "hero_stats", "9", "50")
    assert tuple(past.meta.collect()[0]) == (True, "hero_stats", 300, 9, 6, 50, 0) and past.rows.count() == 0
    empty = browse.browse(collections, "build_item_stats")
    assert tuple(empty.meta.collect()[0]) == (True, "build_item_stats", 0, 1, 0, 50, 0)


def test_hero_filter_and_gate(store):
    collections, rows = store
    page = browse.browse(collections, "hero_stats", hero_id="3abc")
    assert page.rows.count() == sum(r[1] == 3 for r in rows) == page.meta.collect()[0]["total"]
    assert browse.browse(collections, "hero_stats", hero_id="abc").meta.collect()[0]["total"] == 300
    assert browse.browse(collections, "item_stats", hero_id="1").meta.collect()[0]["total"] == 0
    with pytest.raises(browse.HeroRequired):
        browse.browse(collections, "build_item_stats", gate=True)
    assert browse.browse(collections, "build_item_stats", hero_id=1, gate=True).rows.count() == 0
    with pytest.raises(ValueError, match="Unknown collection"):
        browse.browse(collections, "secrets")


def test_internal_id_is_hidden_and_unknown_sort_ignored(store):
    collections, _ = store
    assert browse.browse(collections, "item_stats", sort="nope").rows.columns == ["id"]


def test_sort_by_nested_path_and_order_text(store):
    collections, _ = store
    up = browse.browse(collections, "hero_stats", 1, 5, "info.a", "asc").rows.collect()
    assert [r["id"] for r in up] == [0, 1, 2, 3, 4]
    down = browse.browse(collections, "hero_stats", 1, 5, "info.a", "ASC").rows.collect()
    assert [r["id"] for r in down] == [299, 298, 297, 296, 295]


def test_unsortable_fields(spark):
    frame = spark.createDataFrame([({"k": 1}, (1,))], "m map<string,int>, s struct<a:int>")
    assert paging.resolve_field(frame, "m") is None
    assert paging.resolve_field(frame, "s.b") is None
    assert paging.resolve_field(frame, "s.a") is not None
    entries = (CollectionEntry("t", "c"),)
    page = browse.browse(Collections(spark, tables={"t": frame}, registry=entries), "t", sort="m")
    assert page.rows.count() == 1


def test_top_heroes(store):
    collections, rows = store
    top = browse.top_heroes(collections, limit="5")
    got = top.rows.collect()
    assert [r["win_rate"] for r in got] == sorted((r[2] for r in rows), reverse=True)[:5]
    assert tuple(top.meta.collect()[0]) == (5, got[0]["last_updated"])
    lowest = browse.top_heroes(collections, "id", "asc", "-3")
    assert [r["id"] for r in lowest.rows.collect()] == [0, 1, 2]
    assert browse.top_heroes(collections, limit=0).meta.collect()[0]["count"] == 200


def test_top_of_nothing(spark):
    frame = spark.createDataFrame([], "hero_id int, win_rate double, last_updated string")
    assert tuple(browse.top_rows(frame).meta.collect()[0]) == (0, None)


def test_first_pages_are_top_k(store, spark):
    collections, _ = store
    placed, file, row = paging.with_positions(collections.open("hero_stats"))
    plan = physical_plan(paging.page_rows(placed, keys(("win_rate", False)), 0, 50).select(file, row))
    assert "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<win_rate:double,_tmp_metadata_row_index:bigint>" in plan


def test_page_rows_come_from_few_files(store):
    collections, _ = store
    page = browse.browse(collections, "hero_stats", 1, 1, "win_rate").rows
    page.collect()
    scans = []

    def walk(node):
        if node.metrics().contains("numFiles"):
            scans.append(node.metrics().apply("numFiles").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())
        for n in range(node.children().size()):
            walk(node.children().apply(n))

    walk(page._jdf.queryExecution().executedPlan())
    assert scans == [1]


def test_list_and_navigation(store):
    collections, _ = store
    listed = browse.list_collections(collections)
    counts = {r["name"]: r["count"] for r in listed.collect()}
    assert len(counts) == len(DEFAULT_REGISTRY) == 15
    assert counts["hero_stats"] == 300 and counts["match_history"] == 0
    nav = browse.collections_nav(listed)
    assert [(r["category"], r["label"], r["count_label"]) for r in nav.collect()] == [
        ("Heroes", "Hero Stats", "300"), ("Items", "Item Stats", "1"),
    ]
    groups = browse.nav_groups(nav).collect()
    assert [(g["category"], [e["name"] for e in g["entries"]]) for g in groups] == [
        ("Heroes", ["hero_stats"]), ("Items", ["item_stats"]),
    ]
    assert browse.list_collections(Collections(collections.spark, "/nowhere/at/all")).where("count > 0").isEmpty()


def test_catalog_tables(spark):
    spark.range(3).createOrReplaceTempView("ready")
    collections = Collections(spark, registry=(CollectionEntry("ready", "c"),))
    assert browse.browse(collections, "ready").meta.collect()[0]["total"] == 3


def test_report_view(store, spark):
    collections, _ = store
    page = report.report_view(collections, hero_dimension(spark), "hero_stats", "infernus", sort="id", order="asc")
    assert page.rows.count() == 0  # the search sees ids, not the names shown
    page = report.report_view(collections, hero_dimension(spark), "hero_stats", "49", sort="id", order="asc")
    assert page.rows.columns == ["Id", "Hero", "Win Rate", "Info", "Many", "Last Updated"]
    row = page.rows.where("Id = '49'").collect()[0]
    assert tuple(row) == ("49", "Hero 0", "1300.00%", '{"a":49}', "[49]", "4/22/2026, 12:00:00 AM")
    with pytest.raises(browse.HeroRequired):
        report.report_view(collections, hero_dimension(spark), "build_item_stats")


def test_labels_stay_unique(spark):
    frame = spark.createDataFrame([(1, 2)], "wins int, total_wins int")
    assert list(report.column_labels(frame).values()) == ["Wins", "Wins (total_wins)"]
    assert report.sort_choices(frame) == [("wins", "Wins"), ("total_wins", "Wins")]


def test_hero_picker(spark):
    heroes = spark.createDataFrame([(4,), (1,), (999,), (18,)], "hero_id bigint")
    assert [r["hero_name"] for r in report.hero_picker(heroes, hero_dimension(spark)).collect()] == [
        "Hero 999", "Infernus", "Lady Geist", "Mo & Krill",
    ]


def test_bands(spark):
    frame = spark.createDataFrame([(0.52,), (0.4,), (None,)], "win_rate double")
    assert values(report.with_band(frame), "win_rate_band") == [("high",), ("low",), (None,)]


def test_folder_names_with_blanks_and_partitions(spark, tmp_path):
    root = str(tmp_path / "a b%20ü")
    frame = spark.range(60).select("id", (F.col("id") % 3).alias("hero_id"), F.concat(F.lit("x y="), F.col("id") % 2).alias("part"))
    frame.write.partitionBy("part").parquet(f"{root}/item_stats")
    page = browse.browse(Collections(spark, root), "item_stats", 2, 7, "id", "asc", hero_id=1)
    assert [r["id"] for r in page.rows.collect()] == [n for n in range(60) if n % 3 == 1][7:14]
    assert page.meta.collect()[0]["total"] == 20
