import pytest
from pyspark.sql import functions as F

from frames import physical_plan, values
from snapstats.operators import blocks, discover, filters, joins, lookup
from snapstats.sources.collections import hero_dimension

S1, S2 = "2026-04-05T10:00:00+00:00", "2026-04-05T10:00:00.000001+00:00"


def test_heroes_in_order_of_first_occurrence(spark):
    frame = spark.createDataFrame(
        [(S2, [(1,), (9,)]), (S1, [(5,), (None,), (3,), (5,)])], "fetched_at string, data array<struct<hero_id:bigint>>"
    )
    out = discover.distinct_in_order(frame, "hero_id")
    assert values(out) == [(1, S2, 0), (3, S1, 2), (5, S1, 0), (9, S2, 1)]


def test_match_ids(spark):
    frame = spark.createDataFrame([(1,), (1,), (None,), (2,)], "match_id bigint")
    assert values(discover.distinct_ids(frame, "match_id")) == [(1,), (2,)]


PLAYERS = "array<struct<account_id:bigint>>"


@pytest.mark.parametrize(
    "columns, row, accounts",
    [
        (f"match_info struct<players:{PLAYERS}>, players {PLAYERS}", (([(1,), (0,), (None,)],), [(2,), (-3,), (1,)]), [(1,), (2,)]),
        (f"match_info struct<players:{PLAYERS}>, players {PLAYERS}", (None, None), []),
        (f"players {PLAYERS}", ([(4,), None],), [(4,)]),
        (f"match_info struct<players:{PLAYERS}>", (([(6,)],),), [(6,)]),
        ("match_info struct<other:int>, players array<int>", ((1,), [1]), []),
    ],
)
def test_accounts(spark, columns, row, accounts):
    assert values(discover.distinct_accounts(spark.createDataFrame([row], columns))) == accounts


def test_dependent_records(spark):
    records = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "account_id bigint, v string")
    ids = spark.createDataFrame([(1,), (3,)], "account_id bigint")
    assert values(discover.of_discovered(records, ids, "account_id")) == [(1, "a"), (1, "a")]
    assert values(discover.undiscovered(ids, records, "account_id")) == [(3,)]
    assert values(discover.of_discovered(records, ids.limit(0), "account_id")) == []
    grid = discover.request_grid(ids, ["x", "y"])
    assert values(grid) == [(1, "x"), (1, "y"), (3, "x"), (3, "y")]
    assert values(discover.tracked_totals(records.withColumnRenamed("account_id", "match_id"), ids)) == [(2, 2)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(3000).select(F.when(F.col("id") < 1500, 7).otherwise(F.col("id") % 40).alias("k"), F.lit("copy").alias("v"))
    right = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    assert values(joins.salted_join(left, right, ["k"], how)) == values(left.join(right, ["k"], how))


HOT = "CASE WHEN id < 1500 THEN 7 WHEN id >= 1800 THEN id % 400 END"


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("shown", ["bigint", "string", "decimal(9,2)", "double"])
def test_even_join_splits_heavy_keys_only(spark, how, shown):
    left = spark.range(3000).select(F.expr(HOT).cast(shown).alias("k"), F.lit("copy").alias("v"), F.lit(1).alias("_salt"))
    right = spark.range(30).select(F.col("id").cast(shown).alias("k"), (F.col("id") * 2).alias("w"))
    joined = joins.even_join(left, right, ["k"], how, heavy_rows=100)
    assert values(joined) == values(left.join(right, ["k"], how))
    assert "explode" in physical_plan(joined)
    even = joins.even_join(left.where("k <> 7"), right, ["k"], how, heavy_rows=100)
    assert values(even) == values(left.where("k <> 7").join(right, ["k"], how))
    assert ("explode" in physical_plan(even)) == (shown == "double")  # floating keys are always salted


def test_heavy_keys_get_shares_by_their_size(spark):
    frame = spark.range(4000).select(F.expr(HOT).alias("k"), F.lit("x").alias("t"))
    by_hash = {r["h"]: r["k"] for r in frame.select("k", F.xxhash64("k", "t").alias("h")).distinct().collect()}
    heavy = joins.heavy_keys(frame, ["k", "t"], heavy_rows=100)
    assert {by_hash[h]: n for h, n in heavy.items()} == {7: 4}  # width 4: a fair share has 1,000 rows
    assert joins.heavy_keys(frame, ["k", "t"]) == {} and joins.heavy_keys(frame.limit(0), ["k"], 0) == {}


def test_even_join_of_unlike_key_types(spark):
    left = spark.range(50).select(F.col("id").cast("int").alias("k"))
    right = spark.createDataFrame([(3,), (5_000_000_000,)], "k bigint")
    assert values(joins.even_join(left, right, ["k"], "left_semi", 0)) == [(3,)]
    with pytest.raises(ValueError):
        joins.even_join(left, right, ["k"], "right")


def test_salt_spreads_one_hot_key(spark):
    copies = spark.createDataFrame([("x", 1)] * 4000, "k string, v int").repartition(16)
    spread = copies.groupBy(joins.row_salt(copies).alias("s")).count()
    assert spread.count() > 4


def test_salted_join_rejects_right_joins(spark):
    frame = spark.range(1)
    with pytest.raises(ValueError):
        joins.salted_join(frame, frame, ["id"], "right")


@pytest.mark.parametrize("items, n_blocks, last", [(1, 1, 1), (500, 1, 500), (501, 2, 1), (1000, 2, 500), (1700, 4, 200)])
def test_blocks_are_full_but_the_last(spark, items, n_blocks, last):
    ids = spark.range(items).select(F.col("id").alias("k"))
    out = blocks.number_blocks(ids.union(ids), "k")
    sizes = dict(out.groupBy("block").count().collect())
    assert sorted(sizes) == list(range(1, n_blocks + 1))
    assert [sizes[b] for b in sorted(sizes)] == [500] * (n_blocks - 1) + [last]
    suffixes = {r["block"]: r["suffix"] for r in out.select("block", "suffix").distinct().collect()}
    assert suffixes == {b: f"_batch{b}" if n_blocks > 1 else "" for b in sizes}


def test_text_items_and_attached_records(spark):
    records = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    numbered = blocks.number_blocks(records, "k", block_items=1)
    attached = blocks.attach_blocks(records, numbered, "k")
    assert values(attached, "v") == [(1,), (2,), (3,)]
    totals = blocks.block_totals(attached)
    assert sorted(r["records"] for r in totals.collect()) == [1, 2]


def test_hero_names(spark):
    frame = spark.createDataFrame([(1, 2.0, "68"), (999, None, "x"), (None, 2.5, None)], "hero_id bigint, a_hero_id double, b_hero_id string")
    named = lookup.hero_name(frame, hero_dimension(spark))
    assert values(named, "hero_name") == [("Hero 999",), ("Infernus",), ("—",)]
    everywhere = lookup.name_all_heroes(frame, hero_dimension(spark))
    assert everywhere.columns == frame.columns
    assert values(everywhere) == [("Hero 999", "—", "Hero x"), ("Infernus", "Seven", "Boho"), ("—", "Hero 2.5", "—")]


def test_lookup_never_multiplies_rows_and_may_be_large(spark, monkeypatch):
    frame = spark.createDataFrame([(1,), (2,)], "k bigint")
    names = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id bigint, name string")
    expected = [(1, "b"), (2, "ID Not Found")]
    assert values(lookup.name_or_not_found(frame, names, "k", "id", "name")) == expected
    small = lookup.is_small
    monkeypatch.setattr(lookup, "is_small", lambda f: small(f, 1))
    assert values(lookup.name_or_not_found(frame, names, "k", "id", "name")) == expected


def test_lookup_is_broadcast_when_small(spark):
    frame = spark.range(10).select(F.col("id").alias("hero_id"))
    plan = lookup.hero_name(frame, hero_dimension(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_id_filter(spark):
    frame = spark.createDataFrame([(1, [1, 2], "1"), (2, [3], "2"), (None, None, None)], "hero_id bigint, many array<int>, text string")
    assert values(filters.equals_id(frame, "hero_id", "2x"), "hero_id") == [(2,)]
    assert filters.equals_id(frame, "hero_id", "abc").count() == 3
    assert filters.equals_id(frame, "hero_id", None).count() == 3
    assert filters.equals_id(frame, "absent", 1).count() == 0
    assert filters.equals_id(frame, "text", 1).count() == 0
    assert values(filters.equals_id(frame, "many", 2), "hero_id") == [(1,)]
    assert values(filters.positive(frame.union(frame.limit(0)), "hero_id"), "hero_id") == [(1,), (2,)]


def test_search(spark):
    frame = spark.createDataFrame(
        [(1, "Alpha", 17.0, (1,)), (2, None, 0.5, (2,)), (3, "beta_17", 3.0, (170,))], "id int, name string, x double, s struct<v:int>"
    )
    assert values(filters.search(frame, "ALPHA"), "id") == [(1,)]
    assert values(filters.search(frame, "17"), "id") == [(1,), (3,)]
    assert values(filters.search(frame, "17.0"), "id") == []
    assert values(filters.search(frame, "null"), "id") == []
    assert values(filters.search(frame, "null", nulls=True), "id") == [(2,)]
    assert values(filters.search(frame, "170"), "id") == []
    assert values(filters.search(frame, "170", nested=True), "id") == [(3,)]
    assert filters.search(frame, "").count() == 3 and filters.search(frame, None).count() == 3
    assert values(filters.search(frame, "a_1"), "id") == [(3,)]
