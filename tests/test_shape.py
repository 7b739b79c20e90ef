import pytest
from pyspark.sql import functions as F

from frames import values
from snapstats.operators import shape
from snapstats.sources import payload

RECORD = "struct<a:int, b:struct<c:int, d:struct<e:int>>, list:array<int>, `e.f`:int>"


def envelopes(spark, rows, record=RECORD):
    return spark.createDataFrame(rows, f"fetched_at string, data array<{record}>")


def test_explode_drops_null_and_empty_payloads(spark):
    frame = envelopes(spark, [("s1", [(1, (2, (3,)), [4], 5), None]), ("s2", None), ("s3", [])])
    out = shape.shallow(frame)
    assert out.columns == ["fetched_at", "a", "b", "list", "e.f"]
    assert [r["fetched_at"] for r in out.collect()] == ["s1", "s1"]


def test_flatten_is_one_level_and_in_place(spark):
    frame = envelopes(spark, [("s1", [(1, (2, (3,)), [4], 5)])])
    out = shape.generic(frame)
    assert out.columns == ["fetched_at", "a", "b_c", "b_d", "list", "e.f"]
    row = out.collect()[0]
    assert (row["b_c"], row["b_d"]["e"], row["list"], row["e.f"]) == (2, 3, [4], 5)


def test_flatten_of_backtick_and_dotted_names(spark):
    frame = spark.range(1).select(F.struct(F.lit(1).alias("x.y"), F.lit(2).alias("z`")).alias("o.p"))
    assert values(shape.flatten(frame)) == [(1, 2)]
    assert shape.flatten(frame).columns == ["o.p_x.y", "o.p_z`"]


def test_flatten_collision(spark):
    frame = spark.createDataFrame([((1,), 2)], "a struct<b:int>, a_b int")
    with pytest.raises(shape.ColumnCollision):
        shape.flatten(frame)
    assert shape.flatten(frame, on_collision="suffix").columns == ["a_b", "a_b_2"]


def test_case_only_difference_collides(spark):
    frame = spark.createDataFrame([((1,), 2)], "a struct<b:int>, A_B int")
    with pytest.raises(shape.ColumnCollision):
        shape.flatten(frame)


def test_record_with_its_own_stamp(spark):
    frame = envelopes(spark, [("outer", [("inner", 1)])], "struct<fetched_at:string, a:int>")
    with pytest.raises(shape.ColumnCollision):
        shape.generic(frame)
    assert values(shape.generic(frame, on_collision="suffix")) == [("outer", "inner", 1)]


def test_missing_and_unsuitable_payload(spark):
    with pytest.raises(shape.MissingPayload):
        shape.shallow(spark.createDataFrame([("s",)], "fetched_at string"))
    scalars = spark.createDataFrame([("s", [1])], "fetched_at string, data array<int>")
    with pytest.raises(shape.NotRecords):
        shape.shallow(scalars)


def test_inject_key_overrides_the_record(spark):
    frame = spark.createDataFrame(
        [("s", 7, [(1, 10), (2, 20)]), ("s", 8, [])],
        "fetched_at string, account_id bigint, data array<struct<account_id:bigint, match_id:bigint>>",
    )
    out = shape.inject_key(frame, "account_id")
    assert values(out, "account_id", "match_id") == [(7, 10), (7, 20)]
    assert len(out.columns) == 3


def test_inject_key_adds_an_absent_field(spark):
    frame = spark.createDataFrame(
        [("s", 7, [(10,)])], "fetched_at string, hero_id bigint, data array<struct<match_id:bigint>>"
    )
    assert values(shape.inject_key(frame, "hero_id"), "hero_id", "match_id") == [(7, 10)]


@pytest.mark.parametrize(
    "text, records",
    [
        (None, []),
        ("null", []),
        ("{}", [(None,)]),
        ('{"k": 1}', [(1,)]),
        ('[{"k": 1}, {"k": 2}]', [(1,), (2,)]),
        ("[]", []),
        ("5", []),
        ("{broken", []),
    ],
)
def test_normalize_payload(spark, text, records):
    frame = spark.createDataFrame([(text,)], "t string")
    out = frame.select(payload.normalize_payload(F.col("t"), "struct<k:bigint>").alias("data"))
    assert [tuple(r) for r in out.collect()[0]["data"]] == records


@pytest.mark.parametrize(
    "text, size", [(None, 0), ("null", 0), ("{}", 1), ("[]", 0), ("[1, 2]", 2), ("5", 1), ('"x"', 1), ("{broken", 0)]
)
def test_normalize_variant(spark, text, size):
    frame = spark.createDataFrame([(text,)], "t string")
    out = frame.select(F.size(payload.normalize_variant(F.col("t"))).alias("n"))
    assert out.collect()[0]["n"] == size
