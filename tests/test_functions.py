import datetime as dt

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapstats.functions import display, parsing, stamps


def one(spark, column, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(column(F.col("v"))).collect()[0][0]


@pytest.mark.parametrize(
    "moment",
    [
        dt.datetime(2026, 4, 5, 10, 0, 0, tzinfo=dt.timezone.utc),
        dt.datetime(2026, 4, 5, 23, 59, 59, 7, tzinfo=dt.timezone.utc),
        dt.datetime(1969, 12, 31, 23, 59, 59, 999999, tzinfo=dt.timezone.utc),
        dt.datetime(2000, 2, 29, 0, 0, 0, 120000, tzinfo=dt.timezone.utc),
    ],
)
def test_stamps(spark, moment):
    assert one(spark, stamps.iso_utc, moment, "timestamp") == moment.isoformat()
    micros = (moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    assert one(spark, stamps.iso_micros, moment.isoformat()) == micros
    assert one(spark, stamps.stamp_path, moment, "timestamp") == moment.strftime("%Y/%m/%d/%H%M%S")
    path = one(spark, lambda c: stamps.landing_path(F.lit("e"), c, F.lit("_batch2")), moment.isoformat())
    assert path == moment.strftime("raw/e/%Y/%m/%d/%H%M%S_batch2.json")


def test_stamps_in_another_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        moment = dt.datetime(2026, 3, 8, 2, 30, tzinfo=dt.timezone.utc)
        assert one(spark, stamps.iso_utc, moment, "timestamp") == moment.isoformat()
        assert one(spark, lambda c: stamps.micros_to_iso(stamps.iso_micros(c)), moment.isoformat()) == moment.isoformat()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_display_time(spark):
    assert one(spark, stamps.display_time, "2026-04-05T13:05:00+00:00") == "4/5/2026, 1:05:00 PM"
    assert one(spark, stamps.display_time, "nonsense") == "Invalid Date"
    assert one(spark, lambda c: stamps.display_time(c, bad=None), "nonsense") == "nonsense"
    assert one(spark, stamps.display_time, None) is None


INTEGERS = [
    ("12abc", 12), ("  +7 ", 7), ("-5", -5), ("abc", None), ("", None), (None, None), ("1.9", 1), ("0x1F", 31), ("-0x1f", -31),
]


@pytest.mark.parametrize("text, number", INTEGERS)
def test_leading_int(spark, text, number):
    assert parsing.leading_int(text) == number
    assert one(spark, parsing.leading_int_col, text) == number


@given(st.integers(-(2**62), 2**62), st.text("abc .", max_size=4))
def test_leading_int_ignores_the_rest(number, rest):
    assert parsing.leading_int(f" {number}{rest}") == number


@pytest.mark.parametrize("page, number", [(None, 1), ("0", 1), ("-3", 1), ("x", 1), ("4", 4), (9, 9)])
def test_page_number(page, number):
    assert parsing.page_number(page) == number


@pytest.mark.parametrize("limit, size", [(None, 50), ("0", 50), ("-5", 1), ("500", 200), ("12abc", 12), ("abc", 50)])
def test_page_size(limit, size):
    assert parsing.page_size(limit, 50, 200) == size


@pytest.mark.parametrize("limit, size", [(None, 200), ("0", 200), ("-5", 5), ("900", 500), ("7", 7)])
def test_top_size(limit, size):
    assert parsing.top_size(limit, 200, 500) == size


@pytest.mark.parametrize(
    "value, grouped, plain",
    [
        (1234567.5, "1,234,567.5", "1234567.5"),
        (1000.0005, "1,000.001", "1000.0005"),
        (17.0, "17", "17"),
        (12345678.25, "12,345,678.25", "12345678.25"),
        (0.0001, "0", "0.0001"),
        (-2500.0, "-2,500", "-2500"),
        (100.0, "100", "100"),
        (0.0, "0", "0"),
    ],
)
def test_numbers(spark, value, grouped, plain):
    kind = T.DoubleType()
    assert one(spark, lambda c: display.grouped_number(c, kind), value, "double") == grouped
    assert one(spark, lambda c: display.plain_number(c, kind), value, "double") == plain


@pytest.mark.parametrize(
    "count, text", [(0, "0"), (999, "999"), (1000, "1k"), (34_499, "34k"), (1500, "2k"), (999_999, "1000k"), (1_234_567, "1.2M")]
)
def test_short_count(spark, count, text):
    assert one(spark, display.short_count, count, "bigint") == text


def test_percent_band_and_bar(spark):
    assert one(spark, display.percent, 0.5234, "double") == "52.34%"
    for percentage, name in [(52.0, "high"), (51.99, "mid"), (48.0, "mid"), (47.99, "low"), (None, None)]:
        assert one(spark, display.band, percentage, "double") == name
    assert one(spark, display.bar_width, 120.0, "double") == 100.0
    assert one(spark, display.bar_width, 47.5, "double") == 47.5


def test_labels(spark):
    assert one(spark, display.title_words, "hero_counter_stats") == "Hero Counter Stats"
    assert one(spark, display.title_words, "a_KDA_x") == "A KDA X"
    assert display.column_label("total_wins") == "Wins"
    assert display.column_label("net_worth_KDA") == "Net Worth KDA"
    assert display.is_hero_column("hero_id") and display.is_hero_column("counter_hero_id")
    assert not display.is_hero_column("superhero_id") and not display.is_hero_column("hero_id_count")


def test_clipped_json(spark):
    short = one(spark, display.clipped_json, {"a": None}, "struct<a:int>")
    assert short == '{"a":null}'
    long = one(spark, display.clipped_json, ["x" * 100], "array<string>")
    assert len(long) == 81 and long.endswith("…")


@pytest.mark.parametrize(
    "name, dtype, value, text",
    [
        ("win_rate", "double", 0.5, "50.00%"),
        ("wins", "bigint", 999, "999"),
        ("wins", "bigint", 1000, "1,000"),
        ("wins", "bigint", -1000, "-1,000"),
        ("wins", "bigint", None, "—"),
        ("ratio", "double", 2.5, "2.5"),
        ("fetched_at", "string", "2026-04-05T00:00:00+00:00", "4/5/2026, 12:00:00 AM"),
        ("note", "string", "2026-04-05T00:00:00+00:00", "2026-04-05T00:00:00+00:00"),
        ("flag", "boolean", True, "true"),
        ("list", "array<int>", [1, 2], "[1,2]"),
    ],
)
def test_cell(spark, name, dtype, value, text):
    kind = spark.createDataFrame([], f"v {dtype}").schema["v"].dataType
    assert one(spark, lambda c: display.cell(name, kind, c), value, dtype) == text
