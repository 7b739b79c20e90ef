import pytest


from frames import physical_plan, values
from snapstats.operators import aggregate
from snapstats.operators.shape import MissingPayload, NotRecords

RECORD = "struct<hero_id:bigint, wins:bigint, losses:bigint, matches:bigint>"
S1, S2 = "2026-04-05T10:00:00+00:00", "2026-04-05T10:00:00.000001+00:00"


def frame_of(spark, rows, columns=f"fetched_at string, data array<{RECORD}>"):
    return spark.createDataFrame(rows, columns)


def rates(frame, **how):
    return values(aggregate.win_rate(aggregate.counter_records(frame, "hero_id", **how), "hero_id"))


def test_totals_over_all_snapshots(spark):
    frame = frame_of(spark, [(S1, [(1, 57, 743, 800), (2, 1, 1, 2)]), (S2, [(1, 57, 743, 800)])])
    assert rates(frame) == [(1, 114, 1486, 1600, S2, 0.0713), (2, 1, 1, 2, S1, 0.5)]


def test_null_key_zero_matches_and_null_values(spark):
    frame = frame_of(
        spark,
        [(S1, [(None, 1, 1, 2), (3, 0, 0, 0), (4, 5, 5, None), (5, None, 2, 2), None]), (S1, None), (S2, [])],
    )
    assert rates(frame) == [(5, None, 2, 2, S1, None), (None, 1, 1, 2, S1, 0.5)]


def test_drifted_counters(spark):
    record = "struct<hero_id:bigint, wins:string, losses:double, matches:decimal(10,1)>"
    from decimal import Decimal

    frame = frame_of(
        spark,
        [(S1, [(1, "7", 1.0, Decimal("8.0")), (1, "x", 2.5, Decimal("2.0"))])],
        f"fetched_at string, data array<{record}>",
    )
    assert rates(frame) == [(1, 7, 3, 10, S1, 0.7)]
    rejected = aggregate.rejected_counters(frame).collect()[0]
    assert (rejected["records"], rejected["rejected_wins"], rejected["rejected_losses"]) == (2, 1, 0)


def test_legacy_payload_choices(spark):
    columns = f"fetched_at string, data array<{RECORD}>, heroes array<struct<hero_id:bigint, wins:bigint, matches:bigint, losses:bigint>>"
    frame = frame_of(spark, [(S1, [(1, 1, 0, 1)], None), (S2, None, [(1, 0, 1, 1)])], columns)
    assert rates(frame) == [(1, 1, 0, 1, S1, 1.0)]
    assert rates(frame, legacy="data_first") == [(1, 1, 0, 1, S1, 1.0)]
    assert rates(frame, legacy="per_row") == [(1, 1, 1, 2, S2, 0.5)]
    assert rates(frame.drop("data"), legacy="data_first") == [(1, 0, 1, 1, S2, 0.0)]
    with pytest.raises(MissingPayload):
        rates(frame.drop("data"))


def test_payload_must_hold_records(spark):
    with pytest.raises(NotRecords):
        rates(frame_of(spark, [(S1, [1])], "fetched_at string, data array<int>"))


def test_overflow(spark):
    frame = frame_of(spark, [(S1, [(1, 2**63 - 1, 0, 2), (1, 2**63 - 1, 0, 2)])])
    records = aggregate.counter_records(frame, "hero_id")
    with pytest.raises(Exception, match="OVERFLOW"):
        aggregate.win_rate(records, "hero_id").collect()
    assert aggregate.win_rate(records, "hero_id", overflow="null").collect()[0]["total_wins"] is None


def test_foreign_stamps(spark):
    frame = frame_of(spark, [("5 April", [(1, 1, 1, 2)]), ("6 April", [(1, 1, 1, 2)])])
    with pytest.raises(Exception, match="not a UTC ISO-8601 stamp"):
        rates(frame)
    text = aggregate.counter_records(frame, "hero_id", stamps="text")
    assert values(aggregate.win_rate(text, "hero_id", stamps="text"), "last_updated") == [("6 April",)]


def test_stamp_text_order_equals_time_order(spark):
    frame = frame_of(spark, [(S2, [(1, 1, 1, 2)]), (S1, [(1, 1, 1, 2)]), (None, [(1, 1, 1, 2)])])
    assert rates(frame)[0][4] == max(S1, S2)


def test_win_rate_uses_hash_aggregation(spark):
    frame = frame_of(spark, [(S1, [(1, 1, 1, 2)])])
    plan = physical_plan(aggregate.win_rate(aggregate.counter_records(frame, "hero_id"), "hero_id"))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_counts(spark):
    frame = frame_of(spark, [(S1, [(1, 1, 1, 2)] * 3), (S2, []), (S2, None)])
    assert values(aggregate.with_record_count(frame), "record_count") == [(0,), (0,), (3,)]
    assert values(aggregate.with_record_count(aggregate.non_empty(frame)), "record_count") == [(3,)]
    assert dict(aggregate.tally(frame, "fetched_at").collect()) == {S1: 1, S2: 2}


def test_sums_do_not_depend_on_batching(spark):
    records = [(k % 5, k, 2 * k, 3 * k) for k in range(1, 60)]
    whole = frame_of(spark, [(S1, records)])
    split = frame_of(spark, [(S1, records[:7]), (S1, records[7:40]), (S1, records[40:])])
    assert rates(whole) == rates(split)


def test_rounding_is_half_up(spark):
    records = frame_of(spark, [(S1, [(m, 1, m - 1, m) for m in (3, 32, 800, 20000)])])
    assert [r[5] for r in rates(records)] == [half_up(1, m) for m in sorted((3, 32, 800, 20000), key=str)]


def half_up(w, m):
    return ((20000 * w + m) // (2 * m)) / 10000
