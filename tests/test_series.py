"""Daily load, interpolation and progression on hand-made series."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import casts, labels
from tidemark.operators import quality
from tidemark.plans import body, load, progress

START = date(2026, 1, 1)


def day(n: int) -> date:
    return START + timedelta(days=n)


SETS = (
    "workout_id string, exercise_title string, primary_muscle string, equipment_category string, gym string,"
    " gym_detail string, exercise_notes string, workout_date date, week_start date, year int, weight_kg decimal(6,2), reps int,"
    " tonnage decimal(18,2), is_failure_set boolean, session_duration_min bigint, e int"
)


def sets(spark, rows):
    """Rows of (day number, weight, reps) with optional overrides."""
    out = []
    for n, weight, reps, *rest in rows:
        changes = rest[0] if rest else {}
        base = dict(
            workout_id=f"w{n}", exercise_title="Bench (Barbell)", primary_muscle="chest", equipment_category="Barbell",
            gym="g", gym_detail="g1", exercise_notes=None, workout_date=day(n), week_start=day(n), year=2026,
            weight_kg=Decimal(str(weight)), reps=reps, tonnage=Decimal(str(weight)) * reps, is_failure_set=False,
            session_duration_min=60, e=1,
        )
        out.append(tuple({**base, **changes}.values()))
    return spark.createDataFrame(out, SETS)


def weights(spark, rows):
    return spark.createDataFrame(rows, "workout_date date, bodyweight_kg decimal(10,2)")


def ratio(spark, rows):
    out = load.daily_load_ratio(sets(spark, rows), weights(spark, []))
    return {(r.workout_date - START).days: r for r in out.collect()}


def test_rest_days_exist_and_lower_the_ratio(spark):
    got = ratio(spark, [(n, 100, 10) for n in range(0, 30)] + [(40, 100, 10)])
    assert sorted(got) == list(range(41))
    assert [got[n].days_since_last_session for n in range(29, 41)] == [0, *range(1, 11), 0]
    falling = [got[n].fatigue_index for n in range(29, 37)]
    assert falling == sorted(falling, reverse=True) and got[36].fatigue_index == 0
    assert got[30].daily_tonnage == 0 and not got[30].is_training_day and got[30].gym is None
    assert got[29].training_status == "optimal" and got[36].training_status == "undertraining"


def test_first_27_days_carry_no_status(spark):
    got = ratio(spark, [(n, 50, 10) for n in range(0, 29)])
    assert got[26].training_status == "insufficient_data" and got[26].fatigue_index == 1
    assert got[27].training_status == "optimal" and got[27].days_of_history == 28


def test_zero_chronic_load(spark):
    got = ratio(spark, [(n, 0, 10) for n in range(0, 30)])
    assert got[29].fatigue_index == 0 and got[29].training_status == "insufficient_data"


def test_ratio_on_the_edge_is_optimal(spark):
    frame = spark.createDataFrame(
        [(60, Decimal("6.00"), Decimal("5.00")), (60, Decimal("6.01"), Decimal("5.00"))], "h int, a decimal(20,2), c decimal(20,2)"
    )
    bands = [r[0] for r in frame.select(labels.load_status(F.col("h"), F.col("a"), F.col("c"))).collect()]
    assert bands == ["optimal", "overreaching"]


def test_ratio_never_exceeds_four(spark):
    got = ratio(spark, [(0, 1, 1), (60, 500, 20)])
    assert max(r.fatigue_index for r in got.values()) == 4
    spine = load.daily_load_ratio(sets(spark, [(0, 1, 1), (60, 500, 20)]), weights(spark, []))
    assert quality.no_gaps(spine, [], "workout_date").count() == 0
    assert quality.in_range(spine, "fatigue_index", 0, 5, ["workout_date"]).count() == 0


def test_dominant_venue_is_that_of_the_largest_set(spark):
    rows = [
        (0, 10, 10, {"gym_detail": "small", "exercise_title": "A"}),
        (0, 10, 11, {"gym_detail": "small", "exercise_title": "B"}),
        (0, 10, 15, {"gym_detail": "big"}),
        (0, 10, 99, {"gym_detail": None, "gym": None}),
    ]
    first = ratio(spark, rows)[0]
    assert (first.gym_detail, first.gyms_trained, first.daily_exercises, first.sessions) == ("big", 2, 3, 1)


def test_entities_do_not_mix(spark):
    rows = [(n, 10, 10, {"e": 1}) for n in (0, 3)] + [(n, 20, 10, {"e": 2}) for n in (10, 11)]
    out = load.daily_load_ratio(sets(spark, rows), weights(spark, []).withColumn("e", F.lit(1)), ["e"]).collect()
    assert sorted((r.e, (r.workout_date - START).days) for r in out) == [(1, 0), (1, 1), (1, 2), (1, 3), (2, 10), (2, 11)]


READING = "measurement_date date, weight_kg decimal(5,2), _loaded_at timestamp_ntz"


def interpolated(spark, readings, last=9):
    loaded = datetime(2026, 2, 1)
    frame = spark.createDataFrame([(day(n), Decimal(v), loaded) for n, v in readings], READING)
    out = body.interpolate_daily(sets(spark, [(0, 1, 1), (last, 1, 1)]), frame).collect()
    return {(r.workout_date - START).days: r for r in out}


def test_interpolation_flat_linear_flat(spark):
    got = interpolated(spark, [(2, "80.00"), (6, "82.00")])
    assert [str(got[n].bodyweight_kg) for n in range(10)] == [
        "80.00", "80.00", "80.00", "80.50", "81.00", "81.50", "82.00", "82.00", "82.00", "82.00"
    ]
    assert [n for n in got if got[n].is_measured] == [2, 6]
    assert (got[0].prev_reading_date, got[0].next_reading_date) == (None, day(2))
    assert (got[4].prev_reading_date, got[4].next_reading_date) == (day(2), day(6))
    assert (got[2].prev_reading_date, got[2].next_reading_date) == (day(2), day(2))
    assert (got[9].prev_reading_date, got[9].next_reading_date) == (day(6), None)


def test_readings_outside_the_span_are_ignored(spark):
    got = interpolated(spark, [(-5, "70.00"), (4, "80.00"), (30, "99.00")])
    assert {str(r.bodyweight_kg) for r in got.values()} == {"80.00"}


def test_no_reading_gives_null_days(spark):
    got = interpolated(spark, [])
    assert len(got) == 10 and all(r.bodyweight_kg is None and not r.is_measured for r in got.values())


def test_two_readings_of_a_day_take_the_newest(spark):
    rows = [(day(3), Decimal("80"), datetime(2026, 1, 5)), (day(3), Decimal("79"), datetime(2026, 1, 6))]
    out = body.interpolate_daily(sets(spark, [(0, 1, 1), (5, 1, 1)]), spark.createDataFrame(rows, READING))
    assert out.count() == 6 and {r.bodyweight_kg for r in out.collect()} == {Decimal("79.00")}


def progression(spark, rows, bodyweight=()):
    out = progress.progression(sets(spark, rows), weights(spark, list(bodyweight))).collect()
    return sorted(out, key=lambda r: (r.exercise_title, r.gym_detail, r.workout_date))


@pytest.mark.parametrize(
    "reps, want",
    [(1, "100.00"), (10, "133.33"), (11, "130.56"), (20, "155.56"), (0, "100.00")],
)
def test_one_rep_max(spark, reps, want):
    assert str(progression(spark, [(0, 100, reps)])[0].estimated_1rm) == want


def test_more_than_20_reps_is_left_out_before_history(spark):
    got = progression(spark, [(0, 100, 21), (1, 50, 5)])
    assert len(got) == 1 and got[0].sessions_logged == 1


def test_top_set_takes_the_best_reps_at_the_top_weight(spark):
    got = progression(spark, [(0, 100, 3), (0, 100, 5), (0, 90, 12), (0, 99.99, 20)])
    assert (got[0].top_set_weight_kg, got[0].top_set_reps, got[0].sets_n) == (Decimal("100.00"), 5, 4)


def test_first_session_and_ties_are_records(spark):
    got = progression(spark, [(0, 100, 5), (7, 100, 5), (14, 90, 5), (20, 101, 5)])
    assert [r.is_pr for r in got] == [True, True, False, True]
    assert [r.days_since_pr for r in got] == [0, 0, 7, 0]


@pytest.mark.parametrize("gap, hit", [(20, False), (21, True), (35, True), (36, False)])
def test_offset_window_edges(spark, gap, hit):
    got = progression(spark, [(0, 100, 5), (gap, 110, 5)])
    assert (got[1].e1rm_4wk_ago is not None) is hit


def test_trend_needs_three_sessions(spark):
    two = progression(spark, [(0, 100, 5), (28, 110, 5)])
    assert {r.progression_trend for r in two} == {"insufficient_data"}
    three = progression(spark, [(0, 100, 5), (28, 110, 5), (56, 100, 5)])
    assert [r.progression_trend for r in three] == ["insufficient_data", "improving", "declining"]
    assert three[1].e1rm_pct_change_4wk == 10 and str(three[2].e1rm_pct_change_4wk) == "-9.1"


def test_smith_machine_rename_and_unknown_mismatch(spark):
    got = progression(spark, [(0, 100, 5, {"exercise_notes": "on the Smith"}), (1, 100, 5)])
    assert [r.exercise_title for r in got] == ["Bench (Barbell)", "Bench (Smith Machine)"]
    assert [r.equipment_mismatch for r in got] == [None, True]


def test_venue_and_load_filters(spark):
    assert progression(spark, [(0, 0, 5), (1, 100, 5, {"gym_detail": None})]) == []


def test_relative_strength_and_movement(spark):
    got = progression(
        spark,
        [(0, 100, 1), (0, 30, 1, {"exercise_title": "Single Arm Row", "equipment_category": "cable"})],
        [(day(0), Decimal("80.00"))],
    )
    assert [str(r.e1rm_per_kg_bodyweight) for r in got] == ["1.25", "0.38"]
    assert [r.movement_type for r in got] == ["bilateral", "unilateral"]
    assert [r.is_cross_gym_comparable for r in got] == [True, False]


def test_clean_measurements_and_date_mark(spark):
    schema = "measurement_date string, weight_kg string, body_fat_pct string, _loaded_at timestamp_ntz"
    loaded = datetime(2026, 1, 9)
    raw = spark.createDataFrame(
        [("2026-01-01", "80.005", "", loaded), ("nope", "81", None, loaded), ("2026-01-03", "1234", "20.1", loaded)], schema
    )
    out = {r.measurement_date: (r.weight_kg, r.body_fat_pct) for r in body.clean_measurements(raw).collect()}
    assert out == {date(2026, 1, 1): (Decimal("80.01"), None), date(2026, 1, 3): (None, Decimal("20.10"))}
    held = body.clean_measurements(raw.filter("measurement_date = '2026-01-01'"))
    assert [r.measurement_date for r in body.new_measurements(raw, held).collect()] == [date(2026, 1, 3)]
    assert body.new_measurements(raw, held.filter("1 = 0")).count() == 0


def test_weeks_and_mondays(spark):
    r = spark.createDataFrame([(date(2026, 1, 4), date(2026, 1, 5), date(2026, 1, 19))], "a date, b date, c date").select(
        casts.monday_of(F.col("a")), casts.monday_of(F.col("b")), casts.weeks_between(F.col("b"), F.col("c"))
    ).first()
    assert tuple(r) == (date(2025, 12, 29), date(2026, 1, 5), 2)
