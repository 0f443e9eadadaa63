"""Cleaning rules on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.plans.sets import GRAIN, clean_sets, refresh_sets
from tidemark.operators import quality

RAW = (
    "workout_id string, title string, start_time string, end_time string, description string, exercise_title string,"
    " superset_id string, exercise_notes string, set_index int, set_type string, weight_kg string, reps string,"
    " distance_km string, duration_seconds string, rpe string, _source string, _loaded_at timestamp_ntz"
)
LOC = "start_date date, end_date date, gym string, gym_detail string"
DIM = "title string, equipment_category string, primary_muscle_group string, secondary_muscle_groups string, is_custom boolean"


def row(**changes):
    base = dict(
        workout_id="w1", title="Push", start_time="2026-06-01T07:15:00+05:30", end_time="2026-06-01T08:15:00+05:30",
        description=None, exercise_title="Bench Press (Barbell)", superset_id=None, exercise_notes=None, set_index=0,
        set_type="normal", weight_kg="100", reps="5", distance_km=None, duration_seconds=None, rpe="8.5",
        _source="api", _loaded_at=datetime(2026, 6, 2),
    )
    assert set(changes) <= set(base)
    return tuple({**base, **changes}.values())


def clean(spark, rows, locations=(), **options):
    dim = spark.createDataFrame([("bench press (BARBELL)", "barbell", "chest", '["triceps"]', False)], DIM)
    places = spark.createDataFrame(list(locations), LOC)
    return clean_sets(spark.createDataFrame(rows, RAW), places, dim, **options)


def one(spark, **changes):
    return clean(spark, [row(**changes)]).first()


def test_same_set_loaded_twice_keeps_newest(spark):
    rows = [row(rpe="7"), row(rpe="9", _loaded_at=datetime(2026, 6, 3))]
    out = clean(spark, rows).collect()
    assert len(out) == 1 and out[0].rpe == Decimal("9.0")


def test_repeated_block_gets_occurrences(spark):
    out = clean(spark, [row(), row(weight_kg="110"), row(set_index=1)]).collect()
    assert sorted((r.set_index, r.set_occurrence) for r in out) == [(0, 1), (0, 2), (1, 1)]
    assert quality.unique(clean(spark, [row(), row(weight_kg="110")]), *GRAIN).count() == 0


def test_warmup_and_misspelt_types_are_dropped(spark):
    out = clean(spark, [row(set_type="warmup"), row(set_type="Normal"), row(set_type="dropset", set_index=3)]).collect()
    assert [r.set_type for r in out] == ["dropset"] and out[0].is_dropset


def test_both_time_forms_keep_the_wall_clock(spark):
    long = one(spark, start_time="Feb 3, 2023, 7:15 AM", end_time="Feb 3, 2023, 8:00 AM")
    assert long.start_time == datetime(2023, 2, 3, 7, 15) and long.session_duration_min == 45
    iso = one(spark)
    assert iso.start_time == datetime(2026, 6, 1, 7, 15)
    assert iso.workout_date == date(2026, 6, 1) and iso.week_start == date(2026, 6, 1)


def test_unreadable_time_gives_null(spark):
    bad = one(spark, start_time="soon")
    assert bad.start_time is None and bad.workout_date is None and bad.session_duration_min is None


def test_minutes_are_boundaries_crossed(spark):
    r = one(spark, start_time="2026-06-01T00:00:59", end_time="2026-06-01T00:01:01")
    assert r.session_duration_min == 1


def test_bad_numbers(spark):
    rows = [row(set_index=i, weight_kg=w) for i, w in enumerate(["abc", "", "12.345", "12345.6", "0"])]
    got = {r.set_index: r for r in clean(spark, rows).collect()}
    assert [got[i].weight_kg_raw for i in range(5)] == [None, None, Decimal("12.35"), None, Decimal("0.00")]
    assert got[3].weight_kg == 0 and got[3].is_unloaded_set and got[4].is_unloaded_set and not got[2].is_unloaded_set
    assert one(spark, reps="8.5").reps == 9 and one(spark, reps="x").reps == 0
    assert one(spark, reps="8.5").tonnage == Decimal("900.00")


def test_keyword_wins_over_explicit_tag(spark):
    both = dict(description="gym: Iron Den", exercise_notes="at Thrive")
    assert (one(spark, **both).gym_detail, one(spark, **both).gym) == ("thrive", "chennai")
    assert clean(spark, [row(**both)], explicit_first=True).first().gym_detail == "iron_den"


def test_tag_at_the_end_of_description(spark):
    split = dict(description="gym: iron den", exercise_notes="felt good")
    assert one(spark, **split).gym_detail == "iron_den" and one(spark, **split).gym == "other"
    assert clean(spark, [row(**split)], joined_tag_text=True).first().gym_detail == "iron_den_felt_good"


def test_range_lookup_applies_without_tag(spark):
    trip = [(date(2026, 5, 30), date(2026, 6, 1), "goa", ""), (date(2025, 1, 1), date(2025, 1, 2), "x", "y")]
    inside = clean(spark, [row()], trip).first()
    assert (inside.gym, inside.gym_detail, inside.is_gym_tagged) == ("goa", "goa", False)
    outside = clean(spark, [row(start_time="2026-06-02T07:00:00")], trip).first()
    assert outside.gym is None and outside.gym_detail is None


def test_overlapping_ranges_fan_out_and_fail_the_grain(spark):
    trips = [(date(2026, 5, 1), date(2026, 7, 1), "a", "a1"), (date(2026, 6, 1), date(2026, 6, 1), "b", "b1")]
    out = clean(spark, [row()], trips)
    assert out.count() == 2 and quality.unique(out, *GRAIN).count() == 1


def test_exercise_dimension_ignores_case(spark):
    known, unknown = one(spark), one(spark, exercise_title="Sled")
    assert (known.primary_muscle, known.equipment_category, known.is_unmapped_exercise) == ("chest", "barbell", False)
    assert (unknown.primary_muscle, unknown.is_unmapped_exercise, unknown.is_custom_exercise) == ("unknown", True, False)


def test_superset_flag(spark):
    assert one(spark, superset_id="0").is_superset and not one(spark, superset_id="").is_superset
    assert one(spark).superset_id == ""


def test_edited_set_counts_twice_unless_latest_load_only(spark):
    rows = [row(), row(weight_kg="105", _loaded_at=datetime(2026, 6, 5))]
    assert clean(spark, rows).count() == 2
    latest = clean(spark, rows, latest_load_only=True).collect()
    assert [r.weight_kg for r in latest] == [Decimal("105.00")]


def test_incremental_equals_rebuild(spark):
    rows = [
        row(), row(set_index=1),
        row(workout_id="w2", reps="3"),
        # later load: a repeated block of w1 and a new session
        row(weight_kg="90", _loaded_at=datetime(2026, 6, 9)),
        row(workout_id="w3", _loaded_at=datetime(2026, 6, 9)),
    ]
    raw = spark.createDataFrame(rows, RAW)
    places, dim = spark.createDataFrame([], LOC), spark.createDataFrame([], DIM)
    first = clean_sets(raw.filter(F.col("_loaded_at") < datetime(2026, 6, 9)), places, dim)
    after = refresh_sets(first, raw, places, dim)
    full = clean_sets(raw, places, dim)
    assert sorted(after.select(*GRAIN, "weight_kg").collect()) == sorted(full.select(*GRAIN, "weight_kg").collect())


def test_null_key_parts_are_numbered_together(spark):
    rows = [row(workout_id=None, weight_kg=str(w)) for w in (10, 20, 30)]
    plainly = clean(spark, rows).select("weight_kg", "set_occurrence").collect()
    sliced = clean(spark, rows, one_task_rows=1).select("weight_kg", "set_occurrence").collect()
    assert sorted(plainly) == sorted(sliced) == [(Decimal(w), i) for i, w in enumerate(("10.00", "20.00", "30.00"), 1)]
