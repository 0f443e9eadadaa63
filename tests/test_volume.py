"""Weekly grid, bands and balance."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators import grid
from tidemark.plans import volume
from tidemark.sources.files import default_landmarks

MONDAY = date(2026, 1, 5)
SETS = (
    "exercise_title string, primary_muscle string, secondary_muscle_groups string, workout_date date, week_start date,"
    " weight_kg decimal(6,2), reps int, tonnage decimal(18,2), is_failure_set boolean, is_unloaded_set boolean"
)


def sets(spark, rows):
    """Rows of (week number, muscle, secondary list, how many sets)."""
    out = []
    for week, muscle, secondary, n in rows:
        monday = MONDAY + timedelta(days=7 * week)
        out += [("x", muscle, secondary, monday, monday, Decimal("10"), 5, Decimal("50"), False, False)] * n
    return spark.createDataFrame(out, SETS)


def weeks(spark, rows, **options):
    out = volume.category_week(sets(spark, rows), default_landmarks(spark), **options).collect()
    return {((r.week_start - MONDAY).days // 7, r.muscle): r for r in out}


def test_grid_is_weeks_times_categories(spark):
    got = weeks(spark, [(0, "chest", None, 9), (2, "lats", None, 1)])
    assert len(got) == 2 * 21
    assert got[(2, "chest")].direct_sets == 0 and got[(2, "chest")].volume_status == "not_trained"
    assert got[(2, "chest")].weeks_since_trained == 2 and got[(0, "lats")].weeks_since_trained is None
    assert len(weeks(spark, [(0, "chest", None, 9), (2, "lats", None, 1)], calendar_weeks=True)) == 3 * 21


def test_bands_in_order(spark):
    counts = {7: "below_mev", 8: "optimal", 18: "optimal", 19: "above_mav", 22: "above_mav", 23: "above_mrv"}
    for n, band in counts.items():
        assert weeks(spark, [(0, "chest", None, n)])[(0, "chest")].volume_status == band, n
    assert weeks(spark, [(0, "cardio", None, 3)])[(0, "cardio")].volume_status == "not_tracked"
    assert weeks(spark, [(0, "adductors", None, 1)])[(0, "adductors")].volume_status == "optimal"


def test_indirect_work_counts_half_and_bad_lists_nothing(spark):
    got = weeks(spark, [(0, "chest", '["triceps", "shoulders"]', 3), (0, "lats", "not json", 1), (0, "lats", '["biceps"', 1)])
    assert (got[(0, "triceps")].indirect_sets, got[(0, "triceps")].effective_sets) == (3, Decimal("1.5"))
    assert got[(0, "biceps")].indirect_sets == 0


def test_unlisted_category_is_left_out(spark):
    got = weeks(spark, [(0, "toes", None, 3), (0, "chest", None, 1)])
    assert (0, "toes") not in got and len(got) == 21


def test_previous_week_is_null_across_a_gap(spark):
    got = weeks(spark, [(0, "chest", None, 4), (1, "chest", None, 5), (3, "chest", None, 6)])
    assert got[(0, "chest")].prev_week_sets is None
    assert (got[(1, "chest")].prev_week_sets, got[(1, "chest")].tonnage_pct_change) == (4, Decimal("25.0"))
    assert got[(3, "chest")].prev_week_sets is None and got[(3, "chest")].tonnage_pct_change is None
    assert got[(3, "chest")].sets_4wk_avg == Decimal("5.0")  # three weeks exist in the frame


def test_balance_labels(spark):
    def status(rows):
        by_category = volume.category_week(sets(spark, rows), default_landmarks(spark))
        r = volume.week_balance(by_category).first()
        return r.push_pull_status, r.quad_ham_status

    assert status([(0, "chest", None, 3)]) == ("no_pull_training", "no_hamstring_training")
    assert status([(0, "chest", None, 13), (0, "lats", None, 10), (0, "quadriceps", None, 4), (0, "hamstrings", None, 2)]) == (
        "balanced", "balanced",
    )
    assert status([(0, "chest", None, 14), (0, "lats", None, 10), (0, "quadriceps", None, 5), (0, "hamstrings", None, 2)]) == (
        "push_dominant", "quad_dominant_injury_risk",
    )
    assert status([(0, "chest", None, 6), (0, "lats", None, 10), (0, "quadriceps", None, 1), (0, "hamstrings", None, 2)]) == (
        "pull_dominant", "hamstring_dominant",
    )


def test_balance_training_days(spark):
    frame = sets(spark, [(0, "chest", None, 1), (0, "lats", None, 1)])
    moved = frame.withColumn(
        "workout_date", F.when(F.col("primary_muscle") == "lats", F.date_add("workout_date", 2)).otherwise(F.col("workout_date"))
    )
    r = volume.week_balance(volume.category_week(moved, default_landmarks(spark)), distinct_days=moved).first()
    assert (r.training_days, r.distinct_training_days) == (1, 2)


def test_long_member_list_gives_the_same_grid(spark, monkeypatch):
    periods = spark.range(7).withColumnRenamed("id", "p")
    members = spark.range(50).selectExpr("cast(id as string) as m", "id as v")
    short = grid.complete_grid(periods, members, ["m"])
    monkeypatch.setattr(grid, "INLINE_ROWS", 10)
    long = grid.complete_grid(periods, members, ["m"])
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, long.select(*short.columns).collect()))
    assert long.count() == 350 and grid.complete_grid(periods, members.limit(0), ["m"]).count() == 0


def test_days_of_a_week_fall_together_and_odd_dates_count(spark):
    days = [MONDAY, MONDAY + timedelta(days=6), MONDAY + timedelta(days=6), MONDAY - timedelta(days=1), MONDAY + timedelta(days=70)]
    rows = [("x", "chest", None, d, MONDAY, Decimal("10"), 5, Decimal("50"), False, False) for d in days]
    rows += [("x", "chest", None, d, None, Decimal("10"), 5, Decimal("50"), False, False) for d in days[:2]]
    rows += [("y", "chest", "[]", MONDAY, MONDAY, Decimal("10"), 5, Decimal("50"), False, False)]
    frame = spark.createDataFrame(rows, SETS)
    inside = volume.week_parts(frame.filter("workout_date BETWEEN week_start AND date_add(week_start, 6)"), [])
    assert inside.count() == 2  # one per exercise, not per day
    work = {r.week_start: r for r in volume.direct_work(volume.week_parts(frame, []), []).collect()}
    assert (work[MONDAY].training_days, work[MONDAY].unique_exercises, work[MONDAY].direct_sets) == (4, 2, 6)
    assert (work[None].training_days, work[None].direct_sets) == (2, 2)
    assert dict(work[MONDAY].asDict()).keys() >= {"total_reps", "max_weight_kg"} and "_days" not in work[MONDAY].asDict()
