"""The whole run: raw tables to silver to gold, and the declared checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.plans import body, load, progress, sessions, sets, volume
from tidemark.session import scratch_path
from tidemark.sources.files import stage
from tidemark.sources.tables import Catalog


@dataclass(frozen=True)
class Warehouse:
    """Builds each table on first use and keeps it: a table read by several others is computed once."""

    catalog: Catalog
    landmarks: DataFrame
    entity: tuple[str, ...] = ()

    def silver(self, name: str) -> DataFrame:
        return self.table("silver", name)

    def gold(self, name: str) -> DataFrame:
        return self.table("gold", name)

    def table(self, layer: str, name: str) -> DataFrame:
        stored = self.catalog.table(layer, name)
        if not stored.exists():
            self._write(layer, name)
        return stored.read().drop(MONTH)

    def _write(self, layer: str, name: str) -> None:
        stored = self.catalog.table(layer, name)
        if name in MONTHLY:
            # A full build writes each task's months as they lie; a shuffle of whole rows would cost more than their files.
            stored.replace(by_month(self.plan(name), MONTHLY[name]), partition_by=[MONTH], gather=False)
        else:
            stored.replace(self.plan(name))

    def plan(self, name: str) -> DataFrame:
        """The DataFrame that defines a table, on top of the tables it reads."""
        e, source = list(self.entity), self.catalog.source
        plans: dict[str, Callable[[], DataFrame]] = {
            "sets": lambda: sets.clean_sets(
                source("raw_workouts"), source("gym_locations"), source("dim_exercise_templates"), e
            ),
            "measurements": lambda: body.clean_measurements(source("raw_measurements"), e),
            "sessions": lambda: sessions.session_summary(self.silver("sets"), e),
            "bodyweight_daily": lambda: body.interpolate_daily(self.silver("sets"), self.silver("measurements"), e),
            "training_day": lambda: load.daily_load_ratio(self.silver("sets"), self.silver("bodyweight_daily"), e),
            "muscle_week": lambda: volume.category_week(self.silver("sets"), self.landmarks, e),
            "training_week": lambda: volume.week_balance(self.gold("muscle_week"), e),
            "exercise_progression": lambda: progress.progression(
                self.silver("sets"), self.silver("bodyweight_daily"), e
            ),
        }
        return plans[name]()

    def rebuild(self, names: Sequence[str] | None = None) -> None:
        """Full refresh in dependency order, one new version per table."""
        for layer, name in TABLES:
            if names is None or name in names:
                self._write(layer, name)

    def refresh(self) -> None:
        """Incremental run: sets and sessions by load time, readings by date, the rest in full.

        Touched sessions and new readings are swapped inside their months; other months of the three
        tables stay as they are. Sessions go first: the next run finds what to do by the
        newest load in the set table, so a run that dies in between is repeated.
        """
        e, source = list(self.entity), self.catalog.source
        held = self.catalog.table("silver", "sets")
        if not held.exists():
            return self.rebuild()
        # Built from the sets as they are, should it not be there yet.
        self.silver("sessions")
        keys = [*e, "workout_id"]
        touched, rebuilt = sets.rebuilt_sessions(
            self.silver("sets"), source("raw_workouts", folders=True), source("gym_locations"), source("dim_exercise_templates"), e
        )
        rebuilt = stage(rebuilt, scratch_path(rebuilt.sparkSession, "rebuilt"))
        summary = by_month(sessions.session_summary(rebuilt, e))
        self.catalog.table("silver", "sessions").swap(summary, keys, MONTH, touched)
        held.swap(by_month(rebuilt), keys, MONTH, touched)
        readings = self.catalog.table("silver", "measurements")
        fresh = body.new_measurements(source("raw_measurements"), readings.read(), e)
        readings.swap(by_month(fresh, "measurement_date"), [*e, "measurement_date"], MONTH)
        self.rebuild(["bodyweight_daily", "training_day", "muscle_week", "training_week", "exercise_progression"])


# Partition of the tables that are refreshed month by month, and their day: year and month as a number, 0 for undated rows.
MONTH = "part_month"
MONTHLY = {"sets": "workout_date", "sessions": "workout_date", "measurements": "measurement_date"}


def by_month(clean: DataFrame, day: str = "workout_date") -> DataFrame:
    month = F.year(day) * 100 + F.month(day)
    return clean.withColumn(MONTH, F.coalesce(month, F.lit(0)))


# In dependency order.
TABLES = [
    ("silver", "sets"),
    ("silver", "measurements"),
    ("silver", "sessions"),
    ("silver", "bodyweight_daily"),
    ("gold", "training_day"),
    ("gold", "muscle_week"),
    ("gold", "training_week"),
    ("gold", "exercise_progression"),
]

# The declared checks. Columns that are never NULL, ...
NOT_NULL = {
    "sets": [
        "workout_id", "exercise_title", "set_index", "set_occurrence", "workout_date", "reps", "tonnage",
        "primary_muscle", "equipment_category", "set_type",
    ],
    "sessions": ["workout_id", "workout_date", "total_sets"],
    "measurements": ["measurement_date"],
    "bodyweight_daily": ["workout_date", "bodyweight_kg"],
    "training_day": ["workout_date", "is_training_day", "daily_tonnage", "fatigue_index", "training_status"],
    "training_week": ["week_start", "total_sets", "push_pull_status", "quad_ham_status"],
    "muscle_week": ["week_start", "muscle", "movement_group", "direct_sets", "effective_sets", "volume_status"],
    "exercise_progression": [
        "workout_date", "exercise_title", "gym_detail", "estimated_1rm", "is_cross_gym_comparable",
        "progression_trend",
    ],
    "muscle_landmarks": ["muscle", "movement_group"],
}
# ... keys that are unique (per entity), ...
UNIQUE = {
    "sessions": [["workout_id"]],
    "measurements": [["measurement_date"]],
    "bodyweight_daily": [["workout_date"]],
    "training_day": [["workout_date"]],
    "training_week": [["week_start"]],
    "muscle_landmarks": [["muscle"]],
}
# ... grains that are unique (per entity), ...
GRAINS = {
    "sets": ["workout_id", "exercise_title", "set_index", "set_occurrence"],
    "muscle_week": ["week_start", "muscle"],
    "exercise_progression": ["exercise_title", "gym_detail", "workout_date"],
}
# ... and the values a label may take.
GROUPS = ["push", "pull", "legs", "core", "other"]
ACCEPTED = {
    "sets": {"set_type": ["normal", "failure", "dropset"]},
    "training_day": {"training_status": ["optimal", "overreaching", "undertraining", "insufficient_data"]},
    "training_week": {
        "push_pull_status": ["balanced", "push_dominant", "pull_dominant", "no_pull_training"],
        "quad_ham_status": ["balanced", "quad_dominant_injury_risk", "hamstring_dominant", "no_hamstring_training"],
    },
    "muscle_week": {
        "movement_group": GROUPS,
        "volume_status": ["optimal", "below_mev", "above_mav", "above_mrv", "not_trained", "not_tracked"],
    },
    "exercise_progression": {
        "progression_trend": ["improving", "plateauing", "declining", "insufficient_data"]
    },
    "muscle_landmarks": {"movement_group": GROUPS},
}
FATIGUE_RANGE = (0, 5)


def row_checks(name: str) -> dict[str, Column]:
    """Conditions that mark a bad row of a table."""
    checks = {f"not_null:{name}.{c}": F.col(c).isNull() for c in NOT_NULL.get(name, [])}
    for c, values in ACCEPTED.get(name, {}).items():
        checks[f"accepted:{name}.{c}"] = ~F.col(c).isin(*values)
    if name == "sets":
        checks["working_types:sets"] = ~F.col("set_type").isin(*sets.WORKING_TYPES)
    if name == "training_day":
        low, high = FATIGUE_RANGE
        checks["plausible:training_day"] = ~F.col("fatigue_index").between(low, high)
    return checks


def key_checks(name: str, entity: Sequence[str] = ()) -> dict[str, list[str]]:
    """The keys and grains of a table that no two rows may share."""
    own = [] if name == "muscle_landmarks" else list(entity)
    checks = {f"unique:{name}.{'+'.join(key)}": [*own, *key] for key in UNIQUE.get(name, [])}
    if name in GRAINS:
        checks[f"grain:{name}"] = [*own, *GRAINS[name]]
    return checks


def group_checks(tables: dict[str, DataFrame], entity: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Checks across rows or tables by name, as the DataFrame of what violates them."""
    return {
        "relationship:muscle_week.muscle": quality.relationship(tables["muscle_week"], "muscle", tables["muscle_landmarks"], "muscle"),
        "no_gaps:training_day": quality.no_gaps(tables["training_day"], entity, "workout_date"),
    }


def check_report(tables: dict[str, DataFrame], entity: Sequence[str] = ()) -> DataFrame:
    """Every declared check with its number of violations.

    Row checks of a table share one scan, and so do its checks on repeated keys.
    """
    parts = [quality.failing_rows(df, row_checks(name)) for name, df in tables.items() if row_checks(name)]
    parts += [quality.repeated_keys(df, key_checks(name, entity)) for name, df in tables.items() if key_checks(name, entity)]
    return reduce(DataFrame.unionByName, [*parts, quality.summary(group_checks(tables, entity))])
