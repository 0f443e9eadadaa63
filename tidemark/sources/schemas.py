"""Explicit schemas of the landed files and of the raw tables."""

from __future__ import annotations

from pyspark.sql import types as T

STR, INT = T.StringType(), T.IntegerType()


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in pairs])


# The 14 columns of a set export, in file order.
EXPORT_COLUMNS = [
    "title", "start_time", "end_time", "description",
    "exercise_title", "superset_id", "exercise_notes",
    "set_index", "set_type", "weight_kg", "reps",
    "distance_km", "duration_seconds", "rpe",
]

EXPORT_TEXT = _fields(*[(c, STR) for c in EXPORT_COLUMNS])

RAW_SET = _fields(
    ("workout_id", STR),
    *[(c, INT if c == "set_index" else STR) for c in EXPORT_COLUMNS],
    ("_source", STR),
)

SET_DOC = _fields(
    ("index", INT),
    ("type", STR),
    ("weight_kg", T.DoubleType()),
    ("reps", INT),
    ("distance_meters", T.DoubleType()),
    ("duration_seconds", T.LongType()),
    ("rpe", T.DoubleType()),
)
EXERCISE_DOC = _fields(
    ("title", STR),
    ("superset_id", STR),
    ("notes", STR),
    ("sets", T.ArrayType(SET_DOC)),
)
WORKOUT_DOC = _fields(
    ("id", STR),
    ("title", STR),
    ("start_time", STR),
    ("end_time", STR),
    ("description", STR),
    ("updated_at", STR),
    ("exercises", T.ArrayType(EXERCISE_DOC)),
)
EVENT_DOC = _fields(("type", STR), ("workout", WORKOUT_DOC))

TEMPLATE_DOC = _fields(
    ("id", STR),
    ("title", STR),
    ("equipment", STR),
    ("primary_muscle_group", STR),
    ("secondary_muscle_groups", T.ArrayType(STR)),
    ("is_custom", T.BooleanType()),
)
MEASUREMENT_DOC = _fields(("date", STR), ("weight_kg", T.DoubleType()), ("body_fat_percentage", T.DoubleType()))

THRESHOLD = T.DecimalType(3, 0)
LANDMARK = _fields(
    ("muscle", STR),
    ("movement_group", STR),
    ("mev_sets", THRESHOLD),
    ("mav_sets", THRESHOLD),
    ("mrv_sets", THRESHOLD),
)
