"""One clean row per working set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import (
    minutes_crossed,
    monday_of,
    text_to_decimal,
    text_to_wall_clock,
    text_to_whole,
)
from tidemark.functions.labels import first_match
from tidemark.functions.text import explicit_tag
from tidemark.operators.lookup import caseless_lookup, range_lookup
from tidemark.operators.ordering import ONE_TASK_ROWS, collapse_duplicates, gathered, number_within, oversized_groups, matching
from tidemark.session import scratch_path
from tidemark.sources.files import stage
from tidemark.sources.tables import in_folders_of, replace_groups, since_loaded

# Working set types, as spelled in the raw log.
WORKING_TYPES = ["normal", "failure", "dropset"]

# Words in the free text and the venue each stands for, first match wins.
VENUE_WORDS = [
    ("thrive", "thrive"),
    ("cult chennai", "cult_chennai"),
    ("afterburn", "cult_afterburn"),
    ("vr fitness", "vr_fitness"),
    ("nitw", "nitw_gym"),
    ("golds", "golds"),
    ("jashs", "jashs_gym"),
    ("blr", "blr_other"),
    ("pune", "pune_other"),
]

# The parent of each known venue; any other venue belongs to "other".
VENUE_PARENTS = {
    "thrive": "chennai",
    "cult_chennai": "chennai",
    "cult_afterburn": "hyd",
    "vr_fitness": "hyd",
    "nitw_gym": "hyd",
    "blr_other": "blr_other",
    "pune_other": "pune_other",
}

GRAIN = ["workout_id", "exercise_title", "set_index", "set_occurrence"]
SAME_SET = ["workout_id", "exercise_title", "set_index", "set_type", "weight_kg", "reps"]


def venue_from_text(
    tag_text: Column,
    explicit: Column,
    explicit_first: bool = False,
    venue_words: Sequence[tuple[str, str]] = tuple(VENUE_WORDS),
) -> Column:
    rules = [(tag_text.contains(word), name) for word, name in venue_words]
    if explicit_first:
        rules.insert(0, (explicit.isNotNull(), explicit))
    return first_match(rules, explicit)


def venue_parent(venue: Column, parents: Mapping[str, str] = VENUE_PARENTS) -> Column:
    known = F.create_map(*[F.lit(x) for pair in parents.items() for x in pair]) if parents else F.lit(None).cast("map<string,string>")
    return F.when(venue.isNotNull(), F.coalesce(F.try_element_at(known, venue), F.lit("other")))


def clean_sets(
    raw: DataFrame,
    locations: DataFrame,
    templates: DataFrame,
    entity: Sequence[str] = (),
    explicit_first: bool = False,
    joined_tag_text: bool = False,
    latest_load_only: bool = False,
    one_task_rows: int = ONE_TASK_ROWS,
    working_types: Sequence[str] = tuple(WORKING_TYPES),
    venue_words: Sequence[tuple[str, str]] = tuple(VENUE_WORDS),
    venue_parents: Mapping[str, str] = VENUE_PARENTS,
) -> DataFrame:
    """Working sets, deduplicated, numbered, typed and enriched.

    Decisions where the log's own conventions are ambiguous:

    * Venue words win over an explicit ``gym:`` tag unless ``explicit_first``.
    * The tag is looked up in description and notes separately, so a tag at the
      end of one does not run on into the other; ``joined_tag_text`` scans both
      as one text.
    * An edited set stays beside its original and counts twice;
      ``latest_load_only`` keeps each session's newest load instead.
    * Copies are equal in session, exercise, index, type, load and repetitions;
      other fields may differ and follow the newest load.

    ``locations`` must carry the entity columns when there are any. The set types
    that count, the venue words (first match wins) and the venues' parents are parameters.
    """
    entity = list(entity)
    working = raw.filter(F.col("set_type").isin(*working_types))
    if latest_load_only:
        newest = raw.groupBy(*entity, "workout_id").agg(F.max("_loaded_at").alias("_loaded_at"))
        working = working.join(newest, [*entity, "workout_id", "_loaded_at"], "left_semi")

    # The widest-ranging key leads, so that sorting rarely has to look past it.
    natural = ["workout_id", "exercise_title", "set_index", *entity]
    session = ["workout_id", *entity]
    oversized = None
    spread = read = _read_texts(working, entity, explicit_first, joined_tag_text, venue_words)
    if oversized_groups(working, session, one_task_rows).isEmpty():
        # One shuffle serves both steps, and a session's rows, alike in most columns, stay side by side in its files.
        spread = gathered(read, session)
    else:
        oversized = oversized_groups(working, natural, one_task_rows)
        if oversized.isEmpty():
            # Copies of a set share its natural key.
            oversized, spread = None, gathered(read, natural)
    single = collapse_duplicates(spread, [*SAME_SET, *entity], newest="_loaded_at")
    keyed = number_within(
        single,
        natural,
        [F.col(c).asc_nulls_last() for c in ("_loaded_at", "weight_kg", "reps", "set_type")],
        "set_occurrence",
        oversized,
    )
    tagged = keyed.withColumns(
        {
            "workout_date": F.to_date("start_ts"),
            "_kind": F.lower("set_type"),
            "_superset": F.coalesce("superset_id", F.lit("")),
            "_load": text_to_decimal(F.col("weight_kg"), 6, 2),
            "_reps": F.coalesce(text_to_whole(F.col("reps")), F.lit(0)),
        }
    )

    days = read.select(*entity, F.to_date("start_ts").alias("workout_date"))
    located = range_lookup(tagged, locations, "workout_date", ["gym", "gym_detail"], entity, days=days)
    mapped = caseless_lookup(
        located,
        templates,
        "exercise_title",
        "title",
        {
            "primary_muscle_group": "_muscle",
            "equipment_category": "_equipment",
            "secondary_muscle_groups": "secondary_muscle_groups",
            "is_custom": "_custom",
        },
    )
    load = F.coalesce("_load", F.lit(0).cast("decimal(6,2)"))
    return mapped.select(
        *entity,
        *GRAIN,
        F.col("title").alias("workout_title"),
        F.col("start_ts").alias("start_time"),
        F.col("end_ts").alias("end_time"),
        "workout_date",
        monday_of(F.col("workout_date")).alias("week_start"),
        F.year("start_ts").alias("year"),
        F.month("start_ts").alias("month"),
        minutes_crossed(F.col("start_ts"), F.col("end_ts")).alias("session_duration_min"),
        F.col("_kind").alias("set_type"),
        load.alias("weight_kg"),
        F.col("_load").alias("weight_kg_raw"),
        F.col("_reps").alias("reps"),
        text_to_decimal(F.col("rpe"), 4, 1).alias("rpe"),
        (load * F.col("_reps")).cast("decimal(18,2)").alias("tonnage"),
        F.col("_superset").alias("superset_id"),
        (F.col("_superset") != "").alias("is_superset"),
        (F.col("_kind") == "failure").alias("is_failure_set"),
        (F.col("_kind") == "dropset").alias("is_dropset"),
        (F.col("_load").isNull() | (F.col("_load") == 0)).alias("is_unloaded_set"),
        F.coalesce("_muscle", F.lit("unknown")).alias("primary_muscle"),
        F.coalesce("_equipment", F.lit("unknown")).alias("equipment_category"),
        "secondary_muscle_groups",
        F.coalesce("_custom", F.lit(False)).alias("is_custom_exercise"),
        F.col("_unmatched").alias("is_unmapped_exercise"),
        F.trim(F.coalesce("_venue", F.nullif("range_gym_detail", F.lit("")), "range_gym")).alias("gym_detail"),
        F.trim(F.coalesce(venue_parent(F.col("_venue"), venue_parents), "range_gym")).alias("gym"),
        F.col("_venue").isNotNull().alias("is_gym_tagged"),
        "exercise_notes",
        "_source",
        "_loaded_at",
    )


def rebuilt_sessions(
    target: DataFrame, raw: DataFrame, locations: DataFrame, templates: DataFrame, entity: Sequence[str] = (), **options
) -> tuple[DataFrame, DataFrame]:
    """(sessions with rows loaded since the last run, their clean sets).

    Each touched session is rebuilt from all its raw rows of working types, because a set's
    number depends on the session's other sets. Where the raw table lies in session folders
    (``by_session``), only those of touched sessions are read. Both the sessions and these
    rows are written once to the shared folder; what follows reads only them.
    """
    keys = [*entity, "workout_id"]
    spark = raw.sparkSession
    touched = stage(since_loaded(raw, target).select(*keys).distinct(), scratch_path(spark, "touched"))
    held = in_folders_of(raw, touched)
    if not options.get("latest_load_only"):  # that one asks all rows of a session for its newest load
        held = held.filter(F.col("set_type").isin(*options.get("working_types", WORKING_TYPES)))
    again = stage(matching(held, touched, keys, "left_semi"), scratch_path(spark, "again"))
    return touched, clean_sets(again, locations, templates, entity, **options)


def _read_texts(
    raw: DataFrame, entity: Sequence[str], explicit_first: bool, joined_tag_text: bool, venue_words: Sequence[tuple[str, str]]
) -> DataFrame:
    """Times and venue read from the texts, before any shuffle; long texts not needed later stay behind."""
    description, notes = (F.coalesce(c, F.lit("")) for c in ("description", "exercise_notes"))
    tag_text = F.lower(F.concat_ws(" ", description, notes))
    if joined_tag_text:
        explicit = explicit_tag(tag_text)
    else:
        explicit = F.coalesce(explicit_tag(F.col("description")), explicit_tag(F.col("exercise_notes")))
    return raw.select(
        *entity,
        *SAME_SET,
        "title",
        text_to_wall_clock(F.col("start_time")).alias("start_ts"),
        text_to_wall_clock(F.col("end_time")).alias("end_ts"),
        "superset_id",
        "exercise_notes",
        "rpe",
        "_source",
        "_loaded_at",
        venue_from_text(tag_text, explicit, explicit_first, venue_words).alias("_venue"),
    )


def refresh_sets(
    target: DataFrame, raw: DataFrame, locations: DataFrame, templates: DataFrame, entity: Sequence[str] = (), **options
) -> DataFrame:
    """Target after an incremental run, equal to a full rebuild."""
    touched, rebuilt = rebuilt_sessions(target, raw, locations, templates, entity, **options)
    return replace_groups(target, rebuilt, touched, [*entity, "workout_id"])
