"""Registered queries over the fixture tables, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.bindings import oracle as o
from tidemark.bindings import training_log as log
from tidemark.bindings.training_log import ATHLETE, read, warehouse
from tidemark.functions import casts, labels, text
from tidemark.functions.arith import percent_change, rounded_ratio
from tidemark.operators import calendar, documents, grid, lookup, ordering, quality, questions, similarity
from tidemark.plans import body, curated, load, progress, sessions, sets, volume
from tidemark.plans.warehouse import MONTH, TABLES, by_month, check_report
from tidemark.session import scratch_path
from tidemark.sources import audit, files, schemas, state, tables
from tidemark.sources import documents as feeds
from tidemark.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for engines that differ in decimal types."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
          for f in df.schema.fields]
    )


def hundredths(value: Column) -> Column:
    return value.cast("decimal(12,2)")


# ---- the products -----------------------------------------------------------------------------


EVENT_DAYS = """
event_day AS (
  SELECT user_id, CAST(ts AS DATE) AS day, sum(CAST(round(value * 100) AS BIGINT)) AS c, count(*) AS n FROM events GROUP BY 1, 2
),
event_span AS (SELECT user_id, min(day) AS a, max(day) AS b FROM event_day GROUP BY 1),
event_spine AS (
  SELECT user_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM event_span
),
event_full AS (
  SELECT s.user_id, s.day, coalesce(c, 0) AS c, coalesce(n, 0) AS n, e.day IS NOT NULL AS is_active_day
  FROM event_spine s LEFT JOIN event_day e ON s.user_id = e.user_id AND s.day = e.day
)"""


def event_rows(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select(
        "user_id", F.to_date("ts").alias("day"), hundredths(F.col("value")).alias("load")
    )


@register(
    "daily_load_ratio_events",
    o.with_(
        EVENT_DAYS,
        f"""event_roll AS (
  SELECT *, sum(c) OVER w7 AS c7, count(*) OVER w7 AS n7, sum(c) OVER w28 AS c28, count(*) OVER w28 AS n28,
    sum(n) OVER w7 AS e7, max(day) FILTER (is_active_day) OVER upto AS hit, row_number() OVER upto AS hist
  FROM event_full
  WINDOW w7 AS (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW),
    w28 AS (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 27 DAY PRECEDING AND CURRENT ROW),
    upto AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)""",
        then=f"""SELECT user_id, day, {o.whole('c')} AS daily_load, n AS daily_events, is_active_day,
  CAST(hist AS INTEGER) AS days_of_history, CAST(day - hit AS INTEGER) AS days_since_active,
  CAST(e7 AS BIGINT) AS events_last_7d, {o.rdiv('c7', 'n7 * 100', 2)} AS rolling_7d_avg,
  {o.rdiv('c28', 'n28 * 100', 2)} AS rolling_28d_avg, coalesce({o.rdiv('c7 * n28', 'c28 * n7', 2)}, 0) AS fatigue_index,
  CASE WHEN hist < 28 OR c28 = 0 THEN 'insufficient_data' WHEN 10 * c7 * n28 > 12 * c28 * n7 THEN 'overreaching'
       WHEN 10 * c7 * n28 < 8 * c28 * n7 THEN 'undertraining' ELSE 'optimal' END AS training_status
FROM event_roll""",
    ),
)
def daily_load_ratio_events(spark, d):
    return load.event_load_ratio(event_rows(spark, d), ["user_id"], "day", "load")


@register("clean_sets", o.with_(o.SETS, then=o.SETS_OUT + " FROM sets"))
def clean_sets(spark, d):
    return warehouse(spark, d).plan("sets")


@register("clean_sets_joined_tags", o.with_(o.sets_sql(joined=True), then=o.SETS_OUT + " FROM sets"))
def clean_sets_joined_tags(spark, d):
    source = warehouse(spark, d).catalog.source
    return sets.clean_sets(
        source("raw_workouts"), source("gym_locations"), source("dim_exercise_templates"), ATHLETE, joined_tag_text=True
    )


@register("session_summary", o.with_(o.SETS, o.SESSIONS, then="SELECT * FROM sessions"))
def session_summary(spark, d):
    return warehouse(spark, d).plan("sessions")


@register(
    "clean_measurements",
    o.with_(
        o.MEASUREMENTS,
        then=f"""SELECT athlete, measurement_date, {o.whole('cents')} AS weight_kg, CAST(NULL AS DOUBLE) AS body_fat_pct,
  _loaded_at FROM measurements""",
    ),
)
def clean_measurements(spark, d):
    return warehouse(spark, d).plan("measurements")


@register(
    "interpolate_daily",
    o.with_(o.SETS, o.MEASUREMENTS, o.BODY, then="SELECT * FROM body"),
)
def interpolate_daily(spark, d):
    return warehouse(spark, d).plan("bodyweight_daily")


@register(
    "interpolate_daily_events",
    o.with_(
        EVENT_DAYS,
        """er AS (
  SELECT user_id, CAST(ts AS DATE) AS day, max(CAST(round(value * 100) AS BIGINT)) FILTER (event_type = 'signup') AS v
  FROM events GROUP BY 1, 2
),
ea AS (
  SELECT s.user_id, s.day, r.v, last_value(r.v IGNORE NULLS) OVER up AS pv, last_value(CASE WHEN r.v IS NOT NULL THEN r.day END IGNORE NULLS) OVER up AS pd,
    first_value(r.v IGNORE NULLS) OVER down AS nv, first_value(CASE WHEN r.v IS NOT NULL THEN r.day END IGNORE NULLS) OVER down AS nd
  FROM event_spine s LEFT JOIN er r ON s.user_id = r.user_id AND s.day = r.day
  WINDOW up AS (PARTITION BY s.user_id ORDER BY s.day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    down AS (PARTITION BY s.user_id ORDER BY s.day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
)""",
        then=f"""SELECT user_id, day,
  CASE WHEN v IS NOT NULL THEN {o.whole('v')} WHEN pv IS NULL THEN {o.whole('nv')} WHEN nv IS NULL THEN {o.whole('pv')}
    ELSE {o.rdiv('pv * (nd - day) + nv * (day - pd)', '(nd - pd) * 100', 2)} END AS level,
  v IS NOT NULL AS is_measured, pd AS prev_reading_date, nd AS next_reading_date FROM ea""",
    ),
)
def interpolate_daily_events(spark, d):
    # Every event is a reading; only a signup has a value in it.
    level = F.when(F.col("event_type") == "signup", hundredths(F.col("value")))
    readings = read(spark, d, "events").select("user_id", F.to_date("ts").alias("at"), level.alias("level"))
    return body.interpolate_daily(
        event_rows(spark, d), readings, ["user_id"], day="day", reading_day="at", value="level", out="level"
    )


@register("daily_load_ratio", o.with_(o.SETS, o.MEASUREMENTS, o.BODY, o.DAY, then="SELECT * FROM days"))
def daily_load_ratio(spark, d):
    return warehouse(spark, d).plan("training_day")


@register("category_week", o.with_(o.SETS, o.MUSCLE_WEEK, then="SELECT * FROM muscle_weeks"))
def category_week(spark, d):
    return warehouse(spark, d).plan("muscle_week")


@register(
    "category_week_calendar",
    o.with_(
        o.SETS,
        o.MUSCLE_WEEK.replace(
            "(SELECT DISTINCT athlete, week_start FROM dated)",
            "(SELECT athlete, CAST(unnest(generate_series(min(week_start), max(week_start), INTERVAL 7 DAY)) AS DATE)"
            " AS week_start FROM dated GROUP BY 1)",
        ),
        then="SELECT * FROM muscle_weeks",
    ),
)
def category_week_calendar(spark, d):
    wh = warehouse(spark, d)
    return volume.category_week(wh.silver("sets"), wh.landmarks, ATHLETE, calendar_weeks=True)


@register("week_balance", o.with_(o.SETS, o.MUSCLE_WEEK, o.TRAINING_WEEK, then="SELECT * FROM training_weeks"))
def week_balance(spark, d):
    return warehouse(spark, d).plan("training_week")


@register(
    "week_balance_distinct_days",
    o.with_(
        o.SETS, o.MUSCLE_WEEK, o.TRAINING_WEEK,
        then="""SELECT athlete, week_start, training_days, distinct_training_days FROM training_weeks
  JOIN (SELECT athlete, week_start, count(DISTINCT workout_date) AS distinct_training_days FROM dated GROUP BY 1, 2)
  USING (athlete, week_start)""",
    ),
)
def week_balance_distinct_days(spark, d):
    wh = warehouse(spark, d)
    out = volume.week_balance(wh.gold("muscle_week"), ATHLETE, distinct_days=wh.silver("sets"))
    return out.select("athlete", "week_start", "training_days", "distinct_training_days")


@register(
    "progression", o.with_(o.SETS, o.MEASUREMENTS, o.BODY, o.progress_sql(), then="SELECT * FROM progress")
)
def progression(spark, d):
    return warehouse(spark, d).plan("exercise_progression")


_ONE_BODY = o.BODY.replace(
    "SELECT athlete, min(workout_date) AS a, max(workout_date) AS b FROM sets WHERE workout_date IS NOT NULL GROUP BY 1",
    "SELECT 0 AS athlete, min(workout_date) AS a, max(workout_date) AS b FROM sets WHERE workout_date IS NOT NULL",
).replace(
    "SELECT athlete, measurement_date AS workout_date, cents FROM measurements WHERE cents IS NOT NULL",
    "SELECT 0 AS athlete, measurement_date AS workout_date, cents FROM measurements WHERE cents IS NOT NULL",
).replace("PARTITION BY athlete, measurement_date", "PARTITION BY measurement_date")


@register(
    "progression_single_log",
    o.with_(o.SETS, o.MEASUREMENTS, _ONE_BODY, o.progress_sql(entity=False), then="SELECT * FROM progress"),
)
def progression_single_log(spark, d):
    """No entity: all rows are one person's log, series per exercise and venue."""
    wh = warehouse(spark, d)
    weight = body.interpolate_daily(wh.silver("sets"), wh.silver("measurements"))
    return progress.progression(wh.silver("sets"), weight)


# ---- curated reports --------------------------------------------------------------------------


def report_sql(days: int, limit: int, table: str, day: str, columns: str, order: str) -> str:
    """Each athlete's newest rows: reach and limit are counted for every athlete alone."""
    return f"""SELECT r.athlete, {columns} FROM {table} r
JOIN (SELECT athlete, max({day}) AS newest FROM {table} GROUP BY athlete) m ON m.athlete = r.athlete AND r.{day} >= m.newest - {days}
QUALIFY row_number() OVER (PARTITION BY r.athlete ORDER BY {order}) <= {limit}"""


_DAYS = (o.SETS, o.MEASUREMENTS, o.BODY, o.DAY)
_PROGRESS = (o.SETS, o.MEASUREMENTS, o.BODY, o.progress_sql())


@register(
    "q_fatigue",
    o.with_(*_DAYS, then=report_sql(
        30, 30, "days", "workout_date",
        "workout_date, is_training_day, gym_detail, daily_tonnage, daily_sets, days_since_last_session,"
        " rolling_7d_avg_tonnage, rolling_28d_avg_tonnage, fatigue_index, training_status",
        "workout_date DESC",
    )),
)
def q_fatigue(spark, d):
    return curated.fatigue(warehouse(spark, d).gold("training_day"), entity=ATHLETE)


@register(
    "q_volume",
    o.with_(o.SETS, o.MUSCLE_WEEK, then=report_sql(
        56, 200, "muscle_weeks", "week_start",
        "week_start, muscle, movement_group, direct_sets, indirect_sets, effective_sets, total_tonnage, mev_sets,"
        " mav_sets, volume_status, weeks_since_trained, tonnage_pct_change",
        "week_start DESC, direct_sets DESC, muscle",
    )),
)
def q_volume(spark, d):
    return curated.volume(warehouse(spark, d).gold("muscle_week"), entity=ATHLETE)


@register(
    "q_balance",
    o.with_(o.SETS, o.MUSCLE_WEEK, o.TRAINING_WEEK, then=report_sql(
        56, 12, "training_weeks", "week_start",
        "week_start, training_days, total_sets, push_sets, pull_sets, leg_sets, core_sets, push_pull_ratio,"
        " push_pull_status, quad_ham_ratio, quad_ham_status, muscles_below_mev, muscles_not_trained",
        "week_start DESC",
    )),
)
def q_balance(spark, d):
    return curated.balance(warehouse(spark, d).gold("training_week"), entity=ATHLETE)


@register(
    "q_strength",
    o.with_(*_PROGRESS, then=report_sql(
        28, 100, "progress", "workout_date",
        "workout_date, exercise_title, gym_detail, primary_muscle, top_set_weight_kg, top_set_reps, estimated_1rm,"
        " best_1rm_to_date, is_pr, days_since_pr, e1rm_pct_change_4wk, progression_trend, e1rm_per_kg_bodyweight,"
        " is_cross_gym_comparable",
        "workout_date DESC, estimated_1rm DESC, exercise_title, gym_detail, primary_muscle",
    )),
)
def q_strength(spark, d):
    return curated.strength(warehouse(spark, d).gold("exercise_progression"), entity=ATHLETE)


_BESTS = """SELECT athlete, exercise_title, gym_detail, primary_muscle, equipment_category,
  max(best_1rm_to_date) AS best_e1rm, max(top_set_weight_kg) AS heaviest_weight_kg,
  max(workout_date) FILTER (is_pr) AS last_pr_date, bool_or(is_cross_gym_comparable) AS is_cross_gym_comparable,
  count(*) AS sessions_logged FROM progress GROUP BY ALL"""


@register(
    "q_pr",
    o.with_(*_PROGRESS, f"bests AS ({_BESTS})", then="""SELECT * FROM bests QUALIFY row_number() OVER (
  PARTITION BY athlete ORDER BY best_e1rm DESC, exercise_title, gym_detail, primary_muscle, equipment_category) <= 100"""),
)
def q_pr(spark, d):
    return curated.personal_records(warehouse(spark, d).gold("exercise_progression"), entity=ATHLETE)


@register("all_time_bests", o.with_(*_PROGRESS, then=_BESTS))
def all_time_bests(spark, d):
    return progress.all_time_bests(warehouse(spark, d).gold("exercise_progression"), ATHLETE)


@register(
    "q_sessions",
    o.with_(o.SETS, o.SESSIONS, then=report_sql(
        30, 30, "sessions", "workout_date",
        "workout_date, workout_title, gym_detail, total_sets, total_exercises, muscles_trained, total_tonnage,"
        " session_duration_min, tonnage_per_min",
        "workout_date DESC, workout_title, gym_detail NULLS LAST, total_sets, total_exercises, muscles_trained,"
        " total_tonnage, session_duration_min",
    )),
)
def q_sessions(spark, d):
    return curated.sessions(warehouse(spark, d).silver("sessions"), entity=ATHLETE)


@register(
    "q_raw_sets",
    o.with_(o.SETS, "shown AS (SELECT *, " + o.whole("cents") + " AS weight_kg, " + o.whole("tonnage_c") + " AS tonnage FROM sets)",
            then=report_sql(
        7, 200, "shown", "workout_date",
        "workout_date, workout_title, gym_detail, exercise_title, primary_muscle, set_index, set_type, weight_kg, reps,"
        " tonnage",
        "workout_date DESC, exercise_title, set_index, workout_title, gym_detail NULLS LAST, primary_muscle,"
        " set_type, weight_kg, reps",
    )),
)
def q_raw_sets(spark, d):
    return curated.raw_sets(warehouse(spark, d).silver("sets"), entity=ATHLETE)


# ---- row-level operators ----------------------------------------------------------------------


_SAME = "athlete, workout_id, exercise_title, set_index, set_type, weight_kg, reps"


@register(
    "dedup_exact",
    o.with_(o.RAW, o.DEDUPED, then=f"SELECT {_SAME}, _loaded_at, rpe, _source FROM single"),
)
def dedup_exact(spark, d):
    raw = warehouse(spark, d).catalog.source("raw_workouts").filter(F.col("set_type").isin(*sets.WORKING_TYPES))
    kept = ordering.collapse_duplicates(raw, [*ATHLETE, *sets.SAME_SET], "_loaded_at")
    return kept.select(*ATHLETE, *sets.SAME_SET, "_loaded_at", "rpe", "_source")


_OCCURRENCE = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
  CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS INTEGER) AS occurrence FROM lineitem"""


def _occurrences(spark, d, oversized=None):
    lines = read(spark, d, "lineitem")
    order = [F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")]
    keys = ["l_orderkey", "l_linenumber"]
    out = ordering.number_within(lines, keys, order, "occurrence", oversized(lines, keys) if oversized else None)
    return out.select(*keys, "l_partkey", "l_suppkey", "l_shipdate", "occurrence")


@register("set_occurrence", _OCCURRENCE)
def set_occurrence(spark, d):
    return _occurrences(spark, d, lambda df, keys: ordering.oversized_groups(df, keys))


@register("set_occurrence_sliced", _OCCURRENCE)
def set_occurrence_sliced(spark, d):
    """The same with every repeated key treated as too large for one task."""
    return _occurrences(spark, d, lambda df, keys: ordering.oversized_groups(df, keys, limit=2, fraction=1.0))


@register(
    "running_number_by_status",
    """SELECT o_orderkey, o_orderstatus, CAST(row_number() OVER (PARTITION BY o_orderstatus
  ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS n FROM orders""",
)
def running_number_by_status(spark, d):
    """Three groups hold all rows: each is numbered in ranges, not by one task."""
    rows = read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    out = ordering.number_within(
        rows, ["o_orderstatus"], [F.col("o_orderdate"), F.col("o_orderkey")], "n",
        ordering.oversized_groups(rows, ["o_orderstatus"], limit=1000, fraction=1.0),
    )
    return out.select("o_orderkey", "o_orderstatus", "n")


@register(
    "typed_parse",
    o.with_(o.RAW, then="""SELECT athlete, workout_id, set_index, weight_kg AS weight_text, reps AS reps_text,
  start_ts, end_ts, CAST(start_ts AS DATE) AS workout_date, CAST(date_trunc('week', start_ts) AS DATE) AS week_start,
  CAST(year(start_ts) AS INTEGER) AS year, CAST(month(start_ts) AS INTEGER) AS month,
  date_diff('minute', start_ts, end_ts) AS minutes, CAST(TRY_CAST(weight_kg AS DECIMAL(6,2)) AS DOUBLE) AS weight,
  TRY_CAST(reps AS INTEGER) AS reps, CAST(TRY_CAST(rpe AS DECIMAL(4,1)) AS DOUBLE) AS rpe FROM raw"""),
)
def typed_parse(spark, d):
    raw = warehouse(spark, d).catalog.source("raw_workouts")
    timed = raw.withColumns(
        {
            "start_ts": casts.text_to_wall_clock(F.col("start_time")),
            "end_ts": casts.text_to_wall_clock(F.col("end_time")),
        }
    )
    return timed.select(
        "athlete", "workout_id", "set_index",
        F.col("weight_kg").alias("weight_text"),
        F.col("reps").alias("reps_text"),
        "start_ts", "end_ts",
        F.to_date("start_ts").alias("workout_date"),
        casts.monday_of(F.to_date("start_ts")).alias("week_start"),
        F.year("start_ts").alias("year"),
        F.month("start_ts").alias("month"),
        casts.minutes_crossed(F.col("start_ts"), F.col("end_ts")).alias("minutes"),
        casts.text_to_decimal(F.col("weight_kg"), 6, 2).alias("weight"),
        casts.text_to_whole(F.col("reps")).alias("reps"),
        casts.text_to_decimal(F.col("rpe"), 4, 1).alias("rpe"),
    )


_TAG_TEXT = "coalesce(description, '') || ' ' || coalesce(exercise_notes, '')"
_WORDS = " ".join(f"WHEN contains(lower({_TAG_TEXT}), {o.q(w)}) THEN {o.q(v)}" for w, v in o.VENUE_WORDS)
_PARENT = o.case("venue", o.VENUE_PARENTS.items(), "CASE WHEN venue IS NOT NULL THEN 'other' END")


@register(
    "tag_extract",
    o.with_(
        o.RAW,
        f"""tagged AS (SELECT *, coalesce({o.tag('description')}, {o.tag('exercise_notes')}) AS explicit FROM raw),
resolved AS (SELECT *, CASE {_WORDS} ELSE explicit END AS venue,
  coalesce(explicit, CASE {_WORDS} END) AS venue_explicit_first FROM tagged)""",
        then=f"""SELECT description, exercise_notes, explicit, venue, venue_explicit_first, {_PARENT} AS parent, count(*) AS n
  FROM resolved GROUP BY ALL""",
    ),
)
def tag_extract(spark, d):
    raw = warehouse(spark, d).catalog.source("raw_workouts")
    joined = F.lower(F.concat_ws(" ", F.coalesce("description", F.lit("")), F.coalesce("exercise_notes", F.lit(""))))
    explicit = F.coalesce(text.explicit_tag(F.col("description")), text.explicit_tag(F.col("exercise_notes")))
    tagged = raw.withColumn("explicit", explicit)
    resolved = tagged.withColumns(
        {
            "venue": sets.venue_from_text(joined, F.col("explicit")),
            "venue_explicit_first": sets.venue_from_text(joined, F.col("explicit"), explicit_first=True),
        }
    ).withColumn("parent", sets.venue_parent(F.col("venue")))
    keys = ["description", "exercise_notes", "explicit", "venue", "venue_explicit_first", "parent"]
    return resolved.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@register(
    "range_lookup",
    o.with_(o.LOCATIONS, then="""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, l.gym AS range_gym,
  l.gym_detail AS range_gym_detail FROM orders JOIN customer ON o_custkey = c_custkey
  LEFT JOIN locations l ON c_nationkey = l.athlete AND CAST(o_orderdate AS DATE) BETWEEN l.start_date AND l.end_date"""),
)
def range_lookup(spark, d):
    customer = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("bigint").alias("athlete"))
    facts = read(spark, d, "orders").join(customer, "o_custkey").select("o_orderkey", F.to_date("o_orderdate").alias("day"), "athlete")
    out = lookup.range_lookup(facts, log.locations(spark, d), "day", ["gym", "gym_detail"], ATHLETE)
    return out.drop("athlete")


@register(
    "range_lookup_overlapping",
    """WITH r AS (
  SELECT p_brand, CAST(min(o_orderdate) AS DATE) + p_size * 3 AS a, CAST(min(o_orderdate) AS DATE) + p_size * 40 AS b
  FROM part, (SELECT min(o_orderdate) AS o_orderdate FROM orders) GROUP BY p_brand, p_size)
SELECT o_orderdate AS ts, p_brand AS brand, count(*) AS n
FROM orders LEFT JOIN r ON CAST(o_orderdate AS DATE) BETWEEN a AND b GROUP BY 1, 2""",
)
def range_lookup_overlapping(spark, d):
    """Many long ranges that overlap, per part brand and size."""
    orders = read(spark, d, "orders")
    first = orders.agg(F.to_date(F.min("o_orderdate"))).first()[0]
    ranges = read(spark, d, "part").select("p_brand", "p_size").distinct().select(
        F.col("p_brand").alias("brand"),
        F.date_add(F.lit(first), F.col("p_size") * 3).alias("start_date"),
        F.date_add(F.lit(first), F.col("p_size") * 40).alias("end_date"),
    )
    days = orders.groupBy(F.col("o_orderdate").alias("ts")).agg(F.count(F.lit(1)).alias("w"))
    found = lookup.range_lookup(days.withColumn("day", F.to_date("ts")), ranges, "day", ["brand"])
    return found.groupBy("ts", F.col("range_brand").alias("brand")).agg(F.sum("w").alias("n"))


@register(
    "dim_lookup_ci",
    o.with_(o.TEMPLATES, then=f"""SELECT p_partkey, {o.EXERCISE} AS exercise_title,
  coalesce(primary_muscle_group, 'unknown') AS muscle, coalesce(equipment_category, 'unknown') AS equipment,
  t.title IS NULL AS is_unmapped, coalesce(equipment_category IN ('barbell', 'dumbbell', 'kettlebell'), FALSE) AS is_free_weight
  FROM part LEFT JOIN templates t ON lower({o.EXERCISE}) = lower(t.title)"""),
)
def dim_lookup_ci(spark, d):
    facts = read(spark, d, "part").select("p_partkey", log.exercise(F.col("p_name"), F.col("p_type")).alias("exercise_title"))
    take = {"primary_muscle_group": "_muscle", "equipment_category": "_gear"}
    out = lookup.caseless_lookup(facts, log.templates(spark, d), "exercise_title", "title", take)
    return out.select(
        "p_partkey", "exercise_title",
        F.coalesce("_muscle", F.lit("unknown")).alias("muscle"),
        F.coalesce("_gear", F.lit("unknown")).alias("equipment"),
        F.col("_unmatched").alias("is_unmapped"),
        F.coalesce(F.col("_gear").isin(*progress.FREE_WEIGHTS), F.lit(False)).alias("is_free_weight"),
    )


# ---- calendar operators -----------------------------------------------------------------------

_NATION_DAY = """
nd AS (
  SELECT c_nationkey AS nation, CAST(o_orderdate AS DATE) AS day, count(*) AS n,
    sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS c
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
)"""


def nation_days(spark: SparkSession, d: str) -> DataFrame:
    customer = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    return (
        read(spark, d, "orders")
        .join(customer, "o_custkey")
        .groupBy("nation", F.to_date("o_orderdate").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(hundredths(F.col("o_totalprice"))).alias("total"))
    )


@register(
    "calendar_spine",
    o.with_(_NATION_DAY, then="""SELECT nation, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
  FROM nd GROUP BY nation"""),
)
def calendar_spine(spark, d):
    return calendar.calendar_spine(nation_days(spark, d), ["nation"], "day")


@register(
    "day_bounds",
    o.with_(_NATION_DAY, then="SELECT nation, min(day) AS first_day, max(day) AS last_day FROM nd GROUP BY nation"),
)
def day_bounds(spark, d):
    return calendar.day_bounds(nation_days(spark, d), ["nation"], "day")


@register(
    "calendar_windows",
    o.with_(_NATION_DAY, then=f"""SELECT nation, day, n,
  CAST(sum(n) OVER (PARTITION BY nation ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS n_7d,
  {o.rdiv('sum(c) OVER (PARTITION BY nation ORDER BY day RANGE BETWEEN INTERVAL 35 DAY PRECEDING AND INTERVAL 21 DAY PRECEDING)',
          '(100 * count(*) OVER (PARTITION BY nation ORDER BY day RANGE BETWEEN INTERVAL 35 DAY PRECEDING AND INTERVAL 21 DAY PRECEDING))', 2)}
    AS avg_month_ago,
  {o.whole('max(c) OVER (PARTITION BY nation ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS best_to_date,
  count(*) OVER (PARTITION BY nation) AS days_logged,
  CAST(day - max(day) FILTER (n >= 3) OVER (PARTITION BY nation ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    AS INTEGER) AS days_since_busy,
  CASE WHEN lag(day) OVER (PARTITION BY nation ORDER BY day) = day - 1 THEN lag(n) OVER (PARTITION BY nation ORDER BY day) END
    AS n_day_before
FROM nd"""),
)
def calendar_windows(spark, d):
    """Trailing, offset, running and since-last windows over days with gaps."""
    e = ["nation"]
    w = calendar.series_window(e, F.unix_date("day"))
    ago = calendar.calendar_frame(e, "day", -35, -21)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return nation_days(spark, d).select(
        "nation", "day", "n",
        F.sum("n").over(calendar.calendar_frame(e, "day", -6, 0)).alias("n_7d"),
        F.sum("total").over(ago).alias("_s"),
        F.count(F.lit(1)).over(ago).alias("_n"),
        F.max("total").over(so_far).alias("best_to_date"),
        F.count(F.lit(1)).over(Window.partitionBy(*e)).alias("days_logged"),
        F.datediff("day", calendar.latest_hit(F.col("n") >= 3, F.col("day"), w)).alias("days_since_busy"),
        calendar.previous_period({"n": "n_day_before"}, e, "day", 1)["n_day_before"].alias("n_day_before"),
    ).select(
        "nation", "day", "n", "n_7d", rounded_ratio(F.col("_s"), F.col("_n"), 2).alias("avg_month_ago"),
        "best_to_date", "days_logged", "days_since_busy", "n_day_before",
    )


@register(
    "previous_week",
    o.with_(_NATION_DAY, """nw AS (
  SELECT nation, CAST(date_trunc('week', day) AS DATE) AS week_start, CAST(sum(c) AS BIGINT) AS c FROM nd GROUP BY 1, 2
)""", then=f"""SELECT a.nation, a.week_start, {o.whole('a.c')} AS total, {o.whole('b.c')} AS prev_total,
  {o.rdiv('(a.c - b.c) * 100', 'b.c', 1)} AS pct_change
  FROM nw a LEFT JOIN nw b ON a.nation = b.nation AND b.week_start = a.week_start - 7"""),
)
def previous_week(spark, d):
    weeks = nation_days(spark, d).groupBy("nation", casts.monday_of(F.col("day")).alias("week_start")).agg(
        F.sum("total").alias("total")
    )
    before = calendar.previous_period({"total": "prev_total"}, ["nation"], "week_start", 7)
    return weeks.withColumns(before).withColumn("pct_change", percent_change(F.col("total"), F.col("prev_total")))


@register(
    "complete_grid",
    """WITH w AS (SELECT DISTINCT CAST(date_trunc('week', CAST(ts AS DATE)) AS DATE) AS week_start FROM events),
m AS (SELECT DISTINCT p_name AS member, p_brand AS brand FROM part),
f AS (SELECT p_name AS member, p_brand AS brand, count(*) AS n FROM part GROUP BY 1, 2)
SELECT week_start, member, brand, coalesce(n, 0) AS n FROM w CROSS JOIN m LEFT JOIN f USING (member, brand)""",
)
def complete_grid(spark, d):
    weeks = read(spark, d, "events").select(casts.monday_of(F.to_date("ts")).alias("week_start")).distinct()
    part = read(spark, d, "part").select(F.col("p_name").alias("member"), F.col("p_brand").alias("brand"))
    facts = part.groupBy("member", "brand").agg(F.count(F.lit(1)).alias("n"))
    cells = grid.complete_grid(weeks, part.distinct(), ["member", "brand"])
    return cells.join(facts, ["member", "brand"], "left").select(
        "week_start", "member", "brand", F.coalesce("n", F.lit(0)).alias("n")
    )


@register(
    "label_bands",
    f"""WITH b AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER) AS reps,
    CAST(round(l_extendedprice * 100) AS BIGINT) // 100 AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, reps, {o.whole('c')} AS load,
  CAST(CASE WHEN reps = 1 THEN c WHEN reps <= 10 THEN (2 * c * (30 + reps) + 30) // 60
       WHEN reps <= 20 THEN (2 * c * (36 + reps) + 36) // 72 END AS DOUBLE) / 100 AS e1rm,
  CASE WHEN reps < 8 THEN 'below_mev' WHEN reps > 30 THEN 'above_mrv' WHEN reps > 20 THEN 'above_mav' ELSE 'optimal' END
    AS volume_status FROM b""",
)
def label_bands(spark, d):
    cents = F.floor(hundredths(F.col("l_extendedprice")))
    return read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("int").alias("reps"),
        (cents / F.lit(100).cast("decimal(3,0)")).cast("decimal(14,2)").alias("load"),
    ).withColumns(
        {
            "e1rm": labels.one_rep_max(F.col("load"), F.col("reps")),
            "volume_status": labels.volume_status(F.col("reps"), F.lit(8), F.lit(20), F.lit(30)),
        }
    )


# ---- data quality -----------------------------------------------------------------------------


@register(
    "dq_not_null",
    o.with_(o.SETS, then="""SELECT athlete, workout_id, exercise_title, set_index, set_occurrence FROM sets
  WHERE workout_date IS NULL"""),
)
def dq_not_null(spark, d):
    bad = quality.not_null(warehouse(spark, d).silver("sets"), "workout_date")
    return bad.select("athlete", "workout_id", "exercise_title", "set_index", "set_occurrence")


@register(
    "dq_unique",
    o.with_(o.MEASUREMENTS, then="""SELECT athlete, measurement_date, count(*) AS n FROM measurements
  GROUP BY 1, 2 HAVING count(*) > 1"""),
)
def dq_unique(spark, d):
    return quality.unique(warehouse(spark, d).silver("measurements"), "athlete", "measurement_date")


@register(
    "dq_unique_single",
    "SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
)
def dq_unique_single(spark, d):
    return quality.unique(read(spark, d, "lineitem"), "l_partkey")


@register(
    "dq_accepted_values",
    o.with_(o.RAW, then="""SELECT set_type, count(*) AS n FROM raw
  WHERE set_type NOT IN ('normal', 'failure', 'dropset') GROUP BY 1"""),
)
def dq_accepted_values(spark, d):
    raw = warehouse(spark, d).catalog.source("raw_workouts")
    return quality.accepted_values(raw, "set_type", sets.WORKING_TYPES)


@register(
    "dq_relationships",
    "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def dq_relationships(spark, d):
    child = read(spark, d, "documents").select("doc_id", "lang")
    return quality.relationship(child, "doc_id", read(spark, d, "labels"), "doc_id")


@register(
    "dq_grain_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def dq_grain_unique(spark, d):
    return quality.unique(read(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@register(
    "dq_no_forbidden_types",
    o.with_(o.SETS, then="""SELECT set_type, count(*) AS n FROM sets
  WHERE set_type NOT IN ('normal', 'failure', 'dropset') GROUP BY 1"""),
)
def dq_no_forbidden_types(spark, d):
    return quality.accepted_values(warehouse(spark, d).silver("sets"), "set_type", sets.WORKING_TYPES)


@register(
    "dq_spine_gaps",
    o.with_(_NATION_DAY, then="""SELECT * FROM (SELECT nation, day, lag(day) OVER (PARTITION BY nation ORDER BY day) AS prev_date,
  CAST(day - lag(day) OVER (PARTITION BY nation ORDER BY day) AS INTEGER) AS gap_days FROM nd) WHERE gap_days <> 1"""),
)
def dq_spine_gaps(spark, d):
    """Order days without a spine: the check has to report every gap."""
    return quality.no_gaps(nation_days(spark, d), ["nation"], "day")


@register(
    "dq_plausible_ratio",
    o.with_(*_DAYS, then="""SELECT athlete, workout_date, fatigue_index FROM days
  WHERE fatigue_index < 0.5::DOUBLE OR fatigue_index > 2"""),
)
def dq_plausible_ratio(spark, d):
    days = warehouse(spark, d).gold("training_day")
    return quality.in_range(days, "fatigue_index", 0.5, 2, keep=["athlete", "workout_date"])


def _suite_sql() -> str:
    """Each declared check counted straight from the tables' SQL."""
    from tidemark.plans import warehouse as w

    table = {
        "sets": "sets", "sessions": "sessions", "measurements": "measurements", "bodyweight_daily": "body",
        "training_day": "days", "training_week": "training_weeks", "muscle_week": "muscle_weeks",
        "exercise_progression": "progress", "muscle_landmarks": "landmarks",
    }
    renamed = {"tonnage": "tonnage_c"}
    one = lambda name, t, where: f"SELECT {o.q(name)} AS check_name, count(*) AS violations FROM {t} WHERE {where}"
    parts = [
        one(f"not_null:{n}.{c}", table[n], f"{renamed.get(c, c)} IS NULL") for n, cols in w.NOT_NULL.items() for c in cols
    ]
    for n, rules in w.ACCEPTED.items():
        for c, values in rules.items():
            parts.append(one(f"accepted:{n}.{c}", table[n], f"{c} NOT IN ({', '.join(map(o.q, values))})"))
    parts.append(one("working_types:sets", "sets", "set_type NOT IN ('normal', 'failure', 'dropset')"))
    parts.append(one("plausible:training_day", "days", "fatigue_index < 0 OR fatigue_index > 5"))
    grouped = [(f"unique:{n}.{'+'.join(k)}", n, k) for n, keys in w.UNIQUE.items() for k in keys]
    grouped += [(f"grain:{n}", n, k) for n, k in w.GRAINS.items()]
    for name, n, key in grouped:
        columns = ", ".join(([] if n == "muscle_landmarks" else ["athlete"]) + key)
        parts.append(one(name, f"(SELECT 1 FROM {table[n]} GROUP BY {columns} HAVING count(*) > 1)", "TRUE"))
    parts.append(one("relationship:muscle_week.muscle", "muscle_weeks", "muscle NOT IN (SELECT muscle FROM landmarks)"))
    parts.append(one(
        "no_gaps:training_day",
        "(SELECT workout_date - lag(workout_date) OVER (PARTITION BY athlete ORDER BY workout_date) AS gap FROM days)",
        "gap <> 1",
    ))
    base = (o.SETS, o.SESSIONS, o.MEASUREMENTS, o.BODY, o.DAY, o.MUSCLE_WEEK, o.TRAINING_WEEK, o.progress_sql())
    return o.with_(*base, then=" UNION ALL ".join(parts))


@register("dq_suite", _suite_sql())
def dq_suite(spark, d):
    """All declared checks over all tables: name and number of violations."""
    wh = warehouse(spark, d)
    held = {name: wh.table(layer, name) for layer, name in TABLES}
    return check_report({**held, "muscle_landmarks": wh.landmarks}, ATHLETE)


# ---- files, tables and change capture ---------------------------------------------------------


def export_rows(spark: SparkSession, d: str) -> DataFrame:
    """Order lines in the 14 columns of a set export, with texts that need quoting and NULL texts."""
    # Both grow with the log, so neither is broadcast: the lines land in the order of their sessions at any size.
    line, order = read(spark, d, "lineitem"), read(spark, d, "orders")
    joined = line.join(order.hint("merge"), line.l_orderkey == order.o_orderkey)
    return joined.select(
        F.concat(F.lit('say "'), F.col("o_orderpriority"), F.lit('", twice')).alias("title"),
        F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd").alias("start_time"),
        F.lit("NULL").alias("end_time"),
        F.when(F.col("l_returnflag") == "A", "null").otherwise(F.col("l_returnflag")).alias("description"),
        F.col("l_partkey").cast("string").alias("exercise_title"),
        F.lit("").alias("superset_id"),
        F.col("l_linestatus").alias("exercise_notes"),
        F.when(F.col("l_returnflag") == "N", "first").otherwise(F.col("l_linenumber").cast("string")).alias("set_index"),
        F.lit("normal").alias("set_type"),
        F.col("l_suppkey").cast("string").alias("weight_kg"),
        F.col("l_quantity").cast("int").cast("string").alias("reps"),
        F.lit("").alias("distance_km"),
        F.lit("").alias("duration_seconds"),
        F.col("l_orderkey").cast("string").alias("rpe"),
    )


def _with_broken_lines(spark: SparkSession, d: str, path: str, line: Column, header: str | None = None) -> None:
    """One unreadable line per nation, in a file of their own next to the good ones."""
    lines = read(spark, d, "nation").select(line.alias("value")).coalesce(1)
    if header:
        lines = spark.createDataFrame([(header,)], "value string").unionByName(lines).coalesce(1)
    lines.write.mode("append").text(path)


def landed_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    export_rows(spark, d).write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    _with_broken_lines(
        spark, d, path, F.concat(F.lit("broken,"), F.col("n_name")), ",".join(schemas.EXPORT_COLUMNS)
    )
    return files.stage(files.load_csv(spark, path), scratch_path(spark, "staged"))


@register(
    "load_csv",
    """SELECT 'say "' || o_orderpriority || '", twice' AS title, strftime(o_orderdate, '%Y-%m-%d') AS start_time,
  CAST(NULL AS VARCHAR) AS end_time, CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS description,
  CAST(l_partkey AS VARCHAR) AS exercise_title, CAST(NULL AS VARCHAR) AS superset_id, l_linestatus AS exercise_notes,
  CASE WHEN l_returnflag <> 'N' THEN l_linenumber END AS set_index, 'normal' AS set_type,
  CAST(l_suppkey AS VARCHAR) AS weight_kg, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS reps,
  CAST(NULL AS VARCHAR) AS distance_km, CAST(NULL AS VARCHAR) AS duration_seconds, CAST(l_orderkey AS VARCHAR) AS rpe,
  'csv' AS _source FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def load_csv(spark, d):
    return files.good_rows(landed_csv(spark, d))


_AUDIT = """SELECT 'partially_loaded' AS status, {n} + b AS rows_parsed, {n} AS rows_loaded, b AS errors_seen,
  first_error FROM (SELECT count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  (SELECT count(*) AS b, min({line}) AS first_error FROM nation)"""


@register("load_audit_csv", _AUDIT.format(n="n", line="'broken,' || n_name"))
def load_audit_csv(spark, d):
    return audit.audit(landed_csv(spark, d))


def landed_jsonl(spark: SparkSession, d: str) -> DataFrame:
    rows = export_rows(spark, d).select(
        F.col("rpe").alias("workout_id"),
        *[F.col(c).try_cast("int").alias(c) if c == "set_index" else F.col(c) for c in schemas.EXPORT_COLUMNS],
        F.lit("api").alias("_source"),
    )
    path = files.write_jsonl(rows, scratch_path(spark, "jsonl"), "20260101_000000")
    _with_broken_lines(spark, d, path, F.concat(F.lit('{"workout_id": "'), F.col("n_name")))
    return files.stage(files.load_jsonl(spark, path), scratch_path(spark, "staged"))


@register(
    "load_jsonl",
    """SELECT CAST(l_orderkey AS VARCHAR) AS workout_id, 'say "' || o_orderpriority || '", twice' AS title,
  strftime(o_orderdate, '%Y-%m-%d') AS start_time, CAST(l_partkey AS VARCHAR) AS exercise_title,
  CASE WHEN l_returnflag <> 'N' THEN l_linenumber END AS set_index, CAST(l_suppkey AS VARCHAR) AS weight_kg,
  CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS reps, 'api' AS _source
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def load_jsonl(spark, d):
    return files.good_rows(landed_jsonl(spark, d)).select(
        "workout_id", "title", "start_time", "exercise_title", "set_index", "weight_kg", "reps", "_source"
    )


@register("load_audit", _AUDIT.format(n="n", line="'{\"workout_id\": \"' || n_name"))
def load_audit(spark, d):
    return audit.audit(landed_jsonl(spark, d))


@register(
    "post_load_verify",
    """SELECT (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS total_rows,
  'say "' || o_orderpriority || '", twice' AS title FROM (SELECT DISTINCT o_orderpriority FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey) ORDER BY 2""",
)
def post_load_verify(spark, d):
    total, titles = audit.verify(files.good_rows(landed_csv(spark, d)))
    return titles.withColumn("total_rows", F.lit(total.first()[0]).cast("bigint"))


def workout_docs(spark: SparkSession, d: str) -> DataFrame:
    """Orders as nested workouts: one exercise per part, one set per line."""
    # One shuffle brings a workout's lines together for both groupings and the join.
    line = read(spark, d, "lineitem").repartition("l_orderkey")
    per_exercise = line.groupBy("l_orderkey", "l_partkey").agg(
        F.collect_list(
            F.struct(
                F.col("l_linenumber").alias("index"),
                F.lower("l_returnflag").alias("type"),
                F.col("l_extendedprice").alias("weight_kg"),
                F.col("l_quantity").cast("int").alias("reps"),
                (F.col("l_suppkey") % 5 * 125).cast("double").alias("distance_meters"),
                (F.col("l_suppkey") % 3 * 60).alias("duration_seconds"),
                F.when(F.col("l_tax") > 0, F.lit(7.5)).otherwise(F.lit(0.0)).alias("rpe"),
            )
        ).alias("sets")
    )
    per_order = per_exercise.groupBy("l_orderkey").agg(
        F.collect_list(
            F.struct(
                F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("title"),
                (F.col("l_partkey") % 3).cast("string").alias("superset_id"),
                F.lit(None).cast("string").alias("notes"),
                "sets",
            )
        ).alias("exercises")
    )
    order = read(spark, d, "orders")
    stamp = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return order.join(per_order, order.o_orderkey == per_order.l_orderkey).select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("title"),
        stamp.alias("start_time"),
        stamp.alias("end_time"),
        F.lit(None).cast("string").alias("description"),
        stamp.alias("updated_at"),
        "exercises",
        "o_orderstatus",
    )


_FLAT = """SELECT CAST(l_orderkey AS VARCHAR) AS workout_id, o_orderpriority AS title,
  'part ' || CAST(l_partkey AS VARCHAR) AS exercise_title, CAST(l_partkey % 3 AS VARCHAR) AS superset_id,
  l_linenumber AS set_index, lower(l_returnflag) AS set_type, CAST(l_quantity AS INTEGER) AS reps,
  l_extendedprice AS weight, CASE WHEN l_suppkey % 5 > 0 THEN (l_suppkey % 5) * 125 / 1000::DOUBLE END AS km,
  CASE WHEN l_suppkey % 3 > 0 THEN (l_suppkey % 3) * 60 END AS seconds, CASE WHEN l_tax > 0 THEN 7.5::DOUBLE END AS rpe
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def flat_view(rows: DataFrame) -> DataFrame:
    return rows.select(
        "workout_id", "title", "exercise_title", "superset_id", "set_index", "set_type",
        F.col("reps").cast("int").alias("reps"),
        F.col("weight_kg").cast("double").alias("weight"),
        F.col("distance_km").cast("double").alias("km"),
        F.col("duration_seconds").cast("bigint").alias("seconds"),
        F.col("rpe").cast("double").alias("rpe"),
    )


@register("nested_flatten", _FLAT)
def nested_flatten(spark, d):
    return flat_view(feeds.flatten_workouts(workout_docs(spark, d)))


@register(
    "fallback_sync",
    _FLAT + " WHERE o_orderdate > (SELECT max(o_orderdate) - INTERVAL 365 DAY FROM orders)",
)
def fallback_sync(spark, d):
    last = read(spark, d, "orders").agg(F.max("o_orderdate") - F.expr("interval 365 days")).first()[0]
    return flat_view(ingest.fallback_sync(workout_docs(spark, d), last))


def landed_events(spark: SparkSession, d: str) -> str:
    docs = workout_docs(spark, d)
    kind = F.when(F.col("o_orderstatus") == "F", "deleted").otherwise("updated")
    events = docs.select(kind.alias("type"), F.struct(*[c for c in docs.columns if c != "o_orderstatus"]).alias("workout"))
    path = scratch_path(spark, "landing")
    events.write.option("maxRecordsPerFile", files.FILE_ROWS).json(path, compression="gzip")
    return path


@register("stream_ingest", _FLAT + " WHERE o_orderstatus <> 'F'")
def stream_ingest(spark, d):
    """Landed change events through the file stream into the raw table, run twice."""
    landing = landed_events(spark, d)
    base = scratch_path(spark, "sync")
    bronze = tables.Table(spark, f"{base}/raw_workouts")
    held = state.SyncState(spark, f"{base}/state")
    for hour in (1, 2):  # the second run finds nothing new
        ingest.run_sync(
            spark, landing, bronze, held, f"{base}/checkpoint", datetime(2026, 1, 1, hour, tzinfo=timezone.utc)
        )
    return flat_view(bronze.read())


@register(
    "window_sync",
    _FLAT + " WHERE o_orderdate > (SELECT max(o_orderdate) - INTERVAL 366 DAY FROM orders)",
)
def window_sync(spark, d):
    """Three windows of change times: a first run of 7 days back, a long one and an empty one."""
    # Built once: each window reads the workouts twice, to see whether any changed and to load them.
    docs = files.stage(workout_docs(spark, d), scratch_path(spark, "workouts"))
    last = read(spark, d, "orders").agg(F.max("o_orderdate")).first()[0]
    base = scratch_path(spark, "window")
    bronze = tables.Table(spark, f"{base}/raw_workouts")
    held = state.SyncState(spark, f"{base}/state")
    moments = [last - timedelta(days=359), last + timedelta(days=1), last + timedelta(days=2)]
    for now in moments:
        changed_by_then = docs.filter(F.try_to_timestamp("updated_at") <= F.lit(now))
        ingest.run_window_sync(changed_by_then, bronze, held, now)
    return flat_view(bronze.read())


REPEAT_FEEDS = """WITH feed AS (
  SELECT event_id, TIMESTAMP '2026-01-01' + to_seconds(event_id % 3600) AS sent, event_id % 4 AS part FROM events
)
SELECT event_id, sent, 1 AS feed FROM feed WHERE part IN (0, 1) UNION ALL
SELECT event_id, sent + INTERVAL 1 HOUR, 2 FROM feed WHERE part = 2 UNION ALL
SELECT event_id, sent + INTERVAL 5 DAY, 3 FROM feed WHERE part = 3 UNION ALL
SELECT event_id, sent + INTERVAL 10 DAY, 4 FROM feed WHERE part = 1"""


@register("stream_dedup", REPEAT_FEEDS)
def stream_dedup(spark, d):
    """Four feeds of one stream: repeats an hour later are dropped, repeats ten days later are beyond the delay and come through."""
    sent = F.lit(datetime(2026, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("event_id") % 3600)
    events = read(spark, d, "events").select("event_id", sent.alias("sent"), (F.col("event_id") % 4).alias("part"))
    base = scratch_path(spark, "repeats")
    feeds_of = [("0 HOUR", [0, 1]), ("1 HOUR", [0, 2]), ("5 DAY", [3]), ("10 DAY", [1])]
    for number, (later, own) in enumerate(feeds_of, 1):
        feed = events.filter(F.col("part").isin(own)).select(
            "event_id", (F.col("sent") + F.expr(f"INTERVAL {later}")).alias("sent"), F.lit(number).alias("feed")
        )
        feed.write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(feed.schema).parquet(f"{base}/landing")
        once = ingest.drop_repeated(stream, "event_id", "sent", "2 hours")
        query = (
            once.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@register(
    "change_events",
    """SELECT count(*) FILTER (o_orderstatus <> 'F') AS applied, count(*) FILTER (o_orderstatus = 'F') AS skipped
  FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
)
def change_events(spark, d):
    docs = workout_docs(spark, d)
    kind = F.when(F.col("o_orderstatus") == "F", "deleted").otherwise("updated")
    events = docs.select(kind.alias("type"), F.struct("id").alias("workout"))
    return feeds.split_events(events)[1]


_LATE = "(SELECT max(ts) - INTERVAL 10 DAY FROM events)"


def _event_batches(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Older events as the target (values off by one) and an overlapping batch with the right ones."""
    events = read(spark, d, "events")
    last = events.agg(F.max("ts")).first()[0]
    older = events.filter(F.col("ts") <= F.lit(last) - F.expr("interval 10 days"))
    batch = events.filter(F.col("ts") > F.lit(last) - F.expr("interval 15 days"))
    overlap = F.col("ts") > F.lit(last) - F.expr("interval 15 days")
    stale = older.withColumn("value", F.when(overlap, F.col("value") + 1).otherwise(F.col("value")))
    return stale.withColumn("dropped_column", F.lit(1)).drop("props"), batch


_EVENTS_AFTER = f"""SELECT event_id, ts, user_id, event_type, value,
  CASE WHEN ts > (SELECT max(ts) - INTERVAL 15 DAY FROM events) THEN props END AS props FROM events"""


@register("upsert_incremental", _EVENTS_AFTER)
def upsert_incremental(spark, d):
    """Merge on the key with a column added and one dropped: matched updated, new inserted."""
    target, batch = _event_batches(spark, d)
    table = tables.Table(spark, scratch_path(spark, "events"))
    table.replace(target)
    return table.upsert(batch, ["event_id"])


@register("batches_then_upsert", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def batches_then_upsert(spark, d):
    """Two streams append, a merge takes their batches in, a third batch lands beside the new version."""
    events = read(spark, d, "events")
    part = F.pmod("event_id", F.lit(4))
    wrong = events.withColumn("value", F.col("value") + 1)
    table = tables.Table(spark, scratch_path(spark, "events"))
    table.append_batch(wrong.filter(part == 0), "a-0")
    table.append_batch(events.filter(part == 1), "b-0")
    table.upsert(events.filter(part.isin(0, 2)), ["event_id"])
    table.append_batch(events.filter(part == 3), "a-1")
    table.append_batch(wrong.filter(part == 0), "a-0")  # a retry of a batch that is part of the version
    return table.read()


@register("upsert_partitions", _EVENTS_AFTER.replace(", value,", ", value, CAST(ts AS DATE) AS day,"))
def upsert_partitions(spark, d):
    """The same merge, rewriting only the days the batch touches."""
    target, batch = _event_batches(spark, d)
    day = F.to_date("ts").alias("day")
    start = target.drop("dropped_column").withColumn("props", F.lit(None).cast("string"))
    table = tables.Table(spark, scratch_path(spark, "events-by-day"))
    table.replace(start.select("*", day), ["day"])
    return table.swap(batch.select("*", day), ["event_id"], "day")


@register(
    "change_windows",
    f"""SELECT event_type, count(*) FILTER (ts > {_LATE}) AS since_loaded,
  count(*) FILTER (CAST(ts AS DATE) > (SELECT CAST(max(ts) AS DATE) FROM events WHERE ts <= {_LATE})) AS since_event,
  count(*) FILTER (ts > (SELECT max(ts) - INTERVAL 15 DAY FROM events)) AS since_updated,
  0::BIGINT AS against_empty FROM events GROUP BY 1""".replace(
        "ts > (SELECT max(ts) - INTERVAL 10 DAY FROM events)",
        "ts > (SELECT max(ts) FROM events WHERE ts <= (SELECT max(ts) - INTERVAL 10 DAY FROM events))",
    ),
)
def change_windows(spark, d):
    """Rows each kind of high-water mark lets through, per event type."""
    events = read(spark, d, "events")
    target, batch = _event_batches(spark, d)
    held = target.withColumn("day", F.to_date("ts"))
    start = batch.agg(F.min("ts")).first()[0]
    before = events.filter(F.col("ts") < F.lit(start)).agg(F.max("ts")).first()[0]
    parts = {
        "since_loaded": tables.since_loaded(events, target, "ts"),
        "since_event": tables.since_event(events, held, F.to_date("ts"), "day"),
        "since_updated": tables.since_updated(events, before, "ts"),
        "against_empty": tables.since_loaded(events, target.filter("1 = 0"), "ts"),
    }
    out = events.select("event_type").distinct()
    for name, rows in parts.items():
        out = out.join(rows.groupBy("event_type").agg(F.count(F.lit(1)).alias(name)), "event_type", "left")
    return out.select("event_type", *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in parts])


@register("refresh_sets", o.with_(o.SETS, then=o.SETS_OUT + " FROM sets"))
def refresh_sets(spark, d):
    """Sets loaded in two steps end up equal to a full rebuild."""
    source = warehouse(spark, d).catalog.source
    raw, places, dim = source("raw_workouts", folders=True), source("gym_locations"), source("dim_exercise_templates")
    cut = datetime(1999, 1, 1)
    first = sets.clean_sets(raw.filter(F.col("_loaded_at") <= F.lit(cut)), places, dim, ATHLETE)
    table = tables.Table(spark, scratch_path(spark, "sets"))
    table.replace(first)
    return sets.refresh_sets(table.read(), raw, places, dim, ATHLETE)


@register("swap_sets", o.with_(o.SETS, then=o.SETS_OUT + " FROM sets"))
def swap_sets(spark, d):
    """The same two steps on a table in month folders: only months of touched sessions are written anew."""
    source = warehouse(spark, d).catalog.source
    raw, places, dim = source("raw_workouts", folders=True), source("gym_locations"), source("dim_exercise_templates")
    first = sets.clean_sets(raw.filter(F.col("_loaded_at") <= F.lit(datetime(1999, 1, 1))), places, dim, ATHLETE)
    table = tables.Table(spark, scratch_path(spark, "sets"))
    table.replace(by_month(first), [MONTH], gather=False)
    touched, rebuilt = sets.rebuilt_sessions(table.read(), raw, places, dim, ATHLETE)
    return table.swap(by_month(rebuilt), [*ATHLETE, "workout_id"], MONTH, touched, gather=False).drop(MONTH)


@register("refresh_sessions", o.with_(o.SETS, o.SESSIONS, then="SELECT * FROM sessions"))
def refresh_sessions(spark, d):
    clean = warehouse(spark, d).silver("sets")
    first = sessions.session_summary(clean.filter(F.col("_loaded_at") <= F.lit(datetime(1999, 1, 1))), ATHLETE)
    table = tables.Table(spark, scratch_path(spark, "sessions"))
    table.replace(first)
    return sessions.refresh_sessions(table.read(), clean, ATHLETE)


@register(
    "replace_and_materialise",
    "SELECT p_partkey, p_name, p_retailprice FROM part",
)
def replace_and_materialise(spark, d):
    """A full refresh replaces the table; readers see the newest complete version."""
    catalog = tables.Catalog(spark, scratch_path(spark, "catalog"))
    part = read(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    catalog.materialise("bronze", "dim_exercise_templates", part.withColumn("p_name", F.upper("p_name")))
    catalog.materialise("bronze", "dim_exercise_templates", part)
    return catalog.source("dim_exercise_templates")


@register(
    "seed_roundtrip",
    """SELECT n_name AS muscle, r_name AS movement_group, CAST(n_nationkey AS DOUBLE) AS mev_sets,
  CASE WHEN n_regionkey > 0 THEN CAST(n_regionkey AS DOUBLE) END AS mav_sets, CAST(n_nationkey + 1 AS DOUBLE) AS mrv_sets
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def seed_roundtrip(spark, d):
    nation, region = read(spark, d, "nation"), read(spark, d, "region")
    seed = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("muscle"),
        F.col("r_name").alias("movement_group"),
        F.col("n_nationkey").alias("mev_sets"),
        F.when(F.col("n_regionkey") > 0, F.col("n_regionkey")).alias("mav_sets"),
        (F.col("n_nationkey") + 1).alias("mrv_sets"),
    )
    path = scratch_path(spark, "seed")
    seed.coalesce(1).write.option("header", True).csv(path)
    return files.load_seed(spark, path, schemas.LANDMARK)


@register(
    "sync_state",
    """SELECT event_type AS key, strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f') AS value FROM events GROUP BY 1""",
)
def sync_state(spark, d):
    """A sync mark per event type, written twice: the later one wins."""
    held = state.SyncState(spark, scratch_path(spark, "state"))
    held.ensure()
    events = read(spark, d, "events").groupBy(F.col("event_type").alias("key"))
    for mark in (F.min("ts"), F.max("ts")):
        stamp = F.date_format(mark.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        held.table.upsert(events.agg(stamp.alias("value")), ["key"])
    return held.table.read()


@register(
    "dimension_feed",
    o.with_(o.TEMPLATES, then="""SELECT title, equipment_category, primary_muscle_group, is_custom,
  CASE WHEN json_valid(secondary_muscle_groups) THEN secondary_muscle_groups ELSE '[]' END AS secondary_muscle_groups
  FROM templates"""),
)
def dimension_feed(spark, d):
    """Template documents renamed, defaulted and with their list as JSON text."""
    docs = log.templates(spark, d).select(
        F.col("exercise_template_id").alias("id"), "title", F.col("equipment_category").alias("equipment"),
        "primary_muscle_group",
        F.from_json("secondary_muscle_groups", "array<string>").alias("secondary_muscle_groups"),
        F.when(F.col("is_custom"), F.lit(True)).alias("is_custom"),
    )
    return feeds.template_rows(docs).drop("exercise_template_id")


# ---- text, retrieval and question logs --------------------------------------------------------


def _squeezed(column: str) -> str:
    white = text.WHITE.replace("'", "''")
    return f"lower(trim(regexp_replace({column}, '{white}+', ' ', 'g')))"


@register(
    "text_fingerprint",
    f"SELECT sha256({_squeezed('text')}) AS fingerprint, min(doc_id) AS keeper, count(*) AS copies FROM documents GROUP BY 1",
)
def text_fingerprint(spark, d):
    return documents.equal_text_groups(read(spark, d, "documents"), "doc_id", "text")


@register(
    "drop_equal_texts",
    f"""SELECT doc_id, text FROM documents
  QUALIFY row_number() OVER (PARTITION BY {_squeezed('text')} ORDER BY doc_id) = 1""",
)
def drop_equal_texts(spark, d):
    return documents.drop_equal_texts(read(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


_TRIMMED = f"regexp_replace(regexp_replace(text, '^{text.WHITE}+', ''), '{text.WHITE}+$', '')"


@register(
    "strip_fences",
    f"SELECT doc_id, regexp_replace({_TRIMMED}, ';+$', '') AS bare, {_squeezed('text')} AS normal FROM documents",
)
def strip_fences(spark, d):
    """Whole texts put into a code fence and taken out again."""
    fenced = F.concat(F.lit("\n```SQL\n"), F.col("text"), F.lit("\n```  "))
    return read(spark, d, "documents").select(
        "doc_id", text.strip_fences(fenced).alias("bare"), text.squeeze(F.col("text")).alias("normal")
    )


@register(
    "first_seen_dedup",
    """SELECT lang, source, doc_id, n_chars FROM documents
  QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY n_chars, doc_id) = 1""",
)
def first_seen_dedup(spark, d):
    docs = read(spark, d, "documents").select("lang", "source", "doc_id", "n_chars")
    return ordering.first_seen(docs, ["lang", "source"], ["n_chars", "doc_id"])


@register(
    "first_seen_document",
    """SELECT doc_id, lang, n_chars, source FROM documents
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY source, n_chars, doc_id) = 1""",
)
def first_seen_document(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "lang", "n_chars", "source")
    return documents.first_by_key(docs, "lang", ["source", "n_chars", "doc_id"])


@register(
    "doc_assemble",
    f"""WITH a AS (SELECT doc_id, source || ' ' || lang AS title, replace(text, chr(10), ' ') AS abstract FROM documents)
SELECT doc_id, title, abstract, title || chr(10) || chr(10) || abstract AS content,
  'https://example.org/' || CAST(doc_id AS VARCHAR) || '/' AS source_url
FROM a WHERE {_squeezed('abstract')} <> ''""",
)
def doc_assemble(spark, d):
    """Lines of a text as its parts; blank ones are dropped."""
    docs = read(spark, d, "documents").select(
        "doc_id",
        F.concat_ws(" ", "source", "lang").alias("title"),
        F.split("text", "\n").alias("parts"),
    )
    return documents.assemble(docs, "doc_id", "title", "parts", "https://example.org/").drop("parts")


# Phrases put in front of the fixture's invented texts so that every route occurs.
PHRASES = [
    "What did I do last session?", "What is my bench PR?", "Am I progressing?", "Should I deload?",
    "Which muscles do I neglect?", "Is my push pull split balanced?", "Enough volume for legs?",
    "How often do I train?", "Hello", "How is my pressing?",
]


def questions_table(spark: SparkSession, d: str) -> DataFrame:
    """User messages, each with a phrase in front."""
    n = len(PHRASES)
    phrase = F.element_at(F.array(*[F.lit(p) for p in PHRASES]), ((F.col("conv_id") + F.col("turn")) % n + 1).cast("int"))
    rows = read(spark, d, "conversations").filter(F.col("role") == "user")
    return rows.select("conv_id", "turn", F.concat_ws(" ", phrase, "text").alias("question"))


def _route_sql() -> str:
    edge = r"[^\p{L}\p{N}_]"
    parts = []
    for label, stems, words in questions.ROUTES:
        tests = []
        if stems:
            tests.append(f"(^|{edge})({'|'.join(stems)})")
        if words:
            tests.append(f"(^|{edge})({'|'.join(words)})({edge}|$)")
        clause = " OR ".join("regexp_matches(lower(question), " + o.q(t) + ")" for t in tests)
        parts.append(f"WHEN {clause} THEN '{label}'")
    return "CASE " + " ".join(parts) + f" ELSE '{questions.NO_ROUTE}' END"


_QUESTIONS = f"""questions AS (SELECT conv_id, turn, ({o.listed(PHRASES)})[CAST((conv_id + turn) % {len(PHRASES)} + 1 AS INTEGER)]
  || ' ' || text AS question FROM conversations WHERE role = 'user')"""


@register("route_questions", o.with_(_QUESTIONS, then=f"SELECT conv_id, turn, {_route_sql()} AS route FROM questions"))
def route_questions(spark, d):
    return questions.route_questions(questions_table(spark, d), "question").select("conv_id", "turn", "route")


@register(
    "route_counts",
    o.with_(_QUESTIONS, then=f"SELECT {_route_sql()} AS route, count(*) AS questions FROM questions GROUP BY 1"),
)
def route_counts(spark, d):
    routed = questions.route_questions(questions_table(spark, d), "question")
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("questions"))


@register(
    "dialog_recent_messages",
    """SELECT conv_id, turn, role, coalesce(array_to_string(list(role || ': ' || text) OVER (
  PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), chr(10)), '') AS context FROM conversations""",
)
def dialog_recent_messages(spark, d):
    return questions.recent_messages(read(spark, d, "conversations"))


@register(
    "dialog_context",
    """WITH m AS (
  SELECT *, CASE WHEN lag(role) OVER w = 'user' THEN lag(text) OVER w ELSE '' END AS question
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
),
good AS (SELECT conv_id, turn, question, text AS answer FROM m WHERE role = 'assistant' AND length(text) >= 200),
near AS (
  SELECT u.conv_id, u.turn, g.turn AS said, 'user: ' || g.question || chr(10) || 'assistant: ' || substring(g.answer, 1, 300) AS line
  FROM m u JOIN good g ON u.conv_id = g.conv_id AND g.turn < u.turn WHERE u.role = 'user'
  QUALIFY row_number() OVER (PARTITION BY u.conv_id, u.turn ORDER BY g.turn DESC) <= 3
),
joined AS (SELECT conv_id, turn, count(*) AS k, string_agg(line, chr(10) ORDER BY said) AS history FROM near GROUP BY 1, 2)
SELECT u.conv_id, u.turn, CAST(coalesce(k, 0) AS INTEGER) AS n_answers, coalesce(history, '') AS history
FROM m u LEFT JOIN joined j ON u.conv_id = j.conv_id AND u.turn = j.turn WHERE u.role = 'user'""",
)
def dialog_context(spark, d):
    """Per user message the last three good answers; short answers count as failed runs."""
    talk = read(spark, d, "conversations")
    pairs = questions.answer_pairs(talk, "conv_id", "turn", "role", "text")
    answers = pairs.withColumn("is_error", F.length("answer") < 200)
    return questions.answer_history(talk.filter(F.col("role") == "user"), answers)


RELEVANCE = 0.2  # the fixture's vectors are nearly orthogonal; 0.6 would return nothing


def label_vectors(spark: SparkSession, d: str) -> DataFrame:
    """One query vector per label: the component sums over its members, as whole numbers."""
    parts = read(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    scaled = F.floor(F.col("x").cast("double") * 1_000_000 + 0.5).cast("bigint")
    sums = parts.groupBy("label", "i").agg(F.sum(scaled).alias("s"))
    ordered = F.array_sort(F.collect_list(F.struct("i", F.col("s").cast("double").alias("s"))))
    return sums.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(ordered["s"].alias("embedding"))


_KNN = f"""
parts AS (
  SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings
),
sums AS (SELECT label, i, sum(CAST(floor(CAST(x AS DOUBLE) * 1000000 + 0.5::DOUBLE) AS BIGINT)) AS s FROM parts GROUP BY 1, 2),
asked AS (SELECT CAST(label AS BIGINT) AS query_id, list(CAST(s AS DOUBLE) ORDER BY i) AS v FROM sums GROUP BY 1),
scored AS (
  SELECT query_id, vec_id AS item_id,
    round(list_cosine_similarity(v, CAST(embedding AS DOUBLE[])), 9) AS raw_score FROM asked CROSS JOIN embeddings
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY raw_score DESC, item_id) AS r FROM scored),
evidence AS (
  SELECT query_id, CAST(r AS INTEGER) AS rank, item_id, round(raw_score, 3) AS score FROM ranked
  WHERE r <= 4 AND raw_score > {RELEVANCE}::DOUBLE
)"""


@register("knn_topk", o.with_(_KNN, then="SELECT * FROM evidence"))
def knn_topk(spark, d):
    items = read(spark, d, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    return similarity.top_k(label_vectors(spark, d), items, k=4, threshold=RELEVANCE)


CELLS, PROBES = 32, 20


def vector_index(spark: SparkSession, d: str) -> similarity.CellIndex:
    items = read(spark, d, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    return similarity.build_index(items, scratch_path(spark, "vector_index"), CELLS)


@register("knn_index_all_cells", o.with_(_KNN, then="SELECT * FROM evidence"))
def knn_index_all_cells(spark, d):
    """The same retrieval over the index, with every cell probed: exact."""
    return similarity.indexed_top_k(label_vectors(spark, d), vector_index(spark, d), CELLS, k=4, threshold=RELEVANCE)


@register("knn_index")
def knn_index(spark, d):
    """Only the nearest cells of each query; its recall is measured in the tests."""
    return similarity.indexed_top_k(label_vectors(spark, d), vector_index(spark, d), PROBES, k=4, threshold=RELEVANCE)


def unit_label_vectors(spark: SparkSession, d: str) -> DataFrame:
    """The same vectors scaled to about unit length, for metrics that see length."""
    v = label_vectors(spark, d)
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    return v.select("query_id", F.transform("embedding", lambda x: x / length).alias("embedding"))


_KNN_EUCLIDEAN = _KNN.replace(
    "round(list_cosine_similarity(v, CAST(embedding AS DOUBLE[])), 9)",
    "round(1 - list_sum(list_transform(list_zip(list_transform(v, lambda a: a / sqrt(list_dot_product(v, v))),"
    " CAST(embedding AS DOUBLE[])), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) / sqrt(2::DOUBLE), 9)",
).replace(f"raw_score > {RELEVANCE}::DOUBLE", "raw_score > -0.2::DOUBLE")


@register("knn_topk_euclidean", o.with_(_KNN_EUCLIDEAN, then="SELECT * FROM evidence"))
def knn_topk_euclidean(spark, d):
    items = read(spark, d, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    return similarity.top_k(unit_label_vectors(spark, d), items, k=4, threshold=-0.2, metric="euclidean")


_PAPERS = """
papers AS (
  SELECT e.*, d.source || ' ' || d.lang AS title, d.text AS content FROM evidence e JOIN documents d ON e.item_id = d.doc_id
)"""


def papers(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select(
        F.col("doc_id").alias("item_id"), F.concat_ws(" ", "source", "lang").alias("title"), F.col("text").alias("content")
    )
    return knn_topk(spark, d).join(docs, "item_id")


@register(
    "cite_resolve",
    o.with_(_KNN, _PAPERS, """cited AS (
  SELECT DISTINCT query_id, unnest([3, 1, 3, 0, 9, CAST(query_id % 5 AS INTEGER)]) AS citation FROM asked
)""", then="""SELECT p.query_id, CAST(citation AS INTEGER) AS citation, item_id, title, score FROM papers p
  JOIN cited c ON p.query_id = c.query_id AND p.rank = c.citation"""),
)
def cite_resolve(spark, d):
    found = papers(spark, d)
    numbers = [F.lit(n) for n in (3, 1, 3, 0, 9)]
    asked = label_vectors(spark, d).select("query_id", F.array(*numbers, (F.col("query_id") % 5).cast("int")).alias("sources_used"))
    return questions.cited_items(asked, found).select("query_id", "citation", "item_id", "title", "score")


@register(
    "evidence_context",
    o.with_(_KNN, _PAPERS, then="""SELECT query_id, string_agg('[' || CAST(rank AS VARCHAR) || '] ' || title || chr(10)
  || substring(content, 1, 500), chr(10) || chr(10) ORDER BY rank) AS context FROM papers GROUP BY 1"""),
)
def evidence_context(spark, d):
    return questions.evidence_context(papers(spark, d))


@register(
    "answer_quality",
    """SELECT conv_id, turn, CASE WHEN turn % 4 < 2 AND (length(text) < 150 OR length(text) % 7 = 0) THEN 'low'
  WHEN conv_id % 2 = 0 AND turn % 3 = 0 THEN 'low' WHEN length(text) > 600 THEN 'medium' ELSE 'high' END AS confidence
  FROM conversations WHERE role = 'assistant'""",
)
def answer_quality(spark, d):
    size = F.length("text")
    runs = read(spark, d, "conversations").filter(F.col("role") == "assistant").select(
        "conv_id", "turn",
        (F.col("turn") % 4 < 2).alias("asked_data"),
        (size < 150).alias("data_error"),
        (size % 7).alias("data_rows"),
        (F.col("conv_id") % 2 == 0).alias("asked_papers"),
        (F.col("turn") % 3).alias("paper_rows"),
        F.when(size > 600, 1).otherwise(0).alias("n_notes"),
    )
    return questions.answer_quality(runs).select("conv_id", "turn", "confidence")
