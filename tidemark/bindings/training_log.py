"""The fixture tables seen as a training log.

athlete = customer nation, session = order, set = line item, exercise = part
word and type, readings = orders (a weight only where the status is P). Text columns are written in the
raw log's conventions, including values that do not parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.warehouse import Warehouse
from tidemark.session import scratch_path
from tidemark.sources.files import default_landmarks
from tidemark.sources.tables import Catalog, by_session, session_columns

ATHLETE = ["athlete"]

# Fixed values of the binding: part type to equipment, order number to free text.
EQUIPMENT = {
    "ECONOMY": "Barbell",
    "LARGE": "Dumbbell",
    "MEDIUM": "Machine",
    "PROMO": "Kettlebell",
    "SMALL": "Cable",
    "STANDARD": "Bodyweight",
}
DESCRIPTIONS = [
    "Morning at Thrive", "Cult Chennai again", "afterburn evening", "VR Fitness", "nitw", "Golds", "jashs",
    "BLR trip", "pune trip", "gym: Iron Den", None, "", "Gym: lake house",
]
NOTES = ["smith rack", "gym: Garage Gym", "felt good", "", None, None, None]
SECONDARY = ['["biceps","forearms"]', '["triceps"]', "not json", None, '["quadriceps","hamstrings","glutes"]']
KINDS = ["warmup", "Normal", "normal", "failure", "dropset"]
# Marks of a line: three bits, above them its kind.
TAXED, TWICE, AGAIN, KIND = 1, 2, 4, 8
MUSCLES = [
    "chest", "shoulders", "triceps", "lats", "upper_back", "biceps", "traps", "forearms", "quadriceps",
    "hamstrings", "glutes", "calves", "adductors", "abductors", "abdominals", "lower_back", "neck", "cardio",
    "full_body", "other", "unknown",
]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list, number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def _padded(number: Column) -> Column:
    return F.lpad((number % 100).cast("string"), 2, "0")


def exercise(name: Column, kind: Column) -> Column:
    gear = F.create_map(*[F.lit(x) for pair in EQUIPMENT.items() for x in pair])
    return F.concat(F.split_part(name, F.lit(" "), F.lit(2)), F.lit(" ("), gear[kind], F.lit(")"))


def raw_workouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # All of these grow with the log, so none is broadcast. Lines meet their parts and then their orders as the
    # few columns they are made of, short marks as bits of one number; texts and copies are made after the last shuffle.
    supplier = F.col("l_suppkey")
    kind = (
        F.when(F.col("l_returnflag") == "R", KINDS.index("warmup"))
        .when((F.col("l_returnflag") == "A") & (supplier % 50 == 0), KINDS.index("Normal"))
        .when(F.col("l_returnflag") == "A", KINDS.index("normal"))
        .when(F.col("l_linestatus") == "O", KINDS.index("failure"))
        .otherwise(KINDS.index("dropset"))
    )
    bit = lambda cond, n: F.when(cond, n).otherwise(0)
    marks = bit(F.col("l_tax") > 0, TAXED) + bit(F.col("l_tax") == 0.08, TWICE) + bit(F.col("l_discount") == 0, AGAIN) + kind * KIND
    line = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate",
        # Only its remainders by 2, 3 and 4 are asked for.
        (supplier % 12).cast("int").alias("l_suppkey"), marks.cast("int").alias("_marks"),
    )
    part = read(spark, sf_dir, "part").select("p_partkey", exercise(F.col("p_name"), F.col("p_type")).alias("exercise_title"), "p_size")
    customer = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("athlete"))
    order = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    order = order.join(customer.hint("merge"), order.o_custkey == customer.c_custkey).drop("c_custkey")
    joined = line.join(part.hint("merge"), line.l_partkey == part.p_partkey).drop("p_partkey")
    joined = joined.join(order.hint("merge"), joined.l_orderkey == order.o_orderkey)
    # Overlapping re-syncs: the same sets a day later, and once more at the same time.
    marked = lambda n: F.col("_marks").bitwiseAND(n) != 0
    copies = F.array_compact(F.array(F.lit(0), F.when(marked(AGAIN), 1), F.when(marked(TWICE), 2)))
    key, cust, lkey = F.col("o_orderkey"), F.col("o_custkey"), F.col("l_orderkey")
    day = F.col("o_orderdate").cast("timestamp")
    begin = day + F.make_dt_interval(mins=(key % 1440).cast("int"))
    finish = begin + F.make_dt_interval(mins=(cust % 120).cast("int"))
    iso = lambda t, sec: F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm"), F.lit(f":{sec}+05:30"))
    long = lambda t: F.date_format(t, "MMM d, yyyy, h:mm a")
    start_time = F.when(key % 97 == 0, "unknown").when(key % 2 == 0, long(begin)).otherwise(iso(begin, "59"))
    end_time = F.when(key % 2 == 0, long(finish)).otherwise(iso(finish, "01"))
    weight = (
        F.when(lkey % 53 == 0, "abc")
        .when(lkey % 59 == 0, "")
        .when(lkey % 61 == 0, "12.345")
        .when(lkey % 67 == 0, "12345.6")
        .when(lkey % 71 == 0, F.lit(None))
        .otherwise(F.concat(F.col("p_size").cast("string"), F.lit("."), _padded(F.col("l_partkey"))))
    )
    reps = (
        F.when(lkey % 43 == 0, "8.5")
        .when(lkey % 47 == 0, "x")
        .when(lkey % 41 == 0, F.lit(None))
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
    )
    superset = F.when(F.col("l_suppkey") % 4 == 0, (F.col("l_suppkey") % 3).cast("string")).when(
        F.col("l_suppkey") % 4 == 1, ""
    )
    rpe = F.when(marked(TAXED), F.concat((F.col("l_linenumber") % 5 + 5).cast("string"), F.lit(".5")))
    shipped = F.col("l_shipdate")
    return joined.withColumn("_copy", F.explode(copies)).select(
        "athlete",
        lkey.cast("string").alias("workout_id"),
        F.col("o_orderpriority").alias("title"),
        start_time.alias("start_time"),
        end_time.alias("end_time"),
        _pick(DESCRIPTIONS, key).alias("description"),
        "exercise_title",
        superset.alias("superset_id"),
        _pick(NOTES, F.col("l_partkey")).alias("exercise_notes"),
        F.col("l_linenumber").alias("set_index"),
        F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.shiftright("_marks", 3) + 1).alias("set_type"),
        weight.alias("weight_kg"),
        reps.alias("reps"),
        F.lit(None).cast("string").alias("distance_km"),
        F.lit(None).cast("string").alias("duration_seconds"),
        rpe.alias("rpe"),
        F.when(F.col("l_suppkey") % 2 == 0, "csv").otherwise("api").alias("_source"),
        F.when(F.col("_copy") == 1, shipped + F.expr("interval 1 day")).otherwise(shipped).alias("_loaded_at"),
    )


def templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = (
        read(spark, sf_dir, "part")
        .withColumn("title", exercise(F.col("p_name"), F.col("p_type")))
        .withColumn("title", F.when(F.col("title").startswith("rod"), F.concat(F.lit("old "), F.col("title"))).otherwise(F.col("title")))
        .groupBy("title", "p_type")
        .agg(F.min("p_partkey").alias("n"))
    )
    gear = F.create_map(*[F.lit(x) for pair in EQUIPMENT.items() for x in pair])
    return first.select(
        F.col("n").cast("string").alias("exercise_template_id"),
        F.upper("title").alias("title"),
        F.lower(gear[F.col("p_type")]).alias("equipment_category"),
        _pick(MUSCLES, F.col("n")).alias("primary_muscle_group"),
        _pick(SECONDARY, F.col("n")).alias("secondary_muscle_groups"),
        (F.col("n") % 4 == 0).alias("is_custom"),
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stay per athlete and year: 120 days from the year's first order."""
    year = F.year("o_orderdate")
    stays = (
        read(spark, sf_dir, "orders")
        .join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").cast("bigint").alias("athlete"), year.alias("y"))
        .agg(F.min(F.to_date("o_orderdate")).alias("start_date"))
    )
    return stays.select(
        "athlete",
        "start_date",
        F.date_add("start_date", 120).alias("end_date"),
        F.concat(F.lit("trip_"), F.col("y").cast("string")).alias("gym"),
        F.when(F.col("y") % 2 == 0, "").otherwise(F.concat(F.lit("hotel_"), F.col("y").cast("string"))).alias("gym_detail"),
    )


def raw_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, customer = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    weight = F.concat((cust % 40 + 60).cast("string"), F.lit("."), _padded(key))
    return (
        order.join(customer, order.o_custkey == customer.c_custkey)
        .select(
            F.col("c_nationkey").cast("bigint").alias("athlete"),
            F.when(key % 31 == 0, "not a date")
            .otherwise(F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd"))
            .alias("measurement_date"),
            F.when((F.col("o_orderstatus") == "P") & (key % 29 != 0), weight).otherwise("n/a").alias("weight_kg"),
            F.lit(None).cast("string").alias("body_fat_pct"),
            (F.col("o_orderdate") + F.make_dt_interval(days=(cust % 30).cast("int"))).alias("_loaded_at"),
        )
    )


_built: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Raw tables of this fixture folder in a fresh catalog, one per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        catalog = Catalog(spark, scratch_path(spark, "warehouse"))
        for name, make in (
            ("raw_workouts", raw_workouts),
            ("raw_measurements", raw_measurements),
            ("dim_exercise_templates", templates),
            ("gym_locations", locations),
        ):
            rows = make(spark, sf_dir)
            rows = by_session(rows) if name == "raw_workouts" else rows
            # The last join has brought the rows of a session together.
            catalog.materialise("bronze", name, rows, session_columns(rows.columns), gather=False)
        _built[key] = Warehouse(catalog, default_landmarks(spark), ("athlete",))
    return _built[key]
