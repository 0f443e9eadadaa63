"""Body measurements and their daily interpolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.arith import ratio, rounded
from tidemark.functions.casts import text_to_date, text_to_decimal
from tidemark.operators.calendar import day_bounds, series_window
from tidemark.operators.ordering import collapse_duplicates
from tidemark.sources.tables import since_event


def clean_measurements(raw: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    """Typed readings; rows without a date are dropped, bad numbers become NULL."""
    return raw.select(
        *entity,
        text_to_date(F.col("measurement_date")).alias("measurement_date"),
        text_to_decimal(F.col("weight_kg"), 5, 2).alias("weight_kg"),
        text_to_decimal(F.col("body_fat_pct"), 5, 2).alias("body_fat_pct"),
        "_loaded_at",
    ).filter(F.col("measurement_date").isNotNull())


def new_measurements(raw: DataFrame, target: DataFrame, entity: Sequence[str] = ()) -> DataFrame:
    """Incremental form: readings dated after the newest one held, one per day (newest load)."""
    fresh = since_event(raw, target, text_to_date(F.col("measurement_date")), "measurement_date")
    return collapse_duplicates(clean_measurements(fresh, entity), [*entity, "measurement_date"], "_loaded_at")


def interpolate_daily(
    active: DataFrame,
    readings: DataFrame,
    entity: Sequence[str] = (),
    day: str = "workout_date",
    reading_day: str = "measurement_date",
    value: str = "weight_kg",
    out: str = "bodyweight_kg",
) -> DataFrame:
    """A value for every day between an entity's first and last active day.

    A reading counts on its own day; between two readings the value is linear;
    before the first and after the last it is carried flat. Readings outside
    the active days are ignored. Several readings of one day: the newest load.

    Windows run over the sparse readings. Each reading is then stretched up to
    the next one, so no window has to walk the dense series in two directions.
    """
    entity = list(entity)
    bounds = day_bounds(active, entity, day)
    newest = F.struct("_loaded_at", F.col(value)) if "_loaded_at" in readings.columns else F.struct(F.col(value))
    daily = (
        readings.filter(F.col(value).isNotNull())
        .groupBy(*entity, F.col(reading_day).alias("at"))
        .agg(F.max(newest)[value].alias("v"))
    )
    if entity:
        inside = bounds.join(daily, entity, "left")
    else:
        first, last = bounds.first()
        empty = daily.sparkSession.range(1).select(
            F.lit(None).cast(daily.schema["at"].dataType).alias("at"), F.lit(None).cast(daily.schema["v"].dataType).alias("v")
        )
        inside = daily.unionByName(empty).withColumns(
            {"first_day": F.lit(first).cast("date"), "last_day": F.lit(last).cast("date")}
        )
    # An entity without any usable reading keeps one row with no value.
    in_span = F.col("at").between(F.col("first_day"), F.col("last_day"))
    inside = inside.withColumn("v", F.when(in_span, F.col("v"))).withColumn("at", F.when(in_span, F.col("at")))
    inside = inside.groupBy(*entity, "first_day", "last_day", "at").agg(F.max("v").alias("v"))
    w = series_window(entity, F.col("at").asc_nulls_first())
    placed = inside.withColumns(
        {"before": F.lag("at").over(w), "next_at": F.lead("at").over(w), "next_v": F.lead("v").over(w)}
    )
    # The placeholder row sorts first; it is needed only when it is alone.
    placed = placed.filter(F.col("at").isNotNull() | F.col("next_at").isNull())
    begin = F.when(F.col("before").isNull(), F.col("first_day")).otherwise(F.col("at"))
    until = F.coalesce(F.date_sub("next_at", 1), F.col("last_day"))
    days = placed.withColumn(day, F.explode(F.sequence(begin, until, F.expr("interval 1 day"))))

    offset, width = F.datediff(F.col(day), F.col("at")), F.datediff("next_at", "at")
    mixed = ratio(
        F.col("v") * (width - offset).cast("decimal(10,0)") + F.col("next_v") * offset.cast("decimal(10,0)"), width
    )
    flat = (F.col(day) <= F.col("at")) | F.col("next_at").isNull()
    measured = F.col(day) == F.col("at")
    return days.select(
        *entity,
        day,
        F.when(flat, rounded(F.col("v"), 2)).otherwise(rounded(mixed, 2)).cast("decimal(10,2)").alias(out),
        F.coalesce(measured, F.lit(False)).alias("is_measured"),
        F.when(F.col(day) >= F.col("at"), F.col("at")).alias("prev_reading_date"),
        F.when(F.col(day) <= F.col("at"), F.col("at")).otherwise(F.col("next_at")).alias("next_reading_date"),
    )
