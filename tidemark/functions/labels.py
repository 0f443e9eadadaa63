"""Ordered rules and threshold bands that turn numbers and text into labels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Iterable[tuple[Column, Column | str]], otherwise: Column | str | None) -> Column:
    """Label of the first rule that holds; an unknown condition does not hold."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    branches = list(rules)
    condition, label = branches[0]
    out = F.when(condition, as_col(label))
    for condition, label in branches[1:]:
        out = out.when(condition, as_col(label))
    return out.otherwise(as_col(otherwise))


def load_status(days_of_history: Column, acute: Column, chronic: Column) -> Column:
    """Band of acute / chronic. Compared by cross multiplication, hence on the unrounded ratio."""
    scaled = acute * F.lit(10)
    return first_match(
        [
            (days_of_history < 28, "insufficient_data"),
            (chronic.isNull() | (chronic == 0), "insufficient_data"),
            (scaled > chronic * F.lit(12), "overreaching"),
            (scaled < chronic * F.lit(8), "undertraining"),
        ],
        "optimal",
    )


def volume_status(sets: Column, low: Column, mid: Column, high: Column) -> Column:
    return first_match(
        [
            (low.isNull(), "not_tracked"),
            (sets == 0, "not_trained"),
            (sets < low, "below_mev"),
            (sets > high, "above_mrv"),
            (sets > mid, "above_mav"),
        ],
        "optimal",
    )


def push_pull_status(pull: Column, shown_ratio: Column) -> Column:
    return first_match(
        [
            (pull == 0, "no_pull_training"),
            (shown_ratio > F.lit("1.3").cast("decimal(3,1)"), "push_dominant"),
            (shown_ratio < F.lit("0.7").cast("decimal(3,1)"), "pull_dominant"),
        ],
        "balanced",
    )


def quad_ham_status(ham: Column, shown_ratio: Column) -> Column:
    return first_match(
        [
            (ham == 0, "no_hamstring_training"),
            (shown_ratio > 2, "quad_dominant_injury_risk"),
            (shown_ratio < 1, "hamstring_dominant"),
        ],
        "balanced",
    )


def trend_status(sessions: Column, base: Column, shown_change: Column) -> Column:
    edge = F.lit("2.5").cast("decimal(3,1)")
    return first_match(
        [
            ((sessions < 3) | base.isNull(), "insufficient_data"),
            (shown_change > edge, "improving"),
            (shown_change < -edge, "declining"),
        ],
        "plateauing",
    )


def one_rep_max(weight: Column, reps: Column) -> Column:
    """Estimated single-repetition load from the best set; NULL above 20 repetitions."""
    grown = lambda per: F.round(
        weight.cast("decimal(12,2)") * (F.lit(per) + reps).cast("decimal(10,0)") / F.lit(per).cast("decimal(4,0)"), 2
    ).cast("decimal(14,2)")
    return (
        F.when(reps == 1, weight.cast("decimal(14,2)"))
        .when(reps <= 10, grown(30))
        .when(reps <= 20, grown(36))
    )
