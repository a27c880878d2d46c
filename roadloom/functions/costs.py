"""Travel costs, rounding and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the results depend on.
FORWARD_ONLY = "in direction"
BACKWARD_ONLY = "in opposite direction"
BOTH_WAYS = "both directions"
CLOSED = -1.0
DEFAULT_KMH = 48
KMH_GUARD = 0.01
WALK_METRES_PER_SECOND = 1.4
FERRY_MINUTES = 1.0


def node_key(node: Column, grade: Column) -> Column:
    """Node reference and grade separation run together; NULL parts are skipped."""
    return F.concat_ws("", node.cast("string"), grade.cast("string"))


def travel_minutes(length: Column, kmh: Column) -> Column:
    return (length / 1000) / F.coalesce(kmh + KMH_GUARD, F.lit(float(DEFAULT_KMH))) * 60


def forward_cost(direction: Column, cost: Column) -> Column:
    return F.when(direction == BACKWARD_ONLY, F.lit(CLOSED)).otherwise(cost)


def reverse_cost(direction: Column, cost: Column) -> Column:
    return F.when(direction == FORWARD_ONLY, F.lit(CLOSED)).otherwise(cost)


def reverse_minutes(direction: Column, length: Column, kmh_a: Column, kmh_b: Column) -> Column:
    """A link open only backwards is timed with its first speed, a two-way link with its second."""
    return (
        F.when(direction == FORWARD_ONLY, F.lit(CLOSED))
        .when(direction == BACKWARD_ONLY, travel_minutes(length, kmh_a))
        .otherwise(travel_minutes(length, kmh_b))
    )


def round_to(value: Column, places: int) -> Column:
    """Half-up rounding through a decimal, back to double."""
    return F.round(value.cast("decimal(24,9)"), places).cast("double")


def hms(seconds: Column) -> Column:
    """``HH:MM:SS`` of whole seconds; wraps after a day."""
    s = F.pmod(F.floor(seconds).cast("long"), F.lit(86400))
    pad = lambda v: F.lpad(F.floor(v).cast("long").cast("string"), 2, "0")
    return F.concat_ws(":", pad(s / 3600), pad((s % 3600) / 60), pad(s % 60))
