"""Edges near the ends of each request, and edge-to-arc expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.functions import geometry as G
from roadloom.operators.skew import split_join
from roadloom.sources.schemas import PERIODS

CLIP_METRES = 20_000.0  # fixed value: margin round the two ends of a route
WALK_EXCLUDED = "Motorway"
AREA_EXCLUDED = "Ferry Route"


def without_hierarchy(edges: DataFrame, excluded: str) -> DataFrame:
    """Edges whose hierarchy is known and not ``excluded``."""
    return edges.where(F.col("routehierarchy") != excluded)


def cost_columns(option: str, period: str | None = None) -> tuple[str, str]:
    """Names of the forward and reverse cost column of a request option."""
    if option == "distance":
        return "cost_distance", "reverse_cost_distance"
    if option != "time":
        raise ValueError(f"option must be 'distance' or 'time', not {option!r}")
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, not {period!r}")
    return f"cost_time_{period}", f"reverse_cost_time_{period}"


def fixed_cost(cost: Column, scale: float) -> Column:
    """Cost as a whole number of ``1/scale`` units; NULL for a closed direction."""
    return F.when(cost >= 0, F.floor(cost * float(scale) + 0.5).cast("long"))


def arcs(edges: DataFrame, forward: str, reverse: str) -> DataFrame:
    """(edge, u, v, cost): one row per open direction; NULL ends or costs and negative costs give none."""
    pair = F.array(
        F.struct(F.col("source").alias("u"), F.col("target").alias("v"), F.col(forward).alias("cost")),
        F.struct(F.col("target").alias("u"), F.col("source").alias("v"), F.col(reverse).alias("cost")),
    )
    return (
        edges.select(F.col("id").alias("edge"), F.explode(pair).alias("a"))
        .select("edge", "a.u", "a.v", "a.cost")
        .where("cost >= 0 and u is not null and v is not null")
    )


def _covered(lo_x: str, lo_y: str, hi_x: str, hi_y: str, side: float) -> tuple[Column, Column]:
    square = lambda v: F.floor(F.col(v) / side).cast("long")
    return F.explode(F.sequence(square(lo_x), square(hi_x))), F.explode(F.sequence(square(lo_y), square(hi_y)))


def clip(edges: DataFrame, requests: DataFrame, margin: float = CLIP_METRES) -> DataFrame:
    """(req_id, edge): edges whose box meets the grown box of ``requests(req_id, x1, y1, x2, y2)``.

    Both sides are spread over squares of a size near the request box, so a
    request and an edge cover a few squares each; a pair is kept only in the
    one square that holds the lower corner of their common box.
    """
    side = max(2 * margin, 1000.0)
    box = G.envelope([(F.col("x1"), F.col("y1")), (F.col("x2"), F.col("y2"))], margin)
    windows = requests.select("req_id", *[c.alias(n) for n, c in box.items()])
    rx, ry = _covered("lo_x", "lo_y", "hi_x", "hi_y", side)
    ex, ey = _covered("xmin", "ymin", "xmax", "ymax", side)
    windows = windows.withColumn("gx", rx).withColumn("gy", ry)
    spread = edges.select(F.col("id").alias("edge"), "xmin", "ymin", "xmax", "ymax").withColumn("gx", ex).withColumn("gy", ey)
    first = (F.floor(F.greatest("lo_x", "xmin") / side) == F.col("gx")) & (F.floor(F.greatest("lo_y", "ymin") / side) == F.col("gy"))
    met = split_join(spread, windows, ["gx", "gy"], ["edge"])  # a square of a dense town is many tasks
    return met.where(G.overlaps() & first).select("req_id", "edge")
