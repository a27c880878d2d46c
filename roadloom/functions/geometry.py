"""Points as ``struct<x,y>``, lines as ``array<struct<x,y>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x, y) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def start_point(line: Column) -> Column:
    return F.try_element_at(line, F.lit(1))


def end_point(line: Column) -> Column:
    return F.try_element_at(line, F.lit(-1))


def piece(collection: Column, n) -> Column:
    """The n-th member, counted from 1; NULL when there is none."""
    return F.try_element_at(collection, n if isinstance(n, Column) else F.lit(n))


def piece_count(collection: Column) -> Column:
    return F.size(collection)


def line_length(line: Column) -> Column:
    """Planar length of a polyline."""
    steps = F.zip_with(
        line,
        F.slice(line, F.lit(2), F.greatest(F.size(line), F.lit(1))),
        lambda a, b: F.sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)),
    )
    return F.aggregate(steps, F.lit(0.0), lambda total, d: total + F.coalesce(d, F.lit(0.0)))


def box_columns(line: Column) -> dict[str, Column]:
    """Bounding box of a line as four columns."""
    xs = F.transform(line, lambda p: p.x)
    ys = F.transform(line, lambda p: p.y)
    return {"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def envelope(points: list[tuple[Column, Column]], margin) -> dict[str, Column]:
    """Box round some points, grown by ``margin`` on every side."""
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    low = (lambda cs: F.least(*cs)) if len(points) > 1 else (lambda cs: cs[0])
    high = (lambda cs: F.greatest(*cs)) if len(points) > 1 else (lambda cs: cs[0])
    d = margin if isinstance(margin, Column) else F.lit(float(margin))
    return {"lo_x": low(xs) - d, "lo_y": low(ys) - d, "hi_x": high(xs) + d, "hi_y": high(ys) + d}


def overlaps(box: str = "", window: str = "") -> Column:
    """Closed-interval overlap of an edge box with a request box, by column names."""
    return (
        (F.col(f"{box}xmax") >= F.col(f"{window}lo_x"))
        & (F.col(f"{box}xmin") <= F.col(f"{window}hi_x"))
        & (F.col(f"{box}ymax") >= F.col(f"{window}lo_y"))
        & (F.col(f"{box}ymin") <= F.col(f"{window}hi_y"))
    )


def to_mm(metres: Column) -> Column:
    return F.floor(metres * 1000 + 0.5).cast("long")


def point_text(x: Column, y: Column) -> Column:
    """Point as text with millimetre decimals."""
    return F.concat(
        F.lit("POINT("), x.cast("decimal(12,3)").cast("string"), F.lit(" "), y.cast("decimal(12,3)").cast("string"), F.lit(")")
    )


CURVE_BITS = 20  # grid squares per axis of the curve, as a power of two
CURVE_METRES = 2.0  # side of such a square; the curve spans 2,000 km


def curve_key(x: Column, y: Column) -> Column:
    """Place of a grid position along a Hilbert curve, so that neighbours get near keys.

    One turn per bit: the quadrant adds to the key, then the frame is turned to
    the quadrant's own orientation.
    """
    top = 1 << CURVE_BITS

    def index(v: Column) -> Column:
        return F.least(F.greatest(F.floor(v / CURVE_METRES + top / 4), F.lit(0)), F.lit(top - 1)).cast("long")

    def turn(p: Column, side: Column) -> Column:
        right, upper = p.x >= side, p.y >= side
        quadrant = F.when(right, F.when(upper, 2).otherwise(3)).otherwise(F.when(upper, 1).otherwise(0))
        x, y = p.x - F.when(right, side).otherwise(0), p.y - F.when(upper, side).otherwise(0)
        mirrored = right & ~upper
        return F.struct(
            F.when(upper, x).when(mirrored, side - 1 - y).otherwise(y).alias("x"),
            F.when(upper, y).when(mirrored, side - 1 - x).otherwise(x).alias("y"),
            (p.key * 4 + quadrant).alias("key"),
        )

    start = F.struct(index(x).alias("x"), index(y).alias("y"), F.lit(0).cast("long").alias("key"))
    sides = F.array(*[F.lit(1 << b).cast("long") for b in reversed(range(CURVE_BITS))])
    return F.aggregate(sides, start, turn, lambda p: p.key)
