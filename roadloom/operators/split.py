"""Cutting polylines at points, set-based."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom.operators.skew import split_join
from roadloom.sources.scratch import materialize

ON_LINE = 1e-6  # metres a point may lie off a segment and still cut it
SQUARE = 64.0  # metres; segments and cut points meet in squares of this size
BINS = 1024  # bins per segment in which cuts are counted before the running piece number


def _square(v: Column) -> Column:
    return F.floor(v / SQUARE).cast("long")


def _segments(lines: DataFrame) -> DataFrame:
    """(fid, last, i, ax, ay, bx, by) of every segment with some length; ``last`` is the place of the line's last vertex."""
    return (
        lines.select("fid", (F.size("geom") - 1).alias("last"), F.posexplode(F.zip_with(
            "geom", F.slice("geom", F.lit(2), F.greatest(F.size("geom"), F.lit(1))), lambda a, b: F.struct(a.alias("a"), b.alias("b"))
        )).alias("i", "s"))
        .where("s.b is not null and (s.a.x <> s.b.x or s.a.y <> s.b.y)")
        .select("fid", "last", "i", F.expr("s.a.x").alias("ax"), F.expr("s.a.y").alias("ay"), F.expr("s.b.x").alias("bx"), F.expr("s.b.y").alias("by"))
    )


def _squares_along(segments: DataFrame) -> DataFrame:
    """Each segment once per square it passes: columns of squares, then the rows the line spans in that column."""
    pad = F.lit(2 * ON_LINE)
    lo_x, hi_x = F.least("ax", "bx") - pad, F.greatest("ax", "bx") + pad
    columns = segments.withColumn("gx", F.explode(F.sequence(_square(lo_x), _square(hi_x))))
    # Clip the segment to the column [gx, gx + 1) before taking its y range.
    slope = F.when(F.col("ax") == F.col("bx"), F.lit(None)).otherwise((F.col("by") - F.col("ay")) / (F.col("bx") - F.col("ax")))
    left = F.greatest(F.col("gx") * SQUARE - pad, F.least("ax", "bx"))
    right = F.least((F.col("gx") + 1) * SQUARE + pad, F.greatest("ax", "bx"))
    at = lambda x: F.col("ay") + (x - F.col("ax")) * slope
    slack = pad * (1 + F.abs(F.coalesce(slope, F.lit(0.0))))
    lo_y = F.greatest(F.least("ay", "by"), F.coalesce(F.least(at(left), at(right)) - slack, F.least("ay", "by"))) - pad
    hi_y = F.least(F.greatest("ay", "by"), F.coalesce(F.greatest(at(left), at(right)) + slack, F.greatest("ay", "by"))) + pad
    return columns.withColumn("gy", F.explode(F.sequence(F.least(_square(lo_y), _square(hi_y)), F.greatest(_square(lo_y), _square(hi_y)))))


def cut_positions(lines: DataFrame, points: DataFrame) -> DataFrame:
    """(fid, pos, x, y): where points lie on their line, strictly between its ends.

    ``pos`` counts vertices, with the fraction along the segment. Points and
    segments of one line meet only in shared grid squares, never all with all.
    """
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    px, py = F.col("x") - F.col("ax"), F.col("y") - F.col("ay")
    span = dx * dx + dy * dy
    along, across = px * dx + py * dy, px * dy - py * dx
    placed = points.dropDuplicates(["fid", "x", "y"]).withColumns({"gx": _square(F.col("x")), "gy": _square(F.col("y"))})
    return (
        split_join(placed, _squares_along(_segments(lines)), ["fid", "gx", "gy"], ["x", "y"])
        .where((F.abs(across) <= ON_LINE * F.sqrt(span)) & (along >= 0) & (along <= span))
        .select("fid", "last", (F.col("i") + along / span).alias("pos"), "x", "y")
        .where("pos > 0 and pos < last")
        .groupBy("fid", "pos")
        .agg(F.min(F.struct("x", "y")).alias("p"))
        .select("fid", "pos", "p.x", "p.y")
    )


def split_lines(lines: DataFrame, points: DataFrame) -> DataFrame:
    """(fid, n, geom): the pieces of each line in ``lines``, numbered from its start.

    ``lines`` is (fid, geom) and is read three times, ``points`` is (fid, x, y). Lines without a cut come
    back as one piece. The piece number is a running count of cuts taken in two
    levels: per bin (at most ``BINS`` per segment), then within the bin, so a line
    with very many cuts is not counted by one task alone.
    """
    vertices = lines.select("fid", F.posexplode("geom").alias("pos", "p")).select(
        "fid", F.col("pos").cast("double").alias("pos"), "p.x", "p.y", F.lit(False).alias("cut")
    )
    cuts = materialize(cut_positions(lines, points), "cuts").withColumn("cut", F.lit(True))  # read twice below
    marks = materialize(
        vertices.unionByName(cuts)
        .groupBy("fid", "pos")
        .agg(F.max("cut").alias("cut"), F.min(F.struct("cut", "x", "y")).alias("p"))
        .select("fid", "pos", "cut", "p.x", "p.y", F.floor(F.col("pos") * BINS).alias("bin")),
        "marks",
    )
    ahead = Window.partitionBy("fid").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        marks.groupBy("fid", "bin")
        .agg(F.sum(F.col("cut").cast("long")).alias("cuts"))
        .withColumn("cuts_before", F.coalesce(F.sum("cuts").over(ahead), F.lit(0)))
        .drop("cuts")
    )
    within = Window.partitionBy("fid", "bin").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    n = F.col("cuts_before") + F.coalesce(F.sum(F.col("cut").cast("long")).over(within), F.lit(0)) + 1
    counted = split_join(marks, before, ["fid", "bin"], ["pos"]).withColumn("n", n)
    # A cut ends one piece and starts the next.
    members = counted.withColumn("n", F.explode(F.when(F.col("cut"), F.array(F.col("n"), F.col("n") + 1)).otherwise(F.array("n"))))
    return (
        members.groupBy("fid", "n")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y"))).alias("m"))
        .select("fid", "n", F.transform("m", lambda s: F.struct(s.x.alias("x"), s.y.alias("y"))).alias("geom"))
    )
