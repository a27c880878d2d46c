"""Request tables from query text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.functions.projection import to_grid
from roadloom.sources.schemas import PERIODS

# What an absent parameter means.
DEFAULT_OPTION = "distance"
DEFAULT_AREA_OPTION = "alphashape"
DEFAULT_MINUTES = 10.0
DEFAULT_AREA_PERIOD = "nighttime0004everyday"
AREA_OPTIONS = ["alphashape", "drivingdistance"]


def parse_points(text: Column) -> Column:
    """``"lon lat,lon lat"`` to ``array<struct<lon,lat>>``."""
    return F.transform(
        F.split(text, ","),
        lambda p: F.struct(
            F.get(F.split(F.trim(p), " +"), F.lit(0)).try_cast("double").alias("lon"), F.get(F.split(F.trim(p), " +"), F.lit(1)).try_cast("double").alias("lat")
        ),
    )


def parse_point(text: Column) -> Column:
    """``"lon,lat"`` to ``struct<lon,lat>``."""
    parts = F.split(text, ",")
    return F.struct(F.trim(F.get(parts, F.lit(0))).try_cast("double").alias("lon"), F.trim(F.get(parts, F.lit(1))).try_cast("double").alias("lat"))


def _checked(value: Column, allowed: list[str], what: str) -> Column:
    return F.when(value.isin(allowed), value).otherwise(
        F.raise_error(F.concat(F.lit(f"{what} must be one of {', '.join(allowed)}, not "), F.coalesce(value, F.lit("NULL"))))
    )


def cost_name(option: Column, period: Column) -> Column:
    """Name of the cost a route request asks for: ``distance`` or ``time_<period>``. Anything else raises."""
    option = _checked(F.coalesce(option, F.lit(DEFAULT_OPTION)), ["distance", "time"], "option")
    return F.when(option == "distance", "distance").otherwise(F.concat(F.lit("time_"), _checked(period, PERIODS, "period")))


def area_cost_name(period: Column) -> Column:
    return F.concat(F.lit("time_"), _checked(F.coalesce(period, F.lit(DEFAULT_AREA_PERIOD)), PERIODS, "period"))


def area_option(option: Column) -> Column:
    """What an area request asks for. Anything else raises."""
    return _checked(option, AREA_OPTIONS, "option")


def _with_absent(df: DataFrame, *columns: str) -> DataFrame:
    """Parameters nobody gave, as NULL."""
    return df.withColumns({c: F.lit(None).cast("string") for c in columns if c not in df.columns})


def route_requests(df: DataFrame) -> DataFrame:
    """(req_id, points[, option, period]) as text to grid requests. Points after the second are ignored.

    Requests that cannot be answered are left out; :func:`rejected_requests` lists them.
    """
    ends = _with_reason(df).where("reason is null").withColumns(
        {"s": to_grid(F.col("a.lon"), F.col("a.lat")), "d": to_grid(F.col("b.lon"), F.col("b.lat"))}
    )
    return ends.select(
        "req_id", F.col("s.x").alias("src_x"), F.col("s.y").alias("src_y"), F.col("d.x").alias("dst_x"), F.col("d.y").alias("dst_y"),
        F.coalesce("option", F.lit(DEFAULT_OPTION)).alias("option"), "period",
    )


def _with_reason(df: DataFrame) -> DataFrame:
    """Route requests with their two points ``a`` and ``b``, and why they cannot be answered, or NULL."""
    p = parse_points(F.col("points"))
    ends = _with_absent(df, "option", "period").withColumns({"a": F.get(p, F.lit(0)), "b": F.get(p, F.lit(1))})
    option = F.coalesce("option", F.lit(DEFAULT_OPTION))
    known = F.coalesce(F.col("period").isin(PERIODS), F.lit(False))
    bad = lambda e: F.col(f"{e}.lon").isNull() | F.col(f"{e}.lat").isNull()
    return ends.withColumn(
        "reason",
        F.when(bad("a"), "the first point is not a longitude and a latitude")
        .when(bad("b"), "the second point is not a longitude and a latitude")
        .when(~option.isin("distance", "time"), "unknown option")
        .when((option == "time") & ~known, "unknown period"),
    )


def rejected_requests(df: DataFrame) -> DataFrame:
    """(req_id, reason) of the route requests that cannot be answered; the others go on without them."""
    return _with_reason(df).where("reason is not null").select("req_id", "reason")


def _with_area_reason(df: DataFrame) -> DataFrame:
    """Area requests with their point ``p`` and limit ``minutes``, and why they cannot be answered, or NULL."""
    full = _with_absent(df, "option", "cost", "period").withColumn("p", parse_point(F.col("point")))
    minutes = F.when(F.col("cost").isNull(), DEFAULT_MINUTES).otherwise(F.trim(F.col("cost").cast("string")).try_cast("double"))
    option, period = F.coalesce("option", F.lit(DEFAULT_AREA_OPTION)), F.coalesce("period", F.lit(DEFAULT_AREA_PERIOD))
    sound = F.col("minutes").isNotNull() & ~F.isnan("minutes") & (F.col("minutes") > 0) & (F.col("minutes") < float("inf"))
    return full.withColumn("minutes", minutes).withColumn(
        "reason",
        F.when(F.col("p.lon").isNull() | F.col("p.lat").isNull(), "the point is not a longitude and a latitude")
        .when(~option.isin(AREA_OPTIONS), "unknown option")
        .when(~sound, "the cost is not a positive number of minutes")
        .when(~period.isin(PERIODS), "unknown period"),
    )


def rejected_area_requests(df: DataFrame) -> DataFrame:
    """(req_id, reason) of the area requests that cannot be answered; the others go on without them."""
    return _with_area_reason(df).where("reason is not null").select("req_id", "reason")


def area_requests(df: DataFrame) -> DataFrame:
    """(req_id, point[, option, cost, period]) as text to grid requests, with the defaults filled in.

    Requests that cannot be answered are left out; :func:`rejected_area_requests` lists them.
    """
    placed = _with_area_reason(df).where("reason is null").withColumn("g", to_grid(F.col("p.lon"), F.col("p.lat")))
    return placed.select(
        "req_id", F.col("g.x").alias("x"), F.col("g.y").alias("y"),
        F.coalesce("option", F.lit(DEFAULT_AREA_OPTION)).alias("option"), "minutes", F.coalesce("period", F.lit(DEFAULT_AREA_PERIOD)).alias("period"),
    )


def swap(requests: DataFrame) -> DataFrame:
    """The same requests the other way round."""
    other = {"src_x": "dst_x", "src_y": "dst_y", "dst_x": "src_x", "dst_y": "src_y"}
    return requests.select([F.col(other.get(c, c)).alias(c) for c in requests.columns])


def every_choice(requests: DataFrame) -> DataFrame:
    """Each request once per option and period: distance, then time in all six periods."""
    choices = F.array(
        F.struct(F.lit("distance").alias("option"), F.lit(None).cast("string").alias("period")),
        *[F.struct(F.lit("time").alias("option"), F.lit(p).alias("period")) for p in PERIODS],
    )
    return requests.drop("option", "period").withColumn("c", F.explode(choices)).select("*", "c.option", "c.period").drop("c")
