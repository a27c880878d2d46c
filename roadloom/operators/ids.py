"""Dense surrogate ids over a total order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadloom.sources.scratch import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def dense_id(df: DataFrame, order: list, name: str = "id", offset: int = 0) -> DataFrame:
    """Add ``row_number() over (order by ...) + offset`` as ``name``.

    One range shuffle sorts the rows and one write fixes their places. The
    number of a row is its place in its partition plus the rows before that
    partition; the per-partition counts are the only thing broadcast, one row
    per partition. ``order`` must be a total order to be deterministic.
    """
    placed = materialize(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "dense-id")
    part = F.shiftright("_place", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, (F.col("_start") + row + 1 + offset).cast("long"))
        .drop("_part", "_place", "_start")
    )


def unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``df``, raising when it is read if two rows agree in ``keys``."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    repeated = F.raise_error(F.concat_ws(" ", F.lit(f"{what} is repeated:"), *[F.col(k).cast("string") for k in keys]))
    return df.withColumn("_once", F.when(n > 1, repeated).otherwise(F.lit("")).cast("string")).where("_once = ''").drop("_once")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; empty for a proper key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
