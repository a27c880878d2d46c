"""Equi-joins whose hot keys are spread over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.sources.scratch import materialize

PART_ROWS = 100_000
MOST_KEYS = 1 << 14


def fresh(name: str, *tables: DataFrame) -> str:
    """A column name close to ``name`` that none of ``tables`` has."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def heavy_keys(df: DataFrame, on: list[str], part_rows: int = PART_ROWS, most: int = MOST_KEYS) -> DataFrame:
    """Keys of ``df`` with over ``part_rows`` rows and the ``parts`` they take, at most the ``most`` heaviest.

    A key that is left out for that has at most a ``most``-th of all rows. The counts are combined before they are shuffled.
    """
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > part_rows)
    top = counts.orderBy(F.desc("rows"), *on).limit(most)
    return materialize(top.select(*on, F.ceil(F.col("rows") / part_rows).cast("int").alias("parts")), "heavy-keys")


def split_join(
    big: DataFrame, small: DataFrame, on: list[str], spread: list[str], how: str = "inner", part_rows: int = PART_ROWS, most: int = MOST_KEYS
) -> DataFrame:
    """``big.join(small, on, how)`` for ``how`` inner, left, left_semi or left_anti, with no key of ``big`` in one task.

    A key with over ``part_rows`` rows in ``big`` is dealt to parts by the values of ``spread``, which should differ between its rows; its
    rows in ``small`` are repeated once a part. Only the list of such keys, bounded by ``most``, is broadcast. Rows
    without a key match nothing, as in any join, and are dealt out like other hot keys. ``big`` is read twice, to count and to join:
    hand over a scan or a written table.
    """
    parts, part = fresh("parts", big, small), fresh("part", big, small)
    heavy = heavy_keys(big, on, part_rows, most).withColumnRenamed("parts", parts)

    def marked(df: DataFrame) -> DataFrame:
        same = [df[c].eqNullSafe(heavy[c]) for c in on]
        return df.join(F.broadcast(heavy), same, "left").select(*(df[c] for c in df.columns), F.coalesce(heavy[parts], F.lit(1)).alias(parts))

    dealt = marked(big).withColumn(part, F.pmod(F.xxhash64(*spread), F.col(parts)).cast("int")).drop(parts)
    copied = marked(small).withColumn(part, F.explode(F.sequence(F.lit(0), F.col(parts) - 1))).drop(parts)
    return dealt.join(copied, [*on, part], how).drop(part)
