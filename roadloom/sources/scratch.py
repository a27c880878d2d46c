"""Written intermediate tables.

Loops and numbering passes cut their lineage by writing parquet under the
folder named in ``spark.checkpoint.dir``. A written table outlives lost
executors and gives the next plan true size statistics.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_BY_FILES, _MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch folder of this session."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="roadloom-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder; nothing is created yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def measured_joins(spark: SparkSession):
    """Within, the side of a join is broadcast for its measured size only, or where the code says so.

    Rows may be a hundred times larger in memory than in their files, by which Spark would else judge them, and a broadcast
    passes through the driver. The session's own settings hold again afterwards.
    """
    before = {k: spark.conf.getAll.get(k) for k in (_BY_FILES, _MEASURED)}
    spark.conf.set(_MEASURED, before[_MEASURED] or spark.conf.get(_BY_FILES))
    spark.conf.set(_BY_FILES, "-1")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialize(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once, in sub-folders of the columns ``by`` if given, and read it back."""
    path = new_folder(df.sparkSession, label)
    with measured_joins(df.sparkSession):
        df.write.partitionBy(*(by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
