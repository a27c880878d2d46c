"""Load, replace and append tables; write features.

A table that is replaced is a folder of versions and a log of switches. A new version is written beside the others and becomes the table by one
line added to the log, so a write that fails half-way leaves the table as it was, and readers of the old version finish undisturbed.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadloom.operators.ids import duplicates
from roadloom.sources.schemas import INPUTS

_LOG = "n long, version string"


def load(spark: SparkSession, folder: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Scan one input table with its declared schema, so only used columns are read."""
    return spark.read.format(fmt).schema(INPUTS[name]).load(f"{folder}/{name}.parquet" if fmt == "parquet" else f"{folder}/{name}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast ``df`` to exactly ``schema``."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _version(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """Number and folder of the current version of the table at ``path``; (0, None) before the first."""
    try:
        log = spark.read.schema(_LOG).json(f"{path}/log")
        last = log.orderBy("n", "version", ascending=False).first()
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in (missing.getCondition() or ""):
            raise
        last = None
    return (last.n, f"{path}/{last.version}") if last else (0, None)


def current(spark: SparkSession, path: str) -> DataFrame:
    """A scan of the table at ``path`` as it is now."""
    _, folder = _version(spark, path)
    if folder is None:
        raise ValueError(f"there is no table at {path}")
    return spark.read.parquet(folder)


def save(df: DataFrame, path: str, key: list[str] | None = None) -> DataFrame:
    """Replace the table at ``path`` and return a scan of it. With ``key``, raise and keep the old table if two rows agree in it."""
    spark = df.sparkSession
    n, _ = _version(spark, path)
    version = f"v{n + 1}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{path}/{version}")
    written = spark.read.schema(df.schema).parquet(f"{path}/{version}")
    if key:
        twice = duplicates(written, key).first()
        if twice is not None:
            raise ValueError(f"{', '.join(key)} must be unique, but {twice.asDict()} is not")
    spark.createDataFrame([(n + 1, version)], _LOG).coalesce(1).write.mode("append").json(f"{path}/log")
    return written


def append(df: DataFrame, path: str) -> DataFrame:
    """Add rows to the table at ``path`` and return a scan of it."""
    spark = df.sparkSession
    schema = current(spark, path).schema
    _, folder = _version(spark, path)
    conform(df, schema).write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def responses(summary: DataFrame, features: DataFrame) -> DataFrame:
    """Each request's ``summary`` row with ``features``, its GeoJSON features in order; a request without any has an empty list."""
    seq = F.col("seq") if "seq" in features.columns else F.lit(0)
    listed = features.groupBy("req_id").agg(F.array_sort(F.collect_list(F.struct(seq.alias("seq"), "feature"))).alias("f"))
    texts = F.coalesce(F.transform("f", lambda s: s["feature"]), F.array().cast("array<string>"))
    return summary.join(listed, "req_id", "left").withColumn("features", texts).drop("f")


def write_responses(responses: DataFrame, path: str) -> None:
    """Write one JSON object per request and line: what its row of the summary says, then its features."""
    head = F.to_json(F.struct(*[c for c in responses.columns if c != "features"]), {"ignoreNullFields": "false"})
    text = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"type":"FeatureCollection","features":['), F.concat_ws(",", "features"), F.lit("]}"))
    responses.select(text.alias("value")).write.mode("overwrite").text(path)


def write_features(features: DataFrame, path: str) -> None:
    """Write GeoJSON features as text, one per line; routes come in order of request and step."""
    ordered = features.orderBy("req_id", "seq") if "seq" in features.columns else features
    ordered.select("feature").write.mode("overwrite").text(path)
