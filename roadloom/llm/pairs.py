"""Pairs that share a bucket, compared block by block, and the components their links form.

A bucket of any size is cut into blocks of at most about ``BLOCK`` members, and a group is one pair of blocks. Groups hand on link
counts and a spanning tree of their links, never the pairs themselves, so what is written grows with the members.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.tables import materialize

BLOCK = 256


def block_pairs(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (bucket, lo, hi, side, id, band) from members (id, keys array<long>), one key per band.

    Buckets with one member are left out, and so are buckets with the same members as an earlier band's bucket: the first band two
    members share is always among those that stay. ``id`` must be unique.
    """
    rows = members.select("id", F.posexplode("keys").alias("band", "key"))
    buckets = (
        rows.groupBy("band", "key")
        .agg(F.count("*").alias("n"), F.min("id").alias("least"), F.max("id").alias("most"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("mark"))
        .where("n > 1")
        .groupBy("n", "least", "most", "mark")
        .agg(F.min(F.struct("band", "key")).alias("b"))
        .select("b.band", "b.key", (F.floor((F.col("n") - 1) / block) + 1).cast("int").alias("blocks"))
    )
    placed = rows.join(buckets, ["band", "key"]).withColumn("own", F.pmod(F.xxhash64("id", "band"), F.col("blocks")).cast("int"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select(
        F.xxhash64("band", "key").alias("bucket"), "band", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        (F.col("own") > F.col("other")).alias("second"), "id",
    )


def first_shared(left: np.ndarray, right: np.ndarray, band: int) -> np.ndarray:
    """Which pairs (rows of both key matrices, one against all) share no band before ``band``."""
    fresh = np.ones((len(left), len(right)), bool)
    for b in range(band):
        fresh &= left[:, b][:, None] != right[:, b][None, :]
    return fresh


def spanning_edges(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For links a[i]-b[i] between places in ``ids``: rows (id, least id of its component) of every linked place but the least."""
    label = np.arange(len(ids))
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    label = rank.copy()
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[order[new]])
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != rank)
    return np.stack([ids[moved], ids[order[label[moved]]]], axis=1) if len(moved) else np.zeros((0, 2), np.int64)


def components(edges: DataFrame, label: str) -> DataFrame:
    """Rows (id, component_id), the least id reachable, for every id of ``edges`` (u, v); ids without an edge do not appear.

    Large-star and small-star steps until nothing changes; each step is a written table.
    """
    spark = edges.sparkSession
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    state = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = materialize(small.select("e.*").where("u <> v").distinct(), label)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == state:
            break
        state = seen
    stars = now.groupBy("u").agg(F.min("v").alias("c"))
    roots = stars.select(F.col("c").alias("u"), "c").distinct()
    return spark.createDataFrame([], "u long, c long").union(stars).union(roots).select(F.col("u").alias("id"), F.col("c").alias("component_id"))
