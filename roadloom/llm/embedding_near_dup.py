"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact cosine check, connected components.

Vectors are compared within their label. Equal vectors are one class and are compared once. A table's key is the signs of a vector
against the table's hyperplanes. The number of hyperplanes follows from the largest label's size, so that a bucket holds few unrelated
vectors at any scale, and the number of tables from the wanted chance of missing a pair just at the threshold. Pairs that share a
bucket are checked with their cosine in double precision, block against block.

Defined cases: a vector that is null, zero, or holds null or non-finite components links with nothing, nor does one without a label;
vectors of different lengths do not link. Empty input gives no rows. Rows that repeat a ``vec_id`` are vectors of their own: classes are
known by a written number, not by ``vec_id``. A row without ``vec_id`` links with nothing and is kept, without a component. Vectors are scaled by a power of two first, so squares of very large or small components stay
finite. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.pairs import block_pairs, components, first_shared, spanning_edges
from roadloom.llm.tables import grouped, materialize

THRESHOLD = 0.93
MISS = 1e-4
SEED = 20240607


def tables_for(rows: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits per table, tables): about a tenth of an unrelated partner per bucket, and at most ``miss`` of threshold pairs lost."""
    bits = min(62, max(4, math.ceil(math.log2(max(rows, 2))) + 3))
    agree = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(miss) / math.log1p(-(agree**bits)))


def _planes(size: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, size]).standard_normal((size, bits * tables))


def _scaled(v: np.ndarray) -> np.ndarray:
    """``v`` times the power of two that brings its largest component near 1; this rounds nothing that counts."""
    return np.ldexp(v, -int(np.frexp(np.abs(v).max())[1])) if len(v) else v


def _sign_keys(bits: int, tables: int):
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        weights = np.int64(1) << np.arange(bits, dtype=np.int64)
        for batch in batches:
            flat = [_scaled(np.asarray(v, np.float64)) for v in batch.column("embedding").to_pylist()]
            keys = np.zeros((len(flat), tables), np.int64)
            for size in {len(v) for v in flat}:
                at = [i for i, v in enumerate(flat) if len(v) == size]
                if size not in planes:
                    planes[size] = _planes(size, bits, tables)
                signs = (np.stack([flat[i] for i in at]) @ planes[size] >= 0).reshape(len(at), tables, bits)
                keys[at] = signs @ weights
            # the label and the length are part of the key: other labels are never compared
            tag = np.array([hash((a, len(v))) for a, v in zip(batch.column("label").to_pylist(), flat, strict=True)], np.int64)
            with np.errstate(over="ignore"):
                keys = (keys ^ (tag[:, None] * np.int64(-7046029254386353131))) if len(flat) else keys
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(list(keys), pa.list_(pa.int64()))], names=["id", "keys"]
            )

    return run


def _check(threshold: float):
    def run(batches):
        for (_, _, lo, hi), t in grouped(batches, ["band", "key", "lo", "hi"]):
            band = t.column("band")[0].as_py()
            ids, copies, label, second = (t.column(c).to_numpy() for c in ("id", "copies", "label", "second"))
            keys = np.stack(t.column("keys").to_numpy())
            lists = t.column("embedding").to_pylist()
            size = len(lists[0])
            fits = np.array([len(v) == size for v in lists]) & (label == label[0])  # others met by a chance key, and meet their own elsewhere
            x = np.array([_scaled(np.array(v, np.float64)) if ok else np.zeros(size) for v, ok in zip(lists, fits, strict=True)])
            norm = np.where(fits, np.sqrt((x * x).sum(1)), np.inf)
            left, right = (np.flatnonzero(~second), np.flatnonzero(second)) if lo != hi else (np.arange(len(ids)),) * 2
            if not len(left) or not len(right):
                continue
            cosine = (x[left] @ x[right].T) / norm[left][:, None] / norm[right][None, :]
            hit = (cosine >= threshold) & first_shared(keys[left], keys[right], band)
            if lo == hi:
                hit = np.triu(hit, 1)
            a, b = np.nonzero(hit)
            if not len(a):
                continue
            a, b = left[a], right[b]
            links = np.zeros(len(ids), np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            tree = spanning_edges(a, b, ids)
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([ids[some], tree[:, 0]])),
                    pa.array(np.concatenate([links[some], np.zeros(len(tree), np.int64)])),
                    pa.array(np.concatenate([ids[some], tree[:, 1]])),
                ],
                names=["id", "links", "to"],
            )

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """One row per vector of (vec_id, embedding, label): vec_id, n_links, component_id, kept, and the class of equal vectors."""
    rows = vectors.select("vec_id", "embedding", "label")
    sound = (
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("embedding", lambda v: v != 0)
    )
    sound = F.coalesce(sound, F.lit(False))
    classes = materialize(
        rows.where(sound).groupBy("label", "embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
        .select(F.monotonically_increasing_id().alias("id"), F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding", "copies"),
        "vectors",
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = tables_for(largest, threshold, miss)
    keyed = materialize(classes.select("id", "label", "embedding").mapInArrow(_sign_keys(bits, tables), "id long, keys array<long>"), "signs")
    work = block_pairs(keyed).join(classes.drop("vec_id"), "id").join(keyed, "id")
    found = materialize(
        work.repartition("band", "key", "lo", "hi").sortWithinPartitions("band", "key", "lo", "hi").mapInArrow(_check(threshold), "id long, links long, to long"),
        "links",
    )
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = components(found.where("to <> id").select(F.col("id").alias("u"), F.col("to").alias("v")), "components")
    parts = materialize(parts, "parts")
    least = classes.select("id", "vec_id").join(parts, "id").groupBy("component_id").agg(F.min("vec_id").alias("least"))
    per_class = (
        classes.join(links, "id", "left").join(parts.join(least, "component_id").select("id", "least"), "id", "left")
        .select(
            "label", "embedding", F.col("vec_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("least", "vec_id").alias("component_id"),
        )
    )
    own = rows.where(sound).join(per_class, ["label", "embedding"]).select("vec_id", "n_links", "component_id", "class_id")
    alone = rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"), F.col("vec_id").alias("class_id"))
    return own.union(alone).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("n_links").cast("long").alias("n_links"), "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"), F.col("class_id").cast("long").alias("class_id"),
    )
