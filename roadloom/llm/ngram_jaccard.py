"""N-gram Jaccard join with Bayesian candidate pruning.

A text's set is its distinct runs of five words (a shorter text: all its words, one element). Texts with equal sets are one class.
Each class has a MinHash signature of 128 values; four values are a band, so a pair at the threshold of 0.8 shares none of the 32
bands with a chance of 5e-8. Pairs that share a band are compared value by value in growing steps, and a pair is dropped when, with
a uniform prior, the posterior probability that its similarity reaches the threshold is below the tolerance. What is left is verified
exactly on the sets themselves. Groups are pairs of bounded blocks; link counts and spanning trees leave them, never all pairs.

Defined cases: a null or empty text has no set and links with nothing. Texts of fewer than five words match only texts with the same
words. Rows that repeat a doc_id are documents of their own: classes are known by a written row number, not by doc_id. Of a group, the
row with the smallest doc_id is kept, and of several with that doc_id one. A row without doc_id is a document of its own that links with nothing.
Empty input gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadloom.llm.pairs import block_pairs, components, first_shared, spanning_edges
from roadloom.llm.tables import grouped, materialize, tidy
from roadloom.llm.words import shingles, word_chunks, word_hashes
from roadloom.operators.skew import fresh

WORDS = 5
THRESHOLD = 0.8
VALUES, BAND = 128, 4
TOLERANCE = 1e-6
STEP = 16
BLOCK, SIDE = 1024, 256  # members of a block; sets of each side that are compared at a time
_rng = np.random.default_rng(7)
_A = (_rng.integers(1, 1 << 32, VALUES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_X = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32)


def signature(elements: np.ndarray) -> np.ndarray:
    """MinHash values, folded to 16 bits, four of them in each of the returned 64-bit band keys."""
    folded = (elements >> np.uint64(32)).astype(np.uint32)
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(folded), 2048):
        part = folded[k : k + 2048]
        np.minimum(least, ((part[None, :] ^ _X[:, None]) * _A[:, None]).min(1), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16).view(np.int64)


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For each number of values compared: the fewest matches that leave the threshold likely enough.

    With a uniform prior, P(similarity >= t | m of n match) = P(Binomial(n + 1, t) <= m).
    """
    found = {}
    for n in range(STEP, VALUES + 1, STEP):
        below, m = 0.0, -1
        while below < tolerance:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        found[n] = m
    return found


def _sets(batches):
    """Per row: id, place, body (a hash of the text), digest of the set and its band keys."""
    for batch in batches:
        for w in word_chunks(batch.column("text")):
            sets = shingles(w, word_hashes(w), WORDS)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).slice(w.first, w.last - w.first) for c in ("id", "place", "body")), _digests(sets),
                    pa.array([signature(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                names=["id", "place", "body", "digest", "keys"],
            )


def _digests(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary())


def _elements(batches):
    """(class, elements) from texts with the class they were asked for and its digest; a text of another set is left out."""
    for batch in batches:
        for w in word_chunks(batch.column("text")):
            sets = shingles(w, word_hashes(w), WORDS)
            wanted = batch.column("digest").slice(w.first, w.last - w.first).to_pylist()
            same = [i for i, d in enumerate(_digests(sets).to_pylist()) if d == wanted[i]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("class").slice(w.first, w.last - w.first).take(pa.array(same, pa.int64())), pa.array([sets[i].tobytes() for i in same], pa.binary())],
                names=["class", "elements"],
            )


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many elements each left set shares with each right set, exactly."""
    out = np.zeros((len(left), len(right)), np.float32)
    every = np.concatenate(left + right)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    values, place, count = np.unique(every, return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1
    keep = count[place] > 1
    owner, column = owner[keep], column[place[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (begin, begin + width))
        ones = np.zeros((len(left) + len(right), width), np.float32)
        ones[owner[a:b], column[a:b] - begin] = 1
        out += ones[: len(left)] @ ones[len(left) :].T
    return out


def _likely(t: pa.Table, band: int, halves: bool, needed: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of the pairs of a group that first meet in this band and that no step of the comparison drops."""
    none = np.zeros(0, np.int64)
    second = t.column("second").to_numpy()
    keys = np.stack(t.column("keys").to_numpy())
    left, right = (np.flatnonzero(~second), np.flatnonzero(second)) if halves else (np.arange(len(second)),) * 2
    if not len(left) or not len(right):
        return none, none
    alive = first_shared(keys[left], keys[right], band)
    if not halves:
        alive = np.triu(alive, 1)
    a, b = np.nonzero(alive)
    a, b = left[a], right[b]
    values = np.ascontiguousarray(keys).view(np.uint16)
    matches = np.zeros(len(a), np.int32)
    for n in range(STEP, VALUES + 1, STEP):
        if not len(a):
            break
        matches += (values[a, n - STEP : n] == values[b, n - STEP : n]).sum(1, dtype=np.int32)
        likely = matches >= needed[n]
        a, b, matches = a[likely], b[likely], matches[likely]
    return a, b


def _reaching(blobs: pa.ChunkedArray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs (a, b) of places in ``blobs`` reach the threshold exactly; the sets of ``SIDE`` by ``SIDE`` places are open at a time."""
    linked = np.zeros(len(a), bool)
    rows, row = np.unique(a, return_inverse=True)
    cols, col = np.unique(b, return_inverse=True)
    wide = -(-len(cols) // SIDE)
    part = row // SIDE * wide + col // SIDE
    order = np.argsort(part, kind="stable")
    for these in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        i0, j0 = row[these[0]] // SIDE * SIDE, col[these[0]] // SIDE * SIDE
        left, right = ([np.frombuffer(blobs[int(i)].as_py(), np.uint64) for i in places] for places in (rows[i0 : i0 + SIDE], cols[j0 : j0 + SIDE]))
        i, j = row[these] - i0, col[these] - j0
        shared = _shared_counts(left, right)[i, j]
        union = np.array([len(x) for x in left])[i] + np.array([len(x) for x in right])[j] - shared
        linked[these] = shared >= threshold * union - 1e-9 * union
    return linked


GROUP = ["band", "key", "lo", "hi"]


def _prune(threshold: float, tolerance: float):
    """The members of each group that have a likely pair in it; the others need no sets there."""
    needed = least_matches(threshold, tolerance)

    def run(batches):
        for (band, _, lo, hi), t in grouped(batches, GROUP):
            some = np.unique(np.concatenate(_likely(t, band, lo != hi, needed)))
            if len(some):
                yield from t.select([*GROUP, "second", "id"]).take(pa.array(some)).combine_chunks().to_batches()

    return run


def _verify(threshold: float, tolerance: float):
    needed = least_matches(threshold, tolerance)

    def run(batches):
        for (band, _, lo, hi), t in grouped(batches, GROUP):
            ids, copies = (t.column(c).to_numpy() for c in ("id", "copies"))
            a, b = _likely(t, band, lo != hi, needed)
            if not len(a):
                continue
            linked = _reaching(t.column("elements"), a, b, threshold)
            a, b = a[linked], b[linked]
            if not len(a):
                continue
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


def _in_groups(members: DataFrame) -> DataFrame:
    return members.repartition(*GROUP).sortWithinPartitions(*GROUP)


def _judged(rows: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(id, place, class_id, n_links, component_id, kept) of every row of (id, place, text)."""
    known = rows.where("id is not null").withColumn("body", F.xxhash64("text"))
    # the row number is written with the sets, so it stays the same from here on
    sets = materialize(
        known.mapInArrow(tidy(_sets), "id long, place string, body long, digest binary, keys array<long>").withColumn("row", F.monotonically_increasing_id()), "sets"
    )
    first = sets.where("digest is not null").groupBy("digest").agg(
        F.min(F.struct("id", "row", "body")).alias("first"), F.count("*").alias("copies"), F.any_value("keys").alias("keys")
    )
    classes = materialize(first.select("digest", F.col("first.row").alias("id"), F.col("first.id").alias("class_id"), "first.body", "copies", "keys"), "classes")
    # signatures first: sets are fetched only for members with a likely pair, in the one band where the pair first meets
    pairs = block_pairs(classes.select("id", "keys"), BLOCK).drop("bucket")
    likely = materialize(
        _in_groups(pairs.join(classes.select("id", "keys"), "id")).select(*GROUP, "second", "id", "keys")
        .mapInArrow(tidy(_prune(threshold, tolerance)), "band int, key long, lo int, hi int, second boolean, id long"),
        "likely",
    )
    asked = classes.join(likely.select("id").distinct(), "id", "left_semi").select(F.col("id").alias("class"), F.col("class_id").alias("id"), "body", "digest")
    # one plan at every size: a merge join, also where the ids would be few enough to broadcast
    texts = known.join(asked.hint("merge"), ["id", "body"]).select("class", "digest", "text")
    elements = texts.mapInArrow(tidy(_elements), "class long, elements binary").dropDuplicates(["class"]).withColumnRenamed("class", "id")
    work = likely.join(classes.select("id", "copies", "keys").join(elements, "id"), "id")
    found = materialize(_in_groups(work).mapInArrow(tidy(_verify(threshold, tolerance)), "id long, links long, to long"), "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = materialize(components(found.where("to <> id").select(F.col("id").alias("u"), F.col("to").alias("v")), "components"), "parts")
    # the row of a component that has the smallest doc_id
    least = classes.join(parts, "id").groupBy("component_id").agg(F.min(F.struct("class_id", F.col("id").alias("row"))).alias("best"))
    placed = parts.join(least, "component_id").select("id", "best")
    best = F.coalesce("best", F.struct("class_id", F.col("id").alias("row")))
    per_class = classes.select("digest", "id", "class_id", "copies").join(links, "id", "left").join(placed, "id", "left").select(
        "digest", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), best.alias("best")
    )
    with_set = sets.where("digest is not null").select("id", "place", "row", "digest").join(per_class, "digest").select(
        "id", "place", "class_id", "n_links", F.col("best.class_id").alias("component_id"), (F.col("row") == F.col("best.row")).alias("kept")
    )
    alone = sets.where("digest is null").select("id", "place").union(rows.where("id is null").select("id", "place"))
    return with_set.union(
        alone.select("id", "place", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    )


def _rows(docs: DataFrame, place: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("id"), place.alias("place"), F.col("text").cast("string").alias("text"))


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document of (doc_id, text): doc_id, class_id (least doc_id with an equal set), n_links (other documents at the
    threshold or above, copies included), component_id (least doc_id reachable by links), kept (the one row of its group that stays)."""
    judged = _judged(_rows(docs, F.lit(None).cast("string")), threshold, tolerance)
    return judged.select(F.col("id").alias("doc_id"), "class_id", "n_links", "component_id", "kept")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, scanned: bool = False) -> DataFrame:
    """The rows of ``docs`` (any columns) of which one is kept of each group; rows without doc_id or without words stay.

    Rows are told apart by their place in a file: ``docs`` is written first, unless it is ``scanned``, a plain scan of files.
    """
    there = docs if scanned else materialize(docs, "jaccard-input")
    place = F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))
    gone = _judged(_rows(there, place), threshold, TOLERANCE).where("not kept").select("place")
    at = fresh("place", docs)
    return there.withColumn(at, place).join(gone.withColumnRenamed("place", at), at, "left_anti").select(*docs.columns)
