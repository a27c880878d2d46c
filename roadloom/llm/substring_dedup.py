"""Substring dedup: seed and extend.

Texts that are equal word by word are one: all but the first are repeats as a whole (if they are as long as a window). In the others, seeds are
winnowed runs of ``SEED`` words: every window of 20 words holds the least seed of its own, at the same place wherever the window
occurs, so two equal windows always share a seed. Documents are joined on seeds that occur twice or more. Around such a seed the match is
extended both ways as far as a window that holds the seed can reach; an extension counts when the 20 words have the same 64-bit hash as
an earlier place (smaller doc_id, or earlier in the document). Overlapping extensions make up the maximal repeats, and the words under
them go. Within a document, a window's later places are repeats of its first, so a hash has one row per document at most.

Defined cases: a null or empty text has no words; a text shorter than a window is kept whole; rows that repeat a doc_id are one document, judged
row by row against the others, each by a row number written with its seeds; rows without doc_id are one document too, the last; empty input
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.tables import materialize
from roadloom.llm.words import mix, runs_hash, word_chunks, word_hashes

WINDOW = 20
SEED = 6
LAST = 9223372036854775807


def _sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least (or largest) of every ``width`` consecutive values."""
    f = np.minimum if least else np.maximum
    have = 1
    while have * 2 <= width:
        x = f(x[: len(x) - have], x[have:])
        have *= 2
    return f(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def _grams(hashes: np.ndarray, seed: int) -> np.ndarray:
    return np.maximum(mix(runs_hash(hashes, seed) + np.uint64(seed)), np.uint64(1))


def winnowed(hashes: np.ndarray, row: np.ndarray, window: int = WINDOW, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the seeds that are the least of some window within one text."""
    if len(hashes) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = _grams(hashes, seed)
    width = window - seed + 1
    least = _sliding(grams, width, True)
    whole = row[: len(least)] == row[window - 1 : window - 1 + len(least)]
    least = np.where(whole, least, np.uint64(0))
    around = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    around[width - 1 : width - 1 + len(least)] = least
    place = np.flatnonzero(_sliding(around, width, False) == grams)
    return place, grams[place]


def _seeds(window: int, seed: int):
    def run(batches):
        for batch in batches:
            for w in word_chunks(batch.column("text")):
                n = w.last - w.first
                place, grams = winnowed(word_hashes(w), w.row, window, seed)
                first = np.concatenate([[0], np.cumsum(w.count)])
                cuts = np.searchsorted(w.row[place], np.arange(n + 1)).astype(np.int32)
                ends = np.cumsum(w.sizes)
                digest = [hashlib.sha256(b" ".join(w.data[e - s : e].tobytes().split())).digest() for s, e in zip(w.sizes, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(w.first, n) for c in ("key", "body")), pa.array(w.count), pa.array(digest, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(grams.view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array((place - first[w.row[place]]).astype(np.int32))),
                    ],
                    names=["key", "body", "n_words", "digest", "seeds", "places"],
                )

    return run


def _windows(w, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, start in its row) of every whole window of a chunk."""
    runs = runs_hash(word_hashes(w), window)
    start = np.flatnonzero(w.row[: len(runs)] == w.row[window - 1 : window - 1 + len(runs)]) if len(runs) else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(w.count)])
    return runs[start], w.row[start], start - first[w.row[start]]


def _first_places(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which windows are the first of their hash in their text; windows come in order."""
    order = np.lexsort((np.arange(len(hashes)), hashes, row))
    first = np.ones(len(hashes), bool)
    same = (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
    first[order[1:][same]] = False
    return first


def _reachable(shared: np.ndarray, lengths: np.ndarray, w, start: np.ndarray, window: int, seed: int) -> np.ndarray:
    """Which windows (by their first word in the chunk) have a shared seed as the least of their own."""
    hashes = word_hashes(w)
    if not len(start):
        return np.zeros(0, bool)
    count = w.count
    first = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(lengths)), lengths)
    ok = shared + seed <= count[owner]
    grams = _grams(hashes, seed)
    least = _sliding(grams, window - seed + 1, True)
    return np.isin(least[start], grams[first[owner[ok]] + shared[ok]])


def _extensions(window: int, seed: int):
    def run(batches):
        for batch in batches:
            for w in word_chunks(batch.column("text")):
                places = batch.column("places").slice(w.first, w.last - w.first)
                hashes, row, start = _windows(w, window)
                lengths = pc.list_value_length(places).to_numpy(zero_copy_only=False)
                begin = np.concatenate([[0], np.cumsum(w.count)])[row] + start
                some = np.flatnonzero(_reachable(places.flatten().to_numpy().astype(np.int64), lengths, w, begin, window, seed))
                hashes, row, start = hashes[some], row[some], start[some]
                first = _first_places(hashes, row)
                keys, nos = (batch.column(c).to_numpy()[w.first : w.last][row[first]] for c in ("key", "no"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[first].view(np.int64)), pa.array(keys), pa.array(nos), pa.array(start[first].astype(np.int32))], names=["window", "key", "no", "start"]
                )

    return run


def _kept(window: int):
    def run(batches):
        for batch in batches:
            for w in word_chunks(batch.column("text")):
                n = w.last - w.first
                hashes, row, start = _windows(w, window)
                later = ~_first_places(hashes, row)
                lists = batch.column("starts").slice(w.first, n)
                first = np.concatenate([[0], np.cumsum(w.count)])
                change = np.zeros(len(w.start) + 1, np.int64)
                # a repeat of another document's window is one at all its places in the document
                found = np.zeros(len(hashes), bool)
                at = np.full(len(w.start) + 1, -1)
                at[first[row] + start] = np.arange(len(hashes))
                for i, starts in enumerate(lists):
                    if starts.is_valid and len(starts):
                        found[at[first[i] + np.asarray(starts.values)]] = True
                gone = np.flatnonzero(later | found)
                begin = first[row[gone]] + start[gone]
                np.add.at(change, begin, 1)
                np.add.at(change, begin + window, -1)
                keep = np.cumsum(change[:-1]) == 0
                digests, removed, whole = [], [], []
                ends = np.cumsum(w.sizes)
                for i in range(n):
                    words = w.data[ends[i] - w.sizes[i] : ends[i]].tobytes().split()
                    rest = list(compress(words, keep[first[i] : first[i + 1]].tolist()))
                    whole.append(hashlib.sha256(b" ".join(words)).digest())
                    digests.append(hashlib.sha256(b" ".join(rest)).hexdigest())
                    removed.append(len(words) - len(rest))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(w.first, n), pa.array(whole, pa.binary()), pa.array(w.count), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                    names=["key", "digest", "n_words", "n_removed", "kept_sha256"],
                )

    return run


def repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row per row of (doc_id, text): doc_id, n_words, n_removed, kept_sha256."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("key"), F.xxhash64(text).alias("body"), text.alias("text"))
    seeded = materialize(
        rows.mapInArrow(_seeds(window, seed), "key long, body long, n_words long, digest binary, seeds array<long>, places array<int>")
        .withColumn("no", F.monotonically_increasing_id()),
        "seeds",
    )
    long = seeded.where(F.col("n_words") >= window)
    # written, so that the joins below have a plain shuffle on either side and a digest or seed with very many rows is split
    copies = materialize(long.groupBy("digest").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most").drop("most"), "copies")
    # whether a row's text came earlier in another document; without the seeds, which are long
    judged = materialize(
        seeded.select("key", "body", "no", "n_words", "digest").join(copies, "digest", "left")
        .withColumn("copy", F.coalesce(F.col("key") > F.col("least"), F.lit(False))).drop("least"),
        "judged",
    )
    first = seeded.select("no", "seeds", "places").join(judged.where("copy").select("no"), "no", "left_anti")
    grams = first.select("no", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select(F.col("s.seeds").alias("seed"), "no", F.col("s.places").alias("place"))
    shared = materialize(grams.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed"), "shared")
    places = grams.join(shared, "seed").groupBy("no").agg(F.collect_list("place").alias("places"))
    # rows equal in doc_id and text are asked once and answered alike
    row = ["key", "body"]
    seeds = places.join(judged.select("no", *row), "no").groupBy(*row).agg(F.min("no").alias("no"), F.any_value("places").alias("places"))
    asked = materialize(rows.join(seeds.hint("merge"), row).drop("body"), "asked")
    found = materialize(asked.mapInArrow(_extensions(window, seed), "window long, key long, no long, start int"), "windows")
    earliest = found.groupBy("window").agg(F.min("key").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    repeated = found.join(earliest, "window").where("key > least").groupBy("no").agg(F.collect_list("start").alias("starts"))
    cleaned = asked.join(repeated.hint("merge"), "no", "left").select("key", "text", "starts").mapInArrow(_kept(window), "key long, digest binary, n_words long, n_removed long, kept_sha256 string")
    changed = materialize(cleaned.where("n_removed > 0"), "changed")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    whole = judged.where("copy").select("key", "n_words", F.col("n_words").alias("n_removed"), empty.alias("kept_sha256"))
    same = ["key", "digest"]  # rows that agree in both are the same
    partly = changed.join(judged.where("copy").select(same).distinct().hint("merge"), same, "left_anti").drop("digest")
    rest = judged.where("not copy").join(changed.select(same).distinct(), same, "left_anti").select(
        "key", "n_words", F.lit(0).cast("long").alias("n_removed"), F.lower(F.hex("digest")).alias("kept_sha256")
    )
    return whole.union(partly).union(rest).select(F.when(F.col("key") < LAST, F.col("key")).alias("doc_id"), "n_words", "n_removed", "kept_sha256")
