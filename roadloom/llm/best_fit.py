"""Variable-capacity best-fit packing.

Sequences may have any of several permitted lengths. A document's words are its tokens; a document longer than the longest
permitted length is cut into pieces, none is dropped. Pieces are dealt over shards of bounded size by hash, and each shard is packed
by decreasing best fit: a piece goes to the open bin it leaves the least room in. When none has room, a bin size is opened: the one with the
least cost per token, counting a bin's cost as its length plus a fixed cost per sequence, and its contents as the piece plus what the
smaller pieces still to come can be expected to add. At the end every bin is made as small as the permitted lengths allow.

Defined cases: null and empty texts have no words and get one piece of length 0 with bin -1; rows that repeat a doc_id are packed one by
one; empty input gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.source_mix import word_count
from roadloom.llm.tables import grouped, materialize

LENGTHS = (512, 1024, 2048, 4096)
SEQUENCE_COST = 16
SHARD = 16384


def pack(sizes: np.ndarray, lengths=LENGTHS, sequence_cost: int = SEQUENCE_COST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each piece, offset of each piece in its bin, final length of each bin); sizes are 1 to the longest length."""
    lengths = sorted(lengths)
    order = np.argsort(-sizes, kind="stable")
    ordered = sizes[order]
    to_come = np.concatenate([np.cumsum(ordered[::-1])[::-1], [0]])  # tokens from place i on
    bins = np.zeros(len(sizes), np.int64)
    offsets = np.zeros(len(sizes), np.int64)
    filled: list[int] = []
    rooms: list[tuple[int, int]] = []  # (room, bin), sorted
    for i, piece in enumerate(order):
        size = int(sizes[piece])
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            best = None
            for length in lengths:
                if length < size:
                    continue
                left = length - size
                smaller = int(np.searchsorted(-ordered, -left, "left"))
                expected = min(left, int(to_come[max(smaller, i + 1)]))
                cost = (min(x for x in lengths if x >= size + expected) + sequence_cost) / (size + expected)
                if best is None or cost < best[0]:
                    best = (cost, length)
            b, room = len(filled), best[1]
            filled.append(0)
        bins[piece], offsets[piece] = b, filled[b]
        filled[b] += size
        if room > size:
            insort(rooms, (room - size, b))
    sizes_of = np.array(lengths)
    return bins, offsets, sizes_of[np.searchsorted(sizes_of, np.array(filled, np.int64))] if filled else np.zeros(0, np.int64)


def _pack_shards(lengths, sequence_cost):
    def run(batches):
        for (shard,), t in grouped(batches, ["shard"]):
            size = t.column("length").to_numpy()
            some = np.flatnonzero(size > 0)
            order = some[np.lexsort((t.column("start").to_numpy()[some], t.column("mark").to_numpy()[some]))]  # the same whatever order rows arrive in
            bins = np.full(len(size), -1, np.int64)
            offsets, capacity = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            b, offsets[order], final = pack(size[order], lengths, sequence_cost)
            bins[order] = b + (shard << 24)
            capacity[order] = final[b]
            yield pa.RecordBatch.from_arrays(
                [t.column(c).combine_chunks() for c in ("doc_id", "start", "length")] + [pa.array(x) for x in (bins, offsets, capacity)],
                names=["doc_id", "start", "length", "bin_id", "offset", "capacity"],
            )

    return run


def best_fit(docs: DataFrame, lengths=LENGTHS, sequence_cost: int = SEQUENCE_COST, shard: int = SHARD) -> DataFrame:
    """One row per piece of (doc_id, text): doc_id, start (first word), length, bin_id, offset (in the bin), capacity (of the bin)."""
    longest = max(lengths)
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text")).alias("size"))
    pieces = materialize(
        sized.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(longest).cast("long"))))
        .withColumn("length", F.least(F.col("size") - F.col("start"), F.lit(longest)).cast("long")),
        "pieces",
    )
    shards = max(1, -(-pieces.count() // shard))
    mark = F.xxhash64("doc_id", "start", "size", F.monotonically_increasing_id())  # of the written table: stable, and apart for repeated rows
    dealt = pieces.withColumn("mark", mark).withColumn("shard", F.pmod("mark", F.lit(shards)).cast("long"))
    return dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(
        _pack_shards(tuple(lengths), sequence_cost), "doc_id long, start long, length long, bin_id long, offset long, capacity long"
    )
