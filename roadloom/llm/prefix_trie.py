"""The trie of conversation prefixes, by truncation peeling.

Conversations are rows of turns; a node is a distinct sequence of first turns. Peeling starts from the deepest turns: conversations that end
there are merged into nodes, each node loses its last turn and meets, at its shorter sequence, other nodes and the conversations that end
there, and so on up to the root. A node's measures are summed while its children arrive, so every node is found and finished
in one pass.

What need not be peeled turn by turn is not: the turns a conversation shares with no other are finished at once, and a run of
turns along which the same conversations stay together is peeled as one, so the number of steps is the number of places on a path where
conversations part or end, not its number of turns. To that end the conversations of each sequence are counted first. Sequences are
known by a 128-bit hash chained over the SHA-256 of their turns.

Rebuilt conversations: of conversation c, the first h = crc32(c) % 9 turns of conversation c - c % 5 come first, then c's own after its first h.
A conversation of very many turns passes its task as a stream; hot sequences are joined in parts; the conversation ids that end at a node are
hashed as a sorted stream.

Defined cases: null turns come first, equal turns are in the order of the SHA-256 of their role and text; a null role or text is empty;
repeated rows are turns of their own; rows without conv_id belong to no conversation and are left out; empty input gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import functools
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom.llm.tables import materialize, tidy
from roadloom.operators.skew import PART_ROWS, split_join

SHARED, GROUP = 9, 5
_ROOT = blake2b(b"", digest_size=16).digest()
_NOBODY = sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 of a turn; the length of the role comes first, so that role and text cannot run together."""
    return F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)).cast("binary"), 256)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, ids): rebuilt turns as conv, step (their order), digest, bytes, and the conv of every conversation, with turns or not."""
    body, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), turn_digest(role, body).alias("digest"), F.octet_length(body).cast("long").alias("bytes")
    ).where("conv is not null")
    place = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "digest")
    turns = materialize(rows.withColumn("pos", F.row_number().over(place)).drop("turn"), "turns")
    taken = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(SHARED)).cast("int")
    ids = turns.where("pos = 1").select("conv", taken.alias("h"))
    heads = turns.where((F.col("pos") < SHARED) & (F.col("conv") % GROUP == 0)).select(F.col("conv").alias("base"), "pos", "digest", "bytes")
    given = ids.withColumn("base", F.col("conv") - F.col("conv") % GROUP).join(heads, "base").where("pos <= h")
    own = turns.where(F.col("pos") > taken)
    return given.select("conv", F.col("pos").cast("long").alias("step"), "digest", "bytes").union(
        own.select("conv", (F.col("pos") + SHARED).cast("long").alias("step"), "digest", "bytes")
    ), ids.select("conv")


def _chain(batches):
    """Turns sorted by conversation and step to conv, depth, node, parent, bytes, last."""
    held = None  # the last turn seen: it is known to be its conversation's last when another begins
    for batch in batches:
        out = []
        for conv, digest, size in zip(*(batch.column(c).to_pylist() for c in ("conv", "digest", "bytes")), strict=True):
            if held is not None and held[0] == conv:
                out.append((*held, False))
                depth, parent = held[1] + 1, held[2]
            else:
                if held is not None:
                    out.append((*held, True))
                depth, parent = 1, _ROOT
            held = (conv, depth, blake2b(parent + bytes.fromhex(digest), digest_size=16).digest(), parent, size)
        if out:
            yield _links(out)
    if held is not None:
        yield _links([(*held, True)])


_LINK = "conv long, depth long, node binary, parent binary, bytes long, last boolean"


def _links(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["conv", "depth", "node", "parent", "bytes", "last"])


def _ends(batches):
    """(node, text) rows sorted by node and first id to (node, ends_sha256)."""
    node, digest = None, None
    for batch in batches:
        nodes, hashes = [], []
        for key, text in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if key == node:
                digest.update(b"," + text.encode())
                continue
            if node is not None:
                nodes.append(node)
                hashes.append(digest.hexdigest())
            node, digest = key, sha256(text.encode())
        if nodes:
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(hashes, pa.string())], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()], pa.string())], names=["node", "ends_sha256"])


def _joined_ids(batches):
    """(node, conv) rows in order to (node, first, ids): the ids of a node in this partition, a batch at a time, comma-joined."""
    for batch in batches:
        keys, ids = batch.column("node").to_pylist(), batch.column("conv").to_pylist()
        rows, begin = [], 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[begin]:
                rows.append((keys[begin], ids[begin], ",".join(map(str, ids[begin:i]))))
                begin = i
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.binary(), pa.int64(), pa.string()), strict=True)], names=["node", "first", "ids"]
            )


def ends(ended: DataFrame) -> DataFrame:
    """(node, conv) to (node, ends_sha256). Ids are range-sorted and joined in blocks first, so a hot node moves as few long rows and is hashed as a stream."""
    blocks = ended.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").mapInArrow(tidy(_joined_ids), "node binary, first long, ids string")
    return blocks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(tidy(_ends), "node binary, ends_sha256 string")


def _paths(shared: DataFrame) -> DataFrame:
    """Per conversation with shared turns: conv, ended (at its deepest shared turn), runs.

    A run is an array of (depth, node, bytes, parent) from its first turn to its last, with the same conversations all along.
    """
    order = Window.partitionBy("conv").orderBy("depth")
    runs = shared.withColumn("opens", F.when(F.col("n") != F.lag("n").over(order), 1).otherwise(0)).withColumn("run", F.sum("opens").over(order))
    turns = runs.groupBy("conv", "run").agg(F.array_sort(F.collect_list(F.struct("depth", "node", "bytes", "parent"))).alias("turns"), F.max("last").alias("ended"))
    return turns.groupBy("conv").agg(F.transform(F.array_sort(F.collect_list(F.struct("run", "turns"))), lambda r: r["turns"]).alias("runs"), F.max("ended").alias("ended"))


def _peel(paths: DataFrame) -> DataFrame:
    """Finished shared nodes: depth, node, conv, n, children, leaves, saved, parent, top (whether the parent is in another run)."""
    spark = paths.sparkSession
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    alone = F.when(F.col("ended"), zero).otherwise(one)  # a conversation that goes on by itself is one childless node's branch
    starts = materialize(
        paths.select(F.size("runs").alias("steps"), "runs", "conv", one.alias("n"), alone.alias("children"), alone.alias("leaves"), zero.alias("saved")), "paths", ["steps"]
    )
    steps = starts.agg(F.max("steps")).first()[0]
    if steps is None:
        return spark.createDataFrame([], "depth long, node binary, conv long, n long, children long, leaves long, saved long, parent binary, top boolean")
    done, rising = [], None
    for step in range(steps, 0, -1):
        ending = starts.where(F.col("steps") == step).drop("steps")
        here = ending if rising is None else ending.unionByName(rising)
        run = F.element_at("runs", step)
        met = (
            here.withColumn("node", F.element_at(run, -1)["node"]).groupBy("node")
            .agg(
                F.min("conv").alias("conv"), F.sum("n").alias("n"), F.sum("children").alias("children"), F.sum("leaves").alias("leaves"),
                F.sum("saved").alias("saved"), F.any_value("runs").alias("runs"),
            )
            .withColumn("leaves", F.greatest("leaves", one))
        )
        level = materialize(met.drop("node"), "nodes")
        done.append(level.select("conv", "n", "children", "leaves", "saved", run.alias("run")))
        above = F.aggregate(run, zero, lambda total, t: total + t["bytes"])
        rising = level.select(
            F.slice("runs", 1, step - 1).alias("runs"), "conv", "n", one.alias("children"), "leaves", (F.col("saved") + (F.col("n") - 1) * above).alias("saved")
        )
    every = functools.reduce(DataFrame.unionByName, done)
    below = F.aggregate(F.slice("run", F.col("at") + 2, F.size("run")), zero, lambda total, t: total + t["bytes"])
    spread = every.select("*", F.posexplode("run").alias("at", "turn")).withColumn("deepest", F.col("at") == F.size("run") - 1)
    return spread.select(
        "turn.depth", "turn.node", "conv", "n", F.when(F.col("deepest"), F.col("children")).otherwise(one).alias("children"), "leaves",
        (F.col("saved") + (F.col("n") - 1) * (below + F.col("turn.bytes"))).alias("saved"), "turn.parent", (F.col("at") == 0).alias("top"),
    )


def prefix_trie(conversations: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per node of (conv_id, turn, role, text): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, ids = rebuilt(conversations)
    links = materialize(turns.repartition("conv").sortWithinPartitions("conv", "step").mapInArrow(tidy(_chain), _LINK), "links")
    met = links.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    marked = materialize(split_join(links, met, ["node"], ["conv"], "left", part_rows), "met")
    shared, own = marked.where("n is not null"), marked.where("n is null")
    nodes = materialize(_peel(_paths(shared)), "trie")
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    alone = own.select(
        "depth", "node", "conv", one.alias("n"), F.when(F.col("last"), zero).otherwise(one).alias("children"), one.alias("leaves"), zero.alias("saved"),
        F.when(F.col("last"), F.sha2(F.col("conv").cast("string").cast("binary"), 256)).alias("own_end"),
    )
    # a node's parent is looked for only where it is in another run; elsewhere it has the node's own conversation
    tops = nodes.where("top").select("node", "parent")
    first_own = own.groupBy("conv").agg(F.min(F.struct("depth", "node", "parent")).alias("f")).select("f.node", "f.parent")
    asked = materialize(tops.unionByName(first_own), "tops")
    found = split_join(
        asked.where(F.col("parent") != F.lit(_ROOT)), nodes.select(F.col("node").alias("parent"), F.col("conv").alias("up")), ["parent"], ["node"], "left", part_rows
    )
    least, convs = ids.agg(F.min("conv"), F.count("*")).first()
    below_root = asked.where(F.col("parent") == F.lit(_ROOT)).select("node", F.lit(least).cast("long").alias("up"))
    hashed = ends(shared.where("last").select("node", "conv"))
    every = nodes.drop("top", "parent").withColumn("own_end", F.lit(None).cast("string")).unionByName(alone)
    named = every.join(found.select("node", "up").union(below_root), "node", "left").join(hashed, "node", "left").select(
        F.col("conv").alias("conv_id"), "depth", F.coalesce("up", "conv").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", "own_end", F.lit(_NOBODY)).alias("ends_sha256"),
    )
    if not convs:
        return named
    # the root: one row, from figures of one row each
    first = every.where("depth = 1").agg(F.count("*"), F.sum("leaves"), F.sum("saved")).first()
    turnless = ends(ids.join(links.where("depth = 1").select("conv"), "conv", "left_anti").select(F.lit(_ROOT).alias("node"), "conv")).first()
    root = (least, 0, None, convs, first[0], first[1] or 1, first[2] or 0, turnless.ends_sha256 if turnless else _NOBODY)
    return named.unionByName(named.sparkSession.createDataFrame([root], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema)))
