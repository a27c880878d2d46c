"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: sources in code point order, null last, weigh 5, 2, 1, repeating, and share 150 % of all words; a target stops at twice its
source's size and the excess goes to the others by weight. The words of a source are laid end to end in a hashed order of its documents, twice,
and cut into blocks of equal size. Slot i of the schedule belongs to the source whose part of the cumulated targets holds the golden-ratio point
frac((i + 1/2) * phi); a source's slots are ranked, and the slot of rank j brings the source's block j. What a target has beyond whole
blocks is a slot of its own at the end. A document is taken as far as the blocks that were brought cover it, at most twice.

Any part of the schedule is within two or three points of the targets, so a source's words are within that many blocks of its target. Blocks
follow the smallest target, which has ``BLOCKS`` of them. So that one small source doesn't cut a large corpus into single words, sources whose targets
are ``SPAN`` times apart or more are scheduled in tiers of their own, side by side: a source has from ``BLOCKS`` to ``BLOCKS * SPAN`` slots.

Offsets of documents are two-level running sums over ranges of the hash order, and blocks are keys of their own, so a source with most of
the rows is many groups.

Defined cases: null and empty texts have size 0 and are taken 0 times; a null source is a source of its own, last; rows that repeat
a doc_id or have none are documents of their own; empty input gives no rows; other columns are ignored. No words at all: targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadloom.llm.tables import materialize
from roadloom.operators.skew import fresh

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
BLOCKS = 1 << 10  # of the smallest target in a tier
SPAN = 64  # targets in a tier are less than this many times its smallest
UNIT = 1 << 12  # block sizes are whole numbers of this part of a word, so that bounds are exact
SLOTS = 1 << 32  # places of the whole schedule, on which tiers of any length are laid side by side
RANGES = 1 << 12
PHI = 0.6180339887498949


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``: the places where a word's first character follows white space or the start."""
    blanks = "\t\n\x0b\x0c\r"
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), blanks, " " * len(blanks))
    return F.size(F.array_remove(F.split(plain, " +"), "")).cast("long")


def targets(sizes: DataFrame, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size) to rows with ``rank`` and ``target`` words. One row per source goes through one window."""
    n = len(WEIGHTS)
    by_source = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_source) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("rank") % n + 1).cast("int"))
    )
    # sources fill up in the order of limit per weight; with k of them full the others get rate_k per weight
    filled = ranked.withColumn("limit", F.col("source_size") * float(epochs))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "rank")
    every = Window.partitionBy()
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * share
    rate = (total - F.coalesce(F.sum("limit").over(below), F.lit(0.0))) / F.sum("weight").over(onward)
    return (
        filled.withColumn("rate", rate)
        .withColumn("open", F.col("limit") > F.col("rate") * F.col("weight"))
        .withColumn("final", F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), "rank", "rate"))).over(every))
        .withColumn("target", F.when(F.col("final").isNull(), F.col("limit")).otherwise(F.least("limit", F.col("final.rate") * F.col("weight"))))
        .select("source", "source_size", "rank", "target")
    )


def in_blocks(wanted: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(source, source_size, rank, target) and each source's ``tier``, block size in ``UNIT`` parts of a word, ``whole`` blocks and the
    ``rest`` of its target beyond them in the same parts. A row per source; its two windows are over these."""
    most = F.max("target").over(Window.partitionBy())
    tier = F.floor(F.log(F.try_divide(most, F.col("target"))) / F.log(F.lit(float(SPAN)))).cast("int")
    parts = F.round(F.col("target") * UNIT).cast("long")
    size = F.greatest(F.floor(F.min("target").over(Window.partitionBy("tier")) * UNIT / blocks), F.lit(1)).cast("long")
    return (
        wanted.withColumn("tier", F.when(F.col("target") > 0, tier)).withColumn("block", size)
        .withColumn("whole", F.expr(f"cast(round(target * {UNIT}) as long) div block"))
        .withColumn("rest", parts - F.col("whole") * F.col("block"))
    )


def schedule(wanted: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Rows (rank, turn, slot, first, last) from the rows of ``in_blocks``: the place in the schedule, the source's rank, which of its blocks
    the slot brings, and the words of the source's layout in that block.

    Points and parts meet in cells of the unit interval, so it is an equi-join of the points with a few rows per source.
    """
    cells, chunk = 1024, 4096
    some = wanted.where("target > 0")
    order = Window.partitionBy("tier").orderBy("rank")
    every = Window.partitionBy("tier")
    parts = (
        some.withColumn("high", F.sum("whole").over(order) / F.sum("whole").over(every))
        .withColumn("low", F.coalesce(F.lag("high").over(order), F.lit(0.0)))
        .withColumn("high", F.when(F.lead("rank").over(order).isNull(), F.lit(1.0)).otherwise(F.col("high")))
        .withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)))))
        .select("tier", "rank", "low", "high", "cell")
    )
    tiers = some.groupBy("tier").agg(F.sum("whole").alias("slots"))
    chunks = tiers.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (slots - 1) div {chunk})"))).repartition("tier", "chunk")
    at = (F.col("i") + 0.5) * PHI
    points = (
        chunks.withColumn("i", F.explode(F.expr(f"sequence(chunk * {chunk}, least(slots, (chunk + 1) * {chunk}) - 1)")))
        .withColumn("x", at - F.floor(at)).withColumn("cell", F.floor(F.col("x") * cells))
    )
    place = F.floor((F.col("i") + 0.5) / F.col("slots") * SLOTS).alias("slot")
    own = points.join(parts, ["tier", "cell"]).where("low <= x and x < high").select("rank", "i", place)
    # at most BLOCKS * SPAN slots of a source, give or take the points' discrepancy
    turns = materialize(own.select("rank", (F.row_number().over(Window.partitionBy("rank").orderBy("i")) - 1).cast("long").alias("turn"), "slot"), "turns")
    had = turns.groupBy("rank").agg(F.count("*").alias("turn"))
    spread = (F.col("rank") + 0.5) * PHI
    end = F.floor((spread - F.floor(spread)) * SLOTS).alias("slot")
    ends = some.join(had, "rank", "left").select("rank", F.coalesce("turn", F.lit(0)).cast("long").alias("turn"), end, F.col("rest").alias("parts"))
    slots = turns.withColumn("parts", F.lit(None).cast("long")).union(ends).join(some.select("rank", "block", "source_size"), "rank")
    limit = F.col("source_size") * epochs
    first = F.expr(f"(turn * block + {UNIT - 1}) div {UNIT}")
    whole = F.expr(f"((turn + 1) * block + {UNIT - 1}) div {UNIT}")
    partly = F.expr(f"(turn * block + parts + {UNIT // 2}) div {UNIT}")
    return slots.select("rank", "turn", "slot", first.alias("first"), F.least(F.coalesce(partly, whole), limit).alias("last")).where("first < last")


def mix(docs: DataFrame, blocks: int = BLOCKS, share: float = SHARE, epochs: int = EPOCHS, key: tuple[str, ...] = ()) -> DataFrame:
    """One row per document of (doc_id, text, source): doc_id, size, source_size, target, taken, first_slot (null when not taken),
    and before them the columns ``key``, which tell rows apart that agree in doc_id and text."""
    sized = materialize(
        docs.select(*key, "doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("body"))
        .withColumn("hash", F.when(F.col("doc_id").isNull(), F.xxhash64("body", "size", F.lit(5))).otherwise(F.xxhash64("doc_id", "size", F.lit(5))))
        .withColumn("range", F.shiftrightunsigned("hash", 64 - RANGES.bit_length() + 1).cast("int"))
        .withColumn("row", F.monotonically_increasing_id()),
        "sizes",
    )
    per_range = sized.groupBy("source", "range").agg(F.sum("size").alias("words"))
    sources = materialize(in_blocks(targets(per_range.groupBy("source").agg(F.sum("words").alias("source_size")), share, epochs), blocks), "targets")
    plan = materialize(schedule(sources, epochs), "schedule")
    known = sources.join(plan.groupBy("rank").agg(F.max("turn").alias("top")), "rank", "left")
    starts = per_range.withColumn("start", F.sum("words").over(Window.partitionBy("source").orderBy("range")) - F.col("words")).drop("words")
    inside = Window.partitionBy("source", "range").orderBy("hash", "doc_id", "body", *key).rowsBetween(Window.unboundedPreceding, -1)
    here = sized.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = here.join(starts, (here["source"].eqNullSafe(starts["source"])) & (here["range"] == starts["range"])).select(here["*"], (F.col("start") + F.col("before")).alias("at"))
    joined = placed.join(known, placed["source"].eqNullSafe(known["source"])).drop(known["source"])
    # the blocks a document's words lie in, of those its source has in the schedule
    spans = F.array(*[(F.col("at") + F.col("source_size") * e).cast("long") for e in range(epochs)])
    laid = joined.withColumn("begin", F.explode(spans))
    turns = F.expr(f"sequence((begin * {UNIT}) div block, least(((begin + size - 1) * {UNIT}) div block, top))")
    touched = laid.withColumn("turn", F.explode_outer(F.when((F.col("size") > 0) & (F.expr(f"(begin * {UNIT}) div block") <= F.col("top")), turns)))
    words = F.greatest(F.least(F.col("begin") + F.col("size"), "last") - F.greatest("begin", "first"), F.lit(0))
    brought = touched.join(plan, ["rank", "turn"], "left").withColumn("words", F.when(F.col("first").isNull(), F.lit(0)).otherwise(words))
    return brought.groupBy("row", *key, "doc_id", "size", "source_size", "target").agg(
        F.sum("words").cast("long").alias("taken"), F.min(F.when(F.col("words") > 0, F.col("slot"))).alias("first_slot")
    ).drop("row")


def take(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (any columns) as often as the mix begins them: up to ``EPOCHS`` times, or not at all. They are written once,
    so that rows have locators; those without doc_id or with a repeated one are taken each on its own."""
    there = materialize(docs, "mix-input")
    at, times, turn = (fresh(f"mixed_{name}", docs) for name in ("at", "times", "turn"))
    located = there.withColumn(at, F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string")))
    begun = F.ceil(F.col("taken") / F.col("size")).cast("int")
    taken = mix(located.select(at, "doc_id", "text", "source"), key=(at,)).where("taken > 0").select(at, begun.alias(times))
    return located.join(taken, at).withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
