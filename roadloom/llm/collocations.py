"""Phrase collocation mining by multikey quicksort of suffix pointers.

A text is cut into pieces and words; a suffix is a word and up to three that follow it in its piece. A first pass counts words and word
pairs. Suffixes are then routed by their two leading words and, within a task, pointers to them are sorted by multikey three-way
quicksort down to the fourth word: the weight of each equal partition is the count of a phrase, and a partition below the least count is
abandoned with all that lies under it. Suffixes whose leading pair is certainly too rare do not set out at all: frequent pairs are marked in a bit
table of fixed size, so a rare pair may slip through, never a frequent one get lost.

Words are known by 64-bit hashes of language and word. They are checked to differ over the whole vocabulary; if two do not, all is done again
with another seed. Equal suffixes of a chunk of text travel once, with their number. A pair with over ``PART`` suffixes is spread by the third
word, so its longer phrases are still whole and its own count is the sum over its parts. Scores, cuts and the removal of phrases
inside longer ones are joins of the counted phrases, in decimals of 38 digits.

Defined cases: a null or empty text has no words; a null language is ``und``; rows that repeat a doc_id or have none count each on
its own; equal scores and counts are ranked by phrase in byte order; empty input gives no rows; other columns are ignored.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadloom.llm.tables import batch_bytes, materialize, tidy
from roadloom.llm.words import Words, mix, text_buffers, word_hashes

LEAST = 30
LONGEST = 4
TOP = 2000
COVER = 80  # per cent of a phrase's count that a longer one around it must reach to replace it
CHUNK_BYTES = 1 << 19
BITS = 26
PART = 1 << 20  # suffixes of one leading pair in one group, and suffixes sorted at once
MOST_PARTED = 1 << 18
WORD, BLANK, CUT = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = CUT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_KEYS = [f"w{k}" for k in range(1, LONGEST + 1)]


def _spans(data: np.ndarray, offsets: np.ndarray, size: int):
    """Byte ranges of about ``size`` that end where a text or a piece ends."""
    begin, end = int(offsets[0]), int(offsets[-1])
    while begin < end:
        stop = min(begin + size, end)
        if stop < end:
            ends = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
            if ends > begin:
                stop = ends
            else:  # one text fills the range: cut it behind its last delimiter, or else go on to the next
                cuts = np.flatnonzero(_KIND[data[begin:stop]] == CUT)
                if len(cuts):
                    stop = begin + int(cuts[-1]) + 1
                else:
                    text_end = int(offsets[np.searchsorted(offsets, stop, "left")])
                    rest = np.flatnonzero(_KIND[data[stop:text_end]] == CUT)
                    stop = stop + int(rest[0]) + 1 if len(rest) else text_end
        yield begin, stop
        begin = stop


def _chunks(batch: pa.RecordBatch, seed: int):
    """Per range of a batch's texts: bytes, first and last place of each word, its hash, its piece and its language."""
    data, offsets = text_buffers(batch.column("text"))
    langs = batch.column("lang").dictionary_encode()
    names = langs.dictionary.to_pylist()
    letters = np.random.default_rng(seed).permutation(256).astype(np.uint8)
    salts = np.array([int.from_bytes(blake2b(f"{seed}:{v}".encode(), digest_size=8).digest(), "little") for v in names], np.uint64)
    lang_of = langs.indices.to_numpy(zero_copy_only=False)
    for begin, stop in _spans(data, offsets, CHUNK_BYTES):
        part = _LOWER[data[begin:stop]]
        kind = _KIND[part]
        first = max(0, int(np.searchsorted(offsets, begin, "right")) - 1)
        last = int(np.searchsorted(offsets, stop, "left"))
        bounds = np.maximum(offsets[first : last + 1] - begin, 0)
        word = kind == WORD
        starts = word.copy()
        starts[1:] &= kind[:-1] != WORD
        inner = bounds[(bounds > 0) & (bounds < len(part))]
        starts[inner] = word[inner]
        start = np.flatnonzero(starts)
        if not len(start):
            continue
        stops = word.copy()
        stops[:-1] &= kind[1:] != WORD
        stops[inner - 1] = word[inner - 1]
        end = np.flatnonzero(stops) + 1
        row = first + np.searchsorted(bounds, start, "right") - 1
        piece = np.cumsum(kind == CUT)[start] + row
        hashes = word_hashes(Words(0, 0, part, start, end, row, bounds), letters[part])
        for k in np.flatnonzero(end - start > 64):  # long words by a stronger hash
            hashes[k] = int.from_bytes(blake2b(letters[part[start[k] : end[k]]].tobytes(), digest_size=8).digest(), "little")
        hashes = mix(hashes ^ salts[lang_of[row]])
        hashes[hashes == 0] = 1
        yield part, start, end, hashes, piece, lang_of[row], names


def _next(hashes: np.ndarray, piece: np.ndarray, k: int) -> np.ndarray:
    """The hash of the word ``k`` places on in the same piece, or 0."""
    out = np.zeros_like(hashes)
    if k < len(hashes):
        out[:-k] = np.where(piece[k:] == piece[:-k], hashes[k:], np.uint64(0))
    return out


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second)


def _strings(part: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The words at these places as one Arrow column."""
    sizes = end - start
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], sizes)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(part[at])).cast(pa.string())


def _counts(seed: int):
    """Words (with language and text) and leading pairs (without) of each chunk, with their numbers."""

    def run(batches):
        for batch in batches:
            for part, start, end, hashes, piece, lang, names in _chunks(batch, seed):
                keys, at, n = np.unique(hashes, return_index=True, return_counts=True)
                second = _next(hashes, piece, 1)
                pairs, m = np.unique(_pair(hashes, second)[second != 0], return_counts=True)
                none = pa.nulls(len(pairs), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([keys, pairs]).view(np.int64)),
                        pa.concat_arrays([pa.DictionaryArray.from_arrays(pa.array(lang[at]), pa.array(names)).cast(pa.string()), none]),
                        pa.concat_arrays([_strings(part, start[at], end[at]), none]),
                        pa.array(np.concatenate([n, m]), pa.int64()),
                    ],
                    names=["key", "lang", "word", "n"],
                )

    return run


def _suffixes(seed: int, bits: int, marks, parted):
    """Distinct suffixes of each chunk whose leading pair may be frequent: route, whole, words, number."""

    def run(batches):
        marked = marks.value
        heavy, parts = parted.value
        for batch in batches:
            for _, _, _, hashes, piece, _, _ in _chunks(batch, seed):
                second = _next(hashes, piece, 1)
                pair = _pair(hashes, second)
                slot = pair & np.uint64((1 << bits) - 1)
                go = np.flatnonzero((second != 0) & ((marked[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1).astype(bool))
                if not len(go):
                    continue
                rows = np.stack([hashes[go], second[go], *(_next(hashes, piece, k)[go] for k in range(2, LONGEST))])
                route, whole = pair[go], np.ones(len(go), bool)
                if len(heavy):
                    place = np.minimum(np.searchsorted(heavy, route), len(heavy) - 1)
                    hit = np.flatnonzero(heavy[place] == route)
                    whole[hit] = False
                    route[hit] = _pair(route[hit], rows[2][hit] % parts[place[hit]])
                rows, number, kept = _combined(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(route[kept].view(np.int64)), pa.array(whole[kept]), *(pa.array(w.view(np.int64)) for w in rows), pa.array(number)],
                    names=["route", "whole", *_KEYS, "n"],
                )

    return run


def _combined(rows: np.ndarray, weight: np.ndarray | None = None):
    """Distinct columns of ``rows``, their summed weight and one place of each."""
    key = rows[0]
    for w in rows[1:]:
        key = _pair(key, w)
    _, at, back = np.unique(key, return_index=True, return_inverse=True)
    if (rows[:, at[back]] != rows).any():  # two suffixes share a hash: leave all as they are
        return rows, np.ones(rows.shape[1], np.int64) if weight is None else weight, np.arange(rows.shape[1])
    return rows[:, at], np.bincount(back, weight, len(at)).astype(np.int64), at


def quicksort(rows: np.ndarray, weight: np.ndarray, least: int, parted: bool = False):
    """Yield (place of a suffix, words, count) for every leading run of two words or more that at least ``least`` suffixes share.

    Pointers are parted into those with a smaller, equal or larger word than a pivot at the current depth; equal ones go on a word deeper.
    With ``parted`` the suffixes are a share of their leading pair: down to it nothing is abandoned.
    """
    todo = [(np.arange(len(weight)), 0)]
    while todo:
        at, depth = todo.pop()
        bar = 1 if parted and depth < 2 else least
        key = rows[depth][at]
        pivot = key[len(key) // 2]
        for side in (key < pivot, key > pivot):
            some = at[side]
            if len(some) and weight[some].sum() >= bar:
                todo.append((some, depth))
        if not pivot:  # the piece ends here
            continue
        same = at[key == pivot]
        count = int(weight[same].sum())
        if count < bar:
            continue
        if depth:
            yield same[0], depth + 1, count
        if depth + 1 < len(rows):
            todo.append((same, depth + 1))


def _sorted_counts(least: int, size: int):
    """Counts of phrases from suffixes sorted by route, about ``size`` at a time; a route is never cut."""

    def counted(held):
        rows, weight, whole = (np.concatenate([h[k] for h in held], axis=-1) for k in range(3))
        found = []
        for kind in (True, False):
            some = np.flatnonzero(whole == kind)
            if len(some):
                part = rows[:, some]
                found += [(part[:, i], d, n) for i, d, n in quicksort(part, weight[some], least, not kind)]
        if found:
            phrases = np.stack([w for w, _, _ in found], axis=1)
            length = np.array([d for _, d, _ in found])
            phrases[np.arange(LONGEST)[:, None] >= length] = 0
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(w.view(np.int64)) for w in phrases), pa.array(length, pa.int32()), pa.array([n for _, _, n in found], pa.int64())], names=[*_KEYS, "words", "f"]
            )

    def run(batches):
        held, total, last = [], 0, None  # suffixes not counted yet, and the route of the last of them
        full = 2 * size
        for batch in batches:
            route = batch.column("route").to_numpy()
            if not len(route):
                continue
            rows = np.stack([batch.column(k).to_numpy().view(np.uint64) for k in _KEYS])
            weight, whole = batch.column("n").to_numpy(), batch.column("whole").to_numpy(zero_copy_only=False)
            cut = int(np.flatnonzero(np.diff(route))[-1]) + 1 if route[0] != route[-1] else 0  # the last route begins here
            if cut or route[0] != last:
                held.append((rows[:, :cut], weight[:cut], whole[:cut]))
                total += cut
                if total >= size:
                    yield from counted(held)
                    held, total, full = [], 0, 2 * size
            held.append((rows[:, cut:], weight[cut:], whole[cut:]))
            total += len(route) - cut
            last = route[-1]
            if total >= full:  # one long route: equal suffixes are added up
                rows, weight, whole = (np.concatenate([h[k] for h in held], axis=-1) for k in range(3))
                rows, weight, at = _combined(rows, weight)
                held, total, full = [(rows, weight, whole[at])], len(at), 2 * max(size, len(at))
        if held:
            yield from counted(held)

    return run


def _vocabulary(docs: DataFrame, least: int) -> tuple[DataFrame, int]:
    """Counted words, and pairs (without a word) of at least ``least``, and the seed with which no two words share a hash."""
    for seed in range(8):
        counts = docs.mapInArrow(tidy(_counts(seed)), "key long, lang string, word string, n long").groupBy("key", "lang", "word").agg(F.sum("n").alias("f"))
        counted = materialize(counts.where((F.col("f") >= least) | F.col("word").isNotNull()), "phrase-words")
        if counted.where("word is not null").groupBy("key").count().where("count > 1").isEmpty():
            return counted, seed
    raise ValueError("words share hashes under every seed")


def phrases(docs: DataFrame, least: int = LEAST, part: int = PART, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(phrases, words) of (text, lang): phrases of two words or more as hashes w1.. with number of ``words`` and count f of at least
    ``least``; words as key, lang, word, f, all of them."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    counted, seed = _vocabulary(rows, least)
    pairs = counted.where("word is null").select("key", "f")
    # 64 marks a row, so at most 2^(bits - 6) rows whatever the number of pairs
    slot = F.col("key").bitwiseAND(F.lit((1 << bits) - 1))
    marks = pairs.select(F.shiftrightunsigned(slot, 6).alias("at"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    found = marks.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("marks")).toArrow()
    table = np.zeros(1 << (bits - 3), np.uint8)
    table.view(np.uint64)[found["at"].to_numpy().astype(np.int64)] = found["marks"].to_numpy().astype(np.int64).view(np.uint64)
    heavy = pairs.where(F.col("f") > part).orderBy(F.desc("f"), "key").limit(MOST_PARTED).toArrow()
    keys, sizes = heavy["key"].to_numpy().astype(np.int64).view(np.uint64), heavy["f"].to_numpy().astype(np.int64)
    order = np.argsort(keys)
    parted = (keys[order], (-(-sizes[order] // part)).astype(np.uint64))
    send = spark.sparkContext.broadcast
    suffixes = rows.mapInArrow(
        tidy(_suffixes(seed, bits, send(table), send(parted))), f"route long, whole boolean, {', '.join(f'{k} long' for k in _KEYS)}, n long"
    )
    sorted_out = suffixes.repartition("route").sortWithinPartitions("route").mapInArrow(
        tidy(_sorted_counts(least, part)), f"{', '.join(f'{k} long' for k in _KEYS)}, words int, f long"
    )
    whole = sorted_out.groupBy(*_KEYS, "words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return materialize(whole, "phrases"), counted.where("word is not null")


def _scores(found: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """Phrases with their lowest-scoring cut: l, r, score."""
    zero = F.lit(0).cast("long")
    single = words.where(F.col("f") >= least).select(F.col("key").alias("w1"), *(zero.alias(k) for k in _KEYS[1:]), "f")
    parts = found.select(*_KEYS, "f").union(single)
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    padded = F.array(*_KEYS, *(zero for _ in _KEYS))
    for i, key in enumerate(_KEYS, 1):
        cuts = cuts.withColumn(f"a{i}", F.when(F.lit(i) <= F.col("k"), F.col(key)).otherwise(0)).withColumn(f"b{i}", F.element_at(padded, (F.col("k") + i).cast("int")))
    first = parts.select(*(F.col(k).alias(f"a{i}") for i, k in enumerate(_KEYS, 1)), F.col("f").alias("l"))
    rest = parts.select(*(F.col(k).alias(f"b{i}") for i, k in enumerate(_KEYS, 1)), F.col("f").alias("r"))
    joined = cuts.join(first, [f"a{i}" for i in range(1, LONGEST + 1)]).join(rest, [f"b{i}" for i in range(1, LONGEST + 1)])
    exact = F.expr("cast(f as decimal(38,0)) * cast(2000000 as decimal(7,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = joined.withColumn("score", exact.cast("long"))
    return scored.groupBy(*_KEYS, "words").agg(F.min("f").alias("f"), F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        *_KEYS, "words", "f", "cut.l", "cut.r", "cut.score"
    )


def _outer(found: DataFrame, cover: int) -> DataFrame:
    """Phrases that a longer one around them replaces."""
    inner = []
    for size in range(2, LONGEST):
        for begin in range(LONGEST - size + 1):
            words = [F.col(_KEYS[begin + i]) if i < size else F.lit(0).cast("long") for i in range(LONGEST)]
            inner.append(F.when((F.col("words") > size) & (F.col("words") >= begin + size), F.struct(*(w.alias(k) for w, k in zip(words, _KEYS, strict=True)))))
    around = found.where("words > 2").select(F.explode(F.array(*inner)).alias("p"), "f").where("p is not null").groupBy("p").agg(F.max("f").alias("longer"))
    whole = found.join(around.select("p.*", "longer"), _KEYS)
    return whole.where(F.col("longer").cast("decimal(38,0)") * 100 >= F.col("f").cast("decimal(38,0)") * cover).select(*_KEYS)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, cover: int = COVER) -> DataFrame:
    """Each language's ``top`` phrases of (text, lang): lang, rank, phrase, a (its count), l and r (counts of the parts), n (words of the language), score."""
    with batch_bytes(docs.sparkSession):
        found, words = phrases(docs, least)
    kept = _scores(found, words, least).join(_outer(found, cover), _KEYS, "left_anti")
    known = words.where(F.col("f") >= least)
    scored = kept.join(known.select(F.col("key").alias("w1"), "lang", F.col("word").alias("t1")), "w1")
    # the best of each part of a language first, with ties, so that no language is one task; only what is left is spelt out
    best = [F.desc("score"), F.desc("f")]
    first = scored.withColumn("part", F.pmod(F.xxhash64(*_KEYS), F.lit(64))).withColumn("place", F.rank().over(Window.partitionBy("lang", "part").orderBy(*best)))
    rows = first.where(F.col("place") <= top).withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("place") <= top)
    for i, k in enumerate(_KEYS[1:], 2):
        rows = rows.join(known.select(F.col("key").alias(k), F.col("word").alias(f"t{i}")), k, "left")
    named = rows.withColumn("phrase", F.concat_ws(" ", *(f"t{i}" for i in range(1, LONGEST + 1))))
    ranked = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best, F.asc("phrase"))).cast("long")).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")
