"""Secret scans: fixed patterns, and a battery of randomness tests under false-discovery control.

Patterns give the base spans: assign, access, hex. The method adds ``random`` spans. Candidates are runs of 20 or more characters of
``[A-Za-z0-9+/_=-]`` that no base span touches. Each is read in the smallest encoding that holds its characters (hex, base32, base36, base62,
base64) and put to three tests: chi-squared uniformity over cells of the encoding's alphabet (as many as its length supports),
a runs test about the alphabet's middle, and the lag-one serial correlation; Fisher's sum makes one score of them.

A score says how random a string looks; what counts is how rarely plain text of that length looks so. The null is drawn from all texts:
letters from every word place onwards, cut to a hash-chosen length of a hash-chosen length class, of those that the rest of the text
still fills. Scores are counted in fixed bins per length class, which gives each candidate an empirical p-value, and
Benjamini-Hochberg over all candidates keeps the discoveries at rate ``rate``. A class that no text fills takes the null of the next
shorter one: the shorter plain text is, the more random it looks.

Defined cases: a null text is empty; offsets are code points, end exclusive; rows that repeat a doc_id or have none are reported one by one; empty input gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.tables import materialize
from roadloom.llm.words import mix, word_chunks

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LONG = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LEAST = 20
CLASSES = (20, 24, 32, 40, 48, 64, 96, 128)  # least lengths
BINS = 48
LONGEST = 256  # letters of a null string are fewer
RATE = 0.05
_ALPHABETS = tuple(
    (set(a), {c: i for i, c in enumerate(a)}, len(a))
    for a in (
        "0123456789abcdef", "0123456789ABCDEF", "234567ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdefghijklmnopqrstuvwxyz",
        "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    )
)
_SIXTY_FOUR = {c: i for i, c in enumerate("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/")} | {"-": 62, "_": 63}


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end), leftmost and non-overlapping per kind, by start and kind as listed."""
    found = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(k in low for k in KEYWORDS):
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(s, KINDS[k], e) for s, k, e in sorted(found)]


def _normal_tail(z: float) -> float:
    return math.erfc(z / math.sqrt(2)) / 2


def battery(string: str) -> float:
    """How well the string agrees with uniform random symbols of its encoding, 0 to 1."""
    plain = string.rstrip("=") or string
    used = set(plain)
    for symbols, index, size in _ALPHABETS:
        if used <= symbols:
            break
    else:
        index, size = _SIXTY_FOUR, 64
    x = np.array([index.get(c, 0) for c in plain], np.float64)
    n = len(x)
    cells = max(2, min(size, n // 4))
    seen = np.bincount((x * cells / size).astype(int), minlength=cells)
    width = np.bincount((np.arange(size) * cells / size).astype(int), minlength=cells) / size
    chi = float((((seen - n * width) ** 2) / (n * width)).sum())
    d = cells - 1
    uniform = _normal_tail(((chi / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d)))
    high = x >= size / 2
    a = int(high.sum())
    b = n - a
    if a == 0 or b == 0:
        return 0.0
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 1 + 2 * a * b / n
    spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    even = 2 * _normal_tail(abs(runs - mean) / spread)
    y = x - x.mean()
    serial = 2 * _normal_tail(abs(float((y[1:] * y[:-1]).sum() / max((y * y).sum(), 1e-9))) * math.sqrt(n))
    half = -sum(math.log(max(p, 1e-300)) for p in (uniform, even, serial))
    return math.exp(-half) * (1 + half + half * half / 2)


def score_bin(score: float) -> int:
    return BINS - 1 if score <= 0 else min(BINS - 1, int(-math.log10(score) * 6))


def length_class(n: int) -> int:
    return sum(n >= c for c in CLASSES) - 1


def letter_bins(codes: np.ndarray) -> np.ndarray:
    """``score_bin(battery(...))`` of each row of ASCII letters; all rows are of one length."""
    bins = np.empty(len(codes), np.int64)
    lower, upper = (codes >= 97).all(1), (codes < 97).all(1)
    hexes = ((codes | 32) <= 102).all(1)
    kind = np.select([lower & hexes, upper & hexes, upper, lower], [0, 1, 2, 3], 5)
    for k in np.unique(kind):
        _, index, size = _ALPHABETS[k]
        symbol = np.zeros(128, np.uint8)
        for c, i in index.items():
            symbol[ord(c)] = i
        at = np.flatnonzero(kind == k)
        x = symbol[codes[at]]
        n, rows = x.shape[1], len(x)
        cells = max(2, min(size, n // 4))
        cell = (np.arange(size) * cells / size).astype(np.int64)
        seen = np.bincount((cell[x] + np.arange(rows)[:, None] * cells).ravel(), minlength=rows * cells).reshape(rows, cells)
        width = np.bincount(cell, minlength=cells) / size
        chi = ((seen - n * width) ** 2 / (n * width)).sum(1)
        d = cells - 1
        high = x >= size / 2
        a = high.sum(1)
        b = n - a
        runs = 1 + (high[:, 1:] != high[:, :-1]).sum(1)
        mean = 1 + 2 * a * b / n
        spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        y = x - x.mean(1, keepdims=True)
        serial = np.abs(np.einsum("ij,ij->i", y[:, 1:], y[:, :-1]) / np.maximum(np.einsum("ij,ij->i", y, y), 1e-9)) * math.sqrt(n)
        z = [((chi / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d)), np.abs(runs - mean) / spread, serial]
        p = [np.fromiter(map(math.erfc, (v / math.sqrt(2)).tolist()), np.float64, rows) for v in z]
        half = -sum(np.log(np.maximum(v, 1e-300)) for v in (p[0] / 2, p[1], p[2]))
        score = np.where((a == 0) | (b == 0), 0.0, np.exp(-half) * (1 + half + half * half / 2))
        bins[at] = np.minimum(BINS - 1, -np.log10(np.maximum(score, 1e-300)) * 6).astype(np.int64)
    return bins


def _null_cells(column: pa.Array) -> np.ndarray:
    """How many of the null's strings are in each cell (length class, score bin)."""
    found = np.zeros(len(CLASSES) * BINS, np.int64)
    least = np.array([*CLASSES, LONGEST], np.int64)
    for w in word_chunks(column):
        if not len(w.start):
            continue
        place = np.arange(len(w.start)) - np.searchsorted(w.row, w.row)
        head = w.data[w.start].astype(np.uint64)
        length = np.add.reduceat(w.data.astype(np.uint64), w.start)
        chance = mix(place.astype(np.uint64) * np.uint64(1000003) + head * np.uint64(257) + length)
        letter = ((w.data | 32) >= 97) & ((w.data | 32) <= 122)
        before = np.concatenate([[0], np.cumsum(letter)])
        letters = w.data[letter]
        first = before[w.start]
        left = before[np.cumsum(w.sizes)[w.row]] - first
        chosen = np.flatnonzero(left >= LEAST)
        if not len(chosen):
            continue
        first, left, chance = first[chosen], left[chosen], chance[chosen]
        fit = np.searchsorted(least[:-1], left, "right")
        kind = ((chance >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64) % fit
        room = np.minimum(least[kind + 1], left + 1) - least[kind]
        size = least[kind] + (chance >> np.uint64(32)).astype(np.int64) % room
        order = np.argsort(size, kind="stable")
        sizes, begin = np.unique(size[order], return_index=True)
        for n, these in zip(sizes.tolist(), np.split(first[order], begin[1:]), strict=True):
            every = np.lib.stride_tricks.sliding_window_view(letters, n)
            for k in range(0, len(these), 4096):
                found[length_class(n) * BINS : (length_class(n) + 1) * BINS] += np.bincount(letter_bins(every[these[k : k + 4096]]), minlength=BINS)
    return found


def _scan(batches):
    for batch in batches:
        column = batch.column("text").fill_null("")
        texts = column.to_pylist()
        null = _null_cells(column)
        base, more = [], []
        for text in texts:
            spans = base_spans(text)
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
            runs = [m.span() for m in LONG.finditer(text)]
            # the spans that start before a run's end are the first ones; the run is free if none of them ends behind its start
            starts = [x for x, _, _ in spans]
            reach = [0, *accumulate((y for _, _, y in spans), max)]
            free = [(s, e) for s, e in runs if reach[bisect_left(starts, e)] <= s]
            more.append([{"start": s, "end": e, "cell": length_class(e - s) * BINS + score_bin(battery(text[s:e]))} for s, e in free])
        span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
        cand = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("cell", pa.int32())]))
        # the counts of a batch are in its first row
        counts = [[{"cell": c, "n": int(null[c])} for c in np.flatnonzero(null)] if not i else [] for i in range(len(texts))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(base, span), pa.array(more, cand), pa.array(counts, pa.list_(pa.struct([("cell", pa.int32()), ("n", pa.int64())])))],
            names=["doc_id", "base", "more", "null_cells"],
        )


def discoveries(candidates: dict[int, int], null: dict[int, int], rate: float = RATE) -> list[int]:
    """Benjamini-Hochberg over cells (length class, score bin), given the counts of candidates and null strings in each."""
    p, filled = {}, {x // BINS for x in null}
    for cell in candidates:
        c, b = divmod(cell, BINS)
        c = max((x for x in filled if x <= c), default=c)
        every = sum(n for x, n in null.items() if x // BINS == c)
        above = sum(n for x, n in null.items() if x // BINS == c and x % BINS <= b)
        p[cell] = (1 + above) / (1 + every)
    total, kept, cut = sum(candidates.values()), 0, -1.0
    for cell in sorted(p, key=p.get):
        kept += candidates[cell]
        if p[cell] <= rate * kept / total:
            cut = p[cell]
    return [cell for cell in p if p[cell] <= cut]


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """One row per row of (doc_id, text): doc_id and ``spans``, an array of (start, kind, end) by start and kind."""
    found = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
            _scan,
            "doc_id long, base array<struct<start:long,kind:string,end:long>>, more array<struct<start:long,end:long,cell:int>>, null_cells array<struct<cell:int,n:long>>",
        ),
        "scan",
    )
    # at most len(CLASSES) * BINS rows either way
    candidates = {r[0]: r[1] for r in found.select(F.explode("more.cell").alias("cell")).groupBy("cell").count().collect()}
    null = {r[0]: r[1] for r in found.select(F.inline("null_cells")).groupBy("cell").agg(F.sum("n")).collect()}
    cells = discoveries(candidates, null, rate)
    kept = F.filter("more", lambda c: F.array_contains(F.array(*[F.lit(c) for c in cells]).cast("array<int>"), c["cell"]))
    added = F.transform(kept, lambda c: F.struct(c["start"].alias("start"), F.lit("random").alias("kind"), c["end"].alias("end")))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", added), lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0)).alias("spans"))


def report(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """Counts per kind, the digest of the base spans, and all spans as text."""
    listed = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scan(docs, rate).select(
        "doc_id", n("assign"), n("access"), n("hex"), F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
