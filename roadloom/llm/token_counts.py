"""Token counts by a map-side lookup in two tiers.

A byte-level BPE splits a text into pre-tokens and encodes each on its own, so a text's count is the sum of its pre-tokens' counts. The first
tier is a table of the frequent pre-tokens' counts, at most ``TABLE`` of them, sent to every worker. It comes from
all texts: each task keeps a Misra-Gries summary of its pre-tokens, and summaries are merged in a tree, one row each, so no
pre-token is ever a shuffle key. The second tier is a worker's own cache, which the tokenizer fills on a miss and which is
emptied when it holds ``CACHE`` entries. The table only saves time: counts are the library's whatever it holds.

Texts whose splitting could differ are encoded whole by the library: those that hold the string of an added token, those with a character that
the library classes differently than the splitter does (tested over all code points by :func:`odd_characters`), and all texts if the file's
tokenizer is not a byte-level BPE with the usual split. Long texts are taken in pieces that end before a single space between
two other characters, where pre-tokens always end.

Defined cases: a null or empty text has no bytes and no tokens; rows that repeat a doc_id or have none are counted each on its own;
empty input gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re
import uuid
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.tables import materialize, tidy

LIMIT = 1024
TABLE = 1 << 16
SUMMARY = 1 << 14  # entries in a task's summary as it is handed on; it holds up to four times as many while it counts
CACHE = 1 << 18
PIECE = 1 << 20
FAN_IN = 32
UNASSIGNED = 0x40000
#: The split of byte-level BPE (fixed).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for texts of ASCII alone, where it takes half the time.
SPLIT_ASCII = r""" ?[A-Za-z]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+"""


def _tokenizer(config: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(config)
    t.no_truncation()
    t.no_padding()
    return t


def _splitter():
    """Texts to their pre-tokens."""
    import regex

    whole, plain = regex.compile(SPLIT).findall, re.compile(SPLIT_ASCII).findall
    return lambda text: plain(text) if text.isascii() else whole(text)


def splits_plainly(config: str) -> bool:
    """Whether the tokenizer of this JSON text encodes the pre-tokens of ``SPLIT`` one by one."""
    spec = json.loads(config)
    pre = spec.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
    return bool(plain and spec["model"].get("type") == "BPE" and not spec.get("normalizer") and not spec["model"].get("dropout"))


@functools.lru_cache(maxsize=4)
def odd_characters(config: str) -> str:
    """A pattern for characters around which the library's split differs from ``SPLIT``, for example letters of a later Unicode version.

    All code points below U+40000 are tried as to letter, number, white space or other; those above hold no assigned letters and count as odd.
    """
    cut, split = _splitter(), _tokenizer(config).pre_tokenizer.pre_tokenize_str

    def differ(codes: list[int]) -> list[int]:
        probe = "".join(f"a{c}1!{c}" for c in map(chr, codes))
        at, ends = 0, []
        for token in cut(probe):
            at += len(token)
            ends.append(at)
        if [end for _, (_, end) in split(probe)] == ends:
            return []
        half = len(codes) // 2
        return codes if not half else differ(codes[:half]) + differ(codes[half:])

    every = [c for c in range(UNASSIGNED) if not 0xD800 <= c < 0xE000]
    odd = np.array([c for k in range(0, len(every), 512) for c in differ(every[k : k + 512])], int)
    runs = np.split(odd, np.flatnonzero(np.diff(odd) > 1) + 1) if len(odd) else []
    return "[" + "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs) + f"\\U{UNASSIGNED:08x}-\\U0010ffff]"


def pieces(text: str, size: int = PIECE):
    """``text`` in parts of about ``size`` characters, cut only before a lone space between two characters that are not white space."""
    begin = 0
    while len(text) - begin > size:
        at = begin + size
        while True:
            at = text.find(" ", at)
            if at < 0 or at + 1 >= len(text):
                yield text[begin:]
                return
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                break
            at += 1
        yield text[begin:at]
        begin = at
    yield text[begin:]


def _shrunk(counts: Counter, size: int) -> Counter:
    """A Misra-Gries summary: every count less by the largest that has to go."""
    if len(counts) <= size:
        return counts
    ranked = counts.most_common(size + 1)
    least = ranked[-1][1]
    return Counter({w: n - least for w, n in ranked[:-1] if n > least})


def _summary(batches):
    cut, counts = _splitter(), Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            for piece in pieces(text or ""):
                counts.update(cut(piece))
            if len(counts) > 4 * SUMMARY:
                counts = _shrunk(counts, SUMMARY)
    yield _summary_row(counts)


def _summary_row(counts: Counter) -> pa.RecordBatch:
    kept = _shrunk(counts, SUMMARY).most_common()
    return pa.RecordBatch.from_arrays(
        [pa.array([[w for w, _ in kept]], pa.list_(pa.string())), pa.array([[n for _, n in kept]], pa.list_(pa.int64()))], names=["words", "counts"]
    )


def _merged(batches):
    counts, seen = Counter(), False
    for batch in batches:
        seen = True
        for words, numbers in zip(batch.column("words"), batch.column("counts"), strict=True):
            counts.update(dict(zip(words.as_py(), numbers.as_py(), strict=True)))
            if len(counts) > 4 * SUMMARY:
                counts = _shrunk(counts, SUMMARY)
    if seen:
        yield _summary_row(counts)


def frequent(docs: DataFrame, table: int = TABLE) -> list[str]:
    """The most frequent pre-tokens of all texts, at most ``table``, from summaries merged ``FAN_IN`` at a time."""
    level = materialize(docs.select("text").mapInArrow(tidy(_summary), "words array<string>, counts array<long>"), "pre-tokens")
    while (n := level.count()) > 1:
        parts = -(-n // FAN_IN)
        level = materialize(level.repartition(parts).mapInArrow(tidy(_merged), level.schema), "pre-tokens")
    row = level.first()
    return list(row.words[:table]) if row else []


class _Table:
    """The first tier as it is sent: counts of frequent pre-tokens, and a pattern for characters that are not split as usual."""

    def __init__(self, lengths: dict[str, int], odd: str):
        self.lengths, self.odd = lengths, odd


class _Counts(dict):
    """Pre-token to number of tokens: the table sent to all workers, then this worker's cache, then the tokenizer."""

    def __init__(self, table: dict[str, int], config: str):
        super().__init__(table)
        self.encode = _tokenizer(config).encode
        self.cache: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        n = self.cache.get(word)
        if n is None:
            n = len(self.encode(word, add_special_tokens=False).ids)
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = n
        return n


class _Counter(NamedTuple):
    """What a worker keeps between tasks."""

    counts: _Counts
    specials: list[str]
    odd: re.Pattern
    ascii_too: bool  # whether an ASCII character is among the odd ones


@functools.lru_cache(maxsize=1)
def _worker(job: str, config: str, table: _Table) -> _Counter:
    specials = [t["content"] for t in json.loads(config).get("added_tokens", [])]
    odd = re.compile(table.odd)
    return _Counter(_Counts(table.lengths, config), specials, odd, any(odd.match(chr(c)) for c in range(128)))


def _count(job: str, config, table, plain: bool):
    def run(batches):
        known, cut = _worker(job, config.value, table.value), _splitter()
        get, odd = known.counts.__getitem__, known.odd.search

        def tokens(text: str) -> int:
            as_usual = (text.isascii() and not known.ascii_too) or not odd(text)
            if not plain or not as_usual or any(s in text for s in known.specials):
                return len(known.counts.encode(text, add_special_tokens=False).ids)
            return sum(sum(map(get, cut(piece))) for piece in pieces(text))

        for batch in batches:
            texts = batch.column("text")
            counted = pa.array((tokens(t.as_py()) for t in texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), counted], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, table: int = TABLE) -> DataFrame:
    """One row per document of (doc_id, text): doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    ``path`` is the driver's path of a ``tokenizers`` file; workers get its text.
    """
    spark = docs.sparkSession
    with open(path, encoding="utf-8") as f:
        config = f.read()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    plain = splits_plainly(config)
    known = _Counts({}, config)
    lengths = {w: known[w] for w in (frequent(rows, table) if plain else ())}
    table_sent = spark.sparkContext.broadcast(_Table(lengths, odd_characters(config) if plain else "[^\\S\\s]"))
    job = _count(uuid.uuid4().hex, spark.sparkContext.broadcast(config), table_sent, plain)
    return rows.mapInArrow(tidy(job), "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
