"""Collocations against brute force, with small chunks, groups and bit tables."""

import collections
import random
import re

import numpy as np
import pytest

from roadloom.llm import collocations

SCHEMA = "doc_id long, text string, lang string, n_chars long, word string, key int, f int"


def _texts():
    chance = random.Random(5)
    words = ["a", "B", "the", "of", "é", "漢字", "x" * 70, "z9", "-", "Straße"] + [f"w{k}" for k in range(30)]
    rows = [(None, "en"), ("", None), (" \t .,;", "en"), ("...\n\x0b\x0c\r!?", None), ("One", "en")]
    for k in range(60):
        n = chance.choice([1, 3, 8, 40])
        rows.append((chance.choice([" ", "\t", "  "]).join(chance.choice(words[: chance.choice([3, 10, 40])]) for _ in range(n)), chance.choice(["en", "fr", None, "und"])))
        rows.append((chance.choice([", ", ".\n", " "]).join(["of the", "United Nations of é", "a b a b a b a b", "same same same same same"][: 1 + k % 4]), chance.choice(["en", None])))
    rows.append(("of the " * 3000 + " ".join(chance.choice(words) for _ in range(2000)), "en"))
    return rows + [rows[-2]] * 5


def brute(rows, least, top, cover):
    f, total = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    f[lang, tuple(w[i : i + n])] += 1
    found = {k: n for k, n in f.items() if len(k[1]) > 1 and n >= least}
    out = collections.defaultdict(list)
    for (lang, p), a in found.items():
        if any(100 * n >= cover * a for (other, q), n in found.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))):
            continue
        score, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, i, p.decode(), -a, l, r, total[lang], -s) for lang, v in out.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:top], 1)}


@pytest.mark.parametrize(("least", "top", "part", "bits", "chunk"), [(3, 2000, 1 << 20, 26, 1 << 20), (2, 7, 4, 6, 200), (5, 2000, 50, 10, 40)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, top, part, bits, chunk):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    whole = collocations.phrases
    monkeypatch.setattr(collocations, "phrases", lambda docs, n: whole(docs, n, part, bits))
    rows = _texts()
    docs = spark.createDataFrame([(i if i % 7 else None, t, lang, 1, "x", 2, 3) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    got = collocations.collocations(docs, least, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == brute(rows, least, top, 80)
    assert collocations.collocations(docs.limit(0), least, top).count() == 0


def test_quicksort_counts_partitions():
    chance = np.random.default_rng(2)
    rows = chance.integers(1, 4, (4, 400)).astype(np.uint64)
    rows[3, :200] = 0
    weight = chance.integers(1, 5, 400)
    for least in (1, 20, 60):
        want = collections.Counter()
        for c in range(400):
            w = [int(x) for x in rows[:, c] if x]
            for d in range(2, len(w) + 1):
                want[tuple(w[:d])] += int(weight[c])
        got = {tuple(int(x) for x in rows[:d, i]): n for i, d, n in collocations.quicksort(rows, weight, least)}
        assert got == {k: n for k, n in want.items() if n >= least}


def test_words_that_share_a_hash_take_another_seed(spark, monkeypatch):
    true = collocations._counts

    def clash(seed):
        run = true(seed)

        def clashing(batches):
            import pyarrow as pa

            for b in run(batches):
                key = pa.array([1 if w in ("a", "b") else k for k, w in zip(b["key"].to_pylist(), b["word"].to_pylist(), strict=True)], pa.int64())
                yield pa.RecordBatch.from_arrays([key, *b.columns[1:]], names=b.schema.names)

        return clashing if seed == 0 else run

    monkeypatch.setattr(collocations, "_counts", clash)
    docs = spark.createDataFrame([(1, "a b a b a b", "en")], "doc_id long, text string, lang string")
    assert {(r.phrase, r.a) for r in collocations.collocations(docs, 2).collect()} == {("a b", 3), ("a b a b", 2)}
