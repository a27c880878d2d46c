"""Rows that repeat an id with other content: each is judged on its own."""

import collections
import hashlib
import random

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from roadloom.llm import best_fit, embedding_near_dup, gated_lm, ngram_jaccard, secret_scan, source_mix, substring_dedup, toxicity_crf

chance = random.Random(12)
VOCAB = ["".join(chance.choice("abcdefgh") for _ in range(4)) for _ in range(300)]


def body(n):
    return " ".join(chance.choice(VOCAB) for _ in range(n))


def jaccard_links(rows):
    sets = []
    for _, t in rows:
        w = (t or "").split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    return [[j for j in range(len(rows)) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(rows))]


def grouped(ids, links):
    label = list(range(len(ids)))
    for _ in ids:
        label = [min([label[i], *(label[j] for j in links[i])]) for i in range(len(ids))]
    return label


def jaccard_cases():
    w, other = body(60), body(500)
    near = other.split()
    near[250] = "changed"
    yield [(1, w), (2, w + " more"), (2, other)]
    yield [(1, w), (2, w + " more"), (2, other), (3, " ".join(near)), (None, w), (None, w), (4, None), (4, "")]
    yield [(7, w), (7, w), (7, w + " more"), (7, other), (5, " ".join(near)), (5, body(40))]


@pytest.mark.parametrize("rows", list(jaccard_cases()))
def test_jaccard_join(spark, rows):
    docs = spark.createDataFrame([(i, t, k, "x", 2) for k, (i, t) in enumerate(rows)], "doc_id long, text string, n_chars long, place string, row int").repartition(3)
    known = [(i, t) for i, t in rows if i is not None]
    links = jaccard_links(known)
    label = grouped([i for i, _ in known], links)
    least = {c: min(i for (i, _), k in zip(known, label, strict=True) if k == c) for c in label}
    want = [(i, len(n), least[c]) for (i, _), n, c in zip(known, links, label, strict=True)] + [(None, 0, None)] * (len(rows) - len(known))
    got = ngram_jaccard.jaccard_join(docs).collect()
    assert collections.Counter((r.doc_id, r.n_links, r.component_id) for r in got) == collections.Counter(want)
    assert sum(r.kept for r in got) == len(set(label)) + len(rows) - len(known)
    kept = ngram_jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    left = {r.n_chars for r in kept.collect()}
    groups = collections.defaultdict(list)
    for k, c in zip([k for k, r in enumerate(rows) if r[0] is not None], label, strict=True):
        groups[c].append(k)
    assert all(len(left & set(g)) == 1 and rows[min(left & set(g))][0] == min(rows[k][0] for k in g) for g in groups.values())
    assert len(left) == len(groups) + len(rows) - len(known)


def repeats(rows):
    first = {}
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w, seen, gone = t.split(), set(), set()
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            if first[key] < i or key in seen:
                gone |= set(range(k, k + 20))
            seen.add(key)
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return collections.Counter(out)


W = body(25)


@pytest.mark.parametrize(
    "rows",
    [
        [(1, W), (2, body(500) + " " + W), (2, body(30))],
        [(1, W), (2, body(30)), (2, body(500) + " " + W), (2, W), (2, body(500) + " " + W + " " + body(3) + " " + W)],
        [(3, W + " " + body(40)), (3, W + " " + body(40)), (9, "x " + W), (9, "x " + W), (1, body(10) + " " + W)],
    ],
)
def test_substring_dedup(spark, rows):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, no int").repartition(2)
    got = substring_dedup.repeats(docs).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == repeats(rows)


def test_vectors(spark):
    rows = [(1, [1.0, 0.0, 0.1]), (1, [1.0, 0.01, 0.1]), (2, [0.0, 1.0, 0.0]), (2, [0.0, 1.0, 0.0]), (5, [1e200, 0.0]), (6, [1e200, 1e-3]), (7, [1e-200, 0.0]), (8, [2e-200, 1e-300]), (9, [5e-324, 0.0])]
    vectors = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, id string").repartition(3)
    got = collections.Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_near_dup.near_duplicates(vectors).collect())
    flat = [(5, 4, 5, True)] + [(i, 4, 5, False) for i in (6, 7, 8, 9)]
    assert got == collections.Counter([(1, 1, 1, True)] * 2 + [(2, 1, 2, True)] * 2 + flat)


def test_rows_without_or_with_repeated_ids_are_scored_alike(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    none = docs.where("doc_id in (5, 6)").withColumn("doc_id", F.lit(None).cast("long"))
    odd = docs.unionByName(docs.where("doc_id < 3")).unionByName(none).unionByName(docs.where("doc_id = 7").withColumn("text", F.lit(None).cast("string")))
    for rows in (secret_scan.report(odd).collect(), toxicity_crf.report(odd, labels).collect(), gated_lm.log_likelihood(odd).collect()):
        assert len(rows) == odd.count() and sum(r.doc_id is None for r in rows) == 2 and sum(r.doc_id in (0, 1, 2, 7) for r in rows) == 8
        for i in (0, 1, 2):
            one, two = (r.asDict() for r in rows if r.doc_id == i)
            assert all(abs(one[c] - two[c]) < 1e-3 if isinstance(one[c], float) else one[c] == two[c] for c in one)
        assert not any(r.asDict().get("held_out") for r in rows if r.doc_id is None)


def test_vectors_without_id(spark):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    odd = vectors.unionByName(vectors.where("vec_id < 2").withColumn("vec_id", F.lit(None).cast("long")))
    got = embedding_near_dup.near_duplicates(odd)
    assert [(r.n_links, r.component_id, r.kept) for r in got.where("vec_id is null").collect()] == [(0, None, True)] * 2
    alone = embedding_near_dup.near_duplicates(vectors)
    assert got.where("vec_id is not null").exceptAll(alone).count() == 0 == alone.exceptAll(got).count()


def test_a_very_long_text(spark):
    words = 400_000
    rows = [(1, " ".join(f"w{i % 9973}" for i in range(words)) + " password=Ab3dEf6h", "s"), (2, "short one", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    scanned = {r.doc_id: r for r in secret_scan.report(docs).collect()}
    assert (scanned[1].n_assign, scanned[2].n_assign) == (1, 0)
    mixed = {r.doc_id: r for r in source_mix.mix(docs).collect()}
    assert mixed[1].size == words + 1 and mixed[1].taken <= 2 * (words + 1) and abs(mixed[1].taken - mixed[1].target) < 0.004 * mixed[1].target
    packed = best_fit.best_fit(docs).where("doc_id = 1").collect()
    assert sum(r.length for r in packed) == words + 1 and max(r.length for r in packed) == 4096
