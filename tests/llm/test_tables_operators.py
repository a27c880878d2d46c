"""Vectors, pages, components and the registered queries."""

import base64
import collections
import hashlib
import os
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from roadloom.llm import embedding_near_dup, pairs, warc_revisits
from roadloom.llm.queries import llm_oracles, llm_queries


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(300):
        base = rng.standard_normal(16) if i % 10 else np.ones(16)
        for _ in range(3):
            rows.append((len(rows), [float(v) for v in (base + rng.standard_normal(16) * 0.25).astype(np.float32)], i % 3))
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] + [1.0] * 15, 1), (903, [None] + [1.0] * 15, 1), (904, [1.0] * 16, None), (905, rows[0][1], 0), (906, [1.0, 2.0], 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, copies string").repartition(3)
    got = {r.vec_id: r for r in embedding_near_dup.near_duplicates(df, miss=1e-9).collect()}
    sound = [r for r in rows[:900] + [rows[905]]]
    x = np.array([r[1] for r in sound])
    cosine = (x @ x.T) / np.sqrt((x * x).sum(1))[:, None] / np.sqrt((x * x).sum(1))[None, :]
    ids, label = np.array([r[0] for r in sound]), np.array([r[2] for r in sound])
    link = (cosine >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    part = ids.copy()
    for _ in range(len(ids)):
        new = np.array([min([part[i], *part[link[i]]]) for i in range(len(ids))])
        if (new == part).all():
            break
        part = new
    assert len(got) == len(rows)
    for k, i in enumerate(ids):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (link[k].sum(), part[k], part[k] == i)
    for i in (900, 901, 902, 903, 904, 906):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert embedding_near_dup.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_path_and_of_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(500, 500)]
    got = {r.id: r.component_id for r in pairs.components(spark.createDataFrame(edges, "u long, v long"), "parts").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}}


def test_warc_round_trip(spark, tmp_path):
    same = "<p>ü\r\n\r\nWARC/1.1\r\n</p>"
    rows = [(1, "http://a/ b\n", same), (2, None, same), (3, "u", None), (4, "v", ""), (5, "w", "x" * 200000), (6, "w", same), (6, "w", "other"), (None, "n", "y")]
    pages = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, strong string, refers_to int").repartition(3)
    got = warc_revisits.archive_pages(pages, str(tmp_path / "a")).collect()
    for page, _, html in rows:
        payload = (html or "").encode()
        equal = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        response = page is None or page == max(equal)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert [(r.payload_bytes, r.record_type, r.refers_to) for r in got if r.page_id == page and r.payload_digest == digest] == [(len(payload), "response" if response else "revisit", None if response else max(equal))]
    assert len(got) == len(rows)
    records = warc_revisits.read_archives(spark, str(tmp_path / "a")).where("record_type = 'response'").collect()
    assert sorted(r.payload for r in records) == sorted(["", "x" * 200000, same, "other", "y"])
    assert all(r.record_type == "response" for r in warc_revisits.archive_pages(pages, str(tmp_path / "b"), least_bytes=10**6).collect())
    assert warc_revisits.archive_pages(pages.limit(0), str(tmp_path / "c")).count() == 0


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    got, want = llm_queries()[name](spark, SMALL), con.execute(llm_oracles()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert collections.Counter(map(tuple, got.select(*columns).collect())) == collections.Counter(want.fetchall())


def test_dealt_operators_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in llm_queries()) == list(range(1, 14))


def test_pipeline_decisions_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = seen
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}-{os.getpid()}"
        stage(spark, before, SMALL).write.mode("overwrite").parquet(path)
        seen = spark.read.parquet(path)
        assert seen.columns == columns
        if name != "mixing":
            assert seen.count() == seen.select("doc_id").distinct().count() <= before.count()
            assert seen.exceptAll(before).count() == 0
        if name == "exact_dedup":
            body = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")
            kept = before.groupBy(body.alias("b")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")
            assert seen.select("doc_id").exceptAll(kept).count() == 0 and kept.exceptAll(seen.select("doc_id")).count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, seen, SMALL)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert packed.agg(F.sum("length")).first()[0] == sum(words(r.text) for r in seen.select("text").collect())


CLASHING = ("row", "rank", "turn", "slot", "block", "first", "last", "place", "at", "mixed_at", "mixed_times", "keys", "digest", "id", "size", "words", "target")


def test_pipeline_of_nothing_and_of_clashing_columns(spark, tmp_path):
    few = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 40")
    clashing = few.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in CLASHING])
    for no, docs in enumerate((few.where("false"), clashing)):
        seen = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            stage(spark, seen, SMALL).write.parquet(str(tmp_path / f"{no}-{name}"))
            seen = spark.read.parquet(str(tmp_path / f"{no}-{name}"))
            assert seen.columns == docs.columns
        rows = seen.collect()
        assert (no == 0) == (not rows) and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in CLASHING if no)
        packed = corpus_pipeline.STAGES[-1][1](spark, seen, SMALL).collect()
        assert {r.doc_id for r in packed} == {r.doc_id for r in rows}
