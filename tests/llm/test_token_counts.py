"""Token counts against the library itself."""

import public_tokenizers
from tokenizers import Tokenizer

from roadloom.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "\n", "   \n\t  a", "it's we'll I'm 'tis 'S x 's", "plain words and numbers 123 4 5six", "two  spaces   three\n\nlines \r\n end ",
    "naïve façade über 漢字 かな \U0001f600 é́  nbsp em \x85 \x1c\x1d\x1e\x1f ​ ᠎", "a<|endoftext|>b <|endoftext|> ", "<|endoftext|>" * 3,
    "new letters Ɤ\U00010d50\U00016100 and 1\U00010d40 x", "\U000e0100 \U00050000x \U0010ffff", "x" * 3000, "ab " * 3000, " " * 500 + "z", "!!! ... '' ''' _a_ a_b __ 1_000",
    "\x00 nul \x01", "'", "''s", " 's", "don't’t",
]
SCHEMA = "doc_id long, text string, n_tokens string, words int, job int"


def expected(text):
    return len(Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids)


def test_counts_are_the_librarys(spark):
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], "x", 1, 2), (None, TEXTS[6], "x", 1, 2), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = sorted((-1 if r[0] is None else r[0], len((r[1] or "").encode()), expected(r[1])) for r in rows)
    for table in (token_counts.TABLE, 3, 0):
        got = token_counts.token_counts(docs, PATH, limit=20, table=table).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert all(r.over_limit == (r.n_tokens > 20) for r in got)
    assert token_counts.token_counts(docs.limit(0), PATH).count() == 0
    assert token_counts.token_counts(docs, PATH).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: expected(r.text) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, PATH).collect()} == want


def test_splits_agree():
    import regex
    import random
    import re

    chance = random.Random(4)
    for _ in range(3000):
        text = "".join(chance.choice("ab1 \t\n\r\x0b\x0c\x1c'stmdrevl!_.") for _ in range(chance.randrange(40)))
        want = regex.findall(token_counts.SPLIT, text)
        assert re.findall(token_counts.SPLIT_ASCII, text) == want
        assert [w for p in token_counts.pieces(text, 5) for w in regex.findall(token_counts.SPLIT, p)] == want


def test_other_tokenizers_encode_whole_texts(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS[:9])], "doc_id long, text string")
    library = Tokenizer.from_file(path)
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(TEXTS[:9])}
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, path).collect()} == want


def test_summaries_keep_what_is_frequent(spark):
    texts = [f"hot hot hot rare{i}x{k}" for i in range(40) for k in range(5)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(40)
    assert token_counts.frequent(docs, 2) == [" hot", "hot"] and token_counts.frequent(docs.limit(0)) == []
    from collections import Counter

    assert token_counts._shrunk(Counter(a=9, b=5, c=2, d=2), 2) == Counter(a=7, b=3)
