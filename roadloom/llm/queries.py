"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadloom.llm import (
    best_fit, collocations, embedding_near_dup, exact_dedup, gated_lm, ngram_jaccard, prefix_trie, secret_scan, source_mix, substring_dedup, token_counts,
    toxicity_crf, warc_revisits,
)
from roadloom.llm.tables import read

_QUERIES: dict = {}
_SQL: dict = {}


def query(f):
    _QUERIES[f.__name__] = f
    return f


def llm_queries() -> dict:
    return dict(_QUERIES)


def llm_oracles() -> dict:
    return dict(_SQL)


@query
def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_dup.near_duplicates(read(spark, sf_dir, "embeddings"))


_SQL["op10_embedding_near_dedup"] = r"""
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
n as (select *, sqrt(list_sum(list_transform(e, lambda x: x * x))) as size, min(vec_id) over (partition by label, e) as class_id from v),
links as (
  select a.vec_id as u, b.vec_id as v from n a join n b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) and a.size > 0 and b.size > 0
  where list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.93),
reach as (select distinct u, u as r from links union select reach.u, links.v from reach join links on links.u = reach.r),
least as (select u, min(r) as c from reach group by u),
degree as (select u, count(*) as d from links group by u)
select e.vec_id, coalesce(n.class_id, e.vec_id) as class_id, coalesce(d, 0)::bigint as n_links, coalesce(c, e.vec_id)::bigint as component_id,
  coalesce(c, e.vec_id) = e.vec_id as kept
from embeddings e left join n on n.vec_id = e.vec_id and n.size > 0 left join degree on degree.u = e.vec_id left join least on least.u = e.vec_id
"""


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_join(read(spark, sf_dir, "documents"))


_SQL["op1_ngram_jaccard_join"] = r"""
with recursive w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
sets as (
  select doc_id, list_sort(list_distinct(case when len(words) < 5 then [words]
    else list_transform(range(1, len(words) - 3), lambda i: words[i:i + 4]) end)) as elements from w where len(words) > 0),
classes as (select elements, min(doc_id) as class_id, count(*) as copies from sets group by elements),
grams as (select class_id, unnest(elements) as g from classes),
shared as (select a.class_id as u, b.class_id as v, count(*) as n from grams a join grams b on a.g = b.g and a.class_id <> b.class_id group by all),
sized as (select class_id, copies, len(elements) as m from classes),
links as (select u, v, b.copies from shared join sized a on a.class_id = u join sized b on b.class_id = v where n >= 0.8 * (a.m + b.m - n)),
reach as (select distinct u, u as r from links union select reach.u, links.v from reach join links on links.u = reach.r),
least as (select u, min(r) as c from reach group by u),
degree as (select u, sum(copies) as d from links group by u),
placed as (select s.doc_id, k.class_id, k.copies from sets s join classes k on k.elements = s.elements)
select d.doc_id, coalesce(p.class_id, d.doc_id) as class_id, (coalesce(degree.d, 0) + coalesce(p.copies, 1) - 1)::bigint as n_links,
  coalesce(least.c, p.class_id, d.doc_id) as component_id, coalesce(least.c, p.class_id, d.doc_id) = d.doc_id as kept
from documents d left join placed p on p.doc_id = d.doc_id left join degree on degree.u = p.class_id left join least on least.u = p.class_id
"""


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_files(spark, f"{sf_dir}/documents.parquet").drop("locator")


_SQL["op4_exact_dedup"] = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents),
g as (select body, min(doc_id) as keep_id, count(*) as group_size from t group by body)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256 from t join g using (body)
"""


@query
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(read(spark, sf_dir, "documents"))


@query
def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_revisits.archive_pages(read(spark, sf_dir, "pages")).drop("url")


_SQL["op6_warc_revisits"] = r"""
with p as (select page_id, coalesce(html, '') as body from pages),
last as (select body, max(page_id) as largest from p group by body),
d as (select page_id, largest, octet_length(encode(body))::bigint as payload_bytes, sha1(body) as h from p join last using (body)),
-- five hexadecimal digits are twenty bits, four letters of base 32
b as (select *, list_transform(range(0, 40, 5), lambda i: list_reduce(
    list_prepend(0, list_transform(range(1, 6), lambda k: instr('0123456789abcdef', substr(h, (i + k)::int, 1)) - 1)), lambda x, y: 16 * x + y)) as parts from d),
c as (select *, list_transform(parts, lambda x: concat(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x // 32768 + 1)::int, 1), substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x // 1024 % 32 + 1)::int, 1),
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x // 32 % 32 + 1)::int, 1), substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x % 32 + 1)::int, 1))) as letters from b)
select page_id, payload_bytes, array_to_string(letters, '') as payload_digest, case when page_id = largest then 'response' else 'revisit' end as record_type,
  case when page_id < largest then largest end as refers_to from c
"""


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(read(spark, sf_dir, "documents"))


@query
def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.best_fit(read(spark, sf_dir, "documents"))


@query
def op9_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_crf.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op7_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gated_lm.log_likelihood(read(spark, sf_dir, "documents"))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(read(spark, sf_dir, "documents"))


_SQL["op3_substring_dedup"] = r"""
with t as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
w as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as pos from t),
starts as (select doc_id, unnest(range(1, len(words) - 18)) as pos, words from t where len(words) >= 20),
seqs as (select doc_id, pos, array_to_string(words[pos:pos + 19], ' ') as seq from starts),
later as (select doc_id, pos, row_number() over (partition by seq order by doc_id, pos) > 1 as again from seqs),
gone as (
  select w.doc_id, w.pos, word, coalesce(max(case when again then 1 else 0 end) over (partition by w.doc_id order by w.pos rows between 19 preceding and current row), 0) = 1 as removed
  from w left join later l on l.doc_id = w.doc_id and l.pos = w.pos),
kept as (
  select doc_id, count(*) filter (where removed) as n_removed, sha256(coalesce(string_agg(word, ' ' order by pos) filter (where not removed), '')) as kept_sha256
  from gone group by doc_id)
select t.doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, coalesce(kept_sha256, sha256('')) as kept_sha256
from t left join kept on kept.doc_id = t.doc_id
"""


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


_SQL["op12_collocations"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
sized as (select lang, words, unnest(range(1, 5)) as size from w),
grams as (select lang, size, unnest(list_transform(range(1, len(words) - size + 2), lambda i: list_slice(words, i, i + size - 1))) as g from sized where len(words) >= size),
f as (select lang, size, g, count(*)::hugeint as f from grams group by all),
cand as (select lang, size, g, f from f where size >= 2 and f >= 30),
cuts as (select c.*, unnest(range(1, c.size)) as k from cand c),
scored as (
  select c.lang, c.size, c.g, c.f, c.k, a.f as l, b.f as r, (2000000 * c.f) // (a.f + b.f) as score
  from cuts c join f a on a.lang = c.lang and a.size = c.k and a.g = c.g[1:c.k]
  join f b on b.lang = c.lang and b.size = c.size - c.k and b.g = c.g[c.k + 1:c.size]),
best as (select *, row_number() over (partition by lang, g order by score, k) as nth from scored),
inner_of as (
  select lang, f as longer, unnest(list_concat(
    list_transform(range(1, size), lambda i: g[i:i + 1]),
    case when size = 4 then list_transform(range(1, 3), lambda i: g[i:i + 2]) else [] end)) as g
  from cand where size >= 3),
covered as (select lang, g, max(longer) as longer from inner_of group by all),
n as (select lang, sum(f)::bigint as n from f where size = 1 group by lang),
ranked as (
  select b.lang, row_number() over (partition by b.lang order by b.score desc, b.f desc, array_to_string(b.g, ' ')) as rank,
    array_to_string(b.g, ' ') as phrase, b.f::bigint as a, b.l::bigint as l, b.r::bigint as r, n.n, b.score::bigint as score
  from best b join n on n.lang = b.lang left join covered c on c.lang = b.lang and c.g = b.g
  where b.nth = 1 and (c.longer is null or 100 * c.longer < 80 * b.f))
select * from ranked where rank <= 2000
"""


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


_SQL["op11_prefix_trie"] = r"""
with t as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first,
      sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, '')))) as pos
  from conversations where conv_id is not null),
ids as (select c, c - c % 5 as base, xor(list_reduce(
    list_prepend(4294967295::ubigint, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::ubigint)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::ubigint, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, z: xor(x >> 1, (x & 1) * 3988292384::ubigint))), 4294967295::ubigint) % 9 as h
  from (select distinct c from t)),
turns as (
  select i.c, t.pos as step, t.role, t.text from ids i join t on t.c = i.base and t.pos <= i.h
  union all select i.c, t.pos + 9, t.role, t.text from ids i join t on t.c = i.c and t.pos > i.h),
seqs as (
  select i.c, coalesce(s.seq, []) as seq from ids i left join
    (select c, list(struct_pack(role := role, text := text) order by step) as seq from turns group by c) s on s.c = i.c),
members as (select c, len(seq) as size, d, seq[1:d] as node from (select *, unnest(range(0, len(seq) + 1)) as d from seqs)),
nodes as (
  select d, node, min(c) as conv, count(*) as n, coalesce(octet_length(encode(any_value(node)[-1].text)), 0) as bytes,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where size = d), '')) as ends
  from members group by d, node),
children as (select d - 1 as d, node[1:d - 1] as node, count(*) as children from nodes where d > 0 group by all),
known as (select n.*, coalesce(c.children, 0) as children from nodes n left join children c on c.d = n.d and c.node = n.node),
above as (select children, n, bytes, unnest(range(0, d + 1)) as depth, node from known),
sums as (select depth as d, node[1:depth] as node, count(*) filter (where children = 0) as leaves, sum((n - 1) * bytes)::bigint as saved from above group by all)
select k.conv as conv_id, k.d as depth, p.conv as parent_conv_id, k.n as n_convs, k.children as n_children, s.leaves as n_leaves,
  s.saved as saved_tokens, k.ends as ends_sha256
from known k join sums s on s.d = k.d and s.node = k.node left join nodes p on k.d > 0 and p.d = k.d - 1 and p.node = k.node[1:k.d - 1]
"""
