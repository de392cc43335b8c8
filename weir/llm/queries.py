"""Registered queries of this package: the production call over a whole table, and its SQL or None."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weir.llm import ann, collocations, html_text, langid, mixing, near_dups, packing, pii, repeats, secret_scan, topk, vector_dups, whitening
from weir.queries.tables import table


OP7_SQL = """
with v as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as z
    from embeddings
    where vec_id is not null and embedding is not null
      and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
), s as (
    select q.vec_id as query_id, c.vec_id,
        cast(list_sum(list_transform(list_zip(q.z, c.z), lambda p: p[1] * p[2])) as bigint) as score
    from v q join v c on q.vec_id <> c.vec_id
    where q.vec_id % 20 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from s qualify rank <= 20
"""


OP11_SQL = """
with recursive v as (
    select vec_id, list_transform(embedding, lambda x: cast(x as double)) as z
    from embeddings
    where embedding is not null
      and coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), false)
      and coalesce(list_bool_or(list_transform(embedding, lambda x: coalesce(x <> 0, false))), false)
), pairs as (
    select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.z) = len(b.z)
    where list_cosine_similarity(a.z, b.z) >= 0.9
), reached(a, b) as (
    select a, b from pairs
    union
    select r.a, p.b from reached r join pairs p on p.a = r.b
), found as (
    select e.vec_id, coalesce(n.links, 0) as n_links, least(e.vec_id, coalesce(c.least, e.vec_id)) as component_id
    from embeddings e
    left join (select a, count(*) as links from pairs group by a) n on n.a = e.vec_id
    left join (select a, min(b) as least from reached group by a) c on c.a = e.vec_id
)
select vec_id, n_links, component_id, vec_id = component_id as kept from found
"""

OP13_SQL = r"""
with texts as (
    select coalesce(lang, 'und') as lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents
), pieces as (
    select lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from texts
), worded as (
    select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces
), grams as (
    select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase, w[i] as head, w[i + k - 1] as tail,
        array_to_string(w[i : i + k - 2], ' ') as front, array_to_string(w[i + 1 : i + k - 1], ' ') as rest
    from (select lang, w, unnest(range(1, len(w) + 1)) as i from worded where len(w) > 0), (values (1), (2), (3)) as sizes(k)
    where i + k - 1 <= len(w)
), f as (
    select lang, k, phrase, any_value(head) as head, any_value(tail) as tail, any_value(front) as front,
        any_value(rest) as rest, count(*) as a
    from grams group by all
), totals as (
    select lang, sum(a)::bigint as n from f where k = 1 group by lang
), candidates as (
    select * from f where k > 1 and a >= 10
), cuts as (
    select c.lang, c.k, c.phrase, c.a, 1 as cut, x.a as l, y.a as r
    from candidates c
    join f x on x.lang = c.lang and x.k = 1 and x.phrase = c.head
    join f y on y.lang = c.lang and y.k = c.k - 1 and y.phrase = c.rest
    union all
    select c.lang, c.k, c.phrase, c.a, 2, x.a, y.a
    from candidates c
    join f x on x.lang = c.lang and x.k = 2 and x.phrase = c.front
    join f y on y.lang = c.lang and y.k = 1 and y.phrase = c.tail
    where c.k = 3
), scored as (
    select *, (1000000::hugeint * a * a // (l::hugeint * r))::bigint as score
    from cuts
    qualify row_number() over (partition by lang, k, phrase order by score, cut) = 1
), held as (
    select lang, phrase, max(a) as longer
    from (
        select lang, front as phrase, a from candidates where k = 3
        union all select lang, rest, a from candidates where k = 3
    ) group by lang, phrase
), kept as (
    select s.* from scored s left join held h on h.lang = s.lang and h.phrase = s.phrase and s.k = 2
    where h.longer is null or 100 * h.longer < 50 * s.a
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept join totals using (lang)
qualify rank <= 2000
"""


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.fit_and_identify(table(spark, sf_dir, "documents"))


def op3_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_digest(table(spark, sf_dir, "documents"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op6_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", 20)


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", 5)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_digest(table(spark, sf_dir, "documents"))


def op11_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dups.linked_vectors(table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


REGISTRY = {
    "op1_html_text": (op1_html_text, None),
    "op2_language_id": (op2_language_id, None),
    "op3_near_dups": (op3_near_dups, None),
    "op4_secret_scan": (op4_secret_scan, None),
    "op5_mix_sources": (op5_mix_sources, None),
    "op6_best_fit_pack": (op6_best_fit_pack, None),
    "op7_exact_topk": (op7_exact_topk, OP7_SQL),
    "op8_repeats": (op8_repeats, None),
    "op9_ann": (op9_ann, None),
    "op10_pii": (op10_pii, None),
    "op11_embedding_dups": (op11_embedding_dups, OP11_SQL),
    "op12_whitening": (op12_whitening, None),
    "op13_collocations": (op13_collocations, OP13_SQL),
}
