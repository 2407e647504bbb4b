"""The registered queries of the corpus operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, filter_audit, hard_negatives, html_extract, language_id, lm_scoring, mixing, quality_rules, sentencepiece_tok, simhash, suffix_dedup, url_filter, warc
from .common import table


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: pages that were reached by a tracking link, so that their other spellings are found."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, pages.where(F.contains("url", F.lit("utm_source=")))).select("page_id", "host", "path", "rule", "verdict")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, k=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentencepiece_tok.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_tokens", "token_ids", "decodes", "parity")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"))
    return language_id.identify(docs, ~F.col("held_out")).select("doc_id", "held_out", "lang_pred", "score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    flipped = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", flipped.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (op1_html_extract, op2_warc, op3_lm_score, op4_url_filter, op5_ann, op6_mix_sources, op7_simhash_near_dedup, op8_suffix_dedup, op9_sentencepiece, op10_quality_rules, op11_language_id, op12_hard_negatives, op13_filter_audit)
}

_CANONICAL = r"""
    regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') ||
    case when len(params) > 0 then '?' || array_to_string(params, '&') else '' end
"""
ORACLE_SQL: dict[str, str] = {
    "op2_warc": """
        with p as (select page_id, coalesce(html, '') as body from pages),
        d as (select *, sha1(body) as hex, max(page_id) over (partition by body) as largest from p),
        bits as (select *, list_reduce(list_transform(range(1, 41), lambda i: lpad(bin(('0x' || substr(hex, i, 1))::int), 4, '0')), lambda a, b: a || b) as b from d)
        select page_id, octet_length(encode(body))::bigint as payload_bytes,
            list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
                16 * substr(b, 5 * i::int + 1, 1)::int + 8 * substr(b, 5 * i::int + 2, 1)::int + 4 * substr(b, 5 * i::int + 3, 1)::int + 2 * substr(b, 5 * i::int + 4, 1)::int + substr(b, 5 * i::int + 5, 1)::int), 1)), lambda a, b: a || b) as payload_digest,
            case when page_id = largest then 'response' else 'revisit' end as record_type,
            case when page_id = largest then null else largest end as refers_to
        from bits
    """,
    "op4_url_filter": rf"""
        with cut as (
            select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
        ), parts as (
            select page_id, url,
                translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
                list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' and not
                    (starts_with(x, 'utm_') or starts_with(x, 'ref=') or starts_with(x, 'fbclid=') or starts_with(x, 'gclid=')))) as params
            from cut
        ), keyed as (select *, {_CANONICAL} as key from parts),
        listed as (select distinct key from keyed where contains(url, 'utm_source=') and key <> ''),
        rules(host, path, verdict) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        fit as (
            select k.page_id, k.url, arg_max(r.host || r.path, length(r.host || r.path)) as rule, arg_max(r.verdict, length(r.host || r.path)) as verdict
            from (select distinct page_id, url, host, path from keyed) k join rules r on (k.host = r.host or ends_with(k.host, '.' || r.host)) and starts_with(k.path, r.path)
            group by all
        )
        select k.page_id, k.host, k.path, f.rule, coalesce(f.verdict, case when l.key is not null then 'block' else 'allow' end) as verdict
        from keyed k left join fit f on k.page_id = f.page_id and k.url = f.url left join listed l on k.key = l.key
    """,
    "op5_ann": """
        with v as (
            select vec_id, embedding::double[] as x from embeddings
            where embedding is not null and len(embedding) = 64 and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0 and len(list_filter(embedding, lambda e: e <> 0)) > 0
        ), pairs as (
            select q.vec_id as query_id, c.vec_id, sqrt(list_reduce(list_transform(range(1, 65), lambda i: (c.x[i] - q.x[i]) * (c.x[i] - q.x[i])), lambda a, b: a + b)) as score
            from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
        ), ranked as (select *, row_number() over (partition by query_id order by score, vec_id)::int as rank from pairs)
        select query_id, rank, vec_id, score from ranked where rank <= 10
    """,
    "op12_hard_negatives": """
        with v as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda e: floor(256 * e::double)::bigint) as q from embeddings
            where label is not null and embedding is not null and len(embedding) = 64 and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0
        ), scored as (
            select a.vec_id as anchor_id, a.label = c.label as same, c.vec_id,
                list_reduce(list_transform(range(1, 65), lambda i: a.q[i] * c.q[i]), lambda x, y: x + y) as score
            from v a join v c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id
        ), positives as (
            select anchor_id, vec_id as positive_id, score as positive_score from (
                select *, row_number() over (partition by anchor_id order by score desc, vec_id) as n from scored where same) where n <= 5
        ), ranked as (
            select p.*, s.vec_id as negative_id, s.score as negative_score,
                row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id)::int as rank
            from positives p join scored s on p.anchor_id = s.anchor_id and not s.same
                and 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score
        )
        select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ranked where rank <= 5
    """,
    "op13_filter_audit": r"""
        with recursive texts as (
            select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
        ), flags as (
            select doc_id, max((coalesce(quality, 0) = 1)::int) as good, max((coalesce(toxic, 0) = 1)::int) as toxic from labels where doc_id is not null group by 1
        ), masks as (
            select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
                (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::int
                + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(min(texts.doc_id) over (partition by t) < texts.doc_id, false)::int as mask
            from texts left join flags on texts.doc_id = flags.doc_id
        ), hist as (
            select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from masks group by 1, 2
        ), letters(f, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        grown(o, step, bit, before) as (
            select f, 1, bit, 0 from letters
            union all select o || f, step + 1, letters.bit, before | grown.bit from grown join letters on instr(o, f) = 0
        ), orders as (select o as filter_order from grown where step = 5),
        steps as (select filter_order, step, bit, before from orders join grown on starts_with(filter_order, o))
        select part, filter_order, step,
            sum(case when mask & (before | bit) = 0 then n else 0 end)::bigint as kept,
            sum(case when mask & bit > 0 and mask & before = 0 then n else 0 end)::bigint as removed,
            sum(case when mask & bit > 0 and mask & before > 0 then n else 0 end)::bigint as redundant,
            sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
            sum(case when mask & bit > 0 and mask & before = 0 then good else 0 end)::bigint as good_lost,
            sum(case when mask & bit > 0 and mask & before = 0 then toxic else 0 end)::bigint as toxic_lost,
            sum(case when mask & bit > 0 then n * 120 // bit_count(mask) else 0 end)::bigint as shapley
        from hist cross join steps group by 1, 2, 3
    """,
}
