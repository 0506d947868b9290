"""DuckDB SQL for the registered queries that SQL can express over whole tables.

Tokens and packing (1, 5), the trained extraction (8), the sequential choice at the border of a
sample (9) and all 100-byte windows of a corpus (6, too much for one process) are held against
brute force in the tests instead.
"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = r"'[^\x20\x09-\x0D]+'"

_WARC = """
with p as (select page_id, coalesce(html, '') as body from pages),
     h as (select body, max(page_id) as holder from p group by body)
select page_id, cast(strlen(p.body) as bigint) as payload_bytes, sha1(p.body) as payload_digest,
       case when strlen(p.body) >= 1000 and page_id <> holder then 'revisit' else 'response' end as record_type,
       case when strlen(p.body) >= 1000 and page_id <> holder then holder end as refers_to
from p join h on p.body = h.body
"""

_NEAR = f"""
with recursive
     w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORDS}) as ws from documents),
     s as (select distinct doc_id, array_to_string(ws[i : i + 4], ' ') as shingle
           from w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as places(i) where len(ws) > 0),
     n as (select doc_id, count(*) as n from s group by doc_id),
     p as (select a.doc_id as a, b.doc_id as b, count(*) as common
           from s as a join s as b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
     links as (select a, b from p join n as x on x.doc_id = a join n as y on y.doc_id = b
               where 100 * common >= 85 * (x.n + y.n - common)),
     both_ways as (select a, b from links union all select b, a from links),
     reach(doc_id, origin) as (
       select doc_id, doc_id from documents
       union select both_ways.b, origin from reach join both_ways on both_ways.a = reach.doc_id),
     c as (select doc_id, min(origin) as component_id from reach group by doc_id)
select doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, component_id, doc_id = component_id as kept
from c left join n using (doc_id)
"""

_QUALITY = rf"""
with w as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), {_WORDS}) as ws from documents),
     t as (select doc_id, i, ws[i : i + 2] as window_words
           from w, unnest(range(1, greatest(len(ws) - 1, 1))) as places(i)),
     again as (select doc_id, unnest([i, i + 1, i + 2]) as place from (
                 select doc_id, i, count(*) over (partition by doc_id, window_words) as uses from t) where uses > 1),
     covered as (select doc_id, count(distinct place) as n from again group by doc_id),
     m as (select doc_id, cast(len(ws) as bigint) as n_words,
                  cast(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as bigint) as word_chars,
                  cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
                  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines,
                  cast(coalesce(covered.n, 0) as bigint) as n_repeat_words
           from w left join covered using (doc_id)),
     f as (select *, cast(len(lines) as bigint) as n_lines,
                  cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
                  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 10 * n_symbols > n_words or (2 * n_dup_lines > n_lines and n_dup_lines >= 4)
            or word_chars < 2 * n_words or word_chars > 14 * n_words) as kept
from f
"""

_URLS = f"""
with rules(verdict, host, path) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
       ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
     rest as (select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as r from pages),
     parts as (select page_id, regexp_extract(r, '^[^/?#]*') as h, r from rest),
     u as (select page_id, translate(h, {_LOWER}) as host,
                  regexp_extract(substr(r, length(h) + 1), '^[^?#]*') as path from parts),
     best as (select page_id, arg_max(rules.verdict, length(rules.host || rules.path)) as verdict,
                     arg_max(rules.host || rules.path, length(rules.host || rules.path)) as rule
              from u join rules on (u.host = rules.host or ends_with(u.host, '.' || rules.host))
                               and starts_with(u.path, rules.path) group by page_id)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from u left join best using (page_id)
"""

_VECTORS = """
with recursive
     v as (select vec_id, cast(embedding as double[]) as e from embeddings),
     good as (select vec_id, e, sqrt(list_inner_product(e, e)) as norm from v
              where len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and list_inner_product(e, e) > 0),
     links as (select a.vec_id as a, b.vec_id as b from good as a join good as b
               on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
               where list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
     reach(vec_id, origin) as (
       select vec_id, vec_id from embeddings
       union select links.b, origin from reach join links on links.a = reach.vec_id),
     c as (select vec_id, min(origin) as component_id from reach group by vec_id),
     n as (select a as vec_id, count(*) as n from links group by a)
select vec_id, cast(coalesce(n.n, 0) as bigint) as n_links, component_id, vec_id = component_id as kept
from c left join n using (vec_id)
"""

_NEGATIVES = """
with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda c: floor(256 * cast(c as double))) as x
           from embeddings
           where label is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
     s as (select a.vec_id as anchor_id, e.vec_id, a.label = e.label as same,
                  cast(list_inner_product(a.x, e.x) as bigint) as score
           from e as a join e on a.vec_id <> e.vec_id where a.vec_id % 100 = 0),
     p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
           qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
     n as (select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
                  row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as place
           from p join s using (anchor_id)
           where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select anchor_id, positive_id, cast(place as integer) as "rank", negative_id, positive_score, negative_score
from n where place <= 10
"""

SQL: dict[str, str] = {
    "op13_hard_negatives": _NEGATIVES,
    "op2_warc_archive": _WARC,
    "op3_minhash_near_dedup": _NEAR,
    "op4_quality_rules": _QUALITY,
    "op7_url_filters": _URLS,
    "op10_embedding_near_dedup": _VECTORS,
}
