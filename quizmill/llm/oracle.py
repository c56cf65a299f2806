"""DuckDB SQL with the same rows as the queries, where SQL can express them.

The others can't be: approximate search, a trained classifier, keyed permutations and draws, tokenizers
and templates. Tests hold those against plain versions."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op1_ngram_join": f"""
with recursive d as (select doc_id, {_WORDS.format(_LOWER)} as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) end as s from d),
e as (select doc_id, len(s) as n, unnest(s) as k from s),
pairs as (select a.doc_id as a, b.doc_id as b, any_value(a.n) as m, any_value(b.n) as n, count(*) as shared from e a join e b on a.k = b.k and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from pairs where 100 * shared >= 90 * (m + n - shared)),
ways as (select a, b from links union select b, a from links),
reached as (select doc_id as a, doc_id as b from s union select reached.a, ways.b from reached join ways on reached.b = ways.a)
select doc_id, len(s) as n_shingles, component_id from s join (select a as doc_id, min(b) as component_id from reached group by 1) using (doc_id)""",
    "op6_maxscore": """
with v as (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as w from embeddings
           where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select q.r as q, q.vec_id as query_id, v.vec_id, cast(list_dot_product(q.w, v.w) as bigint) as score from v q join v on q.r <> v.r and len(q.w) = len(v.w) where q.vec_id % 20 = 0)
select query_id, cast(row_number() over (partition by q order by score desc, vec_id) as int) as rank, vec_id, score from p
qualify row_number() over (partition by q order by score desc, vec_id) <= 20""",
    "op9_substring_dedup": f"""
with d as (select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents),
windows as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as k from d, unnest(range(1, len(w) - 18)) t(i)),
again as (select doc_id, i from windows qualify row_number() over (partition by k order by doc_id, i) > 1),
gone as (select distinct doc_id, i + j as p from again, unnest(range(0, 20)) t(j)),
words as (select doc_id, p, w[p] as x from d, unnest(range(1, len(w) + 1)) t(p)),
kept as (select doc_id, count(*) as n, string_agg(x, ' ' order by p) as s from words anti join gone using (doc_id, p) group by 1)
select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(s, '')) as kept_sha256 from d left join kept using (doc_id)""",
    "op11_hard_negatives": """
with v as (select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as w from embeddings
           where vec_id is not null and label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select a.r as a, a.vec_id as anchor_id, b.vec_id as vec_id, a.label = b.label as same, cast(list_dot_product(a.w, b.w) as bigint) as score
      from v a join v b on a.r <> b.r and len(a.w) = len(b.w) where a.vec_id % 50 = 0),
pos as (select a, anchor_id, row_number() over (partition by a order by score desc, vec_id) as k, vec_id as positive_id, score as positive_score from p where same
        qualify row_number() over (partition by a order by score desc, vec_id) <= 5)
select anchor_id, positive_id, cast(row_number() over (partition by a, k order by score desc, vec_id) as int) as rank, vec_id as negative_id, positive_score, score as negative_score
from pos join p using (a, anchor_id) where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify row_number() over (partition by a, k order by score desc, vec_id) <= 3""",
    "op12_periodic_runs": f"""
with d as (select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents),
c as (select *, len(w) as n, xor(list_reduce(list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint), lambda r, b: list_reduce(range(8), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(r, b)), 4294967295::bigint), 4294967295) as h from d),
g as (select *, h // 10 as g, case when n > 0 and h % 10 = 0 then (h // 10) % n else n end as a from c),
p as (select *, 1 + (n - a) // (3 + g % 8) as p from g),
t as (select doc_id, n, i, case when i < a or a is null then w[i + 1] else w[(a + (i - a) % p)::bigint + 1] end as x from p, unnest(range(n)) u(i)),
same as (select l.doc_id, r.i - l.i as q, l.i from t l join t r on l.doc_id = r.doc_id and l.x = r.x and r.i > l.i and 3 * (r.i - l.i) <= l.n),
islands as (select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as k from same),
stretches as (select doc_id, q, min(i) as s, max(i) + 1 + q as e from islands group by doc_id, q, k having max(i) + 1 + q - min(i) >= greatest(24, 3 * q)),
runs as (select doc_id, s, e - s as len, min(q) as q from stretches group by doc_id, s, e),
best as (select doc_id, count(*) as n_runs, arg_max(struct_pack(s := s, len := len, q := q), struct_pack(x := len::double / q, s := -s, q := -q)) as b, sha256(string_agg(s || ',' || len || ',' || q || chr(10), '' order by s, q)) as sha from runs group by doc_id),
gone as (select distinct r.doc_id, u.i from runs r, unnest(range(r.s + r.q, r.s + r.len)) u(i)),
kept as (select doc_id, string_agg(x, ' ' order by i) as text from t anti join gone using (doc_id, i) group by doc_id)
select d.doc_id, len(d.w) as n_words, coalesce(n_runs, 0) as n_runs, b.s as start, b.len as length, b.q as period, 1000 * b.len // b.q as exponent_milli, coalesce(sha, sha256('')) as runs_sha256, sha256(coalesce(kept.text, '')) as collapsed_sha256
from d left join best using (doc_id) left join kept using (doc_id)""",
}
