"""Results of the queries that SQL can express, as DuckDB statements."""

_RULES = "(values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))"

ORACLES = {
    "op4_substring_dedup": """
        with docs as (
            select doc_id, row_number() over () as n, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) as w
            from documents
        ), windows as (
            select doc_id, n, i, hash(array_to_string(w[i:i + 19], ' ')) as h, md5_number(array_to_string(w[i:i + 19], ' ')) as m
            from docs, unnest(range(1, len(w) - 18)) t(i)
        ), firsts as (
            select h, m, min({'d': doc_id, 'i': i}) as first from windows group by h, m having count(*) > 1
        ), again as (
            select distinct n, i + j as pos
            from windows join firsts using (h, m), unnest(range(0, 20)) t(j)
            where first < {'d': doc_id, 'i': i}
        ), gone as (
            select n, list(pos) as gone from again group by n
        )
        select doc_id, len(w)::bigint as n_words, coalesce(len(gone.gone), 0)::bigint as n_removed,
            sha256(coalesce(array_to_string(
                case when gone.gone is null then w else [w[k] for k in range(1, len(w) + 1) if not list_contains(gone.gone, k)] end, ' '), ''))
                as kept_sha256
        from docs left join gone using (n)
    """,
    "op7_url_filter": rf"""
        with split as (
            select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
            from pages
        ), parts as (
            select page_id, translate(regexp_extract(rest, '^[^/?#]*'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
                row_number() over () as n
            from split
        ), fits as (
            select n, r.host || r.path as rule, r.verdict
            from parts p join {_RULES} r(host, path, verdict)
                on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
            qualify row_number() over (partition by n order by length(r.host || r.path) desc, length(r.host) desc) = 1
        )
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join fits using (n)
    """,
    "op8_decontamination": """
        with item_words as (
            select item_id, regexp_extract_all(translate(text,
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
            from (select distinct item_id, text from benchmark where item_id is not null and text is not null)
        ), windows as (
            select distinct item_id, least(10, len(w)) as k,
                array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as seq
            from item_words, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i)
            where len(w) > 0
        ), doc_words as (
            select doc_id, n, coalesce(regexp_extract_all(translate(text,
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) as w
            from (select *, row_number() over () as n from documents)
        ), places as (
            select n, i, k, array_to_string(w[i:i + k - 1], ' ') as seq
            from doc_words, (select distinct k from windows) s, unnest(range(1, len(w) - k + 2)) t(i)
        ), hits as (
            select n, i, p.k, item_id from places p join windows v on p.k = v.k and p.seq = v.seq
        ), hit_words as (
            select n, count(distinct i + j) as n_hit from hits, unnest(range(0, k)) t(j) group by n
        ), hit_items as (
            select n, count(distinct item_id) as n_items,
                string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items
            from hits group by n
        )
        select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
            coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
            coalesce(n_hit, 0) > 0 as contaminated
        from doc_words left join hit_words using (n) left join hit_items using (n)
    """,
    "op9_vector_search": """
        with whole as (
            select row_number() over () as n, vec_id, [floor(1024 * c::double)::bigint for c in embedding] as x
            from embeddings
            where vec_id is not null and embedding is not null
                and len([c for c in embedding if c is not null and isfinite(c)]) = len(embedding)
        ), scored as (
            select q.n, q.vec_id as query_id, v.vec_id as vec_id,
                coalesce(list_sum([q.x[i] * v.x[i] for i in range(1, len(q.x) + 1)]), 0)::bigint as score
            from whole q join whole v on q.vec_id % 100 = 0 and q.n <> v.n and len(q.x) = len(v.x)
        )
        select query_id, rank::int as rank, vec_id, score from (
            select *, row_number() over (partition by n order by score desc, vec_id) as rank from scored
        ) where rank <= 10
    """,
    "op12_hard_negatives": """
        with whole as (
            select row_number() over () as n, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                [floor(256 * c::double)::bigint for c in embedding] as x
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
                and len([c for c in embedding if c is not null and isfinite(c)]) = len(embedding)
        ), scored as (
            select q.n as anchor, q.vec_id as anchor_id, v.n as other, v.vec_id, q.label = v.label as same,
                coalesce(list_sum([q.x[i] * v.x[i] for i in range(1, len(q.x) + 1)]), 0)::bigint as score
            from whole q join whole v on q.vec_id % 100 = 0 and q.n <> v.n and len(q.x) = len(v.x)
        ), positives as (
            select anchor, anchor_id, other as positive, vec_id as positive_id, score as positive_score from scored
            where same qualify row_number() over (partition by anchor order by score desc, vec_id) <= 5
        )
        select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from (
            select p.anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
                row_number() over (partition by p.anchor, positive order by score desc, vec_id) as rank
            from positives p join scored s on p.anchor = s.anchor and not same
                and 80 * positive_score <= 100 * score and score <= positive_score
        ) where rank <= 5
    """,
    "op13_prefix_trie": """
        with steps as (
            select list(list_reduce([b] || range(8), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) order by b) as crc
            from range(256) t(b)
        ), turns as (
            select conv_id, turn, md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as k,
                len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as words
            from conversations where conv_id is not null
        ), own as (
            select conv_id, list({'k': k, 'words': words} order by turn nulls first, k) as turns,
                (xor(list_reduce([4294967295] || [ascii(c)::bigint for c in string_split(conv_id::varchar, '')],
                    lambda x, c: xor(x >> 8, crc[xor(x & 255, c) + 1])), 4294967295) % 4)::int as h
            from turns, steps group by conv_id, crc
        ), rebuilt as (
            select o.conv_id, coalesce(b.turns[1:o.h], []) || o.turns[o.h + 1:] as turns
            from own o left join own b on b.conv_id = o.conv_id - o.conv_id % 20
        ), paths as (
            select conv_id, d, len(turns) as length, md5(array_to_string([t.k for t in turns[1:d]], '')) as key,
                case when d > 0 then md5(array_to_string([t.k for t in turns[1:d - 1]], '')) end as parent,
                case when d > 0 then turns[d].words else 0 end as words
            from rebuilt, unnest(range(0, len(turns) + 1)) t(d)
        ), nodes as (
            select d, key, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words,
                sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where d = length), '')) as ends_sha256
            from paths group by d, key
        ), children as (
            select d - 1 as d, parent as key, count(*) as n_children from nodes where d > 0 group by all
        ), sums as (
            select a.d, a.key, count(*) filter (where c.n_children is null) as n_leaves, sum((n.n_convs - 1) * n.words) as saved_tokens
            from nodes n left join children c on n.d = c.d and n.key = c.key join paths a on a.conv_id = n.conv_id and a.d <= n.d
            group by a.d, a.key
        )
        select n.conv_id, n.d::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0)::bigint as n_children,
            s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, n.ends_sha256
        from nodes n join sums s using (d, key) left join children c using (d, key)
            left join nodes p on p.d = n.d - 1 and p.key = n.parent
    """,
}
