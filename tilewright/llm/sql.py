"""DuckDB SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

from tilewright.llm import divergence, hash_tree, quality, queries, url_filters, vector_codes


def _rules_sql() -> str:
    rows = []
    for say, text in queries.URL_RULES:
        name, slash, prefix = text.partition("/")
        rows.append(f"('{say}', '{text}', '{name}', '{slash + prefix}')")
    return ", ".join(rows)


def _op1() -> str:
    p = url_filters.Reputation()
    low, high = p.strength

    def strength(children: str) -> str:
        return f"""(select least({high}, greatest({low}, coalesce(case when weight > 0 and (spread - noise) / weight > 0 then binomial / ((spread - noise) / weight) - 1 else {high} end, {high}))) as k from (
            select sum(n * (bad / n - pb / pn) * (bad / n - pb / pn)) as spread, sum((1 - n / pn) * (pb / pn) * (1 - pb / pn)) as noise,
                   sum(n * (1 - n / pn)) as weight, sum(n * (pb / pn) * (1 - pb / pn)) / sum(n) as binomial
            from ({children}) where n > 0))"""

    return f"""
    with parts as (
        select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
    ), cut as (
        select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts
    ), outcome as (
        select doc_id as key, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad from labels where doc_id is not null group by 1
    ), hosts as (
        select host, count(o.bad)::double as n, coalesce(sum(o.bad), 0)::double as bad
        from cut left join outcome o on o.key = try_cast(nullif(regexp_extract(path, '^/[^/]+/([0-9]+)', 1), '') as bigint) group by 1
    ), base as (
        select *, case when regexp_matches(h, '{url_filters.ADDRESS}') then h when regexp_matches(h, '{url_filters.LONG_SUFFIX}') then regexp_extract(h, '{url_filters.LONG_SUFFIX}')
                       when len(string_split(h, '.')) > 2 then array_to_string(string_split(h, '.')[-2:], '.') else h end as domain
        from (select *, regexp_replace(regexp_replace(host, '^.*@', ''), '\\.*(:[0-9]*)?\\z', '') as h from hosts)
    ), based as (
        select host, n, bad, domain, case when regexp_matches(domain, '{url_filters.ADDRESS}') then 'ip' when instr(domain, '.') > 0 then regexp_extract(domain, '\\.(.*)', 1) else domain end as suffix from base
    ), domains as (select suffix, domain, sum(n) as n, sum(bad) as bad from based group by all),
    suffixes as (select suffix, sum(n) as n, sum(bad) as bad from domains group by all),
    every as (select coalesce(sum(n), 0) as n, coalesce(sum(bad), 0) as bad from based),
    total as (select (bad + 0.5) / (n + 1) as top from every),
    ks as {strength("select s.*, t.n as pn, t.bad as pb from suffixes s, every t")},
    kd as {strength("select d.*, s.n as pn, s.bad as pb from domains d join suffixes s using (suffix)")},
    kh as {strength("select b.*, d.n as pn, d.bad as pb from based b join domains d using (domain)")},
    rate_s as (select suffix, (s.bad + k * t.top) / (s.n + k) as r from suffixes s, total t, ks),
    rate_d as (select domain, (bad + k * r) / (n + k) as r from domains join rate_s using (suffix), kd),
    shrunk as (select host, bad + k * r as a, n - bad + k * (1 - r) as b from based join rate_d using (domain), kh),
    blocked as (select host, a / (a + b) - {p.z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > {p.odds} * top / (1 - top + {p.odds} * top) as blocked from shrunk, total),
    rules(say, rule, name, prefix) as (values {_rules_sql()}),
    hit as (
        select page_id, max_by(struct_pack(rule, say), length(rule)) as best
        from cut join rules on (host = name or ends_with(host, '.' || name)) and starts_with(path, prefix) group by 1
    )
    select page_id, host, path, best.rule as rule, coalesce(best.say, case when blocked then 'block' else 'allow' end) as verdict
    from cut left join hit using (page_id) left join blocked using (host)
    """


def _op4() -> str:
    def tree(t: hash_tree.HashTree, name: str) -> str:
        rows = ", ".join(f"({level}, {i}, '{child}', {weight}, {after})" for level, nodes in enumerate(t.levels()) for i, own in enumerate(nodes) for child, weight, after in own)
        draw = f"-ln((('0x' || substr(md5('0|' || name || '|' || key), 1, 13))::bigint::double + 0.5) / {float(1 << 52)}) / weight"
        steps = f"{name}_nodes(level, node, name, weight, after) as (values {rows}), {name}_0 as (select distinct key, 0 as node from sized)"
        for level in range(3):
            steps += f", {name}_{level + 1} as (select key, arg_min(after, {draw}) as node from {name}_{level} join {name}_nodes using (node) where level = {level} group by key)"
        return steps

    now = hash_tree.HashTree.uniform(queries.SHARDS)
    return f"""
    with crc as (
        select list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end, n)) as t
    ), octets as (
        select doc_id, coalesce(doc_id::varchar, 'null') as key, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::bigint) as b from documents
    ), sized as (
        select doc_id, key, (len(b) + 1)::bigint as size, xor(list_reduce(b, lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295), 4294967295)::bigint as text_crc32 from octets, crc
    ), {tree(now, "now")}, {tree(now.grown(), "more")}
    select doc_id, size, text_crc32, 'key' as law, n.node::int as shard, m.node::int as grown_shard,
           row_number() over (partition by n.node order by ('0x' || substr(md5(key || '|' || size || '|' || text_crc32), 1, 3))::int, doc_id nulls first, size, text_crc32) - 1 as slot
    from sized join now_3 n using (key) join more_3 m using (key)
    """


_OP5 = r"""
with sized as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size from documents
), sizes as (
    select source, sum(size)::bigint as source_size from sized group by 1
), weighed as (
    select source, source_size, source_size * 3 as cap, 1 + (row_number() over (order by source is null, source) - 1) % 3 as w from sizes
), run as (
    select *, sum(source_size) over () - coalesce(sum(cap) over (order by cap / w, source is null, source rows between unbounded preceding and 1 preceding), 0) as remaining,
           sum(w) over () - coalesce(sum(w) over (order by cap / w, source is null, source rows between unbounded preceding and 1 preceding), 0) as heavy
    from weighed
), level as (
    select arg_min(remaining, (cap / w, source is null, coalesce(source, ''))) as remaining, arg_min(heavy, (cap / w, source is null, coalesce(source, ''))) as heavy
    from run where cap * heavy > remaining * w
), targets as (
    select r.source, source_size, coalesce(case when cap * r.heavy <= r.remaining * w then cap::double else (l.remaining * w)::double / l.heavy end, 0.0)::double as target
    from run r, level l
), counted as (
    select *, case when size > 0 then length(bin(size)) else 0 end as measure, row_number() over (partition by source, doc_id, size) - 1 as nth from sized
), classes as (
    select c.source, measure, sum(size)::bigint as words, any_value(target) as target from counted c join targets t on c.source is not distinct from t.source group by c.source, measure
), scaled as (
    select *, (target - (3 * coalesce(sum(words) over (partition by source order by measure desc rows between unbounded preceding and 1 preceding), 0))::double)
              / sum(measure * words) over (partition by source order by measure rows between unbounded preceding and current row)::double as c
    from classes where words > 0
), solved as (
    select source, measure, words, target, greatest(least(arg_max(c, measure) filter (c * measure <= 3) over (partition by source) * measure, 3.0), 0.0) as fits from scaled
), wanted as (
    select source, measure, words, target, coalesce(fits, 3.0) as copies, floor(coalesce(fits, 3.0))::bigint as whole from solved
), planned as (
    select source, measure, whole, copies - whole as rate, target - (sum(whole * words) over (partition by source))::double as rest from wanted
), ranked as (
    select c.doc_id, c.size, c.source, c.nth, source_size, t.target, coalesce(whole, 0) as whole, rest, rate,
           (('0x' || substr(md5('mix|' || coalesce(c.doc_id::varchar, 'null') || '|' || c.size || '|' || c.nth), 1, 13))::bigint::double + 0.5) / 4503599627370496.0 as u
    from counted c join targets t on c.source is not distinct from t.source left join planned p on c.source is not distinct from p.source and c.measure = p.measure
), ordered as (
    select *, case when rate > 0 and size > 0 then (u / (1 - u)) / (rate / (1 - rate)) end as q from ranked
), summed as (
    select *, sum(size) over (partition by source, q is null order by q, doc_id nulls last, size, nth rows between unbounded preceding and current row) as upto from ordered
)
select doc_id, size, source_size, target, (size * (whole + case when q is not null and 2 * upto - size <= 2 * rest then 1 else 0 end))::bigint as taken from summed
"""


_OP6 = """
with usable as (
    select vec_id, embedding from embeddings
    where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), whole as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from usable
), scored as (
    select a.vec_id as query_id, b.vec_id, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::bigint as score
    from whole a join whole b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where a.vec_id % 20 = 0
), ranked as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from scored)
select * from ranked where rank <= 20
"""


def _op10() -> str:
    r = quality.Rules()
    value = {f: f"({scale} * {over}) // n_words" for f, (over, scale) in quality.FEATURES.items()}
    rows = " union all ".join(f"select lang, source, '{f}' as feature, {v} as value, {r.slack[f]} as slack from based where not base_failed" for f, v in value.items())
    within = " and ".join(f"{v} <= max(most) filter (feature = '{f}')" for f, v in value.items())
    return rf"""
    with split as (
        select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
    ), windows as (
        select rid, i, array_to_string(words[i : i + {r.window - 1}], ' ') as w from (select rid, words, unnest(range(1, len(words) - {r.window - 2})) as i from split where len(words) >= {r.window})
    ), often as (select rid, w from windows group by all having count(*) > 1),
    repeated as (select rid, count(distinct i + o) as n from windows join often using (rid, w), range({r.window}) t(o) group by rid),
    lines as (select rid, unnest(string_split(text, chr(10))) as line from split),
    dup as (select rid, count(*) - count(distinct line) as n from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by rid),
    counted as (
        select rid, doc_id, lang, source, len(words)::bigint as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
               (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols, coalesce(dup.n, 0)::bigint as n_dup_lines, coalesce(repeated.n, 0)::bigint as n_repeat_words
        from split left join dup using (rid) left join repeated using (rid)
    ), based as (select *, n_words < {r.min_words} or 100 * n_repeat_words > {r.max_repeat} * n_words as base_failed from counted),
    featured as ({rows}),
    sketch as (
        select lang, source, feature, slack, case when value < 64 then value else (value >> (length(bin(value)) - 6)) << (length(bin(value)) - 6) end as bucket, count(*) as n from featured group by all
    ), ranked as (
        select *, sum(n) over (partition by lang, source, feature order by bucket) as upto, sum(n) over (partition by lang, source, feature) as whole from sketch
    ), quartiles as (
        select lang, source, feature, slack, min(bucket) filter (4 * upto >= whole) as q1, min(bucket) filter (4 * upto >= 3 * whole) as q3 from ranked group by all
    ), merged as (select lang, feature, bucket, sum(n) as n from sketch group by all),
    pooled as (
        select *, sum(n) over (partition by lang, feature order by bucket) as upto, sum(n) over (partition by lang, feature) as whole from merged
    ), tails as (
        select lang, feature, min(bucket) filter (100 * upto >= {r.tail} * whole) as low, min(bucket) filter (100 * upto >= {100 - r.tail} * whole) as high
        from pooled group by all
    ), fences as (
        select q.lang, source, q.feature, slack, greatest(q1 - {r.reach} * (q3 - q1), low) as below, least(q3 + {r.reach} * (q3 - q1), high) as above
        from quartiles q join tails t on q.lang is not distinct from t.lang and q.feature = t.feature
    ), excess as (
        select f.lang, f.source, f.feature, any_value(below) as below, any_value(above) as above, any_value(f.slack) as slack, sum(n) as n,
               sum(n * greatest(0, least(f.slack, bucket - above))) as more, sum(n * greatest(0, least(f.slack, below - bucket))) as less
        from sketch s join fences f on s.lang is not distinct from f.lang and s.source is not distinct from f.source and s.feature = f.feature group by all
    ), limits as (
        select lang, source, feature, below - slack // 2 - (2 * (less * sum(n) over w + {r.prior} * sum(less) over w)) // ((n + {r.prior}) * sum(n) over w) as least,
               above + slack // 2 + (2 * (more * sum(n) over w + {r.prior} * sum(more) over w)) // ((n + {r.prior}) * sum(n) over w) as most
        from excess window w as (partition by lang, feature)
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from (
        select b.rid, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               not base_failed and coalesce({within} and {value['word_size']} >= max(least) filter (feature = 'word_size'), true) as kept
        from based b left join limits l on b.lang is not distinct from l.lang and b.source is not distinct from l.source
        group by b.rid, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed
    )
    """


def _op12() -> str:
    c = vector_codes.Codes()

    def assigned(n: int) -> str:
        """Nearest entries: distances are whole numbers below 2**53, so doubles hold them."""
        far = "((xx - 2 * list_inner_product(parts.x, e.x) + list_inner_product(e.x, e.x))::hugeint * 65536 + e.entry)"
        return f"""a{n} as materialized (
            select vec_id, label, part, x, (best % 65536)::int as entry, best // 65536 as error
            from (select vec_id, label, part, any_value(parts.x) as x, min({far}) as best from parts join b{n} e using (part) group by row, vec_id, label, part))"""

    rounds = ", ".join(
        f"""{assigned(n)}, s{n} as (
            select part, entry, list(mean order by i) as x from (select part, entry, i, floor(sum(x[i + 1]::hugeint)::double / count(*)) as mean from a{n}, range(16) r(i) group by all) group by all
        ), b{n + 1} as materialized (select part, entry, coalesce(s.x, b.x) as x from b{n} b left join s{n} s using (part, entry))"""
        for n in range(c.rounds)
    )
    return f"""
    with kept as (
        select row_number() over (order by vec_id nulls last) - 1 as row, vec_id, label, list_transform(embedding, lambda x: floor({c.scale} * x::double)) as v
        from embeddings where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), cut as (select row, vec_id, label, p as part, v[p * len(v) // {c.parts} + 1 : (p + 1) * len(v) // {c.parts}] as x from kept, range({c.parts}) t(p)),
    parts as materialized (select *, list_inner_product(x, x) as xx from cut),
    b0 as materialized (select part, row::int as entry, x from parts where row < {c.entries}), {rounds}, {assigned(c.rounds)},
    books as (select sha256(string_agg(array_to_string(list_transform(x, lambda y: y::bigint), ','), ',' order by part, entry)) as codebooks_sha256 from b{c.rounds}),
    coded as (select vec_id, any_value(label) as label, string_agg(printf('%02x', entry), '' order by part) as code, sum(error) as error from a{c.rounds} group by vec_id)
    select vec_id, code, error::bigint as error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from coded, books
    """


def _op13() -> str:
    a = divergence.Audit()
    p = f"1 + ({a.unit}::hugeint * (n + {a.prior})) // (total + {a.prior} * v)"
    return rf"""
    with rows as (
        select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents
    ), occurs as (select row, lang, source, unnest(terms) as term from rows),
    kept as materialized (select lang, term from occurs group by all having count(distinct row) >= {a.min_documents}),
    counts as materialized (select lang, source, term, count(*)::hugeint as n from occurs join kept using (lang, term) group by all),
    groups as materialized (select distinct lang, source from rows),
    sizes as (select lang, count(*)::hugeint as v from kept group by 1),
    own as materialized (
        select g.lang, g.source, k.term, coalesce(c.n, 0) as n, sum(coalesce(c.n, 0)) over (partition by g.lang, g.source) as total, v
        from groups g join kept k using (lang) join sizes using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
    ), p as materialized (select lang, source, term, n, {p} as p from own),
    q as (select lang, term, {p} as q from (select lang, term, sum(n) as n, sum(sum(n)) over (partition by lang) as total, any_value(v) as v from own group by lang, term)),
    pairs as (
        select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
        from groups a join groups b on a.lang = b.lang and a.source <> b.source
        left join (select a.lang, a.source as s, b.source as o, sum(abs(a.p - b.p)) as value from p a join p b on a.lang = b.lang and a.term = b.term group by all) f on f.lang = a.lang and s = a.source and o = b.source
    ), terms as (select lang, source, 'term' as part, term as item, p - q as value from p join q using (lang, term) where n > 0 and p > q),
    ranked as (
        select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from (select * from pairs union all select * from terms)
    )
    select lang, source, part, item, value::bigint as value, rank::int as rank from ranked where part = 'pair' or rank <= {a.top}
    """


def oracle_sql() -> dict[str, str]:
    return {"op1_url_reputation": _op1(), "op4_hash_tree_shards": _op4(), "op5_pareto_mix": _OP5, "op6_bit_sliced_topk": _OP6, "op10_adaptive_quality": _op10(), "op12_delta_lloyd": _op12(), "op13_source_divergence": _op13()}
