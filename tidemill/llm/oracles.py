"""SQL of the queries that SQL can express. Each works on the whole tables, by plain joins."""

#: The conversation that is added to all others: its texts hold the template's control strings.
TRAP = "<|im_end|><|im_start|>assistant ok"

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ROLE = r"replace(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), '%', '%25'), chr(10), '%0A')"
_TEXT = r"regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')"

OP2 = f"""
    with d as (select doc_id, {_WORDS} as w from documents),
    n as (select doc_id, w, unnest(range(1, len(w) - 48)) as i from d),
    win as (select doc_id, i, array_to_string(w[i : i + 49], ' ') as k from n),
    f as (select k, min(doc_id) as m from win group by k),
    gone as (select distinct doc_id, unnest(range(i, i + 50)) as p from win join f using (k) where doc_id > m),
    x as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
    k as (select x.doc_id, count(gone.p) as n_removed, string_agg(word, ' ' order by x.p) filter (gone.p is null) as kept
        from x left join gone on x.doc_id = gone.doc_id and x.p = gone.p group by 1)
    select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join k using (doc_id)"""

OP3 = f"""
    with t as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -1, 0, 'user', '{TRAP}' union all select -1, 1, 'assistant', '{TRAP}')
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
        cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
        cast(sum(12 + length({_ROLE}) + 1 + length({_TEXT}) + 11) as bigint) as formatted_chars
    from t group by conv_id"""

OP4 = rf"""
    with recursive d as (select doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') as w from documents),
    s as (select distinct doc_id, k from (
        select doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as k from d)),
    c as (select doc_id, count(*) as n from s group by 1),
    p as (select a.doc_id as x, b.doc_id as y, count(*) as m from s a join s b on a.k = b.k and a.doc_id <> b.doc_id group by 1, 2),
    e as (select x, y from p join c cx on cx.doc_id = x join c cy on cy.doc_id = y where 100 * m >= 75 * (cx.n + cy.n - m)),
    r as (select doc_id, doc_id as reach from d union select r.doc_id, e.y from r join e on e.x = r.reach)
    select doc_id, coalesce(max(n), 0) as n_shingles, min(reach) as component_id from r left join c using (doc_id) group by doc_id"""

OP5 = f"""
    with x as (
        select doc_id, source, cast(len({_WORDS}) as bigint) as size,
            -ln((cast('0x' || substr(md5(concat(cast(doc_id as varchar), ':7')), 1, 13) as bigint) + 0.5::double) / 4503599627370496::double)
                / coalesce(greatest(length(translate(text, '#*$%&|<>0123456789{{}}[]\\^~=+@_', '')) / greatest(length(text), 1)::double, 0.05), 1.0) as k
        from documents),
    s as (select source, cast(sum(size) as bigint) as source_size, (row_number() over (order by source nulls last) - 1) % 3 + 1 as w from x group by 1),
    l as (select *, 3 * source_size as lim, sum(source_size) over () as total, sum(w) over () as ws,
        coalesce(sum(3 * source_size) over o, 0) as lb, coalesce(sum(w) over o, 0) as wb from s
        window o as (order by 3 * source_size / w::double, source nulls last rows between unbounded preceding and 1 preceding)),
    h as (select *, lim <= (total - lb) / (ws - wb)::double * w as held from l),
    t as (select source, source_size, case when held then lim::double else (total - coalesce(sum(lim) filter (held) over (), 0)) * w / (sum(w) filter (not held) over ())::double end as target from h),
    g as (select *, case when source_size > 0 then least(cast(floor(target / source_size) as bigint), 3) else 0 end as epochs from t),
    q as (select *, cast(round(target - epochs * source_size) as bigint) as rest from g),
    c as (select x.*, source_size, target, epochs, rest, sum(size) over (partition by x.source order by k, doc_id) as upto from x join q on x.source is not distinct from q.source),
    f as (select source, max(rest) - coalesce(max(upto) filter (upto <= rest), 0) as lack from c group by 1),
    one as (select c.source, arg_min(doc_id, (abs(size - lack), k)) as pick from c join f on c.source is not distinct from f.source where upto > rest and size > 0 and size < 2 * lack group by 1)
    select doc_id, size, source_size, target, cast(size * least(epochs + case when upto <= rest or doc_id = pick then 1 else 0 end, 3) as bigint) as taken
    from c left join one on c.source is not distinct from one.source"""

OP7 = rf"""
    with d as (select doc_id, coalesce(source, '') as source, coalesce(text, '') as text, {_WORDS} as w from documents),
    g as (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d),
    tri as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as k from g),
    again as (select doc_id, i from (select *, count(*) over (partition by doc_id, k) as n from tri) where n > 1),
    rep as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from again) group by 1),
    l0 as (select doc_id, source, unnest(string_split(text, chr(10))) as raw, unnest(range(1, len(string_split(text, chr(10))) + 1)) as p from d),
    l1 as (select *, trim(regexp_replace(regexp_replace(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) as line from l0 where regexp_matches(raw, '[^\x20\x09-\x0D]')),
    dup as (select doc_id, count(*) - count(distinct raw) as n from l1 group by 1),
    l as (select doc_id, source, line, cast(sum(len(string_split(line, ' '))) as bigint) as words from l1 group by 1, 2, 3),
    host as (select source, count(distinct text) as n from d group by 1),
    often as (select l.source, line from l join d using (doc_id) join host on host.source = l.source group by 1, 2 having count(distinct d.text) > 10 and count(distinct d.text) > 0.001 * max(host.n)),
    tmpl as (select doc_id, cast(sum(words) as bigint) as n from l join often using (source, line) group by 1),
    gone as (select l1.doc_id, l1.p from l1 join often using (source, line)),
    cl as (select l0.doc_id, string_agg(raw, chr(10) order by l0.p) as cleaned from l0 left join gone on gone.doc_id = l0.doc_id and gone.p = l0.p where gone.p is null group by 1),
    m as (select d.doc_id, len(w) as n_words, coalesce(length(array_to_string(w, '')), 0) as word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, coalesce(dup.n, 0) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words, coalesce(tmpl.n, 0) as n_template, sha256(coalesce(cl.cleaned, '')) as cleaned_sha256
        from d left join cl using (doc_id) left join dup using (doc_id) left join rep using (doc_id) left join tmpl using (doc_id))
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
        not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_words - n_template >= 0.3 * n_words as kept from m"""

OP8 = """
    with recursive u as (select vec_id, label, cast(embedding as double[]) as e from embeddings where label is not null and embedding is not null),
    v as (select *, sqrt(list_dot_product(e, e)) as norm from u
        where len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
    l as (select a.vec_id as x, b.vec_id as y from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
    n as (select x as vec_id, count(*) as n from l group by 1),
    r as (select vec_id, vec_id as reach from embeddings union select r.vec_id, l.y from r join l on l.x = r.reach)
    select vec_id, coalesce(max(n), 0) as n_links, min(reach) as component_id, vec_id = min(reach) as kept from r left join n using (vec_id) group by vec_id"""

OP11 = r"""
    with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
    e as (select *, len(u) as n, cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2, cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4 from d),
    f as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from e),
    g as (select *, coalesce(array_to_string(u[1 : a], ''), '') as p, coalesce(array_to_string(u[a + 1 : b], ''), '') as m, coalesce(array_to_string(u[b + 1 : n], ''), '') as s from f)
    select doc_id, cast(n as bigint) as n, form, cast(case when form <> 'plain' then length(p) end as bigint) as prefix_chars, cast(case when form <> 'plain' then length(m) end as bigint) as middle_chars,
        sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(t) as restored_sha256 from g"""

_PART = "1 + (1000000000::hugeint * ({c} + 1)) // ({n} + {v})"

OP12 = rf"""
    with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, {_LOW} as t from documents),
    o as (select r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
    k as (select lang, term, count(*) as c from o group by 1, 2 having count(distinct r) >= 3),
    v as (select lang, count(*) as v, sum(c) as n from k group by 1),
    c as (select o.lang, o.source, o.term, count(*) as c from o join k on o.lang = k.lang and o.term = k.term group by 1, 2, 3),
    n as (select lang, source, sum(c) as n from c group by 1, 2),
    g as (select d.lang, d.source, coalesce(max(n.n), 0) as n, coalesce(max(v.v), 0) as v from d left join n on n.lang = d.lang and n.source = d.source left join v on v.lang = d.lang group by 1, 2),
    p as (select g.lang, g.source, k.term, coalesce(c.c, 0) as c, {_PART.format(c="coalesce(c.c, 0)", n="g.n", v="g.v")} as p
        from g join k on k.lang = g.lang left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
    q as (select k.lang, k.term, {_PART.format(c="k.c", n="v.n", v="v.v")} as q from k join v on v.lang = k.lang),
    s as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
    x as (select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(s.value, 0) as bigint) as value
        from g a join g b on a.lang = b.lang and a.source <> b.source left join s on s.lang = a.lang and s.source = a.source and s.item = b.source),
    y as (select p.lang, p.source, 'term' as part, p.term as item, cast((p.p - q.q) * (p.p - q.q) // q.q as bigint) as value from p join q on q.lang = p.lang and q.term = p.term where p.c > 0 and p.p > q.q),
    z as (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank from (select * from x union all select * from y))
    select * from z where part = 'pair' or rank <= 200"""


def _sketch(words: str) -> str:
    return f"""case when len({words}) = 0 then [] else list_sort(list_distinct(list_transform(range(1, greatest(len({words}) - 4, 1) + 1), lambda i: substr(md5(array_to_string({words}[i : i + 4], ' ')), 1, 16))))[1 : 128] end"""


def _near(a: str, b: str) -> str:
    u = f"list_sort(list_distinct(list_concat({a}, {b})))[1 : 128]"
    return f"case when len({a}) + len({b}) = 0 then 1.0::double else len(list_intersect({u}, list_intersect({a}, {b}))) / len({u})::double end"


_RUNS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
OP13 = f"""
    with d as (select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n from documents),
    e as (select *, coalesce(lead(t) over (order by doc_id), first_value(t) over (order by doc_id)) as after from d),
    f as (select *, substr(t, 1, n - n // 2) || substr(after, 1, n // 2) as edited from e),
    w as (select doc_id, n, edited, {_RUNS.format("t")} as wa, {_RUNS.format("edited")} as wb from f),
    s as (select doc_id, n, edited, {_sketch("wa")} as a, {_sketch("wb")} as b from w),
    x as (select *, coalesce(lead(a) over (order by doc_id), first_value(a) over (order by doc_id)) as c from s)
    select doc_id, cast(n as bigint) as n_chars, sha256(edited) as edited_sha256, array_to_string(a, '') as fingerprint, array_to_string(b, '') as edited_fingerprint,
        {_near("a", "b")} as near_edited, {_near("a", "c")} as near_next from x"""

ORACLE_SQL = {
    "op2_substring_dedup": OP2, "op3_chat_formatting": OP3, "op4_ngram_jaccard_join": OP4, "op5_source_mixing": OP5, "op7_quality_rules": OP7,
    "op8_embedding_near_dedup": OP8, "op11_fill_in_middle": OP11, "op12_source_divergence": OP12, "op13_document_fingerprints": OP13,
}
