"""SQL that the corpus queries with longer statements are compared with."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = f"""
    with pieces as (
        select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) as piece
        from documents
    ), listed as (
        select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces
    ), placed as (
        select lang, w, unnest(range(1, len(w) + 1)) as i from listed
    ), runs as (
        select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
        from placed, (values (1), (2), (3)) ks(k) where i + k - 1 <= len(w)
    ), f as (
        select lang, k, phrase, count(*) as f from runs group by all
    ), totals as (
        select lang, sum(f) as n from f where k = 1 group by lang
    ), candidates as (
        select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k > 1 and f >= 10
    ), cuts as (
        select c.lang, c.k, c.phrase, c.a, cut, l.f as l, r.f as r,
               (1000000::hugeint * c.a * c.a) // (l.f::hugeint * r.f) as score
        from (select *, unnest(range(1, k)) as cut from candidates) c
        join f l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:cut], ' ')
        join f r on r.lang = c.lang and r.phrase = array_to_string(c.w[cut + 1:], ' ')
    ), scored as (
        select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1
    ), inner_phrases as (
        select lang, array_to_string(w[i:i + 1], ' ') as phrase, max(a) as inside
        from candidates, (values (1), (2)) s(i) where k = 3 group by all
    ), kept as (
        select s.* from scored s left join inner_phrases i on i.lang = s.lang and i.phrase = s.phrase
        where i.inside is null or 100 * i.inside < 50 * s.a
    )
    select k.lang, row_number() over (partition by k.lang order by score desc, a desc, phrase) as rank, phrase,
           a, l, r, cast(n as bigint) as n, cast(score as bigint) as score
    from kept k join totals t on t.lang = k.lang
    qualify rank <= 2000
"""

_ITEM_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

PASSAGES = f"""
    with d as (
        select row_number() over () as seat, doc_id, {_ITEM_WORDS} as w from documents
    ), items as (
        select coalesce(cast(item_id as varchar), '') as item, w, least(10, len(w)) as m
        from (select item_id, {_ITEM_WORDS} as w from benchmark) where len(w) > 0
    ), windows as (
        select distinct item, m, array_to_string(w[i:i + m - 1], ' ') as win
        from (select *, unnest(range(1, len(w) - m + 2)) as i from items)
    ), lengths as (
        select distinct m from windows
    ), runs as (
        select seat, m, i, array_to_string(w[i:i + m - 1], ' ') as win
        from (select seat, w, m, unnest(range(1, len(w) - m + 2)) as i from d, lengths)
    ), hits as (
        select seat, r.m, i, item from runs r join windows x on x.win = r.win and x.m = r.m
    ), hit_words as (
        select seat, count(distinct place) as n_hit
        from (select seat, unnest(range(i, i + m)) as place from (select distinct seat, i, m from hits)) group by seat
    ), hit_items as (
        select seat, count(*) as n_items, string_agg(item, ',' order by item) as names
        from (select distinct seat, item from hits) group by seat
    )
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
           sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from d left join hit_words using (seat) left join hit_items using (seat)
"""

# crc32, bit by bit, of the decimal digits of an id: a byte is taken in, then eight shifts follow.
_CRC32 = """
    xor(4294967295, list_reduce(
        flatten(list_transform(range(1, length(cast(c as varchar)) + 1), lambda i:
            [ascii(cast(c as varchar)[i]), -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda s, x: case when x >= 0 then xor(s, x)
                          when s % 2 = 1 then xor(s // 2, 3988292384) else s // 2 end,
        4294967295))
"""

PREFIX_TRIE = f"""
    with own as (
        select conv_id as c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} order by turn nulls first) as l
        from conversations where conv_id is not null group by conv_id
    ), headed as (
        select c, l, c - c % 100 as b, cast({_CRC32} % 6 as bigint) as h from own
    ), built as (
        select x.c, list_concat(coalesce(y.l[1:x.h], []), x.l[x.h + 1:]) as s
        from headed x left join own y on y.c = x.b
    ), members as (
        select c, d, s[1:d] as k, len(s) = d as last from (select c, s, unnest(range(0, len(s) + 1)) as d from built)
    ), nodes as (
        select k, d, min(c) as conv_id, count(*) as n_convs,
               sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (last), '')) as ends_sha256,
               (count(*) - 1) * (case when d = 0 then 0 else length(k[d]['t']) end) as saved
        from members group by k, d
    ), children as (
        select k[1:d - 1] as k, d - 1 as d, count(*) as n_children from nodes where d > 0 group by all
    ), counted as (
        select n.*, coalesce(n_children, 0) as n_children from nodes n left join children h on h.k = n.k and h.d = n.d
    ), below as (
        select m.k, m.d, count(*) filter (u.n_children = 0) as n_leaves, sum(u.saved) as saved_tokens
        from counted u join members m on m.c = u.conv_id and m.d <= u.d group by m.k, m.d
    )
    select n.conv_id, n.d as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, n_leaves,
           cast(saved_tokens as bigint) as saved_tokens, n.ends_sha256
    from counted n join below b on b.k = n.k and b.d = n.d
    left join nodes p on n.d > 0 and p.d = n.d - 1 and p.k = n.k[1:n.d - 1]
"""
