"""SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP7 = f"""
with doc_words as (
    select doc_id, row_number() over () as row_id,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') as words
    from documents
), item_words as (
    select item_id, regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{WORD}') as words
    from benchmark where text is not null and item_id is not null
), item_windows as (
    select distinct item_id, least(10, len(words)) as size,
           array_to_string(words[i : i + least(10, len(words)) - 1], ' ') as run
    from (select *, unnest(range(1, len(words) - least(10, len(words)) + 2)) as i from item_words where len(words) > 0)
), doc_windows as (
    select row_id, i, size, array_to_string(words[i : i + size - 1], ' ') as run
    from (select d.*, s.size, unnest(range(1, len(words) - s.size + 2)) as i
          from doc_words d, (select distinct size from item_windows) s where len(words) >= s.size)
), found as (
    select d.row_id, d.i, d.size, w.item_id from doc_windows d join item_windows w using (size, run)
), hits as (
    select row_id, count(distinct p) as n_hit
    from (select row_id, unnest(range(i, i + size)) as p from found) group by row_id
), owners as (
    select row_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct row_id, item_id::varchar as item_id from found) group by row_id
)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit,
       coalesce(o.n_items, 0)::bigint as n_items, sha256(coalesce(o.ids, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 as contaminated
from doc_words d left join hits h using (row_id) left join owners o using (row_id)
"""

#: Stated anew here, sorted: the function words that the histogram counts.
COMMON = sorted(
    set(
        "the of and to in a is that for on with as it was be by "
        "le la de et les des en un du que qui dans pour par sur au "
        "der die und in den von zu das mit sich des auf ist dem nicht "
        "de la que el en y a los se del las un por con una".split()
    )
)
_SHARE = "list_transform({0}, lambda x: x / list_sum({0}))"
_COUNTS = ", ".join(f"len(list_filter(words, lambda w: w = '{w}'))" for w in COMMON)
_ANY_COMMON = "[" + ", ".join(f"'{w}'" for w in COMMON) + "]"


def _part(p: str) -> str:
    return f"case when {p} > 0 then {p} * log2({p} / ((s.p + s.q) / 2)) else 0.0 end"


def _js(counts: str, reference: str) -> str:
    shares = f"list_transform(range(1, len({counts}) + 1), lambda k: {{'p': {counts}[k] / list_sum({counts}), 'q': {reference}[k] / list_sum({reference})}})"
    return f"sqrt(greatest(0.0, list_sum(list_transform({shares}, lambda s: {_part('s.p')} + {_part('s.q')})) / 2))"


OP1 = rf"""
with texts as (
    select doc_id, lang, row_number() over () as row_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
    from documents
), counted as (
    select *, len(words)::bigint as n_words,
        coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::bigint as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
        (len(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))
         - len(list_distinct(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))))::bigint as n_dup_lines,
        [length(regexp_replace(text, '[^a-z]', '', 'g')),
         length(text) - length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')),
         length(regexp_replace(text, '[^A-Z]', '', 'g')),
         length(regexp_replace(text, '[^0-9]', '', 'g')),
         length(regexp_replace(text, '[^.,;:!?''"()\-]', '', 'g')),
         length(regexp_replace(text, '[a-zA-Z0-9\x20\x09-\x0D.,;:!?''"()\-]|[^\x00-\x7F]', '', 'g')),
         length(regexp_replace(text, '[\x00-\x7F]', '', 'g'))] as chars,
        [{_COUNTS}, len(list_filter(words, lambda w: not list_contains({_ANY_COMMON}, w)))] as common
    from texts
), runs as (
    select row_id, i, array_to_string(words[i : i + 7], ' ') as run
    from (select row_id, words, unnest(range(1, len(words) - 6)) as i from texts where len(words) > 8)
), twice as (
    select row_id, i from (select *, count(*) over (partition by row_id, run) as n from runs) where n > 1
), repeated as (
    select row_id, count(distinct p) as n from (select row_id, unnest(range(i, i + 8)) as p from twice) group by row_id
), base as (
    select c.*, coalesce(r.n, 0)::bigint as n_repeat_words,
           c.n_words < 20 or 100 * coalesce(r.n, 0) > 30 * c.n_words as base_failed
    from counted c left join repeated r using (row_id)
), sound as (
    select * from base where lang is not null and not base_failed
), sizes as (
    select lang, count(*) >= 20 as counts from sound group by lang having sum(n_words) >= 100
), refs as (
    select lang, list(s order by k) as words
    from (select lang, k, sum(common[k]) as s from (select lang, common, unnest(range(1, len(common) + 1)) as k from sound) group by lang, k) group by lang
), char_refs as (
    select lang, list(s order by k) as chars
    from (select lang, k, sum(chars[k]) as s from (select lang, chars, unnest(range(1, 8)) as k from sound) group by lang, k) group by lang
), distances as (
    select c.row_id, c.word_chars, c.n_words, c.lang as own, r.lang, s.counts, (select bool_or(counts) from sizes) as any_counts,
           {_js("c.chars", "h.chars")} as by_char, {_js("c.common", "r.words")} as by_word
    from counted c, refs r join char_refs h using (lang) join sizes s using (lang) where c.n_words > 0
), verdicts as (
    select row_id, bool_or(near_char and near_word and (counts or not any_counts))
               or (any_value(own) is not null and not bool_or(counts and lang is not distinct from own) and bool_or(near_char and counts)) as near,
           min(by_char + by_word) as least
    from (select *, word_chars < 400 or by_char <= 0.25 as near_char, n_words < 100 or by_word <= 0.3 as near_word from distances) group by row_id
), nearest as (
    select d.row_id, arg_min(d.by_char, d.lang) as by_char, arg_min(d.by_word, d.lang) as by_word
    from distances d join verdicts v on d.row_id = v.row_id and d.by_char + d.by_word = v.least group by d.row_id
)
select b.doc_id, b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, b.n_repeat_words, b.base_failed,
       not b.base_failed and coalesce(v.near, true) as kept,
       round(n.by_char, 6) as char_distance, round(n.by_word, 6) as word_distance
from base b left join verdicts v using (row_id) left join nearest n using (row_id)
"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

OP3 = f"""
with payloads as (
    select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hex from pages
), coded as (
    select page_id, payload, hex, array_to_string(list_transform(range(8), lambda k:
        array_to_string(list_transform([15, 10, 5, 0], lambda shift:
            substr('{_BASE32}', ((('0x' || substr(hex, 5 * k + 1, 5))::int >> shift) & 31)::int + 1, 1)), '')), '') as digest
    from payloads
), firsts as (
    select payload, min(page_id) as first from payloads group by payload having count(*) > 1
)
select c.page_id, strlen(c.payload)::bigint as payload_bytes, c.digest as payload_digest,
       case when f.first is not null and c.page_id is distinct from f.first then 'revisit' else 'response' end as record_type,
       case when c.page_id is distinct from f.first then f.first end as refers_to
from coded c left join firsts f using (payload)
"""

OP11 = rf"""
with pieces as (
    select coalesce(lang, 'und') as lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), words as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), totals as (
    select lang, sum(len(w))::bigint as n from words group by lang
), phrases as (
    select lang, k, array_to_string(w[i : i + k - 1], ' ') as phrase, count(*)::hugeint as f
    from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from words, (select unnest([1, 2, 3]) as k) where len(w) >= k)
    group by lang, k, phrase
), candidates as (
    select lang, k as size, phrase, string_split(phrase, ' ') as w, f as a from phrases where k > 1 and f >= 10
), cuts as (
    select c.*, x.f as l, y.f as r, 1000000::hugeint * a * a // (x.f * y.f) as score
    from (select lang, size, phrase, w, a, unnest(range(1, size)) as c_k from candidates) c
    join phrases x on x.lang = c.lang and x.phrase = array_to_string(w[1 : c_k], ' ')
    join phrases y on y.lang = c.lang and y.phrase = array_to_string(w[c_k + 1 :], ' ')
), scored as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, c_k) = 1
), covered as (
    select lang, phrase, max(a) as longer
    from (select lang, a, array_to_string(w[i : i + 1], ' ') as phrase from candidates, (select unnest([1, 2]) as i) where size = 3)
    group by lang, phrase
)
select s.lang, row_number() over (partition by s.lang order by score desc, a desc, s.phrase)::bigint as rank,
       s.phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score
from scored s left join covered c using (lang, phrase) join totals using (lang)
where s.size = 3 or c.longer is null or 100 * c.longer < 50 * a
qualify rank <= 2000
"""

OP12 = r"""
with texts as (
    select doc_id, row_number() over () as row_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
    select row_id, doc_id, i, array_to_string(w[i : i + 49], ' ') as run
    from (select *, unnest(range(1, len(w) - 48)) as i from texts where len(w) >= 50)
), firsts as (
    select run, min(doc_id) as first from windows group by run
), gone as (
    select distinct row_id, p from (
        select row_id, unnest(range(i, i + 50)) as p from windows join firsts using (run) where first < doc_id
    )
), removed as (
    select row_id, count(*)::bigint as n from gone group by row_id
), kept as (
    select row_id, string_agg(word, ' ' order by p) as rest
    from (select row_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from texts) anti join gone using (row_id, p)
    group by row_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(rest, '')) as kept_sha256
from texts left join removed using (row_id) left join kept using (row_id)
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP13 = f"""
with held as (
    select * from (
        select doc_id, row_number() over () as row_id,
               regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{TERM}') as terms
        from documents where text is not null
    ) where len(terms) > 0
), totals as (
    select count(*)::bigint as all_docs, sum(len(terms))::bigint as all_terms from held
), items as (
    select item_id, row_number() over () as item_row, regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{TERM}') as terms
    from benchmark where text is not null
), wanted as (
    select distinct item_row, unnest(terms) as term from items
), postings as (
    select row_id, term, count(*)::bigint as tf
    from (select row_id, unnest(terms) as term from held) where term in (select term from wanted)
    group by row_id, term
), weights as (
    select term, floor(1000 * ln((2 * any_value(all_docs) + 2) / (2 * count(*) + 1)))::bigint as w
    from postings, totals group by term
), factors as (
    select row_id, doc_id, 100 - 90 + (90 * len(terms) * all_docs) // all_terms as m from held, totals
), scores as (
    select item_row, row_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
    from wanted join postings using (term) join weights using (term) join factors using (row_id)
    group by item_row, row_id
)
select item_id, row_number() over (partition by item_row order by score desc, doc_id)::int as rank, doc_id, score
from scores join factors using (row_id) join items using (item_row)
where score > 0
qualify rank <= 10
"""

EXPECTED_SQL: dict[str, str] = {
    "op1_quality": OP1,
    "op3_warc": OP3,
    "op7_decontaminate": OP7,
    "op11_collocations": OP11,
    "op12_span_dedup": OP12,
    "op13_search": OP13,
}
