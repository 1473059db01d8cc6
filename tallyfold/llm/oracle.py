"""DuckDB SQL with the rows of the queries that SQL can express."""

from __future__ import annotations

from tallyfold.llm.mixing import DOMAINS, PATH, WEIGHTS
from tallyfold.llm.quality_rules import REFERENCES
from tallyfold.llm.url_filters import LOWER, RULES, UPPER, VARIABLE

_WS = "[\\x20\\x09-\\x0D]"
_WORD = "[^\\x20\\x09-\\x0D]+"


def _reference_rows() -> str:
    rows = []
    for lang, ref in REFERENCES.items():
        words = ref["words"]
        shares = [*words.values(), 1000 - sum(words.values())]
        rows.append(
            "('{}', {}::double[], {}::varchar[], {}::double[])".format(
                lang,
                [float(x) for x in ref["chars"]],
                list(words),
                [float(x) for x in shares],
            )
        )
    return ", ".join(rows)


def _js(p: str, q: str) -> str:
    """Jensen-Shannon distance of two list expressions, the first perhaps all zero."""
    share = "(case when list_sum({0}) > 0 then list_transform({0}, lambda v: v / list_sum({0})) else list_transform({0}, lambda v: 0.0) end)"
    a, b = share.format(p), share.format(q)
    part = "(case when {0} > 0 then {0} * log2({0} / ((z[1] + z[2]) / 2)) else 0 end)"
    both = f"list_transform(list_zip({a}, {b}), lambda z: {part.format('z[1]')} / 2 + {part.format('z[2]')} / 2)"
    return f"sqrt(greatest(list_sum({both}), 0))"


OP1 = f"""
with refs(lang, chars, words, shares) as (values {_reference_rows()}),
d as (
  select row_number() over () as row_id, doc_id, lang, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') as w
  from documents
),
n as (
  select *, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) as lines,
         regexp_replace(t, '[\\p{{L}}\\x20\\x09-\\x0D]+', '', 'g') as rest,
         length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g')) as upper
  from d
),
wins as (
  select row_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select row_id, w, unnest(range(1, n_words - 1)) as i from n)
),
marked as (
  select row_id, unnest([i, i + 1, i + 2]) as k
  from (select *, count(*) over (partition by row_id, g) as c from wins) where c > 1
),
covered as (select row_id, count(distinct k) as n_repeat_words from marked group by 1),
c as (
  select n.*, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         length(rest) - length(regexp_replace(rest, '[0-9]+', '', 'g')) as digit,
         length(rest) - length(regexp_replace(rest, '[.,;:!?''"()\\[\\]{{}}¿¡«»„“”‘’…\\-–—/]+', '', 'g')) as punct
  from n left join covered using (row_id)
),
h as (
  select *, [upper, word_chars - length(rest) - upper, digit, length(t) - word_chars, punct, n_symbols,
             length(rest) - digit - punct - n_symbols]::double[] as chars
  from c
),
counted as (
  select h.*, refs.chars as ref_chars, refs.shares,
         list_transform(refs.words, lambda x: len(list_filter(h.w, lambda y: y = x)))::double[] as met
  from h join refs on h.lang = refs.lang or h.lang is null or h.lang not in (select lang from refs)
),
far as (
  select row_id, min({_js('chars', 'ref_chars')}) as cd,
         min({_js('list_concat(met, [n_words - coalesce(list_sum(met), 0)]::double[])', 'shares')}) as wd
  from counted group by 1
),
g as (
  select h.*, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         case when length(t) >= 200 then cd else 0 end as cd,
         case when n_words >= 100 then wd else 0 end as wd
  from h join far using (row_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not (cd > 0.30 or wd > 0.38 or (cd > 0.15 and wd > 0.30)) as kept
from g
"""

def _mix_level(level: int, above: str) -> str:
    """Shares of one level of the tree, as ``l<level>``."""
    path = PATH[: level + 1]
    cols, parent = ", ".join(path), ", ".join(PATH[:level])
    weight = " ".join(
        f"when {' and '.join(f'n.{c} = {v!r}' for c, v in zip(PATH, p, strict=False))} then {w}"
        for p, w in WEIGHTS.items()
        if len(p) == level + 1
    )
    weight = f"case {weight} else 1 end" if weight else "1"
    on = " and ".join(f"n.{c} is not distinct from a.{c}" for c in PATH[:level]) or "true"
    part = f"partition by {parent}" if parent else ""
    order = f"{part} order by supply / weight, {path[-1]} nulls first rows between unbounded preceding and 1 preceding"
    return f"""
n{level} as (
  select n.*, a.budget, {weight}::hugeint as weight
  from (select {cols}, sum(tokens * 2)::hugeint as supply from leaves group by {cols}) n join {above} a on {on}
),
w{level} as (
  select *, coalesce(sum(supply) over ({order}), 0)::hugeint as used,
         (sum(weight) over ({part}) - coalesce(sum(weight) over ({order}), 0))::hugeint as ws
  from n{level}
),
s{level} as (select *, supply * ws <= weight * (budget - used) as short from w{level}),
l{level} as (
  select {cols}, case when short then supply else
    (weight * (budget - coalesce(sum(supply) filter (short) over ({part}), 0)::hugeint))
    // coalesce(sum(weight) filter (not short) over ({part}), 0)::hugeint end as budget
  from s{level}
)"""


_DOMAIN = " ".join(
    f"when source in ({', '.join(repr(s) for s, d in DOMAINS.items() if d == domain)}) then '{domain}'"
    for domain in sorted(set(DOMAINS.values()))
)
OP4 = f"""
with d as (
  select row_number() over () as row_id, doc_id, case {_DOMAIN} else 'other' end as domain, lang, source,
         len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::bigint as n_tokens
  from documents
),
leaves as (select domain, lang, source, sum(n_tokens)::hugeint as tokens from d group by all),
root as (select least(sum(tokens) * 100 // 100, sum(tokens * 2))::hugeint as budget from leaves),
{_mix_level(0, 'root')}, {_mix_level(1, 'l0')}, {_mix_level(2, 'l1')},
plan as (
  select l.*, budget // tokens as epochs, budget % tokens as rest
  from leaves l join l2 b on l.domain = b.domain and l.lang is not distinct from b.lang
    and l.source is not distinct from b.source
  where tokens > 0 and budget > 0
),
j as (
  select d.*, p.epochs, p.rest, md5('17:' || p.epochs || ':' || coalesce(doc_id::varchar, '')) as k
  from d join plan p on d.domain = p.domain and d.lang is not distinct from p.lang
    and d.source is not distinct from p.source
),
o as (
  select *, sum(n_tokens) over (partition by domain, lang, source order by k)
            - sum(n_tokens) over (partition by domain, lang, source, k) as sofar
  from j
),
x as (select *, unnest(range(0, (epochs + case when sofar < rest then 1 else 0 end)::bigint)) as epoch from o)
select doc_id, domain, lang, source, n_tokens, epoch::int as epoch,
       md5('17:' || epoch || ':' || coalesce(doc_id::varchar, '')) as place
from x
"""

OP5 = """
with d as (
  select row_number() over () as row_id, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents
),
l as (
  select row_id, doc_id, i, ls[i] as line,
         translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select *, unnest(range(1, len(ls) + 1)) as i from d)
),
r as (
  select k, max(doc_id) as last from l where length(k) >= 20 group by k having count(distinct row_id) >= 3
),
j as (select l.*, r.k is not null and l.doc_id is distinct from r.last as lost from l left join r using (k))
select doc_id, count(*)::bigint as n_lines, count(*) filter (lost)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not lost), '')) as kept_sha256
from j group by row_id, doc_id
"""

OP8 = """
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
  select q.vec_id as query_id, v.vec_id,
         list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * v.v[i]))::bigint as score
  from v q join v on q.vec_id <> v.vec_id where q.vec_id % 50 = 0
),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""


def _url_level(level: int) -> str:
    """Templates after generalising the segment at ``level`` (from 0)."""
    return f"""
k{level} as (
  select *, case when len(template) > {level} then array_to_string(template[1:{level}], '/') end as p,
         template[{level + 1}] as c
  from t{level}
),
w{level} as (
  select host, p from (
    select host, p, c, sum(pages) as pages from k{level} where p is not null and c not in ('*', '**') group by all
  ) group by all having count(*) >= 8 and sum(pages) <= 2 * count(*)
),
t{level + 1} as (
  select k.host, lexical, pages, labelled, bad,
         case when w.host is not null and c not in ('*', '**')
              then list_concat(list_concat(template[1:{level}], ['*']), template[{level + 2}:]) else template end as template
  from k{level} k left join w{level} w on k.host = w.host and k.p = w.p
)"""


_FIT = " ".join(
    f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') then '{r.name}|{r.verdict}'"
    for r in sorted(RULES, key=lambda r: -len(r.name))
)
OP9 = f"""
with u as (
  select page_id, coalesce(url like '%://%', false) as has, url from pages
),
v as (
  select page_id,
         case when has then translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') else '' end as host,
         case when has then regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) else '' end as path
  from u
),
r as (
  select *, case {_FIT} end as fit,
         list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
                        lambda s: case when regexp_matches(s, '{VARIABLE}') then '*' else s end) as segs
  from v
),
l as (select *, case when len(segs) > 6 then list_concat(segs[1:6], ['**']) else segs end as lexical from r),
marks as (
  select doc_id, count(*) as labelled, count(*) filter (quality = 0) as bad from labels where quality is not null group by 1
),
t0 as (
  select host, lexical, lexical as template, count(*)::hugeint as pages,
         coalesce(sum(labelled), 0)::hugeint as labelled, coalesce(sum(bad), 0)::hugeint as bad
  from l left join marks on page_id = doc_id group by host, lexical
),
{", ".join(_url_level(i) for i in range(6))},
g as (
  select host, lexical, array_to_string(template, '/') as template, pages, labelled, bad from t6
),
lv as (
  select host, template, regexp_replace(template, '(^|/)[^/]*$', '') as parent,
         sum(labelled)::hugeint as n, sum(bad)::hugeint as b
  from g group by host, template
),
po as (
  select *, sum(n) over (partition by host, parent)::hugeint as pn, sum(b) over (partition by host, parent)::hugeint as pb
  from lv
),
al as (
  select *, (b * pn - pb * n) * (b * pn - pb * n) <= 4 * pb * (pn - pb) * n as alike from po
),
me as (
  select host, template,
         case when alike then sum(n) filter (alike) over (partition by host, parent) else n end::hugeint as n,
         case when alike then sum(b) filter (alike) over (partition by host, parent) else b end::hugeint as b
  from al
),
ov as (select sum(labelled)::hugeint as a, sum(bad)::hugeint as ab from t0),
ve as (select host, template, coalesce(100 * (b * a + 10 * ab) >= 50 * a * (n + 10) and n > 0, false) as rejected from me, ov)
select page_id, l.host, path, nullif(split_part(coalesce(fit, '|'), '|', 1), '') as rule,
       case when fit is not null then split_part(fit, '|', 2) when rejected then 'block' else 'allow' end as verdict,
       g.template
from l join g on l.host = g.host and l.lexical = g.lexical
join ve on g.host = ve.host and g.template = ve.template
"""

_LOWER_AZ = f"'{UPPER}', '{LOWER}'"
_TEST_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
OP11 = f"""
with it as (
  select coalesce(item_id::varchar, '') as item, regexp_extract_all(translate(coalesce(text, ''), {_LOWER_AZ}), '{_TEST_WORD}') as w
  from benchmark
),
win as (
  select distinct item, l, array_to_string(w[i + 1 : i + l], ' ') as g
  from (select item, w, least(len(w), 10) as l, unnest(range(0, len(w) - least(len(w), 10) + 1)) as i from it where len(w) > 0)
),
lens as (select distinct l from win),
d as (
  select row_number() over () as row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER_AZ}), '{_TEST_WORD}') as w
  from documents
),
probes as (
  select row_id, l, i, array_to_string(w[i + 1 : i + l], ' ') as g
  from (select row_id, w, l, unnest(range(0, greatest(len(w) - l + 1, 0))) as i from d, lens)
),
hits as (select p.row_id, p.i, p.l, win.item from probes p join win on p.l = win.l and p.g = win.g),
words as (select row_id, count(distinct k) as n_hit from (select row_id, unnest(range(i, i + l)) as k from hits) group by row_id),
items as (
  select row_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
  from (select distinct row_id, item from hits) group by row_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (row_id) left join items using (row_id)
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a varchar expression; needs ``crc`` joined in,
    one row with the table that the polynomial gives."""
    byte = f"(16 * (instr('0123456789ABCDEF', substr(hex({text}), 2 * i - 1, 1)) - 1) + instr('0123456789ABCDEF', substr(hex({text}), 2 * i, 1)) - 1)"
    bytes_ = f"list_transform(range(1, length(hex({text})) // 2 + 1), lambda i: {byte}::bigint)"
    return f"xor(list_reduce({bytes_}, lambda c, b: xor(c >> 8, crc_t[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint)"


# The table of CRC-32 from its polynomial.
_CRC = """
crc as (
  select list_transform(range(0, 256), lambda i: list_reduce(range(0, 8),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i::bigint)) as crc_t
)"""

OP12 = f"""
with recursive {_CRC},
runs as (
  select coalesce(doc_id::varchar, '') || ':' as d, translate(r, {_LOWER_AZ}) as r
  from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as r from documents)
  where length(r) >= 7
),
hashed as (select r, {_crc32('d || r')} as h from runs, crc),
words as (select case when h % 31 = 0 then substr(r, 1, (h % length(r))::int) || substr(r, (h % length(r))::int + 2) else r end as w from hashed),
v as (select w, count(*) as n from words where length(w) >= 7 group by w having count(*) >= 2),
cutting as (
  select w, n, p, substr(w, 1, p - 1) || substr(w, p + 1) as e from (select w, n, unnest(range(1, length(w) + 1)) as p from v)
),
pairs as (
  select distinct c.w as a, v.w as b from cutting c join v on c.e = v.w
  union
  select distinct x.w, y.w from cutting x join cutting y on x.p = y.p and x.e = y.e and x.w <> y.w and length(x.w) = length(y.w)
),
near as (select a as w, b as o from pairs union select b, a from pairs),
best as (
  select near.w, count(*) as n_near, min((-v.n, encode(near.o), near.o)) as b from near join v on near.o = v.w group by near.w
),
formed as (
  select v.w, v.n, coalesce(n_near, 0) as n_near,
         case when -b[1] >= 10 * v.n then b[3] end as form, case when -b[1] >= 10 * v.n then -b[1] end as form_n
  from v left join best using (w)
),
chain as (
  select w, w as at from formed
  union all
  select chain.w, formed.form from chain join formed on chain.at = formed.w where formed.form is not null
)
select f.w as word, f.form, c.at as root, f.n::bigint as n, f.n_near::bigint as n_near, f.form_n::bigint as form_n
from formed f join chain c using (w) join formed last on last.w = c.at and last.form is null
"""

OP13 = f"""
with recursive {_CRC},
t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place
  from conversations where conv_id is not null
),
own as (select conv_id, count(*) as n from t group by conv_id),
shaped as (
  select o.conv_id, o.conv_id - o.conv_id % 100 as base, h, least(h, coalesce(b.n, 0)) as m
  from (select conv_id, {_crc32('conv_id::varchar')} % 6 as h from own, crc) o left join own b on b.conv_id = o.conv_id - o.conv_id % 100
),
rebuilt as (
  select s.conv_id, t.place, role, text from shaped s join t on t.conv_id = s.base and t.place <= s.m
  union all
  select s.conv_id, t.place - h + m, role, text from shaped s join t using (conv_id) where t.place > h
),
memb as (
  select conv_id, 0::bigint as depth, []::struct(r varchar, x varchar)[] as k, '' as text from shaped
  union all
  select m.conv_id, m.depth + 1, list_append(m.k, {{'r': r.role, 'x': r.text}}), r.text
  from memb m join rebuilt r on r.conv_id = m.conv_id and r.place = m.depth + 1
),
ends as (
  select depth, k, string_agg(conv_id::varchar, ',' order by conv_id) as listed
  from (select m.*, max(depth) over (partition by conv_id) as last from memb m) where depth = last group by depth, k
),
node as (select depth, k, min(conv_id) as conv_id, count(*) as n_convs, any_value(text) as text from memb group by depth, k),
numbered as (select *, row_number() over () as id from node),
linked as (
  select n.*, p.id as parent, p.conv_id as parent_conv_id from numbered n left join numbered p on p.depth = n.depth - 1 and p.k = n.k[: n.depth - 1]
),
kids as (select parent as id, count(*) as n_children from linked where parent is not null group by parent),
base as (
  select l.*, coalesce(n_children, 0) as n_children, (n_convs - 1) * length(text) as saved from linked l left join kids using (id)
),
up as (
  select id, id as top, parent, n_children, saved from base
  union all
  select up.id, b.id, b.parent, up.n_children, up.saved from up join base b on b.id = up.parent
),
total as (select top as id, count(*) filter (n_children = 0) as n_leaves, sum(saved) as saved_tokens from up group by top)
select b.conv_id, b.depth, parent_conv_id, n_convs::bigint as n_convs, n_children::bigint as n_children, n_leaves::bigint as n_leaves,
       saved_tokens::bigint as saved_tokens, sha256(coalesce(listed, '')) as ends_sha256
from base b join total using (id) left join ends e on e.depth = b.depth and e.k = b.k
"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": OP1, "op4_mixing": OP4, "op5_line_dedup": OP5, "op8_topk": OP8, "op9_url_filters": OP9, "op11_decontamination": OP11, "op12_spelling": OP12,
    "op13_prefix_trie": OP13,
}
