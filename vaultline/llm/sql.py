"""DuckDB SQL of those queries that SQL can express."""

from __future__ import annotations

URL_FILTER = r"""
with cut as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), parts as (
  select page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^([^/?#]*)', 1)) + 1), '^([^?#]*)', 1) as path
  from cut
), rules(verdict, domain, prefix) as (
  values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits as (
  select p.page_id, p.host, r.domain || r.prefix as rule, r.verdict,
    row_number() over (partition by p.page_id order by length(r.domain || r.prefix) desc) as place
  from parts p join rules r on (p.host = r.domain or ends_with(p.host, '.' || r.domain)) and starts_with(p.path, r.prefix)
), best as (
  select * from fits where place = 1
), listed as (
  select distinct host from best where verdict = 'block'
)
select p.page_id, p.host, p.path, b.rule,
  coalesce(b.verdict, case when p.host in (select host from listed) then 'block' else 'allow' end) as verdict
from parts p left join best b on p.page_id = b.page_id
"""

SOURCE_MIX = r"""
with sized as (
  select doc_id, source, md5(coalesce(cast(doc_id as varchar), '')) as key,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
  from documents
), sums as (
  select source, sum(size)::bigint as source_size from sized group by source
), weighed as (
  select source, source_size, 3 * source_size as cap, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from sums
), placed as (
  select *, sum(source_size) over () - coalesce(sum(cap) over before, 0) as remaining,
    sum(weight) over () - coalesce(sum(weight) over before, 0) as open_weight
  from weighed
  window before as (order by cap * 6 // weight, source nulls last rows between unbounded preceding and 1 preceding)
), levelled as (
  select *, weight * remaining > cap * open_weight as is_full from placed
), level as (
  select remaining, open_weight from levelled where not is_full order by open_weight desc limit 1
), goals as (
  select source, source_size,
    case when is_full then cap::double
      else (weight * (select remaining from level))::double / (select open_weight from level)::double end as target
  from levelled
), budgets as (
  select *, floor(target + 0.5)::bigint as budget, case when source_size > 0 then floor(target + 0.5)::bigint // source_size else 0 end as epochs
  from goals
), ordered as (
  select s.doc_id, s.size, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size as rest,
    coalesce(sum(s.size) over (partition by s.source order by s.key, s.doc_id nulls first, s.size rows between unbounded preceding and 1 preceding), 0) as before
  from sized s join budgets b on s.source is not distinct from b.source
)
select doc_id, size, source_size::bigint as source_size, target,
  (epochs * size + least(size, greatest(0, rest - before)))::bigint as taken
from ordered
"""

LINE_DEDUP = r"""
with lines as (
  select doc_id, n, line,
    translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (
    select doc_id, unnest(list) as line, unnest(range(len(list))) as n
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as list from documents)
  )
), frequent as (
  select key from lines where key <> '' group by key having count(distinct doc_id) >= 10
)
select doc_id, count(*) as n_lines, count(*) filter (f.key is not null) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by n) filter (f.key is null), '')) as kept_sha256
from lines l left join frequent f on l.key = f.key
group by doc_id
"""

DECONTAMINATION = r"""
with doc_words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), item_words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), windows as (
  select distinct item_id, least(len(w), 10) as size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as phrase
  from (select item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as i from item_words where len(w) > 0)
), sizes as (
  select distinct size from windows
), places as (
  select doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') as phrase
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from doc_words, sizes where len(w) >= size)
), found as (
  select p.doc_id, p.i, p.size, w.item_id from places p join windows w on p.size = w.size and p.phrase = w.phrase
), hits as (
  select doc_id, count(distinct spot) as n_hit
  from (select doc_id, unnest(range(i, i + size)) as spot from found) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as id from found) group by doc_id
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words d left join hits using (doc_id) left join items using (doc_id)
"""

COLLOCATIONS = r"""
with pieces as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
  from (
    select coalesce(lang, 'und') as lang,
      unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
  )
), totals as (
  select lang, sum(len(w))::bigint as n from pieces group by lang
), grams as (
  select lang, k, array_to_string(w[i: i + k - 1], ' ') as phrase
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from pieces, unnest(range(1, 6)) as sizes(k))
), frequent as (
  select lang, k, phrase, count(*)::bigint as a from grams group by all having count(*) >= 100
), cuts as (
  select *, array_to_string(w[1: c], ' ') as head, array_to_string(w[c + 1: k], ' ') as tail
  from (select *, string_split(phrase, ' ') as w, unnest(range(1, k)) as c from frequent)
), scores as (
  select x.lang, x.phrase, x.a, x.c, x.k, l.a as l, r.a as r, t.n, ((1000::hugeint * x.a * t.n) // (l.a::hugeint * r.a))::bigint as score
  from cuts x join frequent l on l.lang = x.lang and l.phrase = x.head join frequent r on r.lang = x.lang and r.phrase = x.tail
  join totals t on t.lang = x.lang
), least_cut as (
  select * from scores qualify row_number() over (partition by lang, phrase order by score, c) = 1
), inner_parts as (
  select lang, array_to_string(w[i: i + m - 1], ' ') as phrase, max(a) as within
  from (
    select lang, a, w, m, unnest(range(1, k - m + 2)) as i
    from (select lang, a, k, string_split(phrase, ' ') as w, unnest(range(2, k)) as m from frequent)
  ) group by all
), kept as (
  select s.* from least_cut s left join inner_parts p on p.lang = s.lang and p.phrase = s.phrase where p.within is null or 100 * p.within < 100 * s.a
)
select lang, rank, phrase, a, l, r, n, score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
where rank <= 2000
"""

PREFIX_TRIE = r"""
with turns as (
  select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as pos
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)
), ids as (
  select conv_id, conv_id - conv_id % 20 as base,
    xor(list_reduce(
      list_prepend(4294967295::bigint, flatten(list_transform(string_split(conv_id::varchar, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda crc, x: case when x >= 0 then xor(crc, x) else xor(crc >> 1, case when crc % 2 = 1 then 3988292384::bigint else 0::bigint end) end
    ), 4294967295::bigint) % 4 as h
  from (select distinct conv_id from turns)
), rebuilt as (
  select i.conv_id, 0 as part, t.pos, t.role, t.text from ids i join turns t on t.conv_id = i.base and t.pos < i.h
  union all
  select i.conv_id, 1, t.pos, t.role, t.text from ids i join turns t on t.conv_id = i.conv_id and t.pos >= i.h
), steps as (
  select conv_id, text, row_number() over by_turn as depth, string_agg(md5(length(role) || ':' || role || text), '') over by_turn as path
  from rebuilt window by_turn as (partition by conv_id order by part, pos rows between unbounded preceding and current row)
), nodes as (
  select depth, path, min(conv_id) as conv_id, count(*) as n_convs, any_value(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) as words
  from steps group by depth, path
  union all
  select 0, '', min(conv_id), count(*), 0 from ids having count(*) > 0
), parents as (
  select *, case when depth > 0 then left(path, 32 * (depth - 1)) end as parent from nodes
), children as (
  select parent, count(*) as n_children from parents where parent is not null group by parent
), figures as (
  select p.*, coalesce(c.n_children, 0) as n_children from parents p left join children c on c.parent = p.path
), sums as (
  select left(path, 32 * k) as path, sum((n_children = 0)::int) as n_leaves, sum((n_convs - 1) * words) as saved_tokens
  from (select path, n_children, n_convs, words, unnest(range(depth + 1)) as k from figures) group by all
), ends as (
  select path, string_agg(conv_id::varchar, ',' order by conv_id) as members
  from (select i.conv_id, coalesce(max(s.path), '') as path from ids i left join steps s on s.conv_id = i.conv_id group by i.conv_id)
  group by path
)
select f.conv_id, f.depth::bigint as depth, a.conv_id as parent_conv_id, f.n_convs::bigint as n_convs, f.n_children::bigint as n_children,
  s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, sha256(coalesce(e.members, '')) as ends_sha256
from figures f join sums s on s.path = f.path left join nodes a on a.path = f.parent left join ends e on e.path = f.path
"""

ORACLES: dict[str, str] = {
    "op3_line_dedup": LINE_DEDUP, "op4_decontamination": DECONTAMINATION,
    "op6_source_mix": SOURCE_MIX, "op10_url_filter": URL_FILTER, "op12_prefix_trie": PREFIX_TRIE,
    "op13_collocations": COLLOCATIONS,
}
