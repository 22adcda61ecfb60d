"""SQL of the checking engine that states the results of the registered queries."""

from __future__ import annotations

URL_FILTER = r"""
with recursive u as (
  select page_id, html, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), p as (
  select page_id, coalesce(html, '') as html,
    translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^#]*)', 1) as tail
  from u
), n as (
  select *, case when host = '' then null when tail = '' then host || '/' when tail[1] = '?' then host || '/' || tail
    else host || tail end as node from p
), tags as (
  select node, host, path, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) as tag from n
), links as (
  select node, host, path,
    case when regexp_matches(tag, '(?i)^<link') and regexp_matches(tag, '(?i)\brel\s*=\s*["'']?[^"''>]*\bcanonical\b')
      then regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
    when regexp_matches(tag, '(?i)^<meta') and regexp_matches(tag, '(?i)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')
      then regexp_extract(tag, '(?is)\bcontent\s*=\s*["'']?\s*[0-9.]*\s*[;,]\s*url\s*=\s*[''"]?([^"''>\s]+)', 1)
    end as to_url
  from tags
), urls as (
  select node, case when regexp_matches(to_url, '(?i)^[a-z][a-z0-9+.-]*://') then substr(to_url, strpos(to_url, '://') + 3)
    when starts_with(to_url, '//') then substr(to_url, 3) when starts_with(to_url, '/') then host || to_url
    when starts_with(to_url, '?') then host || path || to_url when starts_with(to_url, '#') then host || path
    else host || case when strpos(path, '/') = 0 then '/' else regexp_extract(path, '^.*/') end || to_url end as rest
  from links where to_url <> ''
), cut as (
  select node, lower(regexp_extract(rest, '^[^/?#]*')) as host, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) as tail from urls
), edges as (
  select distinct node as a, case when tail = '' then host || '/' when tail[1] = '?' then host || '/' || tail
    else host || tail end as b from cut where host <> '' and node is not null
), reach(a, b) as (
  select a, b from edges union select b, a from edges
  union
  select r.a, e.b from reach r join (select a, b from edges union all select b, a from edges) e on r.b = e.a
), rules(action, h, t) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), sites as (
  select host, path from p
  union select regexp_extract(b, '^[^/?#]*'), regexp_extract(b, '^[^/?#]*([^?#]*)', 1) from edges
), fits as (
  select s.host, s.path, max_by({'rule': h || t, 'action': action}, length(h || t)) as won
  from sites s join rules on (s.host = h or ends_with(s.host, '.' || h)) and starts_with(s.path, t)
  group by all
), bad as (
  select distinct r.a as node from reach r join fits f
    on f.host = regexp_extract(r.b, '^[^/?#]*') and f.path = regexp_extract(r.b, '^[^/?#]*([^?#]*)', 1)
  where f.won.action = 'block'
)
select n.page_id, n.host, n.path, f.won.rule as rule,
  case when f.won is not null then f.won.action when bad.node is not null then 'block' else 'allow' end as verdict,
  case when f.won is not null then 'rule' when bad.node is not null then 'alias' else 'default' end as reason
from n left join fits f on f.host = n.host and f.path = n.path left join bad on bad.node = n.node
"""

NGRAM_JACCARD = r"""
with recursive w as (
  select doc_id, [x for x in regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'
  ) if x <> ''] as words from documents
), s as (
  select doc_id, case when len(words) = 0 then [] when len(words) < 3 then [array_to_string(words, ' ')]
    else list_distinct([words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] for i in range(1, len(words) - 1)]) end as grams
  from w
), g as (
  select doc_id, len(grams) as n, unnest(grams) as gram from s
), overlap as (
  select a.doc_id as a, b.doc_id as b, a.n as n, b.n as m, count(*) as c
  from g a join g b on a.gram = b.gram and a.doc_id <> b.doc_id and 100 * b.n >= 90 * a.n and 100 * a.n >= 90 * b.n
  group by all
), links as (
  select a, b from overlap where 100 * c >= 90 * (n + m - c)
), reach(a, b) as (
  select doc_id, doc_id from documents union select r.a, l.b from reach r join links l on r.b = l.a
)
select s.doc_id, cast(len(s.grams) as bigint) as n_shingles, min(r.b) as component_id,
  (select count(*) from links l where l.a = s.doc_id) as n_links
from s join reach r on r.a = s.doc_id group by s.doc_id, s.grams
"""

WARC = """
with p as (
  select page_id, encode(coalesce(html, '')) as payload from pages
), d as (
  select page_id, octet_length(payload) as payload_bytes, sha1(payload) as payload_digest,
    max(page_id) over (partition by payload) as first
  from p
)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id <> first then first end as refers_to
from d
"""

TOP_K = """
with v as (
  select row_number() over () as row_no, vec_id, [cast(floor(64 * cast(x as double)) as bigint) for x in embedding] as g
  from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), s as (
  select q.row_no, q.vec_id as query_id, c.vec_id as vec_id,
    cast(list_dot_product(cast(q.g as double[]), cast(c.g as double[])) as bigint) as score
  from v q join v c on c.row_no <> q.row_no where q.vec_id % 20 = 0
), r as (
  select query_id, row_number() over (partition by row_no order by score desc, vec_id) as rank, vec_id, score from s
)
select query_id, rank, vec_id, score from r where rank <= 20
"""

LINE_DEDUP = r"""
with split as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), l as (
  select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as at from split
), k as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l
), often as (
  select key from k where length(key) >= 1 group by key having count(distinct doc_id) >= 10
)
select k.doc_id, count(*) as n_lines, count(o.key) as n_dropped,
  sha256(coalesce(string_agg(k.line, chr(10) order by k.at) filter (where o.key is null), '')) as kept_sha256
from k left join often o on o.key = k.key group by k.doc_id
"""


PHRASES = """with pieces as (
  select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\n\x0B\f\r]')) piece
  from documents),
split as (select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') w from pieces),
grams as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) phrase
  from split, (values (1), (2), (3), (4)) s(k) where len(w) >= k),
counts as (select lang, k, phrase, count(*) f from grams group by all),
totals as (select lang, cast(sum(f) as bigint) n from counts where k = 1 group by 1),
candidates as (select lang, k, phrase, f a from counts where k > 1 and f >= 30),
longer as (
  select lang, a, unnest(list_transform(range(1, k - j + 2), lambda i: array_to_string(string_split(phrase, ' ')[i:i + j - 1], ' '))) phrase
  from candidates, (values (2), (3)) s(j) where j < k),
covers as (select lang, phrase, max(a) cover from longer group by all),
free as (select c.* from candidates c left join covers v on c.lang = v.lang and c.phrase = v.phrase
  where v.cover is null or 100 * v.cover < 80 * c.a),
cuts as (
  select lang, phrase, a, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') head,
    array_to_string(string_split(phrase, ' ')[j + 1:k], ' ') tail
  from free, (values (1), (2), (3)) s(j) where j < k),
scored as (
  select c.lang, c.phrase, c.a, h.f l, t.f r,
    cast((cast(2000000 as hugeint) * c.a) // (cast(h.f as hugeint) + t.f) as bigint) score, j
  from cuts c join counts h on h.lang = c.lang and h.phrase = c.head join counts t on t.lang = c.lang and t.phrase = c.tail),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, j) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from lowest)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000"""
