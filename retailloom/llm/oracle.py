"""Expected results of the queries that SQL can express, in DuckDB."""

from __future__ import annotations

from retailloom.llm.licenses import TEMPLATES

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(table: str, key: str) -> str:
    return f"select {key}, regexp_extract_all({_LOWER}, '{WORDS}') as w from {table}"


DECONTAMINATE = f"""
with docs as ({_words('documents', 'doc_id')}), items as ({_words('benchmark', 'item_id')}),
item_windows as (
  select distinct item_id, least(len(w), 13) as n, array_to_string(w[s : s + least(len(w), 13) - 1], ' ') as content
  from (select *, unnest(generate_series(1, greatest(1, len(w) - 12))) as s from items where len(w) > 0)),
sizes as (select distinct n from item_windows),
doc_windows as (
  select doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') as content
  from (select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as s from docs, sizes where len(w) >= n)),
met as (select d.doc_id, d.s, d.n, i.item_id from doc_windows d join item_windows i on d.content = i.content and d.n = i.n),
hit as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(generate_series(s, s + n - 1)) as p from met) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct doc_id, cast(item_id as varchar) as item from met) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join hit using (doc_id) left join found using (doc_id)"""

NEAR_DUPLICATES = f"""
with recursive docs as ({_words('documents', 'doc_id')}),
tokens as (
  select distinct doc_id, array_to_string(w[s : s + 4], ' ') as t
  from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) as s from docs where len(w) > 0)),
sizes as (select doc_id, count(*) as n from tokens group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as common from tokens a join tokens b on a.t = b.t and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 5 * common >= 4 * (x.n + y.n - common)),
reached(node, other) as (select doc_id, doc_id from documents union select r.node, l.b from reached r join links l on l.a = r.other)
select doc_id, class_id, coalesce(n_links, 0) as n_links
from (select node as doc_id, min(other) as class_id from reached group by node)
left join (select a as doc_id, count(*) as n_links from links group by a) using (doc_id)"""


def _escaped(text: str) -> str:
    for plain, code in (("\\", "\\\\"), ("[", "\\("), ("]", "\\)"), ("<", "\\{")):
        text = f"replace({text}, '{plain}', '{code}')"
    return text


CHATS = f"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as place,
    lag(role, 1, 'start') over (partition by conv_id order by turn nulls first, role, text) as before from given),
marked as (
  select *, before || '>' || role in ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user') as fits,
    case role when 'system' then length('<<SYS>>x' || 'x<</SYS>>x') when 'user' then length('[INST] ' || ' [/INST]')
      when 'assistant' then length('<s> ' || ' </s>x') else length('[ROLE:] ' || ' [/ROLE]x') + length({_escaped('role')}) end as marks from turns)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(marks + length({_escaped('text')})) as bigint) as formatted_chars,
  bool_and(fits) and max_by(role, place) = 'assistant' as valid,
  cast(coalesce(min(place) filter (where not fits), 0) - 1 as int) as wrong_turn
from marked group by conv_id"""

SOURCE_MIX = r"""
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
    md5('1:' || doc_id) as key from documents),
sources as (
  select *, cast([5, 2, 1][(sid - 1) % 3 + 1] as double) as weight, cast(3 * source_size as double) as cap
  from (select source, source_size, row_number() over (order by source nulls last) as sid
        from (select source, cast(sum(size) as bigint) as source_size from sized group by source))),
levels as (
  select *, (cast(sum(source_size) over () as double) - coalesce(sum(cap) over before, 0.0)) / (sum(weight) over () - coalesce(sum(weight) over before, 0.0)) as level
  from sources window before as (order by cap / weight, sid rows between unbounded preceding and 1 preceding)),
targets as (
  select source, source_size, least(cap, coalesce(max(case when cap > level * weight then level end) over () * weight, cap)) as target from levels),
placed as (
  select s.*, t.source_size, t.target, cast(floor(t.target) as bigint) as due,
    coalesce(sum(size) over (partition by s.source order by key, doc_id, size rows between unbounded preceding and 1 preceding), 0) as place
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, source, size, source_size, target,
  cast(case when source_size = 0 then 0 else due // source_size * size + least(size, greatest(0, due % source_size - place)) end as bigint) as taken
from placed"""

TOP_K = """
with vectors as (
  select vec_id, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] as v from embeddings
  where vec_id is not null and len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]) as bigint) as score
  from vectors q join vectors c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id)
select query_id, cast(rank as int) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 10"""


COLLOCATIONS = rf"""
with pieces as (
  select r, lang, p, unnest(generate_series(1, len(piece))) as s, piece
  from (select r, lang, generate_subscripts(found, 1) as p, unnest(found) as piece from (
    select row_number() over () as r, coalesce(lang, 'und') as lang,
      [regexp_extract_all(x, '[^\x20\x09]+') for x in regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')] as found
    from documents))),
grams as (
  select lang, size, piece[s : s + size - 1] as w, count(*) as f
  from pieces, (select unnest([1, 2, 3]) as size) where s + size - 1 <= len(piece) group by all),
totals as (select lang, cast(sum(f) as bigint) as n from grams where size = 1 group by lang),
candidates as (select lang, size, w, f as a from grams where size > 1 and f >= 10),
cuts as (
  select c.*, k, w[1 : k] as lw, w[k + 1 : size] as rw from candidates c, (select unnest([1, 2]) as k) where k < size),
scored as (
  select c.lang, c.size, c.w, a, x.f as l, y.f as r, k,
    (1000000::hugeint * a * a) // (x.f::hugeint * y.f) as score
  from cuts c join grams x on x.lang = c.lang and x.w = lw join grams y on y.lang = c.lang and y.w = rw),
lowest as (select * from (select *, row_number() over (partition by lang, w order by score, k) as nth from scored) where nth = 1),
inside as (
  select lang, part, max(a) as longer from (
    select lang, a, unnest([w[1 : 2], w[2 : 3]]) as part from candidates where size = 3) group by all),
kept as (
  select lowest.* from lowest left join inside i on i.lang = lowest.lang and i.part = lowest.w
  where longer is null or 100 * longer < 50 * lowest.a),
ranked as (
  select lang, array_to_string(w, ' ') as phrase, a, l, r, cast(score as bigint) as score,
    row_number() over (partition by lang order by score desc, a desc, array_to_string(w, ' ')) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000"""

RANKED = rf"""
with docs as (
  select row_number() over () as r, doc_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from documents),
items as (
  select distinct item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from benchmark),
counted as (select r, doc_id, t, count(*) as tf from docs group by all),
lengths as (select r, cast(sum(tf) as bigint) as n from counted group by r),
total as (select count(*) as docs, cast(sum(n) as bigint) as tokens from lengths),
weights as (select t, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint) as w from (select t, count(*) as df from counted group by t), total),
sizes as (select r, 100 - 90 + ((90 * n * docs) // tokens) as m from lengths, total),
scored as (
  select item_id, doc_id, r, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
  from items join counted using (t) join weights using (t) join sizes using (r) group by all having score > 0)
select item_id, cast(rank as int) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored) where rank <= 10"""


def _licenses() -> str:
    templates = ", ".join(f"({k}, '{license_id}', '{text}')" for k, (license_id, text) in enumerate(TEMPLATES))
    terms = "regexp_extract_all(lower({}), '[a-z0-9]+')"
    return f"""
with templates(k, license, text) as (values {templates}),
template_terms as (select k, license, t, count(*) as n from (select k, license, unnest({terms.format('text')}) as t from templates) group by all),
files as (
  select doc_id, coalesce(source, 'none') || '/' || (doc_id // 1000) || '/' || (doc_id // 100) as directory, coalesce(text, '') as text from documents),
held as (
  select t, count(*) as df from (select unnest(list_distinct({terms.format('text')})) as t from files)
  where t in (select t from template_terms) group by t),
total as (select count(*) as files from files),
weights as (
  select distinct t, 1 + ln((1 + files) / (1 + coalesce(df, 0))) as idf from (select distinct t from template_terms) left join held using (t), total),
scaled as (
  select k, license, t, n * idf / sqrt(sum(n * idf * n * idf) over (partition by k)) as share from template_terms join weights using (t)),
passages as (
  select doc_id, false as is_whole, unnest(string_split(text, chr(10))) as passage from files union all select doc_id, true, text from files),
counted as (select passage, t, count(*) as n from (select passage, unnest({terms.format('passage')}) as t from (select distinct passage from passages)) group by all),
weighed as (select passage, t, n * coalesce(idf, 1 + ln(1 + files)) as weight from counted left join weights using (t), total),
lengths as (select passage, sqrt(sum(weight * weight)) as length from weighed group by passage),
dots as (select passage, k, license, sum(weight * share) as dot from weighed join scaled using (t) group by all),
scores as (
  select passage, license, round(dot / length, 6) as score,
    row_number() over (partition by passage order by round(dot / length, 6) desc, k) as place from dots join lengths using (passage)),
judged as (select doc_id, is_whole, license, score from passages join scores using (passage) where place = 1),
ranked as (
  select *, row_number() over (partition by doc_id, is_whole order by score desc, license desc) as nth,
    row_number() over (partition by doc_id order by score desc, license desc) as nth_of_all from judged),
best as (select doc_id, license, score from ranked where nth_of_all = 1 and score >= 0.7),
whole as (select doc_id, license, score from ranked where is_whole and nth = 1 and score >= 0.6),
own as (
  select f.doc_id, f.directory, f.directory || '/' || f.doc_id || '.txt' as path, coalesce(b.license, w.license) as own_license,
    coalesce(b.score, w.score) as own_score, w.score is not null as is_license_file
  from files f left join best b using (doc_id) left join whole w using (doc_id)),
speakers as (
  select directory as above, own_license as given, path as giver
  from (select *, row_number() over (partition by directory order by own_score desc, path, doc_id) as nth from own where is_license_file) where nth = 1),
above as (
  select distinct directory, unnest([directory, split_part(directory, '/', 1) || '/' || split_part(directory, '/', 2), split_part(directory, '/', 1), '']) as above
  from own),
nearest as (
  select directory, given, giver from (
    select directory, given, giver, row_number() over (partition by directory order by length(above) desc) as nth from above join speakers using (above)) where nth = 1)
select doc_id, path, own_license, own_score, is_license_file, given as inherited_license, giver as inherited_from, coalesce(own_license, given) as license
from own left join nearest using (directory)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": _licenses(), "op4_decontaminate": DECONTAMINATE, "op6_jaccard_join": NEAR_DUPLICATES, "op8_chat_format": CHATS,
        "op9_source_mix": SOURCE_MIX, "op10_topk": TOP_K, "op11_collocations": COLLOCATIONS, "op12_lexical_search": RANKED,
    }
