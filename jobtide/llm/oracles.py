"""DuckDB SQL that gives the same rows as queries of this package."""

from __future__ import annotations

#: crc32 of an ASCII string expression, bit by bit.
CRC32 = """xor(4294967295, list_reduce(
      list_prepend(4294967295::bigint, list_transform(string_split({0}, ''), lambda c: ascii(c)::bigint)),
      lambda r, b: list_reduce(
        [xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))))"""

PREFIX_TRIE = f"""
with turn as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as k
  from conversations where conv_id is not null
), conv as (
  select conv_id, conv_id - conv_id % 100 as origin, cast({CRC32.format("cast(conv_id as varchar)")} as bigint) % 6 as h
  from (select distinct conv_id from turn)
), piece as (
  select c.conv_id, 0 as part, t.k, t.role, t.text from conv c join turn t on t.conv_id = c.origin and t.k < c.h
  union all
  select c.conv_id, 1, t.k, t.role, t.text from conv c join turn t on t.conv_id = c.conv_id and t.k >= c.h
), rebuilt as (
  select c.conv_id, coalesce(p.turns, []) as turns from conv c left join (
    select conv_id, list({{'role': role, 'text': text}} order by part, k) as turns from piece group by conv_id
  ) p using (conv_id)
), prefix as (
  select conv_id, d, turns[1:d] as path, len(turns) = d as ends
  from (select conv_id, turns, unnest(range(len(turns) + 1)) as d from rebuilt)
), node as (
  select d, path, min(conv_id) as conv_id, count(*) as n_convs,
         coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '') as ends
  from prefix group by d, path
), edge as (
  select n.*, p.conv_id as parent_conv_id, case when n.d > 0 then (n.n_convs - 1) * length(n.path[n.d].text) else 0 end as saved
  from node n left join node p on p.d = n.d - 1 and p.path = n.path[1:n.d - 1]
), child as (
  select parent_conv_id as conv_id, d - 1 as d, count(*) as n_children from edge where d > 0 group by all
), own as (
  select e.*, coalesce(c.n_children, 0) as n_children from edge e left join child c using (conv_id, d)
), above as (
  select path[1:up] as path, up as d, saved, n_children = 0 as leaf from (select *, unnest(range(d + 1)) as up from own)
), rolled as (
  select d, path, sum(saved) as saved_tokens, count(*) filter (leaf) as n_leaves from above group by d, path
)
select o.conv_id, o.d::bigint as depth, o.parent_conv_id, o.n_convs, o.n_children, r.n_leaves, r.saved_tokens::bigint as saved_tokens,
       sha256(o.ends) as ends_sha256
from own o join rolled r on o.d = r.d and o.path = r.path"""


def _codes(rounds: int) -> str:
    """Assignments and new books one after the other, as many as there are rounds."""
    steps = ""
    for i in range(rounds + 1):
        steps += f""", gap{i} as materialized (
  select p.row_no, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) as gap
  from piece p join book{i} b on p.part = b.part and p.pos = b.pos group by p.row_no, p.part, b.entry
), own{i} as materialized (
  select * from gap{i} qualify row_number() over (partition by row_no, part order by gap, entry) = 1
)"""
        if i < rounds:
            steps += f""", mean{i} as (
  select o.part, o.entry, p.pos, floor(sum(p.x)::double / count(*))::bigint as x
  from own{i} o join piece p on o.row_no = p.row_no and o.part = p.part group by all
), book{i + 1} as materialized (
  select b.part, b.entry, b.pos, coalesce(m.x, b.x) as x from book{i} b left join mean{i} m using (part, entry, pos)
)"""
    return steps


PART_CODES = f"""
with kept as materialized (
  select row_number() over (order by vec_id) as row_no, vec_id, label, embedding from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), piece as materialized (
  select row_no, (i - 1) // (n // 16) as part, (i - 1) % (n // 16) as pos, floor(256 * embedding[i]::double)::bigint as x
  from (select row_no, embedding, len(embedding) as n, unnest(range(1, len(embedding) + 1)) as i from kept)
), book0 as (
  select part, row_no - 1 as entry, pos, x from piece where row_no <= 64
){_codes(2)}, coded as (
  select k.vec_id, k.label, string_agg(printf('%02x', o.entry), '' order by o.part) as code, sum(o.gap)::bigint as error
  from kept k join own2 o using (row_no) group by k.row_no, k.vec_id, k.label
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
       (select sha256(string_agg(cast(x as varchar), ',' order by part, entry, pos)) from book2) as codebooks_sha256
from coded"""

#: ASCII letters in lower case, then runs of letters, digits and all that lies beyond ASCII.
WORDS = (
    "list_filter(string_split_regex(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
)

MULTI_SEARCH = f"""
with item as (
  select cast(item_id as varchar) as item_id, {WORDS.format("text")} as words from benchmark where text is not null
), pattern as materialized (
  select distinct item_id, least(len(words), 10) as n, array_to_string(words[pos:pos + least(len(words), 10) - 1], ' ') as words
  from (select item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as pos from item where len(words) > 0)
), doc as materialized (
  select row_number() over () as row_no, doc_id, {WORDS.format("coalesce(text, '')")} as words from documents
), place as (
  select d.row_no, l.n, unnest(range(1, len(d.words) - l.n + 2)) as pos
  from doc d, (select distinct n from pattern) l where len(d.words) >= l.n
), found as materialized (
  select p.row_no, p.n, p.pos, t.item_id
  from place p join doc d using (row_no) join pattern t on t.n = p.n and t.words = array_to_string(d.words[p.pos:p.pos + p.n - 1], ' ')
), hit as (
  select row_no, count(distinct word) as n_hit from (select row_no, unnest(range(pos, pos + n)) as word from found) group by row_no
), named as (
  select row_no, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
  from (select distinct row_no, item_id from found where item_id is not null) group by row_no
)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit, coalesce(i.n_items, 0)::bigint as n_items,
       sha256(coalesce(i.items, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from doc d left join hit h using (row_no) left join named i using (row_no)"""


#: Runs of anything but space and the controls 9 to 13.
PLAIN_WORDS = "list_filter(string_split_regex(coalesce({0}, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: From the table edge (u, v), both ways: the smallest node that each node on an edge can reach.
COMPONENTS = """reach(node, low) as (
  select u, u from edge union select e.v, r.low from reach r join edge e on e.u = r.node and r.low < e.v
), component as (select node, min(low) as component_id from reach group by node)"""

#: Two sets as similar as 0.8 share one of the rarest (n - 0.8 n + 1) shingles of each.
NEAR_DOCUMENTS = f"""
with recursive doc as materialized (
  select row_number() over () as row_no, doc_id, {PLAIN_WORDS.format(LOWER.format("text"))} as words from documents
), shingle as materialized (
  select distinct row_no, array_to_string(words[pos:pos + least(len(words), 2) - 1], ' ') as s
  from (select row_no, words, unnest(range(1, greatest(len(words) - 1, 1) + 1)) as pos from doc where len(words) > 0)
), size as materialized (
  select row_no, count(*) as n from shingle group by row_no
), ranked as (
  select h.row_no, h.s, row_number() over (partition by h.row_no order by f.docs, h.s) as place
  from shingle h join (select s, count(*) as docs from shingle group by s) f using (s)
), rare as materialized (
  select r.row_no, r.s, z.n from ranked r join size z using (row_no) where r.place <= z.n - (80 * z.n + 99) // 100 + 1
), candidate as materialized (
  select distinct a.row_no as x, b.row_no as y, a.n as x_n, b.n as y_n
  from rare a join rare b on a.s = b.s and a.row_no < b.row_no and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), linked as (
  select x, y from (
    select c.x, c.y, c.x_n, c.y_n, count(*) as n_both
    from candidate c join shingle a on a.row_no = c.x join shingle b on b.row_no = c.y and a.s = b.s group by all
  ) where 100 * n_both >= 80 * (x_n + y_n - n_both)
), pair as (
  select a.doc_id as x, b.doc_id as y from linked l join doc a on a.row_no = l.x join doc b on b.row_no = l.y
  where a.doc_id is not null and b.doc_id is not null
), edge as materialized (
  select x as u, y as v from pair union select y, x from pair
), {COMPONENTS}
select d.doc_id, coalesce(z.n, 0)::bigint as n_shingles,
       case when d.doc_id is not null then coalesce(c.component_id, d.doc_id) end as component_id,
       coalesce(coalesce(c.component_id, d.doc_id) = d.doc_id, true) as kept
from doc d left join size z using (row_no) left join component c on c.node = d.doc_id"""

NEAR_VECTORS = f"""
with recursive vector as materialized (
  select row_number() over () as row_no, vec_id, embedding::double[] as x from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0 and len(list_filter(embedding, lambda e: e <> 0)) > 0
), pair as materialized (
  select a.row_no as x, b.row_no as y, a.vec_id as x_id, b.vec_id as y_id from vector a join vector b on a.row_no < b.row_no
  where case when len(a.x) = len(b.x) then list_cosine_similarity(a.x, b.x) end >= 0.95
), edge as materialized (
  select x_id as u, y_id as v from pair union select y_id, x_id from pair
), degree as (
  select row_no, count(*) as n_links from (select x as row_no from pair union all select y from pair) group by row_no
), {COMPONENTS}
select e.vec_id, coalesce(e.n_links, 0)::bigint as n_links, coalesce(c.component_id, e.vec_id) as component_id,
       coalesce(coalesce(c.component_id, e.vec_id) = e.vec_id, true) as kept
from (
  select v.vec_id, d.n_links from vector v left join degree d using (row_no)
  union all
  select vec_id, 0 from embeddings where vec_id is null or embedding is null
    or len(list_filter(embedding, lambda e: e is null or not isfinite(e))) > 0 or len(list_filter(embedding, lambda e: e <> 0)) = 0
) e left join component c on c.node = e.vec_id"""

HOST_RULES = f"""
with doc as materialized (
  select row_number() over () as row_no, doc_id, source, coalesce(text, '') as text, {PLAIN_WORDS.format("text")} as words from documents
), triple as (
  select row_no, pos, array_to_string(words[pos:pos + 2], ' ') as w
  from (select row_no, words, unnest(range(1, len(words) - 1)) as pos from doc where len(words) >= 3)
), again as (
  select row_no, pos from triple qualify count(*) over (partition by row_no, w) > 1
), repeated as (
  select row_no, count(distinct word) as n from (select row_no, unnest(range(pos, pos + 3)) as word from again) group by row_no
), figure as materialized (
  select doc_id, source, len(words)::bigint as n_words, len(array_to_string(words, ''))::bigint as word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         coalesce(n, 0)::bigint as n_repeat_words, len(lines) as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines
  from (select *, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines from doc)
       left join repeated using (row_no)
), judged as materialized (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         base_failed or n_symbols > 0.1::double * greatest(n_words, 1) or n_dup_lines > 0.3::double * greatest(n_lines, 1)
           or word_chars::double / greatest(n_words, 1) not between 2 and 12 as fails
  from figure
), host as (
  select source, count(*)::double as docs, count(*) filter (fails)::double as failed from judged group by source
), prior as (
  select avg(failed / docs) as m, var_samp(failed / docs) as seen, avg(1 / docs) as single from host
), spread as (
  select m, case when single < 1 then (seen - m * (1 - m) * single) / (1 - single) end as v from prior
), strong as (
  select m, case when v > 1e-12 then greatest(0, m * (1 - m) / v - 1) end as strength from spread
), rated as (
  select h.source, h.docs, s.m, s.strength,
         case when s.strength is null then s.m else (h.failed + s.strength * s.m) / (h.docs + s.strength) end as rate
  from host h cross join strong s
), verdict as (
  select source, rate > 0.5 as rejected,
         coalesce(rate - 2 * sqrt(rate * (1 - rate) / (docs + strength + 1)) > m, false) as suspect
  from rated
)
select j.doc_id, j.n_words, j.word_chars, j.n_symbols, j.n_dup_lines, j.n_repeat_words, j.base_failed,
       not (j.base_failed or v.rejected or (v.suspect and j.fails)) as kept
from judged j join verdict v on j.source is not distinct from v.source"""

LINE_DEDUP = f"""
with doc as materialized (
  select row_number() over () as row_no, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), line as materialized (
  select row_no, doc_id, pos, lines[pos] as line, {LOWER.format("regexp_replace(lines[pos], '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g')")} as k
  from (select *, unnest(range(1, len(lines) + 1)) as pos from doc)
), shared as (
  select k, min(doc_id) as first_doc from line where length(k) >= 10 group by k having count(distinct doc_id) >= 2
), told as (
  select l.*, coalesce(l.doc_id <> s.first_doc, false) as lost from line l left join shared s using (k)
)
select doc_id, count(*) as n_lines, count(*) filter (lost) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not lost), '')) as kept_sha256
from told group by row_no, doc_id"""

#: Rows that share a doc_id are put in order by their text here, by a digest of it in the query.
MIXING = f"""
with sized as materialized (
  select row_number() over () as row_no, doc_id, source, coalesce(text, '') as text, len({PLAIN_WORDS.format("text")})::bigint as size from documents
), drawn as materialized (
  select row_no, doc_id, source, text, size,
         -ln((('0x' || substr(md5('17:' || coalesce(cast(doc_id as varchar), 'null')), 1, 13))::bigint::double + 0.5) / 4503599627370496)
           / (1.0::double / (1.0::double + 8.0::double * len(regexp_replace(text, '[^#*$%&|<>!]', '', 'g')) / greatest(size, 1))) as draw
  from sized
), total as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source is null, source) as place from sized group by source
), bounded as (
  select *, [5, 2, 1][(place - 1) % 3 + 1] as w, 3 * source_size as bound from total
), filling as (
  select *, row_number() over f as turn, sum(source_size) over () as all_words,
         coalesce(sum(bound) over (f rows between unbounded preceding and 1 preceding), 0) as bound_before,
         coalesce(sum(w) over (f rows between unbounded preceding and 1 preceding), 0) as w_before, sum(w) over () as all_w
  from bounded window f as (order by bound::double / w, source is null, source)
), level as (
  select arg_min((all_words - bound_before)::double / (all_w - w_before)::double, turn) as height from filling
  where (all_words - bound_before)::double / (all_w - w_before)::double * w <= bound
), goal as (
  select source, source_size, case when height is null then bound::double else least(bound::double, height * w) end as target
  from filling cross join level
), budget as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs, round(target)::bigint - epochs * source_size as rest from goal
)
select d.doc_id, d.size, b.source_size, b.target,
       (b.epochs * d.size + greatest(0, least(d.size, b.rest - (sum(d.size) over (
          partition by d.source order by d.draw, d.doc_id, d.text, d.row_no rows between unbounded preceding and current row) - d.size))))::bigint as taken
from drawn d join budget b on d.source is not distinct from b.source"""
