"""SQL for the checking database that states the results of the queries SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK_WORD = "[^\\x20\\x09-\\x0D]+"
TERM = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

CHAT = """
with said as (
  select conv_id, turn, role, text, turn // 64 as part,
    row_number() over (partition by conv_id, turn // 64 order by turn nulls first, role nulls first, text nulls first) - 1 as n
  from conversations
), speakers as (
  select distinct conv_id, role as participant from conversations where role is not null and role <> 'system'
), shown as (
  select s.conv_id, participant, part, n // 64 as piece, n, coalesce(role = participant, false) as own,
    regexp_replace(replace(replace(coalesce(role, 'unknown'), '<\\', '<\\\\'), '<|', '<\\|'), '\\s+', '_', 'g') as name, role,
    replace(replace(coalesce(text, ''), '<\\', '<\\\\'), '<|', '<\\|') || '<|im_end|>' as body
  from said s join speakers p on s.conv_id is not distinct from p.conv_id
), headed as (
  select *, '<|im_start|>' || case when own then 'assistant' when role = 'system' then name else 'user name=' || name end || chr(10) as head
  from shown
), placed as (
  select *, coalesce(sum(length(head) + length(body) + 1) over (
    partition by conv_id, participant, part, piece order by n rows between unbounded preceding and 1 preceding), 0) + length(head) as start
  from headed
)
select conv_id, participant, part, piece, count(*)::int as n_turns,
  string_agg(head || body || chr(10), '' order by n) as text,
  coalesce(string_agg(start || '-' || (start + length(body)), ',' order by n) filter (where own), '') as spans,
  coalesce(sum(length(body)) filter (where own), 0)::int as trained_chars
from placed group by all
"""

DECONTAMINATION = f"""
with item_words as (
  select coalesce(item_id::varchar, '') as item, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') as w from benchmark
), cuts as (
  select item, w, unnest(range(1, greatest(len(w) - 8, 2))) as s from item_words where len(w) > 0
), phrases as (
  select distinct item, array_to_string(w[s:s + 9], ' ') as phrase, len(w[s:s + 9]) as k from cuts
), docs as (
  select doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}'), []) as w from documents
), lengths as (
  select distinct k from phrases
), places as (
  select doc_id, k, w, unnest(range(1, len(w) - k + 2)) as s from docs, lengths where len(w) >= k
), found as (
  select doc_id, s, p.k, item from places l join phrases p on p.k = l.k and p.phrase = array_to_string(l.w[l.s:l.s + l.k - 1], ' ')
), words as (
  select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(s, s + k)) as place from found) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
  from (select distinct doc_id, item from found) group by doc_id
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (doc_id) left join items using (doc_id)
"""

RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
RULE_ROWS = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in RULES)
TWO_LABELS = "'co.uk','org.uk','ac.uk','com.au','co.jp','co.nz','com.br','co.in','co.za','com.cn'"


TRIALS = 33


def _trials(source: str, low: str, high: str) -> str:
    """The log likelihood of each trial value of the outcomes' correlation within the groups of a level."""
    return f"""select k, x, round(sum(lgamma(bad + w * m) - lgamma(w * m) + lgamma(n - bad + w - w * m) - lgamma(w - w * m) - lgamma(n + w) + lgamma(w)), 6) as fit
      from (select *, 1 / x - 1 as w from (select k, {low} * pow({high} / {low}, k / {TRIALS - 1}.0::double) as x from range({TRIALS}) t(k))),
        (select * from {source} where n > 1 and m between 1e-12 and 1 - 1e-12) group by k, x"""


def shrunk(source: str) -> str:
    """A level's posterior: the correlation of the largest beta-binomial likelihood, of a coarse row and of a finer one; then the mean."""
    coarse = f"select x, lag(x, 1, x) over (order by k) as lower, lead(x, 1, x) over (order by k) as upper, k, fit from ({_trials(source, '0.0001::double', '0.5::double')})"
    best = f"select * from ({coarse}) order by fit desc, k limit 1"
    fine = _trials(source, f"(select lower from ({best}))", f"(select upper from ({best}))")
    return f"""select *, (w * m + bad) / (w + n) as mean from (
      select *, 1 / coalesce((select x from ({fine}) order by fit desc, k limit 1), 0.1) - 1 as w from {source})"""


REPUTATION = f"""
with parsed as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), split as (
  select page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') as host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path from parsed
), known as (
  select doc_id as page_id, max((quality = 0 or toxic = 1)::int) as bad from labels
  where (quality = 0 or toxic = 1) is not null group by doc_id
), sites as (
  select host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as site,
    count(bad)::double as n, coalesce(sum(bad), 0)::double as bad
  from split left join known using (page_id) group by host
), labelled as (
  select *, string_split(site, '.') as l, array_to_string(string_split(site, '.')[-2:], '.') as two,
    array_to_string(string_split(site, '.')[-3:], '.') as three from sites
), hosts as (
  select host, n, bad,
    case when regexp_matches(site, '^[0-9.]*$') then site when two in ({TWO_LABELS}) then three else two end as domain,
    case when regexp_matches(site, '^[0-9.]*$') then '' when two in ({TWO_LABELS}) then two else l[-1] end as suffix
  from labelled
), s0 as (
  select suffix, sum(n) as n, sum(bad) as bad, (select (sum(bad) + 1.0) / (sum(n) + 2.0) from hosts) as m from hosts group by suffix
), s1 as ({shrunk("s0")}),
d0 as (
  select h.domain, h.suffix, sum(h.n) as n, sum(h.bad) as bad, any_value(s1.mean) as m
  from hosts h join s1 using (suffix) group by h.domain, h.suffix
), d1 as ({shrunk("d0")}),
h0 as (select h.host, h.n, h.bad, d1.mean as m from hosts h join d1 using (domain, suffix)),
h1 as ({shrunk("h0")}),
fits as (
  select page_id, host, path, r.v, r.h || r.p as rule, row_number() over (
    partition by page_id order by length(r.h || r.p) desc, r.v desc, r.h || r.p desc) as nth
  from split join (values {RULE_ROWS}) r(v, h, p)
    on (host = r.h or ends_with(host, '.' || r.h)) and starts_with(path, r.p)
)
select p.page_id, p.host, p.path, f.rule,
  coalesce(f.v, case when mean - 1.645 * sqrt(mean * (1 - mean) / (w + n + 1)) > 0.5 then 'block' else 'allow' end) as verdict,
  case when f.rule is null then 'reputation' else 'rule' end as basis
from split p join h1 using (host) left join fits f on f.page_id = p.page_id and f.nth = 1
"""

LINES = f"""
with listed as (
  select doc_id, string_split(text, chr(10)) as l from documents
), cut as (
  select doc_id, unnest(l) as line, generate_subscripts(l, 1) - 1 as i from listed
), numbered as (
  select *, len(regexp_extract_all(line, '{BLANK_WORD}')) as own, row_number() over (order by doc_id, i) as place from cut
), pairs as (
  select b.doc_id, b.i, b.own, a.doc_id as earlier, b.i - a.i as shift from numbered a join numbered b on a.line = b.line and a.place < b.place
), runs as (
  select *, i - row_number() over (partition by doc_id, earlier, shift order by i) as run from pairs
), long as (
  select doc_id, min(i) as first, max(i) as last from runs group by doc_id, earlier, shift, run having sum(own) >= 25
), gone as (
  select distinct doc_id, unnest(range(first, last + 1)) as i from long
)
select doc_id, count(c.i)::int as n_lines, count(g.i)::int as n_removed,
  coalesce(string_agg(g.i::varchar, ',' order by g.i), '') as removed,
  case when any_value(d.text) is not null then coalesce(string_agg(c.line, chr(10) order by c.i) filter (where g.i is null), '') end as clean_text
from documents d left join cut c using (doc_id) left join gone g using (doc_id, i) group by doc_id
"""

NEAR = f"""
with recursive docs as (
  select doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{BLANK_WORD}'), []) as w from documents
), shingles as (
  select distinct doc_id, array_to_string(w[s:s + 2], ' ') as shingle
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as s from docs where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as k from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id
  group by all
), links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)
), either as (
  select a, b from links union all select b, a from links
), reach as (
  select doc_id as node, doc_id as seen from docs union select node, b from reach join either on seen = a
), least as (
  select node as doc_id, min(seen) as component_id from reach group by node
)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from docs left join sizes using (doc_id) join least using (doc_id)
"""

NEAREST = """
with usable as (
  select vec_id, embedding::double[] as v from embeddings
  where vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs as (
  select q.vec_id as query_id, c.vec_id,
    list_dot_product(q.v, c.v) / (sqrt(list_dot_product(c.v, c.v)) * sqrt(list_dot_product(q.v, q.v))) as score
  from usable q join usable c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from pairs qualify rank <= 5
"""

def crc32_of(ascii: str) -> str:
    """CRC-32 of an expression of ASCII text, bit by bit with the reversed polynomial 0xEDB88320."""
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, z: xor(x >> 1, 3988292384::bigint * (x & 1)))"
    codes = f"list_transform(string_split({ascii}, ''), lambda x: ord(x)::bigint)"
    return f"xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint, {codes}), lambda c, b: {byte}))"


WARC = """
with payloads as (
  select page_id, url, coalesce(html, '') as payload from pages
), judged as (
  select page_id, strlen(payload) as payload_bytes, sha256(payload) as payload_digest,
    row_number() over (partition by payload order by page_id nulls last, url nulls first) as nth,
    first_value(page_id) over (partition by payload order by page_id nulls last, url nulls first) as first_id
  from payloads
)
select page_id, payload_bytes, payload_digest, case when nth > 1 and payload_bytes >= 100 then 'revisit' else 'response' end as record_type,
  case when nth > 1 and payload_bytes >= 100 then first_id end as refers_to
from judged
"""

MERKLE_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def merkle_leaf(fields: tuple[str, ...]) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in fields) + ")"


MERKLE = f"""
with recursive leaves as (
  select doc_id, coalesce('1' || source, '0') as tree, {merkle_leaf(MERKLE_FIELDS)} as leaf,
    {merkle_leaf((*MERKLE_FIELDS[:-1], "lost"))} as found
  from (select *, case when doc_id is not null and crc % 2 = 0 then replace(text, chr(10), '') else text end as lost
    from (select *, {crc32_of("coalesce(doc_id::varchar, '0')")} as crc from documents))
), placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by tree) as n from leaves
), nodes as (
  select tree, 0 as lvl, idx, leaf as hash, n from placed
  union all
  select tree, lvl + 1, idx // 3, sha256(string_agg(hash, '' order by idx)), any_value((n + 2) // 3) from nodes where n > 1 group by tree, lvl, idx // 3
), tops as (
  select tree, lvl as height, hash, row_number() over (order by tree) - 1 as idx, count(*) over () as n from nodes where n = 1
), crown as (
  select 0 as lvl, idx, hash, n from tops
  union all
  select lvl + 1, idx // 3, sha256(string_agg(hash, '' order by idx)), any_value((n + 2) // 3) from crown where n > 1 group by lvl, idx // 3
), steps as (
  select t.tree, p.idx as leaf_idx, l.lvl, l.tree as of, l.idx, l.idx // 3 as run
  from placed p join tops t using (tree) join nodes l on l.tree = p.tree and l.n > 1 and l.idx = p.idx // (3 ** l.lvl)::bigint
  union all
  select t.tree, p.idx, t.height + c.lvl, null, c.idx, c.idx // 3
  from placed p join tops t using (tree) join crown c on c.n > 1 and c.idx = t.idx // (3 ** c.lvl)::bigint
), runs as (
  select tree as of, lvl, idx // 3 as run, idx, hash from nodes where n > 1
), crown_runs as (
  select lvl, idx // 3 as run, idx, hash from crown where n > 1
), sides as (
  select s.tree, s.leaf_idx, s.lvl, coalesce(string_agg(r.hash, '' order by r.idx) filter (where r.idx < s.idx), '') as l,
    coalesce(string_agg(r.hash, '' order by r.idx) filter (where r.idx > s.idx), '') as r
  from steps s join runs r on s.of = r.of and s.lvl = r.lvl and s.run = r.run group by all
  union all
  select s.tree, s.leaf_idx, s.lvl, coalesce(string_agg(r.hash, '' order by r.idx) filter (where r.idx < s.idx), ''),
    coalesce(string_agg(r.hash, '' order by r.idx) filter (where r.idx > s.idx), '')
  from steps s join tops t on t.tree = s.tree join crown_runs r on s.of is null and s.lvl - t.height = r.lvl and s.run = r.run group by all
), walk as (
  select tree, idx as leaf_idx, 0 as lvl, found as hash from placed
  union all
  select w.tree, w.leaf_idx, w.lvl + 1, sha256(s.l || w.hash || s.r) from walk w join sides s using (tree, leaf_idx, lvl)
), ends as (
  select tree, leaf_idx, arg_max(hash, lvl) as folded_root from walk group by all
), proofs as (
  select tree, leaf_idx, string_agg(l || r, '' order by lvl) as proof from sides group by all
)
select doc_id, leaf, t.hash as subroot, c.hash as root, sha256(coalesce(proof, '')) as proof_sha256, folded_root, folded_root = c.hash as verified
from placed p join tops t using (tree) join crown c on c.n = 1 join ends e on e.tree = p.tree and e.leaf_idx = p.idx
left join proofs f on f.tree = p.tree and f.leaf_idx = p.idx
"""

def repair_moves() -> str:
    """(state, kind of the row or NULL for any, whether it must go, letters, cost, state after) of inserts and a row's edit."""
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    rows = []
    for state in ("", "s", "u", "a"):
        now = state
        for inserts in range(3):
            turn = "a" if now == "u" else "u"
            before, cost = "I" * inserts, 3 * inserts
            rows.append(f"('{state}', null, null, '{before}D', {cost + 4}, '{now}')")
            rows.append(f"('{state}', null, false, '{before}R', {cost + 3}, '{turn}')")
            rows += [f"('{state}', '{kind}', false, '{before}K', {cost}, '{to}')" for (at, kind), to in follow.items() if at == now]
            now = turn
    return ", ".join(rows)


BLANK_CHARS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

REPAIR = f"""
with recursive fated as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {crc32_of("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as fate from conversations
), damaged as (
  select conv_id, turn, case when fate = 4 then 'user' else role end as role,
    case fate when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(case when fate = 3 then [1, 2] else [1] end) as copy
  from fated where fate <> 0
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(strlen(role) || ':' || role || text), copy) - 1 as i,
    rtrim(text, {BLANK_CHARS}) as kept from damaged
), judged as (
  select *, case when kept = '' then 'blank' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
    when right(kept, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
    lead(substr(role, 1, 1)) over (partition by conv_id order by i) as follower from placed
), counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
    count(*) filter (where fault = 'truncated') as truncated,
    count(*) filter (where follower is not null and substr(role, 1, 1) || follower not in ('su', 'ua', 'au')) as illegal, count(*) as n
  from judged group by conv_id
), moves(state, kind, gone, letters, cost, after) as (values {repair_moves()}
), best as (
  select conv_id, 0::bigint as i, '' as state, '000000' as found from counts
  union all
  select b.conv_id, b.i + 1, m.after, min(printf('%06d', b.found[:6]::int + m.cost + case when fault = 'truncated' and m.letters not like '%D' then 3 else 0 end) || b.found[7:] || m.letters)
  from best b join judged r on r.conv_id is not distinct from b.conv_id and r.i = b.i
    join moves m on m.state = b.state and (m.kind is null or m.kind = substr(role, 1, 1)) and (m.gone is null or fault not in ('blank', 'duplicate'))
  group by b.conv_id, b.i, m.after
), ended as (
  select c.conv_id, min(printf('%06d', found[:6]::int + case state when 'u' then 3 when 's' then 6 else 0 end) || found[7:] || case state when 'u' then 'I' when 's' then 'II' else '' end) as found
  from best b join counts c on c.conv_id is not distinct from b.conv_id and c.n = b.i group by c.conv_id
), letters as (
  select conv_id, found[7:] as audit, unnest(range(1, len(found) - 5)) as p from ended
), steps as (
  select conv_id, p, audit[p] as letter, coalesce(len(replace(audit[:p - 1], 'I', '')), 0) as i,
    coalesce(len(replace(audit[:p - 1], 'D', '')), 0) as o from letters
), shaped as (
  select s.*, r.role, r.text, max(case when letter = 'K' and substr(r.role, 1, 1) = 's' then 1 else 0 end) over (partition by s.conv_id) as led
  from steps s left join judged r on r.conv_id is not distinct from s.conv_id and r.i = s.i and letter <> 'I'
), repaired as (
  select conv_id, sha256(string_agg(case when letter = 'K' then role when (o - led) % 2 = 0 then 'user' else 'assistant' end || ':' || coalesce(text, ''), chr(10) order by p)) as hash
  from shaped where letter <> 'D' group by conv_id
), asked as (
  select distinct conv_id from conversations
)
select a.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(found[:6]::bigint, 0) as cost, coalesce(found[7:], '') as audit, coalesce(hash, sha256('')) as repaired_sha256
from asked a left join counts c on c.conv_id is not distinct from a.conv_id left join ended e on e.conv_id is not distinct from a.conv_id
left join repaired r on r.conv_id is not distinct from a.conv_id
"""

ORACLES = {
    "op2_chat_perspectives": CHAT,
    "op3_decontaminate": DECONTAMINATION,
    "op6_host_reputation": REPUTATION,
    "op7_dedup_lines": LINES,
    "op8_near_duplicates": NEAR,
    "op10_nearest": NEAREST,
    "op11_warc_records": WARC,
    "op12_merkle_manifest": MERKLE,
    "op13_repair_conversations": REPAIR,
}
