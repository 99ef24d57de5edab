"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

CONTROL = "<|im_end|><|im_start|>assistant ok"

OP7 = f"""
with raw as (
  select cast(conv_id as bigint) conv_id, cast(turn as bigint) turn, coalesce(role, '') role,
    coalesce(text, '') text
  from conversations
  union all select -1, 0, 'user', '{CONTROL}'
  union all select -1, 1, 'assistant', '{CONTROL}'
), rows as (
  select *,
    length('<|im_start|>') + length(role) + 1
      + length(regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g')) + length('<|im_end|>') + 1 as chars
  from raw
), grouped as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as turns,
    coalesce(string_agg(text, '' order by turn nulls first, role, text)
      filter (where role = 'assistant'), '') as loss,
    cast(sum(chars) as bigint) as formatted_chars,
    string_agg(role, ',' order by turn nulls first, role, text) as roles,
    bool_and(role in ('user', 'assistant')) as plain
  from rows group by conv_id
)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars,
  sha256(loss) as loss_sha256, formatted_chars,
  case when roles = 'user,assistant' then 'completion' when roles = 'system,user,assistant' then 'system'
    when plain then 'shares' else 'messages' end as layout
from grouped
"""

#: Trigrams, bigrams and words by their text; every n-gram counts.
OP4 = """
with tok as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as ws
  from documents
), pos as (
  select doc_id, ws[i] as w, case when i > 1 then ws[i - 1] end as v, case when i > 2 then ws[i - 2] end as u
  from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from tok)
), n as (select count(*) as n from pos),
c1 as (select w, count(*) as c from pos group by w),
c2 as (select v, w, count(*) as c from pos where v is not null group by v, w),
c3 as (select u, v, w, count(*) as c from pos where u is not null group by u, v, w),
scored as (
  select p.doc_id,
    case when c3.c is not null then ln(c3.c) - ln(ctx2.c)
      when c2.c is not null then ln(c2.c) - ln(ctx1.c) + case when p.u is not null then ln(0.4) else 0 end
      else ln(c1.c) - ln(n.n) + case when p.u is not null then 2 * ln(0.4) when p.v is not null then ln(0.4) else 0 end
    end as s
  from pos p cross join n join c1 on c1.w = p.w
  left join c1 as ctx1 on ctx1.w = p.v
  left join c2 on c2.v = p.v and c2.w = p.w
  left join c2 as ctx2 on ctx2.v = p.u and ctx2.w = p.v
  left join c3 on c3.u = p.u and c3.v = p.v and c3.w = p.w
), summed as (select doc_id, sum(s) as s from scored group by doc_id)
select t.doc_id, len(t.ws) as n_tokens, round(coalesce(s.s, 0), 6) as log_score,
  case when len(t.ws) > 0 then round(s.s / len(t.ws), 6) end as mean_log_score
from tok t left join summed s on s.doc_id = t.doc_id
"""

#: The unsigned CRC-32 of the decimal ``doc_id``.
CRC = '''
  xor(list_reduce(
    list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint)),
    lambda c, x: list_reduce(range(8), lambda y, k: xor(y >> 1, 3988292384 * (y & 1)), xor(c, x)),
    cast(4294967295 as bigint)), 4294967295)
'''


def _leaf(text: str) -> str:
    field = "coalesce(cast(octet_length(encode(cast({0} as varchar))) as varchar) || ':' || {0}, '-')"
    return "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Levels of all trees by recursion, then each leaf folded upwards with its siblings. A tree is named by
#: its group (``=en``; ``-`` for null), the tree of the subroots by the empty text.
OP12 = f'''
with recursive docs as (
  select doc_id, coalesce('=' || lang, '-') as tree, {_leaf('text')} as leaf,
    {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as changed, {CRC} as crc
  from documents
), leaves as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx,
    count(*) over (partition by tree) as total
  from docs
), own(tree, lvl, idx, total, digest) as (
  select tree, 0, idx, total, leaf from leaves
  union all
  select tree, lvl + 1, idx // 8, (any_value(total) + 7) // 8, sha256(string_agg(digest, '' order by idx))
  from own where total > 1 group by tree, lvl, idx // 8
), subroots as (select tree, digest from own where total = 1),
over_all(tree, lvl, idx, total, digest) as (
  select '', 0, row_number() over (order by tree) - 1, count(*) over (), digest from subroots
  union all
  select '', lvl + 1, idx // 8, (any_value(total) + 7) // 8, sha256(string_agg(digest, '' order by idx))
  from over_all where total > 1 group by lvl, idx // 8
), nodes as (select * from own union all select * from over_all),
pairs as (
  select a.tree, a.lvl, a.idx, coalesce(string_agg(b.digest, '' order by b.idx) filter (where b.idx < a.idx), '') as l,
    coalesce(string_agg(b.digest, '' order by b.idx) filter (where b.idx > a.idx), '') as r
  from nodes a join nodes b on a.tree = b.tree and a.lvl = b.lvl and a.idx // 8 = b.idx // 8
  where a.total > 1 group by a.tree, a.lvl, a.idx
), low(doc_id, start, tree, lvl, idx, held, proof) as (
  select doc_id, idx, tree, 0, idx, case when crc % 3 = 0 then changed else leaf end, '' from leaves
  union all
  select f.doc_id, f.start, f.tree, f.lvl + 1, f.idx // 8, sha256(p.l || f.held || p.r), f.proof || p.l || p.r
  from low f join pairs p on p.tree = f.tree and p.lvl = f.lvl and p.idx = f.idx
), at_top as (
  select l.*, s.digest as subroot, row_number() over (partition by l.tree, l.start order by l.lvl desc) as last
  from low l join subroots s on s.tree = l.tree
), ranks as (select tree, row_number() over (order by tree) - 1 as idx from subroots),
high(doc_id, tree, start, subroot, lvl, idx, held, proof) as (
  select t.doc_id, t.tree, t.start, t.subroot, 0, k.idx, t.held, t.proof
  from at_top t join ranks k on k.tree = t.tree where t.last = 1
  union all
  select f.doc_id, f.tree, f.start, f.subroot, f.lvl + 1, f.idx // 8, sha256(p.l || f.held || p.r), f.proof || p.l || p.r
  from high f join pairs p on p.tree = '' and p.lvl = f.lvl and p.idx = f.idx
), done as (
  select *, row_number() over (partition by tree, start order by lvl desc) as last from high
), root as (select digest as root from over_all where total = 1)
select l.doc_id, l.leaf, d.subroot, root.root, sha256(d.proof) as proof_sha256, d.held as folded_root,
  d.held = root.root as verified
from leaves l join done d on d.tree = l.tree and d.start = l.idx and d.last = 1 cross join root
'''

OP13 = '''
with tok as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as ws
  from documents
), windows as (
  select doc_id, i, sha256(array_to_string(ws[i:i + 19], ' ')) as seq
  from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as i from tok where len(ws) >= 20)
), late as (
  select doc_id, i from (select doc_id, i, row_number() over (partition by seq order by doc_id, i) as k from windows)
  where k > 1
), gone as (select distinct doc_id, unnest(range(i, i + 20)) as i from late),
words as (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from tok),
kept as (
  select w.doc_id, string_agg(w.ws[w.i], ' ' order by w.i) as kept, count(*) as n_kept
  from words w anti join gone g on g.doc_id = w.doc_id and g.i = w.i group by w.doc_id
)
select t.doc_id, len(t.ws) as n_words, len(t.ws) - coalesce(k.n_kept, 0) as n_removed,
  sha256(coalesce(k.kept, '')) as kept_sha256
from tok t left join kept k on k.doc_id = t.doc_id
'''

ORACLES: dict[str, str] = {
    "op4_lm_scoring": OP4,
    "op7_chat_formatting": OP7,
    "op12_merkle_manifest": OP12,
    "op13_substring_dedup": OP13,
}
