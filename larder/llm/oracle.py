"""SQL for the queries that it can express, written from their contracts."""

from larder.llm import quality_rules

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
with texts as (select doc_id, {_WORDS} as ws from documents),
windows as (
  select doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) as win
  from (select doc_id, ws, unnest(range(1, len(ws) - 33)) as i from texts)),
repeated as (select win from windows group by win having count(*) > 1),
covered as (
  select distinct doc_id, unnest(range(i, i + 35)) as p from windows where win in (select win from repeated)),
left_over as (
  select doc_id, string_agg(word, ' ' order by p) as kept, count(*) as n
  from (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as p from texts)
  anti join covered using (doc_id, p) group by doc_id)
select doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from texts left join left_over using (doc_id)
"""

_CUTOFFS = ", ".join(f"({j}, {c})" for j, c in enumerate(quality_rules.CUTOFFS))
_RATE = quality_rules.RISK / len(quality_rules.RULES)

OP3 = rf"""
with texts as (
  select doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as t, {_WORDS} as ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
windows as (
  select doc_id, i, array_to_string(ws[i:i + 7], ' ') as win
  from (select doc_id, ws, unnest(range(1, len(ws) - 6)) as i from texts)),
repeats as (
  select doc_id, count(distinct p) as n from (
    select doc_id, unnest(range(i, i + 8)) as p
    from (select doc_id, i, count(*) over (partition by doc_id, win) as c from windows) where c > 1)
  group by doc_id),
measures as (
  select doc_id, stratum, cast(len(ws) as bigint) as n_words,
    cast(length(array_to_string(ws, '')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, len(lines) as n_lines,
    cast(coalesce(n, 0) as bigint) as n_repeat_words,
    length(regexp_replace(array_to_string(ws, ''), '[^A-Z!]', '', 'g')) as n_loud
  from texts left join repeats using (doc_id)),
shares as (
  select doc_id, stratum, unnest([0, 1, 2, 3]) as rule, unnest([
    n_symbols / nullif(word_chars, 0), n_dup_lines / nullif(n_lines, 0),
    n_repeat_words / nullif(n_words, 0), n_loud / nullif(word_chars, 0)]) as share
  from measures),
good as (select distinct doc_id from labels where quality = 1),
cutoffs as (select * from (values {_CUTOFFS}) c (j, cutoff)),
tests as (
  select stratum, rule, j, cutoff, count(*) as n, count(*) filter (coalesce(share, 0) > cutoff) as k
  from shares semi join good using (doc_id), cutoffs group by all),
tails as (
  select *, 4 * count(distinct stratum) over () as sequences,
    list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - case when i = 0 then 0 else lgamma(i + 1) end
      - case when i = n then 0 else lgamma(n - i + 1) end + i * ln({_RATE!r}) + (n - i) * ln(1 - {_RATE!r})))) as tail
  from tests),
passed as (
  select *, min(case when k < n * {_RATE!r} and tail <= {quality_rules.DELTA} / sequences then 1 else 0 end)
    over (partition by stratum, rule order by j) as safe
  from tails),
limits as (select stratum, rule, min(cutoff) as cutoff from passed where safe = 1 group by all),
over_limit as (select distinct doc_id from shares join limits using (stratum, rule) where share > cutoff)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and doc_id not in (select doc_id from over_limit) as kept
from measures
"""

OP10 = """
with recursive able as (
  select vec_id, embedding::double[] as e from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as x, b.vec_id as y from able a join able b
    on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (
  select x, y from links
  union select reach.x, links.y from reach join links on reach.y = links.x),
least as (select x, min(y) as y from reach group by x),
counted as (select x, count(*) as n from links group by x)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(y, vec_id)) as component_id,
  vec_id <= coalesce(y, vec_id) as kept
from embeddings left join least l on l.x = vec_id left join counted c on c.x = vec_id
"""


# CRC-32 has no function in SQL: a table of 256 remainders, and a fold over the bytes.
_CRC = """
crc_bits(i, c, step) as (
  select i, i, 0 from (select unnest(range(0, 256)) as i)
  union all
  select i, case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, step + 1 from crc_bits where step < 8),
crc_table as (select list(c order by i) as remainders from crc_bits where step = 8)"""


def _crc32(hex_text: str) -> str:
    """CRC-32 of the bytes written in ``hex_text``; ``remainders`` must be in scope."""
    byte = f"cast('0x' || substr({hex_text}, cast(2 * k + 1 as int), 2) as bigint)"
    bytes_ = f"list_transform(range(0, length({hex_text}) // 2), lambda k: {byte})"
    return f"xor(list_reduce({bytes_}, lambda c, b: xor(c >> 8, remainders[xor(c & 255, b) + 1]), 4294967295), 4294967295)"


OP12 = rf"""
with recursive {_CRC},
lowered as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-zÀ-ÿ]+')) as run from documents),
runs as (select run, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as h from lowered where length(run) >= 7),
checked as (select run, {_crc32("h")} as crc from runs, crc_table),
damaged as (
  select case when crc % 31 = 0 then left(run, crc % length(run)) || substr(run, crc % length(run) + 2) else run end as word from checked),
words as (select word, count(*) as n from damaged where length(word) >= 7 group by word having count(*) >= 2),
cut as (select word, n, unnest(range(1, length(word) + 1)) as p from words),
holes as (select word, n, p, left(word, p - 1) || substr(word, p + 1) as rest from cut),
near as (
  select a.word, b.word as other, b.n as m from holes a join holes b on a.p = b.p and a.rest = b.rest and a.word <> b.word
  union select a.word, b.word, b.n from holes a join words b on a.rest = b.word
  union select b.word, a.word, a.n from holes a join words b on a.rest = b.word),
best as (
  select word, count(*) as n_near, min({{'less': -m, 'other': other}}) as top from near group by word),
named as (
  select words.word, n, coalesce(n_near, 0) as n_near, case when -top.less >= 10 * n then top.other end as form,
    case when -top.less >= 10 * n then -top.less end as form_n
  from words left join best using (word)),
chain as (
  select word, word as root from named
  union all
  select chain.word, named.form from chain join named on chain.root = named.word where named.form is not null),
ends as (select chain.word, chain.root from chain join named on chain.root = named.word where named.form is null)
select named.word, form, root, n, n_near, form_n from named join ends using (word)
"""

# The cheapest way to each end state: its cost, edits and transcript, least in this order.
_WAY = "{'c': %s, 'e': %s, 't': %s}"


def _next(state: str, cost: str, edits: str, said: str) -> str:
    return f"case when {state}.c is not null then {_WAY % (f'{state}.c + {cost}', f'{state}.e || {edits}', said)} end"


def _least(*ways: str) -> str:
    return f"list_min(list_filter([{', '.join(ways)}], lambda w: w is not null))"


def _said(state: str, *lines: str) -> str:
    """The transcript of a way with more lines."""
    first, *more = lines
    later = "".join(f" || chr(10) || {x}" for x in more)
    return f"case when {state}.t is null then {first} else {state}.t || chr(10) || {first} end{later}"


def _kept(state: str, kind: str, before: tuple[str, ...]) -> list[str]:
    """Ways by which a row stays or is renamed, after rows put in."""
    name = {"u": "'user'", "a": "'assistant'"}[kind]
    put = [f"'{x}:'" for x in before]
    extra, mark = f"{3 * len(before)} + add_", "'" + "I" * len(before)
    stay = _next(state, extra, mark + "K'", _said(state, *put, "role || ':' || text"))
    renamed = _next(state, extra + " + 3", mark + "R'", _said(state, *put, f"{name} || ':' || text"))
    return [f"case when not gone then case when start = '{kind}' then {stay} else {renamed} end end"]


def _deleted(state: str) -> list[str]:
    return [_next(state, "4", "'D'", f"{state}.t")]


_STEP = ", ".join([
    f"{_least(*_deleted('e'))} as e",
    f"{_least(*_deleted('s'), 'case when not gone and start = chr(115) then ' + _next('e', 'add_', chr(39) + 'K' + chr(39), 'role || chr(58) || text') + ' end')} as s",
    f"{_least(*_deleted('u'), *_kept('e', 'u', ()), *_kept('s', 'u', ()), *_kept('a', 'u', ()), *_kept('u', 'u', ('assistant',)))} as u",
    f"{_least(*_deleted('a'), *_kept('u', 'a', ()), *_kept('e', 'a', ('user',)), *_kept('s', 'a', ('user',)), *_kept('a', 'a', ('user',)))} as a",
])
_FINISH = _least("e", "a", _next("u", "3", "'I'", _said("u", "'assistant:'")), _next("s", "6", "'II'", _said("s", "'user:'", "'assistant:'")))
_NO_WAY = "cast(null as struct(c bigint, e varchar, t varchar))"

OP13 = rf"""
with recursive {_CRC},
rows_ as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  hex(encode(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '))) as h from conversations),
kinds as (select *, {_crc32("h")} % 20 as kind from rows_, crc_table),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then replace(replace(replace(text, '.', ''), '!', ''), '?', '') else text end as text,
    unnest(range(0, case kind when 3 then 2 else 1 end)) as copy
  from kinds where kind <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(length(role) || ':' || role || ':' || text), copy) as place,
    left(role, 1) as start, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as inner_ from damaged),
marked as (
  select *, inner_ = '' as blank, inner_ <> '' and row_number() over (partition by conv_id, role, text order by place) > 1 as duplicate,
    lag(start) over (partition by conv_id order by place) as before from placed),
judged as (
  select *, blank or duplicate as gone, not blank and not duplicate and right(inner_, 1) not in ('.', '!', '?') as truncated from marked),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
    count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated,
    count(*) filter (before is not null and before || start not in ('su', 'ua', 'au')) as illegal, max(place) as size
  from judged group by conv_id),
steps as (select *, case when truncated then 3 else 0 end as add_ from judged),
ways as (
  select distinct conv_id, cast(0 as bigint) as place, {_WAY % ("cast(0 as bigint)", "''", "cast(null as varchar)")} as e,
    {_NO_WAY} as s, {_NO_WAY} as u, {_NO_WAY} as a from conversations
  union all
  select ways.conv_id, steps.place, {_STEP}
  from ways join steps on ways.conv_id is not distinct from steps.conv_id and steps.place = ways.place + 1),
best as (select conv_id, place, {_FINISH} as way from ways)
select best.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, way.c as cost, way.e as audit, sha256(coalesce(way.t, '')) as repaired_sha256
from best left join counted on best.conv_id is not distinct from counted.conv_id where best.place = coalesce(size, 0)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": OP1, "op3_quality_rules": OP3, "op10_embedding_dedup": OP10,
        "op12_spelling_variants": OP12, "op13_conversation_repair": OP13}
