"""The same results as the queries of this subpackage in DuckDB SQL, where SQL can express them."""

from wavelane.llm.queries import WEIGHTS


def _weight(level: str) -> str:
    cases = "".join(f" when '{name}' then {value}" for name, value in WEIGHTS[level].items())
    return f"(case {level}{cases} else 1 end)::hugeint"


def _poured(nodes: str, siblings: str, name: str) -> str:
    """Water filling of ``given`` over rows with ``weight`` and ``supply``; see ``mixing.water_fill``."""
    over = f"partition by {siblings}" if siblings else ""
    order = f"{over} order by supply::double / weight::double, {name} rows between unbounded preceding and 1 preceding"
    return f"""
  select *, (case when is_full then supply
    else ((given - sum(case when is_full then supply else 0 end) over ({over})) * weight)
      // sum(case when is_full then 0 else weight end) over ({over}) end)::hugeint as budget
  from (select *, before * weight + supply * (sum(weight) over ({over}) - weights_before) <= given * weight as is_full
    from (select *, coalesce(sum(supply) over ({order}), 0)::hugeint as before,
      coalesce(sum(weight) over ({order}), 0)::hugeint as weights_before from ({nodes})))"""


OP4 = f"""
with units as (
  select 'd' || (ascii(right(source, 1)) % 3) as domain, lang, source, doc_id,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as n_tokens
  from documents),
leaves as (select domain, lang, source, sum(n_tokens)::hugeint as tokens from units group by 1, 2, 3),
total as (select (sum(tokens) * 600000 // 1000000)::hugeint as given from leaves),
domains as ({_poured(f"select domain, sum(tokens) * 3 as supply, {_weight('domain')} as weight, any_value(given) as given from leaves, total group by 1", "", "domain")}),
langs as ({_poured(f"select l.domain, lang, sum(tokens) * 3 as supply, {_weight('lang')} as weight, any_value(budget) as given from leaves l join domains d on l.domain = d.domain group by 1, 2", "domain", "lang")}),
sources as ({_poured("select l.domain, l.lang, source, tokens * 3 as supply, 1::hugeint as weight, budget as given from leaves l join langs d on l.domain = d.domain and l.lang = d.lang", "domain, lang", "source")}),
planned as (
  select s.domain, s.lang, s.source, budget, budget // greatest(tokens, 1) as whole,
    budget - budget // greatest(tokens, 1) * tokens as rest
  from sources s join leaves l on s.domain = l.domain and s.lang = l.lang and s.source = l.source where tokens > 0),
ordered as (
  select u.*, budget, whole, rest, coalesce(sum(n_tokens) over (partition by u.domain, u.lang, u.source
    order by md5('0:' || whole || ':' || doc_id) rows between unbounded preceding and 1 preceding), 0) as before
  from units u join planned p on u.domain = p.domain and u.lang = p.lang and u.source = p.source)
select doc_id, unnest(range(copies::bigint))::int as epoch, n_tokens, budget::bigint as leaf_budget
from (select *, whole + case when before < rest then 1 else 0 end as copies from ordered) where copies > 0
"""

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(
    f"substr('{_LETTERS}', (((('0x' || substr(hex, {5 * group + 1}, 5))::int >> {shift}) & 31) + 1)::int, 1)"
    for group in range(8)
    for shift in (15, 10, 5, 0)
)

OP10 = f"""
with known as (select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hex from pages),
headed as (select *, max(page_id) over (partition by hex) as head from known)
select page_id, strlen(payload)::bigint as payload_bytes, {_BASE32} as payload_digest,
  case when page_id = head then 'response' else 'revisit' end as record_type,
  case when page_id <> head then head end as refers_to
from headed
"""

_CRC = """list_reduce(list_prepend(4294967295::ubigint, list_transform(range(1, strlen(name) + 1), lambda k: ascii(name[k])::ubigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::ubigint[]),
      lambda r, _: case when r % 2 = 1 then xor(r // 2, 3988292384::ubigint) else r // 2 end))"""
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# What the repaired turns end with: 0 nothing, 1 a system turn, 2 a user's, 3 an answer. A step of the recursion
# puts up to two turns in, then keeps, changes or deletes a turn; of each state the cheapest way stays.
_PUT_IN = """
  select conv_id, i, state, least.cost as cost, least.audit as audit, least.body as body from (
    select conv_id, i, state, arg_min({{'cost': cost, 'audit': audit, 'body': body}}, (cost, audit)) as least from (
      select conv_id, i, state, cost, audit, body from {ways}
      union all
      select conv_id, i, case state when 2 then 3 else 2 end, cost + 5, audit || 'I',
        list_append(body, case state when 2 then 'assistant:' else 'user:' end) from {ways}
      union all
      select conv_id, i, case state when 2 then 2 else 3 end, cost + 10, audit || 'II',
        body || case state when 2 then ['assistant:', 'user:'] else ['user:', 'assistant:'] end from {ways}
    ) group by conv_id, i, state)"""

OP13 = f"""
with recursive given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations),
faulty as (select *, xor({_CRC}, 4294967295::ubigint) % 20 as fault from given),
turns as (
  select conv_id, turn, case fault when 4 then 'user' else role end as role,
    case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from (select *, unnest(case when fault = 3 then [0, 1] else [0] end) as copy from faulty where fault > 0)),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i,
    trim(text, {_BLANKS}) as seen, left(role, 1) as initial from turns),
judged as (
  select *, case when seen = '' then 'blank'
    when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
    when right(seen, 1) not in ('.', '!', '?') then 'truncated' else '' end as wrong,
    lag(initial) over (partition by conv_id order by i) || initial not in ('su', 'ua', 'au') as odd
  from placed),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (wrong = 'blank') as blank, count(*) filter (wrong = 'duplicate') as duplicate,
    count(*) filter (wrong = 'truncated') as truncated, count(*) filter (odd) as illegal, count(*) as n
  from judged group by conv_id),
ways as (
  select distinct conv_id, 0::bigint as i, 0 as state, 0 as cost, '' as audit, []::varchar[] as body from given
  union all
  select conv_id, i, state, least.cost, least.audit, least.body from (
    select conv_id, i, state, arg_min({{'cost': cost, 'audit': audit, 'body': body}}, (cost, audit)) as least from (
      select w.conv_id, w.i + 1 as i, move.state as state, w.cost + move.cost as cost, w.audit || move.letter as audit,
        case when move.letter = 'D' then w.body else list_append(w.body, case move.letter when 'K' then j.role
          else case move.state when 2 then 'user' else 'assistant' end end || ':' || j.text) end as body
      from (select *, unnest([{{'letter': 'D', 'state': v.state}}, {{'letter': 'R', 'state': case v.state when 2 then 3 else 2 end}},
          {{'letter': 'K', 'state': case v.state when 2 then 3 when 0 then 1 else 2 end}}, {{'letter': 'K', 'state': 2}}]) as step
        from ({_PUT_IN.format(ways="ways")}) v) w
      join judged j on j.conv_id is not distinct from w.conv_id and j.i = w.i + 1
      cross join lateral (select step.letter as letter, step.state as state, case step.letter when 'D' then 2 when 'R' then 1 else 0 end
        + case when j.wrong = 'truncated' and step.letter <> 'D' then 5 else 0 end as cost) move
      where move.letter = 'D' or j.wrong not in ('blank', 'duplicate') and (move.letter = 'R'
        or move.state = 1 and w.state = 0 and j.initial = 's' or move.state = 2 and w.state <> 2 and j.initial = 'u'
        or move.state = 3 and j.initial = 'a')
    ) group by conv_id, i, state)),
ended as ({_PUT_IN.format(ways="ways")}),
best as (
  select e.conv_id, arg_min({{'cost': cost, 'audit': audit, 'body': body}}, (cost, audit)) as least
  from ended e left join counts c on c.conv_id is not distinct from e.conv_id
  where e.i = coalesce(c.n, 0) and state in (0, 3) group by e.conv_id)
select b.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, least.cost::bigint as cost, least.audit as audit,
  sha256(array_to_string(least.body, chr(10))) as repaired_sha256
from best b left join counts c on c.conv_id is not distinct from b.conv_id
"""

ORACLES: dict[str, str] = {"op4_mixing": OP4, "op10_warc": OP10, "op13_conversations": OP13}
