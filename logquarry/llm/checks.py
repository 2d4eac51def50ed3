"""Checks in SQL of the operators that repair conversations and group spellings."""

from __future__ import annotations

# A table of 256 values for the check sum, by its rule.
_CRC_TABLE = """crc_table as (
  select list(v order by i) as crc_values from (
    select i, list_reduce([i, 1, 1, 1, 1, 1, 1, 1, 1],
                          lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
    from range(256) r(i)))"""


def _crc32(column: str) -> str:
    """crc32 of the UTF-8 bytes of a text, beside the values of ``crc_table``."""
    size = f"octet_length(encode({column}))"
    byte = f"cast('0x' || hex(encode({column}))[2 * j + 1 : 2 * j + 2] as bigint)"
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range({size}), lambda j: {byte})),
               lambda c, b: xor(c >> 8, crc_values[(xor(c, b) & 255) + 1])))"""


def _best(*options: str) -> str:
    return "least(" + ", ".join(options) + ")"


def _edit(after: str, cost: str, edit: str, line: str = "''") -> str:
    return f"{{'c': {after}.c + {cost}, 'r': '{edit}' || {after}.r, 't': {line} || {after}.t}}"


_STATES = ("e", "s", "u", "a")
_FOLLOWS = {"e": "u", "s": "u", "u": "a", "a": "u"}
_NAMES = {"u": "user", "a": "assistant"}
_KEPT = {"e": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}


def _row_edits(state: str) -> str:
    """The best of a row's own edits in a state."""
    to = _FOLLOWS[state]
    line = f"'{_NAMES[to]}:' || f.text || chr(10)"
    options = [_edit(f"b.{state}", "2", "D")]
    free = [_edit(f"b.{to}", "1 + extra", "R", line)]
    worst = "{'c': 1000000000000, 'r': '', 't': ''}"
    options += [f"case when not forced then {free[0]} else {worst} end"]
    for kept in _KEPT[state]:
        option = _edit(f"b.{kept}", "extra", "K", "f.role || ':' || f.text || chr(10)")
        options.append(f"case when not forced and kind = '{kept}' then {option} else {worst} end")
    return f"{_best(*options)} as {state}"


def _inserted(state: str, of: str) -> str:
    to = _FOLLOWS[state]
    return _edit(of, "5", "I", f"'{_NAMES[to]}:' || chr(10)")


REPAIR = f"""
    with recursive {_CRC_TABLE},
    given as (
      select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
             coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as named
      from conversations),
    fated as (select *, {_crc32('named')} % 20 as fate from given, crc_table),
    damaged as (
      select conv_id, turn, case when fate = 4 then 'user' else role end as role,
             case when fate = 1 then '' when fate = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
             unnest(range(case when fate = 3 then 2 else 1 end)) as copy
      from fated where fate <> 0),
    numbered as (
      select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged),
    coded as (
      select *, row_number() over (partition by conv_id, role, text order by i) > 1 as again, left(role, 1) as kind,
             coalesce(kind_before || left(role, 1) not in ('su', 'ua', 'au'), false) as illegal,
             regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) as final
      from (select *, lag(left(role, 1)) over (partition by conv_id order by i) as kind_before from numbered)),
    faulty as (
      select *, final = '' as is_blank, final <> '' and again as is_again,
             final <> '' and not again and final not in ('.', '!', '?') as is_cut,
             final = '' or again as forced,
             case when final <> '' and not again and final not in ('.', '!', '?') then 5 else 0 end as extra
      from coded),
    counts as (
      select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
             count(*) filter (is_blank) as blank, count(*) filter (is_again) as duplicate,
             count(*) filter (is_cut) as truncated, count(*) filter (illegal) as illegal, count(*) as n
      from faulty group by conv_id),
    best as (
      select conv_id, n + 1 as i, {{'c': 0, 'r': '', 't': ''}} as e,
             {{'c': 10, 'r': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)}} as s,
             {{'c': 5, 'r': 'I', 't': 'assistant:' || chr(10)}} as u, {{'c': 0, 'r': '', 't': ''}} as a
      from counts
      union all
      select conv_id, i, {_best('e', _inserted('e', 'u'))}, {_best('s', _inserted('s', 'u'))}, u, a
      from (select conv_id, i, e, s, {_best('u', _inserted('u', 'a'))} as u, {_best('a', _inserted('a', 'u'))} as a
            from (select f.conv_id, f.i, {', '.join(map(_row_edits, _STATES))}
                  from best b join faulty f on f.conv_id is not distinct from b.conv_id and f.i = b.i - 1)))
    select g.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
           coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(b.e.c, 0) as cost,
           coalesce(b.e.r, '') as audit, sha256(coalesce(left(b.e.t, length(b.e.t) - 1), '')) as repaired_sha256
    from (select distinct conv_id from conversations) g
    left join counts c on g.conv_id is not distinct from c.conv_id
    left join best b on g.conv_id is not distinct from b.conv_id and b.i = 1
"""

SPELLING = f"""
    with recursive {_CRC_TABLE},
    runs as (
      select doc_id, word, count(*) as times
      from (select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as word from documents)
      where length(word) >= 5 group by doc_id, word),
    summed as (
      select *, {_crc32('named')} as h
      from (select *, coalesce(cast(doc_id as varchar), '') || ':' || word as named from runs), crc_table),
    slipped as (
      select case when h % 97 = 0
                  then word[1 : cast(h % length(word) as int)] || word[cast(h % length(word) as int) + 2 :]
                  else word end as word, times from summed),
    words as (
      select word, cast(sum(times) as bigint) as n from slipped where length(word) >= 5 group by word having sum(times) >= 3),
    less as (
      select word, n, i, word[1 : i - 1] || word[i + 1 :] as rest
      from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
    near as (
      select a.word, b.word as other, b.n as other_n from less a join less b on a.i = b.i and a.rest = b.rest and a.word <> b.word
      union select a.rest, a.word, a.n from less a
      union select a.word, b.word, b.n from less a join words b on a.rest = b.word),
    ranked as (
      select w.word, w.n, other, other_n, count(other) over (partition by w.word) as n_near,
             row_number() over (partition by w.word order by other_n desc nulls last, encode(other)) as place
      from words w left join near using (word)),
    formed as (
      select word, n, n_near, case when other_n >= 2 * n then other end as form, case when other_n >= 2 * n then other_n end as form_n
      from ranked where place = 1),
    followed as (
      select word, word as root, form as next from formed
      union all
      select f.word, f.next, g.form from followed f join formed g on f.next = g.word)
    select word, form, root, n, n_near, form_n from formed join (select word, root from followed where next is null) using (word)
"""
