"""The repair of damaged conversations for DuckDB: four least (cost, edits) by row, from the last row to the first."""


def _least(*ways: str) -> str:
    return f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1]"


def _put(name: str, rest: str) -> str:
    return f"{{'c': {rest}.c + 2, 'a': 'I' || {rest}.a, 't': list_prepend('{name}:', {rest}.t)}}"


def _row(state: int) -> str:
    """The cheapest way to delete, keep or rerole the row at hand in a state (0 nothing, 1 system, 2 user, 3 assistant written)."""
    to, name = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))[state]
    keep = {0: "CASE ini WHEN 's' THEN b1 WHEN 'u' THEN b2 END", 2: "CASE ini WHEN 'a' THEN b3 END"}.get(state, "CASE ini WHEN 'u' THEN b2 END")
    ways = [
        f"{{'c': b{state}.c + 3, 'a': 'D' || b{state}.a, 't': b{state}.t}}",
        f"CASE WHEN NOT gone AND ({keep}) IS NOT NULL THEN {{'c': ({keep}).c + late, 'a': 'K' || ({keep}).a, 't': list_prepend(line, ({keep}).t)}} END",
        f"CASE WHEN NOT gone THEN {{'c': b{to}.c + late + 2, 'a': 'R' || b{to}.a, 't': list_prepend('{name}:' || text, b{to}.t)}} END",
    ]
    return f"{_least(*ways)} AS v{state}"


_END = "{{'c': {}, 'a': '{}', 't': {}}}"
_NONE = "[]::VARCHAR[]"

REPAIR_SQL = rf"""
WITH RECURSIVE
bit AS (SELECT n, list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc
        FROM (SELECT unnest(range(256)) AS n)),
tab AS (SELECT list(crc ORDER BY n) AS t FROM bit),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
               list_concat([4294967295], list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda y: ascii(y)::BIGINT)),
               lambda c, k: xor(c >> 8, t[(xor(c, k) & 255) + 1])), 4294967295) % 20 AS kind FROM conversations, tab),
hit AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
               CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
               unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM src),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(
                 concat_ws(':', coalesce(length(conv_id::VARCHAR), -1), coalesce(conv_id::VARCHAR, ''), length(role), role, text)), copy) AS i,
               rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown FROM hit),
fault AS (SELECT *, CASE WHEN shown = '' THEN 'blank'
                         WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
                         WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS f,
                 lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM num),
one AS (SELECT conv_id, i, left(role, 1) AS ini, text, role || ':' || text AS line, f IN ('blank', 'duplicate') AS gone, (f = 'truncated')::INT AS late FROM fault),
sums AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (f = 'blank') AS blank, count(*) FILTER (f = 'duplicate') AS duplicate, count(*) FILTER (f = 'truncated') AS truncated,
                count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM fault GROUP BY conv_id),
dp(conv_id, i, b0, b1, b2, b3) AS (
  SELECT conv_id, n + 1, {_END.format(0, '', _NONE)}, {_END.format(4, 'II', "['user:', 'assistant:']")},
         {_END.format(2, 'I', "['assistant:']")}, {_END.format(0, '', _NONE)} FROM sums
  UNION ALL
  SELECT conv_id, i, {_least('v0', _put('user', 'w2'))}, {_least('v1', _put('user', 'w2'))}, w2, {_least('v3', _put('user', 'v2'))}
  FROM (SELECT *, {_least('v2', _put('assistant', 'v3'))} AS w2
        FROM (SELECT one.conv_id, one.i, {_row(0)}, {_row(1)}, {_row(2)}, {_row(3)}
              FROM dp JOIN one ON one.conv_id IS NOT DISTINCT FROM dp.conv_id AND one.i = dp.i - 1)))
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(b0.c, 0)::BIGINT AS cost, coalesce(b0.a, '') AS audit,
       sha256(coalesce(array_to_string(b0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN dp ON dp.conv_id IS NOT DISTINCT FROM a.conv_id AND dp.i = 1
"""
