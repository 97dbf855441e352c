"""Longer SQL counterparts, put together from their repeated parts."""

from __future__ import annotations

from candlewick.llm import codes
from candlewick.llm import conversations as conv

# crc32 byte by byte; the keys are ASCII.
_CRC = """
letters AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS codes)"""


def _crc(key: str) -> str:
    steps = f"list_prepend(4294967295, list_transform(string_split({key}, ''), lambda x: ord(x)::BIGINT))"
    return f"xor(list_reduce({steps}, lambda c, b: xor(c >> 8, codes[1 + (xor(c, b) & 255)])), 4294967295)"


def _least(candidates: list[str]) -> str:
    """The least struct of those that are not null."""
    return f"list_sort([{', '.join(candidates)}], 'ASC', 'NULLS LAST')[1]"


def _grown(state: str, inserted: str, cost: str, edit: str, text: str) -> str:
    message = "".join(f" || chr(10) || '{conv.TITLES[i]}:'" for i in inserted)
    return (
        f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {conv.INSERT * len(inserted)} + {cost}, "
        f"'a': {state}.a || '{'I' * len(inserted)}{edit}', 't': {state}.t{message}{text}}} END"
    )


def _insertions(state: int) -> list[tuple[str, int]]:
    """Messages inserted, none to two, and the state after them."""
    found = [("", state)]
    for _ in range(2):
        messages, last = found[-1]
        found.append((messages + conv.TURN[last], conv.AFTER[conv.TURN[last]][last]))
    return found


def _step() -> str:
    into: dict[int, list[str]] = {q: [] for q in range(4)}
    for source in range(4):
        for messages, state in _insertions(source):
            into[state].append(_grown(f"s{source}", messages, f"{conv.DELETE}", "D", ""))
            for initial, after in conv.AFTER.items():
                if after[state] is not None:
                    kept = _grown(f"s{source}", messages, "penalty", "K", " || chr(10) || role || ':' || text")
                    into[after[state]].append(f"CASE WHEN alive AND initial = '{initial}' THEN {kept} END")
            title = conv.TURN[state]
            new = _grown(f"s{source}", messages, f"{conv.RETITLE} + penalty", "R", f" || chr(10) || '{conv.TITLES[title]}:' || text")
            into[conv.AFTER[title][state]].append(f"CASE WHEN alive THEN {new} END")
    return ", ".join(f"{_least(into[q])} AS s{q}" for q in range(4))


def _end() -> str:
    done = [
        _grown(f"s{source}", messages, "0", "", "")
        for source in range(4)
        for messages, state in _insertions(source)
        if state in (conv.START, conv.ASSISTANT)
    ]
    return _least(done)


_BLANKS = "\\x20\\x09-\\x0D"

CONVERSATIONS = f"""
WITH RECURSIVE {_CRC},
dealt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations, letters),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, k
  FROM dealt, range(2) AS copies(k) WHERE kind <> 0 AND (k = 0 OR kind = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, k) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, k) AS copy
  FROM damaged),
rows AS MATERIALIZED (
  SELECT *, left(role, 1) AS initial,
         CASE WHEN NOT regexp_matches(text, '[^{_BLANKS}]') THEN 'blank' WHEN copy > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][{_BLANKS}]*$') THEN 'truncated' ELSE '' END AS fault,
         fault NOT IN ('blank', 'duplicate') AS alive, CASE fault WHEN 'truncated' THEN {conv.TRUNCATED} ELSE 0 END AS penalty,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s1,
         NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s2, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT walk.conv_id, walk.i + 1, {_step()}
  FROM walk JOIN rows ON rows.conv_id IS NOT DISTINCT FROM walk.conv_id AND rows.i = walk.i + 1),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id),
ended AS (
  SELECT walk.conv_id, i, coalesce(n, 0) AS n, gaps, blank, duplicate, truncated, illegal, {_end()} AS best
  FROM walk LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM walk.conv_id)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
       sha256(substr(best.t, 2)) AS repaired_sha256
FROM ended WHERE i = n
"""


def _nearest(books: str) -> str:
    """Every part with its nearest entry of ``books``, and the squared distance."""
    return f"""
  SELECT r, part, v, min(struct_pack(d := list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := entry)) AS best
  FROM parts JOIN {books} USING (part) GROUP BY r, part, v"""


def _round(number: int) -> str:
    """The entries after another round; those without parts stay."""
    books = f"books{number - 1}"
    return f"""
near{number} AS ({_nearest(books)}),
sums{number} AS (
  SELECT part, best.e AS entry, position, floor(sum(v[position])::DECIMAL(38, 0) / count(*)) AS x
  FROM near{number}, range(1, len(v) + 1) AS p(position) GROUP BY ALL),
books{number} AS (
  SELECT part, entry, coalesce(moved, c) AS c
  FROM {books} LEFT JOIN (
    SELECT part, entry, list(x::BIGINT ORDER BY position) AS moved FROM sums{number} GROUP BY ALL) USING (part, entry))"""


VECTORS = f"""
WITH whole AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * {codes.SCALE})::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT r, part, v[part * (len(v) // {codes.PARTS}) + 1 : (part + 1) * (len(v) // {codes.PARTS})] AS v
  FROM whole, range({codes.PARTS}) AS p(part)),
books0 AS (SELECT part, r AS entry, v AS c FROM parts WHERE r < {codes.ENTRIES}),{",".join(map(_round, range(1, codes.ROUNDS + 1)))},
final AS ({_nearest(f"books{codes.ROUNDS}")}),
coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
  FROM final GROUP BY r),
books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books{codes.ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM whole JOIN coded USING (r), books
"""
