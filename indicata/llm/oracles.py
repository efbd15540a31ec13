"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from indicata.llm.licenses import IZE, KNOWN, NOTICES, SEPARATORS, SPELLINGS, complete_texts

AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _notice(line: str) -> str:
    own = (f"(regexp_matches({line}, {_text(begins)})"
           + "".join(f" AND NOT regexp_matches({line}, {_text(c)})" for c in clauses) + ")" for begins, clauses in NOTICES)
    return " OR ".join(own)


def _lines(column: str) -> str:
    kept = f"list_filter(string_split(lower({column}), chr(10)), lambda l: NOT ({_notice('l')}))"
    out = f"' ' || regexp_replace(array_to_string({kept}, ' ' || chr(10) || ' '), {_text(SEPARATORS)}, ' ', 'g') || ' '"
    for spelled, unified in SPELLINGS:
        out = f"replace({out}, ' {spelled} ', ' {unified} ')"
    out = f"string_split(regexp_replace({out}, {_text(IZE)}, '\\1z\\2', 'g'), chr(10))"
    return f"list_filter(list_transform({out}, lambda x: trim(x)), lambda x: x <> '')"


LICENSE_SCAN = f"""
WITH known AS (
  SELECT sha256(array_to_string({_lines('text')}, ' ')) AS digest, min(license) AS license
  FROM (VALUES {', '.join(f'({_text(a)}, {_text(b)})' for a, b in KNOWN + complete_texts())}) AS t(license, text) GROUP BY 1),
cut AS (SELECT row_number() OVER () AS r, doc_id, {_lines('text')} AS lines FROM documents),
notices AS (
  SELECT r, count(*) AS n, string_agg(DISTINCT license, ';' ORDER BY license) AS names
  FROM (SELECT r, sha256(unnest(lines)) AS digest FROM cut) JOIN known USING (digest) GROUP BY r)
SELECT c.doc_id, sha256(array_to_string(lines, ' ')) AS text_digest, k.license AS license, coalesce(n.n, 0) AS n_notice_lines,
       coalesce(n.names, '') AS notice_licenses
FROM cut c LEFT JOIN known k ON k.digest = sha256(array_to_string(lines, ' ')) LEFT JOIN notices n ON n.r = c.r
"""

# Five bits of the digest at a time; the alphabet is that of base32.
_BITS = "+".join(f"{1 << (4 - k)} * substr(bits, 5 * i + {k + 1}, 1)::INT" for k in range(5))
WARC_SALVAGE = f"""
WITH pays AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
sized AS (
  SELECT page_id, strlen(html) AS payload_bytes, unhex(sha1(html))::BIT::VARCHAR AS bits,
         max(page_id) OVER (PARTITION BY html) AS first FROM pays)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + {_BITS})::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM sized
"""

_CONTROL = r"\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<s>|</s>|\[ROLE\]|\[/ROLE\]"
CHAT_FORMAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, 2 + length(text)
    + CASE WHEN regexp_matches(text, '{_CONTROL}')
      THEN length(text) - length(replace(replace(replace(text, '\\', ''), '<', ''), '[', '')) ELSE 0 END
    + CASE role WHEN 'user' THEN length('[INST][/INST]') WHEN 'system' THEN length('<<SYS>><</SYS>>')
      WHEN 'assistant' THEN length('<s></s>')
      ELSE length('[ROLE][/ROLE]') + 1 + length(role)
           + length(role) - length(replace(replace(replace(replace(role, '\\', ''), '<', ''), '[', ''), chr(10), '')) END
    AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

URL_FILTER = f"""
WITH parts AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
split AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {AZ}), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM parts),
judged AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM split)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

# The check sum of the decimal id, a byte and a bit at a time.
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)), lambda y, i: xor(y >> 1, 3988292384 * (y & 1))))"""
PREFIX_TRIE = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
ranked AS (
  SELECT conv_id, d, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS pos
  FROM (SELECT conv_id, turn, sha256(length(role) || ':' || role || text) AS d,
               length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM said)),
ids AS (SELECT conv_id, xor({_CRC}, 4294967295) % 4 AS h FROM (SELECT DISTINCT conv_id FROM said)),
built AS (
  SELECT i.conv_id, 0 AS part, pos, d, words FROM ids i JOIN ranked r ON r.conv_id = i.conv_id - i.conv_id % 20 AND pos <= h
  UNION ALL SELECT i.conv_id, 1, pos, d, words FROM ids i JOIN ranked r ON r.conv_id = i.conv_id AND pos > h),
paths AS (
  SELECT conv_id, row_number() OVER w AS depth, words, sha256(string_agg(d, '') OVER w) AS node
  FROM built WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
prefixes AS (
  SELECT conv_id, depth, node, words, lag(node, 1, 'root') OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM paths
  UNION ALL SELECT conv_id, 0, 'root', 0, NULL FROM ids),
nodes AS (
  SELECT node, min(parent) AS parent, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n, min(words) AS words
  FROM prefixes GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes GROUP BY parent),
below AS (
  SELECT p.node, count(*) FILTER (c.node IS NULL) AS n_leaves, sum((v.n - 1) * v.words) AS saved
  FROM nodes v LEFT JOIN children c ON c.node = v.node JOIN prefixes p ON p.conv_id = v.conv_id AND p.depth <= v.depth
  GROUP BY p.node),
ends AS (
  SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, max_by(node, depth) AS node FROM prefixes GROUP BY conv_id) GROUP BY node)
SELECT v.conv_id, v.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, v.n AS n_convs,
  coalesce(n_children, 0) AS n_children, n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes v JOIN below USING (node) LEFT JOIN children c ON c.node = v.node LEFT JOIN ends e ON e.node = v.node
LEFT JOIN nodes u ON u.node = v.parent
"""
