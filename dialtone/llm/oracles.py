"""DuckDB statements for the queries of this folder that SQL can express.

The others (trained models, connected components, pseudorandom mixes, approximate
search) are tested against brute force, round trips or held-out labels in tests/llm.
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

BENCHMARK_DECONTAMINATION = f"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL
), sized AS (
  SELECT item_id, w, least(13, len(w)) AS n FROM item_words WHERE len(w) > 0
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
), doc_words AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS}, []) AS w FROM documents
), doc_windows AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc_words, (SELECT DISTINCT n FROM sized) WHERE len(w) >= n)
), hits AS (
  SELECT rid, i, n, item_id FROM doc_windows JOIN item_windows USING (n, win)
), hit_words AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM hits)) GROUP BY rid
), hit_items AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""


def _escaped(text: str) -> str:
    for mark, safe in (("\\", "\\\\"), ("<s>", "<\\s>"), ("</s>", "<\\/s>"), ("[INST]", "[\\INST]"), ("[/INST]", "[\\/INST]")):
        text = f"replace({text}, '{mark}', '{safe}')"
    return text


CHAT_FORMATTING = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, n, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(n, r)
), placed AS (
  SELECT *, row_number() OVER o AS pos, lag(role) OVER o IS DISTINCT FROM role AS begins
  FROM said WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length({_escaped('text')}) + CASE WHEN begins THEN length({_escaped('role')}) + 13 ELSE 7 END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""

#: crc32 by shifts: a byte enters with the first of eight, 0xEDB88320 is its polynomial.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda x, e: xor(xor(x, e) >> 1, (xor(x, e) & 1) * 3988292384)), 4294967295)"""

PREFIX_TRIE = rf"""
WITH placed AS (
  SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(said ORDER BY pos) AS said, {_CRC32} % 4 AS h FROM placed GROUP BY conv_id
), lines AS (
  SELECT o.conv_id, list_concat(coalesce(b.said[1:o.h], []), o.said[o.h + 1:]) AS line
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
), members AS (
  SELECT conv_id, d, line[1:d] AS prefix, len(line) = d AS ends FROM (SELECT *, unnest(range(0, len(line) + 1)) AS d FROM lines)
), nodes AS (
  SELECT prefix, d, min(conv_id) AS c, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY prefix, d
), named AS (
  SELECT m.conv_id, n.* FROM members m JOIN nodes n USING (prefix, d)
), linked AS (
  SELECT n.c, n.d, p.c AS parent, n.n_convs, n.ends_sha256,
         (n.n_convs - 1) * CASE WHEN n.d = 0 THEN 0 ELSE len(regexp_extract_all(n.prefix[n.d].text, '[^ 	-]+')) END AS saved
  FROM nodes n LEFT JOIN named p ON p.conv_id = n.c AND p.d = n.d - 1
), counted AS (
  SELECT l.*, (SELECT count(*) FROM linked k WHERE k.parent = l.c AND k.d = l.d + 1) AS n_children FROM linked l
), below AS (
  SELECT a.c, a.d, count(*) FILTER (l.n_children = 0) AS n_leaves, CAST(sum(l.saved) AS BIGINT) AS saved_tokens
  FROM counted l JOIN named a ON a.conv_id = l.c AND a.d <= l.d GROUP BY a.c, a.d
)
SELECT c AS conv_id, d AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM counted JOIN below USING (c, d)
"""

ORACLES = {
    "op1_benchmark_decontamination": BENCHMARK_DECONTAMINATION,
    "op4_chat_formatting": CHAT_FORMATTING,
    "op13_prefix_trie": PREFIX_TRIE,
}
