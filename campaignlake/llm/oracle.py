"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# a backslash is added after the first character of each control string
_ESCAPED = (
    r"regexp_replace(regexp_replace(text,"
    r" '(<)(\\*(?:\|im_start\|>|\|im_end\|>|/?s>|<SYS>>|</SYS>>))', '\1\\\2', 'g'),"
    r" '(\[)(\\*/?INST\])', '\1\\\2', 'g')"
)

ORACLE_SQL = {
    "op1_winnowing": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
items AS (SELECT * FROM b WHERE len(ws) > 0),
windows AS (
  SELECT item_id, least(len(ws), 10) AS size,
         unnest(list_transform(range(1, len(ws) - least(len(ws), 10) + 2),
                lambda p: array_to_string(ws[p : p + least(len(ws), 10) - 1], ' '))) AS w
  FROM items),
spans AS (
  SELECT r, s.size, unnest(range(1, len(ws) - s.size + 2)) AS p, ws
  FROM d, (SELECT DISTINCT size FROM windows) s WHERE len(ws) >= s.size),
found AS (
  SELECT DISTINCT r, p, s.size, item_id
  FROM (SELECT r, p, size, array_to_string(ws[p : p + size - 1], ' ') AS w FROM spans) s
  JOIN windows USING (size, w)),
hit AS (
  SELECT r, count(DISTINCT q) AS n_hit
  FROM (SELECT r, unnest(range(p, p + size)) AS q FROM (SELECT DISTINCT r, p, size FROM found))
  GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items,
         sha256(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS s
  FROM (SELECT DISTINCT r, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, coalesce(s, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)""",
    "op6_chat_prefix": rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, row_number() OVER w AS n,
    length({_ESCAPED}) + length(role) + length('<|im_start|>' || chr(10) || '<|im_end|>' || chr(10)) AS chars
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
grown AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS prefix,
         max(n) OVER (PARTITION BY conv_id) AS last FROM sized)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE WHEN role = 'assistant' OR n = last THEN prefix ELSE 0 END) AS BIGINT) AS formatted_chars,
  CAST(count(*) FILTER (role = 'assistant' OR n = last) AS BIGINT) AS examples
FROM grown GROUP BY conv_id""",
    "op5_block_naming": f"""
WITH d AS (
  SELECT doc_id, {_LOWER} AS t, row_number() OVER () AS r FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST, r) = 1 AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)""",
    "op11_roaring_fim": """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) % (length(t) + 1) AS c1,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (length(t) + 1) AS c2,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
              OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
         WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
c AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b FROM g),
p AS (
  SELECT *, substr(t, 1, a) AS head, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS tail FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || mid
         ELSE '<S>' || tail || '<P>' || head || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p""",
    "op13_misra_gries_phrases": f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM pieces),
grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2),
         lambda p: array_to_string(ws[p : p + size - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3]) AS size) WHERE len(ws) >= size),
f AS (
  SELECT lang, size, phrase, CAST(count(*) AS BIGINT) AS f FROM grams GROUP BY ALL HAVING size = 1 OR count(*) >= 10),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE size > 1),
cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(ws[1 : k], ' ') AS lp, array_to_string(ws[k + 1 :], ' ') AS rp
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
s AS (
  SELECT cuts.lang, cuts.phrase, a, x.f AS l, y.f AS r, k,
         CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lp JOIN f y ON y.lang = cuts.lang AND y.phrase = rp
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS longest FROM (
    SELECT lang, a, unnest([array_to_string(ws[1 : 2], ' '), array_to_string(ws[2 : 3], ' ')]) AS phrase
    FROM c WHERE size = 3) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM s LEFT JOIN longer ON longer.lang = s.lang AND longer.phrase = s.phrase
  WHERE longest IS NULL OR 100 * longest < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
}
