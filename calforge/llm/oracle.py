"""DuckDB SQL for the queries of this subpackage that SQL can express."""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i + 1:i + k], ' ') AS win
    FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(0, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
doc_windows AS (
    SELECT row_id, k, i, array_to_string(w[i + 1:i + k], ' ') AS win
    FROM (SELECT row_id, w, k, unnest(range(0, len(w) - k + 1)) AS i
          FROM d, (SELECT DISTINCT k FROM item_windows) lengths WHERE len(w) >= k)),
hits AS (SELECT row_id, i, k, item_id FROM doc_windows JOIN item_windows USING (k, win)),
hit_words AS (SELECT row_id, count(DISTINCT word_no) AS n FROM (SELECT row_id, unnest(range(i, i + k)) AS word_no FROM hits) GROUP BY row_id),
hit_items AS (
    SELECT row_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit_words.n, 0) AS n_hit, coalesce(hit_items.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit_words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (row_id) LEFT JOIN hit_items USING (row_id)"""

FILL_IN_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
                  sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT *, len(u) AS n, CAST('0x' || x[1:8] AS BIGINT) % (len(u) + 1) AS p1, CAST('0x' || x[9:16] AS BIGINT) % (len(u) + 1) AS p2,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                  WHEN CAST('0x' || x[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM d),
c AS (SELECT *, array_to_string(u[1:least(p1, p2)], '') AS p, array_to_string(u[least(p1, p2) + 1:greatest(p1, p2)], '') AS m,
             array_to_string(u[greatest(p1, p2) + 1:], '') AS s FROM h)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM c"""

CHAT_FORMAT = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
           UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
       CAST(sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|(im_start|im_end)\|>', '<\1\\|\2|>', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""
