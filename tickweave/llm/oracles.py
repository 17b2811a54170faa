"""SQL oracles of the text queries that SQL can express on whole tables, for DuckDB.

They follow the definitions window by window and share nothing with the operators.
"""

WORDS_7 = r"""words AS (SELECT {id} AS id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM (
  SELECT {id}, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM {table} WHERE text IS NOT NULL))"""


def _windows(words: str, sizes) -> str:
    """Every run of each size of words, as text."""
    return " UNION ALL ".join(
        f"""SELECT id, p, {m} AS m, win FROM (SELECT id, p, count(*) OVER w AS size, string_agg(word, ' ') OVER w AS win
    FROM {words} WINDOW w AS (PARTITION BY id ORDER BY p ROWS BETWEEN CURRENT ROW AND {m - 1} FOLLOWING)) WHERE size = {m}"""
        for m in sizes)


DECONTAMINATION = f"""WITH {WORDS_7.format(id='doc_id', table='documents').replace('words AS', 'dw AS', 1)},
{WORDS_7.format(id='item_id', table='benchmark').replace('words AS', 'iw AS', 1)},
lengths AS (SELECT id, least(13, count(*)) AS m FROM iw GROUP BY id),
items AS (SELECT DISTINCT w.id AS item_id, w.m, win FROM ({_windows('iw', range(1, 14))}) w
  JOIN lengths l ON l.id = w.id AND l.m = w.m),
hits AS (SELECT w.id AS doc_id, p, w.m, item_id FROM ({_windows('dw', range(1, 14))}) w
  JOIN items i ON i.m = w.m AND i.win = w.win),
hit_words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (
  SELECT doc_id, unnest(range(p, p + m)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id),
sized AS (SELECT id AS doc_id, count(*) AS n_words FROM dw GROUP BY id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(n_words, 0) AS contaminated
FROM documents d LEFT JOIN sized USING (doc_id) LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""

SUBSTRINGS = r"""WITH dw AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM (
  SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents WHERE text IS NOT NULL)),
wins AS (SELECT doc_id, p, word, count(*) OVER w AS size, md5(string_agg(word, ' ') OVER w) AS h FROM dw
  WINDOW w AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
ranked AS (SELECT *, size = 20 AND row_number() OVER (PARTITION BY h, size ORDER BY doc_id, p) > 1 AS again FROM wins),
marked AS (SELECT doc_id, p, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY p
  ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM ranked),
kept AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
  coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT gone), '') AS text FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256 FROM documents d LEFT JOIN kept USING (doc_id)"""

# CRC-32 by its definition: eight steps of the reversed polynomial give a table entry a byte value
CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8),
  lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), b)) AS t)"""


def _crc(codes: str, state: str = "4294967295") -> str:
    """The running CRC of a list of byte values (to be inverted at the end)."""
    return f"list_reduce({codes}, lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8), {state})"


PREFIX_TRIE = rf"""WITH {CRC_TABLE},
turns AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS txt,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
counts AS (SELECT c, count(*) AS own, c - c % 20 AS base FROM turns GROUP BY c),
plans AS (SELECT p.c, p.base, h, least(h, coalesce(b.own, 0)) AS taken, p.own FROM (SELECT *, xor({_crc(
    "list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))")}, 4294967295) % 4 AS h
  FROM counts, crc) p LEFT JOIN counts b ON b.c = p.base),
whole AS (SELECT p.c, i AS d, role, txt FROM plans p JOIN turns t ON t.c = p.base AND i <= taken
  UNION ALL SELECT p.c, i - h + taken, role, txt FROM plans p JOIN turns t ON t.c = p.c AND i > h
  UNION ALL SELECT c, 0, '', '' FROM plans),
paths AS (SELECT c, d, md5(string_agg(md5(role) || md5(txt), '' ORDER BY d) OVER
  (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS k,
  CASE WHEN d > 0 THEN len(regexp_extract_all(txt, '[^ 	-
]+')) ELSE 0 END AS w,
  max(d) OVER (PARTITION BY c) AS total FROM whole),
nodes AS (SELECT k, d, min(c) AS rep, count(*) AS n, any_value(w) * (count(*) - 1) AS saved,
  sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = total), '')) AS ends
  FROM paths GROUP BY k, d),
linked AS (SELECT n.*, up.k AS pk FROM nodes n LEFT JOIN paths up ON up.c = n.rep AND up.d = n.d - 1),
kids AS (SELECT pk, count(*) AS n_children FROM linked WHERE pk IS NOT NULL GROUP BY pk),
below AS (SELECT up.k, sum(n.saved) AS saved, count(*) FILTER (kids.n_children IS NULL) AS leaves
  FROM nodes n LEFT JOIN kids ON kids.pk = n.k JOIN paths up ON up.c = n.rep AND up.d <= n.d GROUP BY up.k)
SELECT l.rep AS conv_id, l.d AS depth, p.rep AS parent_conv_id, l.n AS n_convs,
  coalesce(n_children, 0) AS n_children, leaves AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens,
  l.ends AS ends_sha256
FROM linked l JOIN below ON below.k = l.k LEFT JOIN kids ON kids.pk = l.k LEFT JOIN nodes p ON p.k = l.pk"""

# the states of a word's checksum go on from the state after "<doc_id>:"
SPELLING = rf"""WITH RECURSIVE {CRC_TABLE},
lowered AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS txt
  FROM documents WHERE text IS NOT NULL),
runs AS (SELECT doc_id, run, count(*) AS times FROM (
  SELECT doc_id, unnest(regexp_extract_all(txt, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM lowered)
  WHERE length(run) >= 5 GROUP BY doc_id, run),
checked AS (SELECT run, times, xor({_crc(
    "flatten(list_transform(string_split(concat(doc_id, ':', run), ''), lambda x: CASE WHEN ord(x) < 128 "
    "THEN [CAST(ord(x) AS BIGINT)] ELSE [195, CAST(ord(x) AS BIGINT) - 64] END))")}, 4294967295) AS h FROM runs, crc),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (SELECT times, CASE WHEN h % 97 = 0
    THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM checked)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
less AS (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM pairs GROUP BY word),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.m >= 2 * w.n THEN best.m END AS form_n,
  CASE WHEN best.m >= 2 * w.n THEN (SELECT min(other) FROM pairs p WHERE p.word = w.word AND p.m = best.m) END AS form
  FROM words w LEFT JOIN best USING (word)),
ways AS (SELECT word, word AS root, 0 AS steps FROM formed
  UNION ALL SELECT ways.word, form, steps + 1 FROM ways JOIN formed f ON f.word = ways.root WHERE form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (
  SELECT word, arg_max(root, steps) AS root FROM ways GROUP BY word) USING (word)"""

ORACLES = {
    "op7_decontamination": DECONTAMINATION,
    "op8_substring_dedup": SUBSTRINGS,
    "op11_spelling_variants": SPELLING,
    "op12_prefix_trie": PREFIX_TRIE,
}
