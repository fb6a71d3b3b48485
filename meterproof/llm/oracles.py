"""DuckDB counterparts of the queries that SQL can express; written from the contract, not from the operators."""

from __future__ import annotations

# Character classes as RE2 reads them inside a DuckDB string.
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_INK = r"[^\x20\x09-\x0D]"

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || role || ': ') + length(text) + length('</turn>') + 1
    + length(text) - length(replace(text, '\', ''))
    + coalesce(list_sum([length(x) - 2 FOR x IN regexp_extract_all(text, '##+#')]), 0)
    + (length(text) - length(replace(text, '</turn>', ''))) // 7)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

LINES = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents
), inked AS (
  SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM l WHERE regexp_matches(line, '{_INK}')
), w AS (
  SELECT doc_id, k, line AS a, lead(line) OVER d AS b, lead(line, 2) OVER d AS c FROM inked WINDOW d AS (PARTITION BY doc_id ORDER BY k)
), later AS (
  SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS nth FROM w WHERE c IS NOT NULL) WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, i FROM inked JOIN (SELECT DISTINCT doc_id, k + s AS k FROM later, (VALUES (0), (1), (2)) v(s)) USING (doc_id, k)
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM l ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_lines, coalesce(r, 0)::BIGINT AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN md5(coalesce(kept.text, '')) END AS text_md5
FROM documents d
LEFT JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM inked GROUP BY doc_id) USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS r FROM gone GROUP BY doc_id) USING (doc_id)
"""

LINKS = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(ws[p:p + 4], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS p FROM d WHERE len(ws) > 0)
),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(gram, chr(10) ORDER BY gram)) AS own FROM g GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(na.own) AS ox, any_value(nb.own) AS oy
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 5 * count(*) >= 4 * (na.n + nb.n - count(*))
),
reach(x, y) AS (SELECT x, y FROM pairs UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x)
SELECT doc_id, least(doc_id, coalesce(low, doc_id)) AS class_id, 1 + coalesce(copies, 0) AS n_copies,
  coalesce(links, 0) AS n_links, coalesce(partners, 0) AS n_partners
FROM documents
LEFT JOIN (SELECT x AS doc_id, min(y) AS low FROM reach GROUP BY x) USING (doc_id)
LEFT JOIN (
  SELECT x AS doc_id, count(*) AS links, count(*) FILTER (ox = oy) AS copies, count(DISTINCT oy) FILTER (ox <> oy) AS partners FROM pairs GROUP BY x
) USING (doc_id)
"""

CONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(13, len(ws)) AS n, array_to_string(ws[p:p + 12], ' ') AS phrase
  FROM (SELECT item, ws, unnest(generate_series(1, greatest(1, len(ws) - 12))) AS p FROM b WHERE len(ws) > 0)
),
dw AS (
  SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS p FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)
),
m AS (SELECT doc_id, p, n, item FROM dw JOIN bw USING (n, phrase)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM m) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id
),
spots AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS q FROM d),
often AS (SELECT w, count(*) AS n FROM spots GROUP BY w),
rare AS (
  SELECT item, w, count(*) OVER (PARTITION BY item) AS need
  FROM (
    SELECT item, w, row_number() OVER (PARTITION BY item ORDER BY coalesce(n, 0), encode(w)) AS nth
    FROM (SELECT DISTINCT item, unnest(ws) AS w FROM b) LEFT JOIN often USING (w)
  ) WHERE nth <= 4
),
occ AS (SELECT doc_id, item, need, w, q FROM spots JOIN rare USING (w)),
near AS (
  SELECT doc_id, count(DISTINCT item) AS n_near FROM (
    SELECT e.doc_id, e.item FROM occ e JOIN occ o ON e.doc_id = o.doc_id AND e.item = o.item AND o.q BETWEEN e.q - 39 AND e.q
    GROUP BY e.doc_id, e.item, e.q, e.need HAVING count(DISTINCT o.w) = e.need
  ) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated, coalesce(n_near, 0) AS n_near_items
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN near USING (doc_id)
"""

RULES = rf"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_INK}+') AS ws FROM documents
),
ls AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_INK}') GROUP BY doc_id),
win AS (SELECT doc_id, p, array_to_string(ws[p:p + 7], ' ') AS phrase FROM (
  SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 7)) AS p FROM d WHERE len(ws) > 8)),
rep AS (SELECT doc_id, count(DISTINCT q) AS n FROM (
  SELECT doc_id, unnest(generate_series(p, p + 7)) AS q FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, phrase) AS c FROM win) WHERE c > 1) GROUP BY doc_id),
st AS (SELECT doc_id, count(*) AS n FROM (
  SELECT doc_id, w, lag(w) OVER (PARTITION BY doc_id ORDER BY q) AS v FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS q FROM d)) WHERE w = v GROUP BY doc_id),
c AS (
  SELECT doc_id, lang, source, len(ws)::BIGINT AS n_words, coalesce(list_sum([length(w) FOR w IN ws]), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(ls.n_lines, 0)::BIGINT AS n_lines,
    coalesce(ls.dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(st.n, 0)::BIGINT AS n_stutters
  FROM d LEFT JOIN ls USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN st USING (doc_id)
),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS failed FROM c),
r AS (
  SELECT doc_id, lang, source, unnest([
    {{'rate': 'symbol', 'c': n_symbols, 'n': word_chars, 'value': n_symbols * 1000 // word_chars, 'times': 5, 'sparse': FALSE}},
    {{'rate': 'length', 'c': word_chars, 'n': n_words, 'value': word_chars * 10 // n_words, 'times': 6, 'sparse': FALSE}},
    {{'rate': 'lines', 'c': n_dup_lines, 'n': n_lines, 'value': n_dup_lines * 1000 // n_lines, 'times': 4, 'sparse': TRUE}},
    {{'rate': 'repeat', 'c': n_repeat_words, 'n': n_words, 'value': n_repeat_words * 1000 // n_words, 'times': 3, 'sparse': TRUE}},
    {{'rate': 'stutter', 'c': n_stutters, 'n': n_words, 'value': n_stutters * 1000 // n_words, 'times': 10, 'sparse': FALSE}}]) AS x
  FROM b WHERE NOT failed
),
q AS (
  SELECT level, l, s, rate, times, count(*) AS docs, list_sort(list(bin)) AS bins FROM (
    SELECT x.rate AS rate, x.times AS times, v.level AS level, CASE WHEN v.level < 2 THEN lang END AS l, CASE WHEN v.level < 1 THEN source END AS s,
      x.value - x.value % (1::BIGINT << greatest(length(bin(x.value)) - 10, 0)) AS bin
    FROM r, (VALUES (0), (1), (2)) v(level) WHERE NOT x.sparse OR x.value > 0
  ) GROUP BY level, l, s, rate, times
),
e AS (
  SELECT level, l, s, rate, times, docs, bins[((docs * 10 + 99) // 100)::INT] AS q10, bins[((docs * 25 + 99) // 100)::INT] AS q25,
    bins[((docs * 75 + 99) // 100)::INT] AS q75, bins[((docs * 90 + 99) // 100)::INT] AS q90,
    q25 + (1::BIGINT << greatest(length(bin(q25)) - 10, 0)) AS after25, q90 + (1::BIGINT << greatest(length(bin(q90)) - 10, 0)) AS after90 FROM q
),
f AS (SELECT level, l, s, rate, docs, q10 - (after25 - q10) * times AS low, after90 - 1 + (after90 - q75) * times AS high FROM e),
leaning AS (
  SELECT doc_id, x.rate AS rate, x.value AS value, x.c AS c, x.n AS n, coalesce(f0.docs, 0) AS n0, f0.low AS low0, f0.high AS high0, coalesce(f1.docs, 0) AS n1,
    floor((coalesce(f1.docs * f1.low, 0) + 100 * f2.low) / (coalesce(f1.docs, 0) + 100)) AS low1,
    floor((coalesce(f1.docs * f1.high, 0) + 100 * f2.high) / (coalesce(f1.docs, 0) + 100)) AS high1
  FROM r
  LEFT JOIN f f0 ON f0.level = 0 AND f0.l IS NOT DISTINCT FROM lang AND f0.s IS NOT DISTINCT FROM source AND f0.rate = x.rate
  LEFT JOIN f f1 ON f1.level = 1 AND f1.l IS NOT DISTINCT FROM lang AND f1.rate = x.rate
  LEFT JOIN f f2 ON f2.level = 2 AND f2.rate = x.rate
),
sides AS (
  SELECT doc_id, rate, value, c, n, floor((coalesce(n0 * low0, 0) + 100 * low1) / (n0 + 100)) AS low, floor((coalesce(n0 * high0, 0) + 100 * high1) / (n0 + 100)) AS high FROM leaning
),
verdict AS (
  SELECT doc_id, bool_and(coalesce(CASE WHEN rate = 'length' THEN value BETWEEN low AND high
    ELSE c::DOUBLE * 1000 <= high::DOUBLE * n OR (c::DOUBLE * 1000 - high::DOUBLE * n) * (c::DOUBLE * 1000 - high::DOUBLE * n) <= high::DOUBLE * n * 9000 END, TRUE)) AS ok
  FROM sides GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stutters,
  failed AS base_failed, NOT failed AND coalesce(ok, false) AS kept
FROM b LEFT JOIN verdict USING (doc_id)
"""


# CRC-32 of a string in SQL: the table of its polynomial, then one lookup per byte.
_CRC_TABLE = """crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
)"""


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of `text`; the query reads `crc` too."""
    step = "xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])"
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: {step}), 4294967295::BIGINT)"


VARIANTS = rf"""
WITH {_CRC_TABLE},
raw AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
),
hashed AS (
  SELECT run, n, {_crc32("doc_id::VARCHAR || ':' || run")} AS h FROM (SELECT doc_id, run, count(*) AS n FROM raw GROUP BY doc_id, run), crc
),
w AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT) ELSE run END AS word, n FROM hashed
  ) GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3
),
cut AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM w)),
near AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT a.word, b.word FROM cut a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cut a JOIN w b ON a.rest = b.word
),
best AS (
  SELECT near.word, count(*) AS n_near, first(other ORDER BY o.n DESC, encode(other)) AS form, max(o.n) AS form_n
  FROM near JOIN w o ON o.word = other GROUP BY near.word
),
f AS (
  SELECT w.word, w.n, CASE WHEN form_n >= 2 * w.n THEN form END AS form, CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n, coalesce(n_near, 0) AS n_near
  FROM w LEFT JOIN best USING (word)
),
chain AS (
  SELECT word, word AS root FROM f WHERE form IS NULL
  UNION ALL SELECT f.word, chain.root FROM f JOIN chain ON f.form = chain.word
)
SELECT f.*, root FROM f JOIN chain USING (word)
""".replace("WITH crc", "WITH RECURSIVE crc")

TRIE = rf"""
WITH {_CRC_TABLE},
o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said FROM conversations WHERE conv_id IS NOT NULL
),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM o), crc),
r AS (
  SELECT c.conv_id, i, said FROM c JOIN o ON o.conv_id = c.base AND i <= h
  UNION ALL SELECT conv_id, i, said FROM c JOIN o USING (conv_id) WHERE i > h
),
whole AS (SELECT c.conv_id, coalesce(said, []) AS said FROM c LEFT JOIN (SELECT conv_id, list(said ORDER BY i) AS said FROM r GROUP BY conv_id) USING (conv_id)),
p AS (SELECT conv_id, d, said[:d] AS node, d = len(said) AS last FROM (SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS d FROM whole)),
n AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last) AS ends,
    (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE length(node[d].text) END AS saved
  FROM p GROUP BY node, d
),
k AS (SELECT up.node, count(*) AS n_children FROM n up JOIN n down ON down.d = up.d + 1 AND down.node[:up.d] = up.node GROUP BY up.node),
below AS (
  SELECT up.node, sum(CASE WHEN k.n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(down.saved) AS saved_tokens
  FROM (SELECT DISTINCT a.node AS up, b.node AS down FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.d <= b.d) pair
  JOIN n up ON up.node = pair.up JOIN n down ON down.node = pair.down LEFT JOIN k ON k.node = down.node GROUP BY up.node
)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n JOIN below USING (node) LEFT JOIN k USING (node) LEFT JOIN n up ON n.d = up.d + 1 AND n.node[:up.d] = up.node
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat_format": CHAT,
        "op5_line_dedup": LINES,
        "op6_ngram_join": LINKS,
        "op8_decontamination": CONTAMINATION,
        "op9_quality_rules": RULES,
        "op11_spelling_variants": VARIANTS,
        "op12_conversation_trie": TRIE,
    }
