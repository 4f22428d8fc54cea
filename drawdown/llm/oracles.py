"""DuckDB SQL for the text queries that SQL can express."""

from __future__ import annotations

# Windows of 10 words, shorter items whole; every place of every document is tried for every length in use.
OP8 = r"""
WITH item_words AS (
  SELECT DISTINCT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, w[pos : pos + 9] AS words
  FROM item_words, unnest(generate_series(1, greatest(1, len(w) - 9))) AS s(pos) WHERE len(w) > 0
), docs AS (
  SELECT DISTINCT doc_id, text, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), lengths AS (SELECT DISTINCT len(words) AS n FROM windows),
places AS (
  SELECT doc_id, text, n, pos, w[pos : pos + n - 1] AS words
  FROM docs, lengths, unnest(generate_series(1, len(w) - n + 1)) AS s(pos)
), found AS (
  SELECT p.doc_id, p.text, p.pos, p.n, v.item_id FROM places p JOIN windows v ON p.words = v.words
), hits AS (
  SELECT doc_id, text, count(DISTINCT pos + k) AS n_hit
  FROM found, unnest(generate_series(0, n - 1)) AS s(k) GROUP BY ALL
), items AS (
  SELECT doc_id, text, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, text, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY ALL
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.listed, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h ON h.doc_id IS NOT DISTINCT FROM d.doc_id AND h.text IS NOT DISTINCT FROM d.text
LEFT JOIN items i ON i.doc_id IS NOT DISTINCT FROM d.doc_id AND i.text IS NOT DISTINCT FROM d.text
"""

_ESCAPE = (
    r"replace(replace(replace(replace(replace(replace({0}, '\', '\b'), '<|', '<\p'), '</s>', '<\e'), '<s>', '<\s'), "
    r"'[INST]', '[\i'), '[/INST]', '[\o')"
)

# Lengths of prefixes are running sums; only the digests need texts.
OP9 = f"""
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, length('<|turn|>') + length(replace({_ESCAPE.format("role")}, chr(10), '\\n')) + 1
      + length({_ESCAPE.format("text")}) + length('<|end|>') + 1 AS chars
  FROM turns
), placed AS (
  SELECT *, sum(chars) OVER w AS upto, lead(1) OVER w IS NULL AS final
  FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR final) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""


# One row for each id, all pairs of anchors and rows, windows by rank.
OP11 = """
WITH parts AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), rows_ AS (
  SELECT vec_id, unnest(min(struct_pack(label := label, q := q))) FROM parts
  WHERE len(q) = (SELECT len(q) FROM parts GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1)
  GROUP BY vec_id
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pairs WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
  n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.alike
  AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

# Stops of targets from running sums, multipliers by bisection, and one walk along all keys of a source. The walk goes beyond the
# operator's candidates only in sources with over a thousand documents of broken rate.
OP12 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS s, count(*) AS n_docs FROM docs GROUP BY source)
), stops AS (  -- sources in the order in which they reach three times their size
  SELECT source, s, n_docs, weight, CAST(s AS DOUBLE) / weight AS ratio,
    sum(s) OVER () - 3 * sum(s) OVER before AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER before2, 0) AS open_,
    sum(s) OVER () - 3 * coalesce(sum(s) OVER before2, 0) AS rest_before
  FROM sources
  WINDOW before AS (ORDER BY CAST(s AS DOUBLE) / weight, source ROWS UNBOUNDED PRECEDING),
    before2 AS (ORDER BY CAST(s AS DOUBLE) / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT rest_before AS rest, open_ AS w FROM stops WHERE weight * rest_before <= 3 * s * open_ ORDER BY ratio, source LIMIT 1
), targets AS (
  SELECT source, s, CAST(s AS DOUBLE) / n_docs AS mean, weight * rest > 3 * s * w AS full_,
    CASE WHEN weight * rest > 3 * s * w THEN CAST(3 * s AS DOUBLE) ELSE CAST(weight * rest AS DOUBLE) / CAST(w AS DOUBLE) END AS target
  FROM sources, level
), cells AS (
  SELECT source, size, count(*) AS n FROM docs WHERE size > 0 GROUP BY ALL
), halving AS (  -- the multiplier by bisection
  SELECT source, -1000.0::DOUBLE AS low, 1000.0::DOUBLE AS high, 0 AS k FROM targets WHERE NOT full_ AND target > 0
  UNION ALL
  SELECT source, CASE WHEN reached < target THEN mid ELSE low END, CASE WHEN reached < target THEN high ELSE mid END, k + 1
  FROM (
    SELECT h.source, any_value(h.low) AS low, any_value(h.high) AS high, any_value((h.low + h.high) / 2) AS mid, any_value(k) AS k,
      any_value(t.target) AS target, sum(c.n * c.size * least(3.0, exp(least((h.low + h.high) / 2 * (c.size / t.mean), 1.2)))) AS reached
    FROM halving h JOIN targets t ON h.source IS NOT DISTINCT FROM t.source JOIN cells c ON h.source IS NOT DISTINCT FROM c.source
    WHERE k < 90 GROUP BY h.source
  )
), rates AS (
  SELECT d.*, t.s, t.target, CASE WHEN d.size = 0 THEN 0.0 WHEN t.full_ THEN 3.0
    ELSE least(3.0, exp(least((h.low + h.high) / 2 * (d.size / t.mean), 1.2))) END AS rate
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
  LEFT JOIN halving h ON h.k = 90 AND h.source IS NOT DISTINCT FROM d.source
), parts AS (
  SELECT *, CAST(floor(rate) AS BIGINT) AS whole, rate - floor(rate) AS part,
    (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS h
  FROM rates
), keyed AS (
  SELECT *, CASE WHEN part > 0 THEN CAST(floor(h * (1 - part) / (h * (1 - part) + part * (1 - h)) * 4503599627370496.0) AS BIGINT) END AS key
  FROM parts
), items AS (
  SELECT source, key, size, sum(size) AS words, row_number() OVER (PARTITION BY source ORDER BY key, size) AS pos
  FROM keyed WHERE key IS NOT NULL GROUP BY source, key, size
), need AS (
  SELECT source, greatest(0, CAST(floor(any_value(target) + 0.5) AS BIGINT) - sum(size * whole)) AS left_ FROM keyed GROUP BY source
), walk AS (
  SELECT source, left_, 0::BIGINT AS pos, NULL::BIGINT AS key, NULL::BIGINT AS size, false AS got FROM need
  UNION ALL
  SELECT w.source, CASE WHEN i.words <= w.left_ THEN w.left_ - i.words ELSE w.left_ END, i.pos, i.key, i.size, i.words <= w.left_
  FROM walk w JOIN items i ON i.source IS NOT DISTINCT FROM w.source AND i.pos = w.pos + 1
), ends AS (
  SELECT source, arg_max(left_, pos) AS left_ FROM walk GROUP BY source
), nearer AS (
  SELECT i.source, i.key, i.size FROM items i JOIN walk w ON w.source IS NOT DISTINCT FROM i.source AND w.pos = i.pos AND NOT w.got
  JOIN ends e ON e.source IS NOT DISTINCT FROM i.source AND i.words < 2 * e.left_
  QUALIFY row_number() OVER (PARTITION BY i.source ORDER BY i.words, i.key, i.size) = 1
), extra AS (
  SELECT source, key, size FROM walk WHERE got UNION SELECT * FROM nearer
)
SELECT k.doc_id, k.size, k.s AS source_size, k.target, CAST(k.size * (k.whole + (x.key IS NOT NULL)::BIGINT) AS BIGINT) AS taken
FROM keyed k LEFT JOIN extra x ON x.source IS NOT DISTINCT FROM k.source AND x.key = k.key AND x.size = k.size
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op8_decontaminate": OP8,
        "op9_chat": OP9,
        "op11_hard_negatives": OP11,
        "op12_mixing": OP12,
    }
