"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from corvane.llm import url_filters
from corvane.llm.wordhash import SHINGLE

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rules() -> str:
    fits = []
    for rule, verdict in url_filters.RULES:
        name, slash, rest = rule.partition("/")
        fits.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{rest}') THEN '{rule}'")
    by_length = sorted(zip(url_filters.RULES, fits, strict=True), key=lambda x: -len(x[0][0]))
    verdicts = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in url_filters.RULES)
    return f"CASE {' '.join(f for _, f in by_length)} END AS rule", f"CASE rule {verdicts} END"


RULE, VERDICT = _rules()

OP1 = rf"""
WITH h AS (
  SELECT row_number() OVER () AS row, page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)\A.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
p AS (SELECT *, {RULE} FROM h),
t AS (SELECT *, {VERDICT} AS listed, list_sort(list_distinct(list_concat(
    list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'host=' || x),
    list_transform(list_filter(string_split(regexp_replace(translate(path, '{UPPER}', '{LOWER}'), '[0-9]+', '0', 'g'), '/'), lambda x: x <> ''), lambda x: 'path=' || x),
    list_transform(list_filter(list_transform(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda x: regexp_extract(x, '^[^=]*')), lambda x: x <> ''),
      lambda x: 'field=' || x)))) AS tokens FROM p),
taught AS (SELECT row, tokens, listed FROM t WHERE listed IS NOT NULL AND len(tokens) > 0),
one AS (SELECT row, listed, unnest(tokens) AS token FROM taught),
sets AS (
  SELECT row, listed, [token] AS combo FROM one
  UNION ALL SELECT a.row, a.listed, [a.token, b.token] FROM one a JOIN one b ON a.row = b.row AND a.token < b.token
  UNION ALL SELECT a.row, a.listed, [a.token, b.token, c.token] FROM one a JOIN one b ON a.row = b.row AND a.token < b.token JOIN one c ON a.row = c.row AND b.token < c.token),
counted AS (SELECT combo, listed AS verdict, count(*) AS n, sum(count(*)) OVER (PARTITION BY combo) AS held FROM sets GROUP BY combo, listed),
rules AS (SELECT combo, verdict, n / held::DOUBLE AS confidence, n / (SELECT count(*) FROM taught)::DOUBLE AS support FROM counted
  WHERE n >= ceil({url_filters.MIN_SUPPORT} * (SELECT count(*) FROM taught)) AND n / held::DOUBLE >= {url_filters.MIN_CONFIDENCE}),
kept AS (SELECT * FROM rules r WHERE NOT EXISTS (SELECT 1 FROM rules s WHERE s.verdict = r.verdict AND len(s.combo) < len(r.combo)
  AND list_has_all(r.combo, s.combo) AND s.confidence >= r.confidence)),
best AS (SELECT t.row, arg_min(k.verdict, (-confidence, -support, len(combo), combo, k.verdict)) AS mined
  FROM t JOIN kept k ON t.rule IS NULL AND list_has_all(t.tokens, k.combo) GROUP BY t.row)
SELECT page_id, host, path, rule, coalesce(listed, mined, '{url_filters.DEFAULT}') AS verdict FROM t LEFT JOIN best USING (row)
"""

OP8 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= {SHINGLE} THEN list_distinct(list_transform(range(1, len(w) - {SHINGLE} + 2), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' ')))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
same AS (SELECT list_sort(s) AS s, min(doc_id) AS node, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), len(s)),
one AS (SELECT node, n, unnest(s) AS shingle FROM same),
often AS (SELECT shingle FROM one GROUP BY shingle HAVING count(*) > 1),
shared AS (SELECT a.node AS a, b.node AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS m
  FROM (SELECT * FROM one SEMI JOIN often USING (shingle)) a JOIN (SELECT * FROM one SEMI JOIN often USING (shingle)) b ON a.shingle = b.shingle AND a.node < b.node GROUP BY a.node, b.node),
links AS (SELECT a, b FROM shared WHERE 100 * m >= 85 * (na + nb - m)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(x, y) AS (SELECT a, b FROM edges UNION SELECT r.x, e.b FROM reach r JOIN edges e ON r.y = e.a),
class AS (SELECT x, min(y) AS low FROM reach GROUP BY x),
named AS (SELECT s, n, least(node, coalesce(low, node)) AS component_id FROM same LEFT JOIN class ON node = x)
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM sets LEFT JOIN named ON list_sort(sets.s) = named.s
"""

#: The remainders of the CRC-32 polynomial, by its rule, and the checksum of a string's bytes.
_TABLE = "list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i))"
OP9 = f"""
WITH crc AS MATERIALIZED (SELECT {_TABLE} AS t),
b AS (SELECT doc_id, source, coalesce(octet_length(encode(text)), 0) + 1 AS size, hex(encode(coalesce(text, ''))) AS x, md5('11:' || coalesce(doc_id::VARCHAR, 'null')) AS key FROM documents),
d AS (SELECT doc_id, source, size, key, xor(list_reduce(list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
    lambda c, v: xor(c >> 8, crc.t[(xor(c, v) & 255) + 1]), 4294967295), 4294967295) AS text_crc32 FROM b, crc),
r AS (SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, text_crc32, size) - 1)::DOUBLE / (2 * count(*) OVER (PARTITION BY source))::DOUBLE AS place FROM d),
g AS (SELECT *, row_number() OVER (ORDER BY place, source NULLS LAST, key, doc_id NULLS FIRST, text_crc32, size) - 1 AS place_no, count(*) OVER () AS total FROM r)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (place_no * 16 // total)::INT AS shard,
  (place_no - (place_no * 16 // total * total + 15) // 16)::BIGINT AS slot, NULL::INT AS grown_shard FROM g
"""

ORACLES = {"op1_url_filters": OP1, "op8_near_duplicates": OP8, "op9_sharding": OP9}
