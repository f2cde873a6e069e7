"""DuckDB SQL for the queries that SQL can express."""

_WORDS = r"w AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents)"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LEDGER = rf"""
WITH {_WORDS},
g AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) >= 8),
k AS (SELECT doc_id, i FROM (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS s FROM g) QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM k, (SELECT unnest(range(8)) AS j) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM w),
m AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(ls) AS n_lines,
 length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaim, length(regexp_replace(t, '[^0-9]', '', 'g')) AS n_digits, len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutter
 FROM w JOIN l ON l.doc_id = w.doc_id LEFT JOIN rep ON rep.doc_id = w.doc_id),
b AS (SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT + 4 * (100 * n_symbols > 10 * n_words)::BIGINT + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::BIGINT
 + 32 * (100 * n_upper > 50 * word_chars)::BIGINT + 64 * (100 * n_exclaim > 20 * n_words)::BIGINT + 128 * (100 * n_digits > 50 * word_chars)::BIGINT + 256 * (100 * n_stutter > 30 * n_words)::BIGINT AS failed FROM m)
"""

#: CRC-32 (reflected, polynomial EDB88320) of a list of bytes, by a table of 256 remainders.
_CRC = "crc AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS rem)"


def _crc32(octets: str) -> str:
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, rem[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"


_OCTETS = "list_transform(range(strlen(t)), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)"
_DIGITS = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"
_TERMS = r"list_transform(regexp_extract_all({t}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"

ORACLES = {
    "op3_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0),
ok AS (SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_aggregate(list_transform(e, lambda x: abs(x)), 'max') > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
r AS (SELECT vec_id AS root, vec_id AS id FROM embeddings UNION SELECT r.root, l.b FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(root) AS c FROM r GROUP BY id)
SELECT vec_id, coalesce(n.n, 0) AS n_links, c.c AS component_id, c.c = vec_id AS kept FROM embeddings LEFT JOIN n ON n.a = vec_id JOIN c ON c.id = vec_id""",
    "op4_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND payload_bytes >= 100""",
    "op7_substring_dedup": f"""
WITH {_WORDS},
g AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM w WHERE len(ws) >= 13),
k AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s FROM g),
hit AS (SELECT doc_id, i FROM k QUALIFY min(doc_id) OVER (PARTITION BY s) < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM hit, (SELECT unnest(range(13)) AS j)),
u AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS x FROM w),
kept AS (SELECT u.doc_id, string_agg(x, ' ' ORDER BY u.i) AS s FROM u ANTI JOIN gone ON u.doc_id = gone.doc_id AND u.i = gone.i GROUP BY u.doc_id),
m AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(m.n, 0) AS n_removed, sha256(coalesce(kept.s, '')) AS kept_sha256 FROM w LEFT JOIN m ON m.doc_id = w.doc_id LEFT JOIN kept ON kept.doc_id = w.doc_id""",
    "op8_quality_rules": _LEDGER + """SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed FROM b""",
    "quality_ablations": _LEDGER + """, r AS (SELECT unnest(['few_words', 'repeated_words', 'symbols', 'repeated_lines', 'word_length', 'capitals', 'exclamations', 'digits', 'stutter']) AS rule, unnest(range(9)) AS bit)
SELECT rule, count(*) FILTER ((failed >> bit) & 1 = 1) AS n_failed, count(*) FILTER (failed = 1 << bit) AS n_only FROM r, b GROUP BY rule""",
    "op10_jaccard_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, len(g) AS n FROM s),
u AS (SELECT doc_id, unnest(g) AS x FROM s),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS root, doc_id AS id FROM documents UNION SELECT r.root, e.b FROM r JOIN e ON e.a = r.id),
c AS (SELECT id, min(root) AS c FROM r GROUP BY id)
SELECT n.doc_id, n.n AS n_shingles, c.c AS component_id FROM n JOIN c ON c.id = n.doc_id""",
    "op11_sharding": f"""
WITH {_CRC},
x AS (SELECT doc_id, coalesce('s' || source, 'n') AS source, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h FROM documents),
d AS (SELECT doc_id, source, strlen(t) + 16 AS size, {_crc32(_OCTETS)} AS text_crc32, ('0x' || substr(md5(concat_ws('/', '11', doc_id)), 1, 15))::BIGINT AS h, ('0x' || substr(md5('12/' || source), 1, 15))::BIGINT AS u FROM x, crc),
r AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY h, doc_id, text_crc32, size) - 1 + u / 1152921504606846976::DOUBLE) / count(*) OVER (PARTITION BY source) AS fraction FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY fraction, source, h, doc_id, text_crc32, size) - 1 AS place, count(*) OVER () AS n FROM r),
s AS (SELECT *, place * 40 // n AS shard FROM p)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INT AS shard, place - (shard * n + 39) // 40 AS slot, NULL::INT AS grown_shard FROM s""",
    "op12_lexical_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format(t="coalesce(text, '')")} AS ts FROM documents),
m AS (SELECT *, len(ts) AS n, count(*) OVER () AS nn, sum(len(ts)) OVER ()::BIGINT AS ll FROM d WHERE len(ts) > 0),
f AS (SELECT r, doc_id, t, 100 - 50 + (50 * n * nn) // ll AS m, nn, count(*) AS tf FROM (SELECT *, unnest(ts) AS t FROM m) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f GROUP BY t),
q AS (SELECT DISTINCT item_id, unnest({_TERMS.format(t="coalesce(text, '')")}) AS t FROM benchmark),
s AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score FROM q JOIN w ON w.t = q.t JOIN f ON f.t = q.t GROUP BY item_id, r, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 50""",
    "op13_tandem_runs": f"""
WITH {_WORDS}, {_CRC},
h AS (SELECT doc_id, ws, len(ws) AS n, {_crc32(_DIGITS)} AS h FROM w, crc),
a AS (SELECT *, h // 10 AS g, h // 10 % greatest(n, 1) AS a FROM h),
p AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i: ws[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1]) ELSE ws END AS ws FROM a),
u AS (SELECT doc_id, unnest(range(n)) AS i, unnest(ws) AS x FROM p),
g AS (SELECT doc_id, i, array_to_string(ws[i + 1:i + 6], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(n - 5)) AS i FROM p WHERE n >= 12)),
c AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i),
k AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS grp FROM c),
e AS (SELECT doc_id, min(i) AS s, max(i) + 6 + q AS e, q FROM k GROUP BY doc_id, q, grp HAVING max(i) + 6 + q - min(i) >= greatest(12, 2 * q)),
r AS (SELECT doc_id, s, e, min(q) AS q FROM e GROUP BY doc_id, s, e),
z AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM r GROUP BY doc_id),
b AS (SELECT doc_id, s, e - s AS l, q FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY e - s DESC, s, q) = 1),
v AS (SELECT DISTINCT doc_id, unnest(range(s + q, e)) AS i FROM r),
t AS (SELECT u.doc_id, string_agg(x, ' ' ORDER BY u.i) AS t FROM u ANTI JOIN v ON u.doc_id = v.doc_id AND u.i = v.i GROUP BY u.doc_id)
SELECT p.doc_id, n AS n_words, coalesce(n_runs, 0) AS n_runs, s AS start, l AS length, q AS period, 1000 * l // q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t.t, '')) AS collapsed_sha256
FROM p LEFT JOIN z ON z.doc_id = p.doc_id LEFT JOIN b ON b.doc_id = p.doc_id LEFT JOIN t ON t.doc_id = p.doc_id""",
}
