"""The queries' results as DuckDB SQL."""

from __future__ import annotations

from tickloom.llm.secrets import ACCESS, ALLOW, ASSIGN, ASSIGN_LEAST, CLASSES, HEX, PLACEHOLDERS, UNLIKE_WORDS

EXACT = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM n JOIN g USING (t)
"""

MIX = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5('mix:' || doc_id) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, source_size * 3.0::DOUBLE AS cap, sum(source_size) OVER ()::DOUBLE AS total,
    coalesce(sum(source_size * 3.0::DOUBLE) OVER (ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
    sum(weight) OVER (ORDER BY source_size * 3.0::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM s),
t AS (
  SELECT source, source_size, least(cap, weight * max((total - filled) / open) FILTER ((total - filled) / open * weight <= cap) OVER ()) AS target
  FROM l),
q AS (
  SELECT doc_id, size, source_size, target, key,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS UNBOUNDED PRECEDING)::BIGINT AS sent
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT doc_id, size, key, (e * source_size + sent)::DOUBLE / target AS finish
  FROM q, (VALUES (0), (1), (2)) AS epochs(e) WHERE size > 0 AND target > 0),
m AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY finish, key, size ROWS UNBOUNDED PRECEDING) AS mixed FROM c),
k AS (
  SELECT doc_id, sum(size)::BIGINT AS taken FROM m WHERE mixed <= (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM q LEFT JOIN k USING (doc_id)
"""


WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, t, strlen(t)::BIGINT AS payload_bytes, sha1(t) AS h FROM p),
g AS (SELECT t, min(page_id) AS first FROM d GROUP BY t)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform(range(0, 4), lambda j:
    substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substring(h, i * 5 + 1, 5))::BIGINT >> (15 - 5 * j)) & 31)::INT + 1, 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d JOIN g USING (t)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _located(name: str, pattern: str, kind: str, rank: int, keep: str = "true", of: str = "d") -> str:
    return f"""{name} AS (
  SELECT doc_id, {_quoted(kind)} AS kind, {rank} AS rank, text, x.piece AS piece, x.start AS start, x.start + length(x.piece) AS stop
  FROM (SELECT doc_id, text, unnest(list_transform(range(1, len(m) + 1), lambda i: {{'piece': m[i],
      'start': list_sum(list_transform(g[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0)}})) AS x
    FROM (SELECT doc_id, text, regexp_extract_all(text, {_quoted(pattern)}) AS m, string_split_regex(text, {_quoted(pattern)}) AS g FROM {of}) WHERE len(m) > 0)
  WHERE {keep})"""


def secrets() -> str:
    least = f"length(regexp_extract(x.piece, {_quoted(ASSIGN)}, 2)) >= {ASSIGN_LEAST}"
    parts = [
        "d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)",
        _located("assign", ASSIGN, "assign", 1, least),
        _located("access", ACCESS, "access", 2),
        _located("hex", HEX, "hex", 3),
    ]
    allowed = "|".join(f"(?:{a})" for a in ALLOW)
    blanked = "text"
    for word in PLACEHOLDERS:
        blanked = f"replace({blanked}, '{word}', '{' ' * len(word)}')"
    parts.append(f"e AS (SELECT doc_id, {blanked} AS text FROM d)")
    for rank, c in enumerate(CLASSES, 4):
        k, w = c.kind, c.window
        parts += [
            _located(f"{k}_c", f"[{c.members}]{{{w},}}", k, rank, of="e"),
            f"""{k}_w AS (SELECT doc_id, text, start, pos, count(*) * log2(count(*)) AS part FROM (
    SELECT doc_id, text, start, pos, unnest(string_split(substring(piece, pos, {w}), '')) AS ch
    FROM (SELECT *, unnest(range(1, length(piece) - {w} + 2)) AS pos FROM {k}_c)) GROUP BY doc_id, text, start, pos, ch)""",
            f"""{k}_h AS (SELECT doc_id, text, start, (start + pos - 1)::BIGINT AS first FROM {k}_w GROUP BY doc_id, text, start, pos HAVING log2({w}) - sum(part) / {w} > {c.bits})""",
            f"""{k}_i AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, start ORDER BY first) AS island FROM (
    SELECT *, CASE WHEN first - lag(first) OVER (PARTITION BY doc_id, start ORDER BY first) <= {w} THEN 0 ELSE 1 END AS fresh FROM {k}_h))""",
            f"""{k} AS (SELECT doc_id, {_quoted(k)} AS kind, {rank} AS rank, min(first) AS start, max(first) + {w} AS stop FROM {k}_i
    GROUP BY doc_id, text, {k}_i.start, island
    HAVING NOT regexp_matches(substring(text, min(first) + 1, max(first) + {w} - min(first)), {_quoted(allowed)})
      AND regexp_matches(substring(text, min(first) + 1, max(first) + {w} - min(first)), {_quoted(UNLIKE_WORDS)}))""",
        ]
    one = lambda names: " UNION ALL ".join(f"SELECT doc_id, kind, rank, start, stop FROM {n}" for n in names)
    text = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop)"
    return f"""WITH {", ".join(parts)},
base AS ({one(["assign", "access", "hex"])}),
spans AS (SELECT * FROM base UNION ALL {one([c.kind for c in CLASSES])}),
b AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, {text} AS base FROM base GROUP BY doc_id),
s AS (SELECT doc_id, {text} AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN s USING (doc_id)"""


NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS other, a.label = v.label AS same, CAST(list_inner_product(a.e, v.e) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.vec_id <> v.vec_id AND len(a.e) = len(v.e) WHERE a.vec_id % 100 = 0
),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 5"""

#: The polynomial of CRC-32, turned around, and all ones.
CRC_POLYNOMIAL, CRC_ONES = 3988292384, 4294967295

SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  GROUP BY ALL
),
tab AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {CRC_POLYNOMIAL}) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))
),
named AS (SELECT run, c, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, c, xor(list_reduce(list_concat([{CRC_ONES}], list_transform(range(0, len(x) // 2),
      lambda i: 16 * (strpos('0123456789ABCDEF', x[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', x[2 * i + 2]) - 1)),
    lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), {CRC_ONES}) AS h
  FROM named, tab
),
w AS (
  SELECT word, sum(c)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, c FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
),
cut AS (SELECT word, n, i, word[:i] || word[i + 2:] AS v FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM w)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut AS a JOIN cut AS b ON a.i = b.i AND a.v = b.v AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut AS a JOIN w AS b ON a.v = b.word
  UNION SELECT b.word, a.word, a.n FROM cut AS a JOIN w AS b ON a.v = b.word
),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word),
form AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN other END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n
  FROM w LEFT JOIN best USING (word)
),
way AS (
  SELECT word, word AS at FROM form
  UNION ALL SELECT way.word, form.form FROM way JOIN form ON way.at = form.word WHERE form.form IS NOT NULL
)
SELECT form.word, form.form, way.at AS root, form.n, form.n_near, form.form_n
FROM form JOIN way USING (word) JOIN form AS top ON top.word = way.at AND top.form IS NULL"""


ORACLE: dict[str, str] = {
    "op5_warc": WARC,
    "op7_secret_scan": secrets(),
    "op8_exact_dedup": EXACT,
    "op10_mix_sources": MIX,
    "op11_hard_negatives": NEGATIVES,
    "op12_spelling_variants": SPELLING,
}
