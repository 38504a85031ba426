"""The same results as DuckDB SQL, where SQL can express them."""

SPACES = r"[\x20\x09-\x0D]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# The cleaned rows of `docs` (doc_id, source, text, ...), for line deduplication with the default parameters.
LINES = r"""
numbered AS (SELECT row_number() OVER () AS rid, * FROM {docs}),
line AS (
  SELECT rid, source, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM numbered WHERE text IS NOT NULL),
trimmed AS (SELECT *, regexp_replace(l, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS k FROM line),
host AS (SELECT source, count(*) AS pages FROM numbered GROUP BY source),
seen AS (SELECT source, k, count(DISTINCT rid) AS n FROM trimmed WHERE k <> '' GROUP BY source, k),
boiler AS (SELECT seen.source, seen.k FROM seen JOIN host ON seen.source IS NOT DISTINCT FROM host.source
  WHERE n >= 5 AND n > 0.05 * pages),
marked AS (SELECT t.*, b.k IS NOT NULL AS bad FROM trimmed t LEFT JOIN boiler b
  ON t.source IS NOT DISTINCT FROM b.source AND t.k = b.k),
rebuilt AS (
  SELECT rid, coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (NOT bad), '') AS cleaned,
    count(*)::BIGINT AS n_lines, count(*) FILTER (bad)::BIGINT AS n_dropped
  FROM marked GROUP BY rid)
"""

OP4 = f"""
WITH {LINES.format(docs="documents")}
SELECT doc_id, source, cleaned AS text, coalesce(n_lines, 0)::BIGINT AS n_lines,
  coalesce(n_dropped, 0)::BIGINT AS n_dropped
FROM numbered LEFT JOIN rebuilt USING (rid)
"""

HITS = r"""
dw AS (
  SELECT rid, w, pos FROM (
    SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM (
      SELECT rid, regexp_extract_all({lower_doc}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM numbered))),
bi AS (
  SELECT item_id, regexp_extract_all({lower_item}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS size, array_to_string(ws[s:s + least(10, len(ws)) - 1], ' ') AS gram
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM bi WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
windows AS (
  SELECT rid, pos, size, string_agg(w, ' ') OVER (PARTITION BY rid, size ORDER BY pos
    ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS ahead FROM dw, sizes),
grams AS (SELECT rid, pos, size, array_to_string(string_split(ahead, ' ')[1:size], ' ') AS gram FROM windows),
found AS (SELECT rid, pos, size, item_id FROM grams JOIN bw USING (size, gram)),
hit AS (SELECT rid, count(*)::BIGINT AS n_hit FROM (
  SELECT DISTINCT rid, unnest(range(pos, pos + size)) AS p FROM (SELECT DISTINCT rid, pos, size FROM found)) GROUP BY rid),
named AS (SELECT rid, count(*)::BIGINT AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (
  SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY rid)
""".format(lower_doc=LOWER.format("text"), lower_item=LOWER.format("text"))

OP9 = f"""
WITH numbered AS (SELECT row_number() OVER () AS rid, * FROM documents), {HITS}
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM numbered LEFT JOIN (SELECT rid, count(*)::BIGINT AS n_words FROM dw GROUP BY rid) USING (rid)
LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
"""

OP10 = f"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACES}', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""

ORACLES = {"op4_line_dedup": OP4, "op9_decontamination": OP9, "op10_exact_dedup": OP10}

OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT h, max(page_id) AS holder FROM p GROUP BY h)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> holder THEN holder END AS refers_to
FROM p JOIN g USING (h)
"""
ORACLES["op8_warc_salvage"] = OP8

# Shares by weight with a cap: after the k sources that reach it first, the others share the rest by weight.
OP13 = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  substr(md5(coalesce(doc_id::VARCHAR, '') || '/' || md5(coalesce(text, ''))), 1, 15) AS place FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::DOUBLE AS weight,
  sum(source_size) OVER ()::BIGINT AS total FROM s),
c AS (SELECT *, coalesce(sum(3 * source_size) OVER before, 0)::BIGINT AS held, sum(weight) OVER after AS open
  FROM w WINDOW before AS (ORDER BY 3 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  after AS (ORDER BY 3 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT arg_min((total - held) / open, 3 * source_size / weight) AS level FROM c
  WHERE weight * ((total - held) / open) < 3 * source_size),
t AS (SELECT source, source_size, CASE WHEN weight * coalesce(level, 0) >= 3 * source_size THEN (3 * source_size)::DOUBLE
  ELSE weight * coalesce(level, 0) END AS target FROM w LEFT JOIN l ON true),
p AS (SELECT d.*, source_size, target, floor(target)::BIGINT AS take, coalesce(sum(size) OVER (PARTITION BY d.source
  ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begun
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (greatest(0, least(size, take - begun)) + greatest(0, least(size, take - begun - source_size))
  + greatest(0, least(size, take - begun - 2 * source_size)))::BIGINT AS taken FROM p
"""
ORACLES["op13_source_mixing"] = OP13

OP12 = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS vec FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.rid AS anchor, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, b.rid AS other,
  coalesce(list_sum(list_transform(list_zip(a.vec, b.vec, true), lambda z: z[1] * z[2])), 0)::HUGEINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.rid <> b.rid),
p AS (SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id NULLS LAST, other) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.id NULLS LAST, n.other) AS rank
  FROM p JOIN pairs n ON p.anchor = n.anchor AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score::BIGINT AS positive_score,
  negative_score::BIGINT AS negative_score FROM n WHERE rank <= 3
"""
ORACLES["op12_hard_negatives"] = OP12

OP11 = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({text}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM t),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) AS p
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, p, count(*)::BIGINT AS f FROM g GROUP BY lang, k, p),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
often AS (SELECT * FROM f WHERE f >= 30),
cuts AS (SELECT c.lang, c.p, c.f AS a, l.f AS l, r.f AS r, cut, (2000000 * c.f::HUGEINT) // (l.f + r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM often WHERE k > 1) c
  JOIN often l ON l.lang = c.lang AND l.p = c.p[1:cut] JOIN often r ON r.lang = c.lang AND r.p = c.p[cut + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
inner_ AS (SELECT lang, p[i:i + m - 1] AS p, max(f) AS f FROM (
  SELECT lang, f, p, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM often WHERE k > 2)) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN inner_ i ON i.lang = best.lang AND i.p = best.p
  WHERE i.f IS NULL OR 100 * i.f::HUGEINT < 80 * a),
ranked AS (SELECT *, array_to_string(p, ' ') AS phrase,
  row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
""".format(text=LOWER.format("coalesce(text, '')"))
ORACLES["op11_phrase_mining"] = OP11
