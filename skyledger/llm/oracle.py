"""DuckDB SQL for the operators that SQL can express."""

from skyledger.llm.url_filter import BAD_NAMES, BUCKETS, DECAY, FACTORS, GOOD_NAMES, KINDS, ROUNDS

#: Word sizes and MD5 order. Sources fill up in the order of cap / weight; the level a source would
#: leave to the rest rises as long as sources are full and falls after that, so it is the greatest.
MIX = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size) AS cap,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM rows GROUP BY source),
filled AS (
  SELECT *, 1.5 * sum(source_size) OVER () AS budget,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
         sum(weight) OVER (ORDER BY cap / weight DESC, source DESC ROWS UNBOUNDED PRECEDING) AS weight_left
  FROM sources),
level AS (
  SELECT max((budget - cap_before) / weight_left) AS level FROM filled),
targets AS (
  SELECT f.source, f.source_size, least(cap, weight * coalesce(level, 0)) AS target FROM filled f, level),
placed AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, round(t.target)::BIGINT AS goal,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.key, r.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (goal // source_size) * size + greatest(0, least(size, goal % source_size - before)) END::BIGINT AS taken
FROM placed
"""

_ESCAPED = r"regexp_replace({}, '([<\[])(~*)(/?(?:s>|INST\]))', '\1~\2\3', 'g')"

CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (
  SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) <> role, true) AS opens FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length({_ESCAPED.format("text")}) + CASE WHEN role = 'assistant' THEN 7 ELSE 6 END
           + CASE WHEN opens THEN 7 + length({_ESCAPED.format("role")}) ELSE 0 END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

VECTORS = """
WITH RECURSIVE fine AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach(vec_id, node) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.node = l.a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id)::BIGINT AS n_links,
       r.least AS component_id, r.least = e.vec_id AS kept
FROM embeddings e JOIN (SELECT vec_id, min(node) AS least FROM reach GROUP BY vec_id) r USING (vec_id)
"""



def _grams(codes: str, length: int, moved: int) -> str:
    total = " + ".join([str(moved), *(f"{codes}[i + {n}] * {factor}" for n, factor in enumerate(FACTORS[:length]))])
    return f"list_transform(range(1, len({codes}) - {length - 2}), lambda i: ({total}) % {BUCKETS})"


def _names(names: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{name}'" for name in names) + "]"


_FEATURES = "list_distinct(" + " || ".join(_grams(f"{part}_codes", n, moved) for part, n, moved in KINDS) + ")"
_PARTS = r"""
  coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
  list_transform(regexp_extract_all('.' || host || '.', '(?s).'), lambda c: unicode(c)::BIGINT) AS host_codes,
  list_transform(regexp_extract_all(path, '(?s).'), lambda c: unicode(c)::BIGINT) AS path_codes
"""

#: The weights are the labelled urls' features times one coefficient each, as the descent starts from zero.
URLS = f"""
WITH RECURSIVE names AS (
  SELECT 1 AS label, unnest(range(len(n)))::BIGINT AS i, unnest(n) AS name FROM (SELECT {_names(BAD_NAMES)} AS n)
  UNION ALL SELECT 0, unnest(range(len(n)))::BIGINT, unnest(n) FROM (SELECT {_names(GOOD_NAMES)} AS n)),
labelled AS (
  SELECT label, (['http://', 'https://www.', 'https://m.', 'http://blog.', 'https://'])[i % 5 + 1] || name
         || (['.example.com', '.example.net', '.example.org', '.test'])[i // 2 % 4 + 1] || '/'
         || (['en', 'fr', 'de', 'es'])[i // 3 % 4 + 1] || '/' || CAST(1 + 37 * i AS VARCHAR) AS url
  FROM names),
learnt AS (
  SELECT row_number() OVER (ORDER BY url) AS n, label::DOUBLE AS label, {_FEATURES} AS buckets FROM (SELECT label, url, {_PARTS} FROM labelled)),
products AS (
  SELECT a.n, list(len(list_intersect(a.buckets, b.buckets)) / sqrt((len(a.buckets) * len(b.buckets))::DOUBLE) ORDER BY b.n) AS inner_products
  FROM learnt a, learnt b GROUP BY a.n),
fixed AS (
  SELECT (SELECT list(inner_products ORDER BY n) FROM products) AS products, (SELECT list(label ORDER BY n) FROM learnt) AS labels,
         (SELECT 4 / greatest(max(list_sum(inner_products)), 1) FROM products) AS step),
descent(round, parts) AS (
  SELECT 0, (SELECT list_transform(labels, lambda x: 0::DOUBLE) FROM fixed)
  UNION ALL
  SELECT round + 1, list_transform(products, lambda row, i:
           parts[i] * (1 - {DECAY}::DOUBLE) + step * (labels[i] - 1 / (1 + exp(-list_dot_product(row, parts)))))
  FROM descent, fixed WHERE round < {ROUNDS}),
parts AS (
  SELECT unnest(range(1, len(parts) + 1)) AS n, unnest(parts) AS part FROM descent WHERE round = {ROUNDS}),
weights AS (
  SELECT bucket, sum(share) AS weight
  FROM (SELECT unnest(buckets) AS bucket, part / sqrt(len(buckets)::DOUBLE) AS share FROM learnt JOIN parts USING (n)) GROUP BY bucket),
judged AS (
  SELECT row_number() OVER () AS place, page_id, host, path, {_FEATURES} AS buckets FROM (SELECT page_id, {_PARTS} FROM pages)),
scores AS (
  SELECT place, sum(weight) AS total FROM (SELECT place, unnest(buckets) AS bucket FROM judged) JOIN weights USING (bucket) GROUP BY place),
ruled AS (
  SELECT j.*, coalesce(total, 0) / sqrt(greatest(len(buckets), 1)::DOUBLE) AS score,
         CASE WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
              WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
              WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
              WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
              WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule
  FROM judged j LEFT JOIN scores USING (place))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN score > 0 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def _codebooks(rounds: int) -> str:
    """Lloyd's rounds over parts ``n, p, x``: codes_0 to codes_<rounds> and books_0 to books_<rounds>."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
codes_{r} AS (
  SELECT n, p, least % 16 AS e, least // 16 AS error
  FROM (SELECT a.n, a.p, min(list_sum(list_transform(a.x, lambda v, i: (v - b.c[i]) * (v - b.c[i])))::BIGINT * 16 + b.e) AS least
        FROM pieces a JOIN books_{r} b USING (p) GROUP BY a.n, a.p))""")
        if r < rounds:
            steps.append(f"""
sums_{r} AS (
  SELECT p, e, i, sum(v) AS s, count(*) AS k
  FROM (SELECT p, e, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS i FROM pieces JOIN codes_{r} USING (n, p)) GROUP BY ALL),
books_{r + 1} AS (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c
  FROM books_{r} b LEFT JOIN (
    SELECT p, e, list((((s - ((s % k) + k) % k)) // k)::BIGINT ORDER BY i) AS c FROM sums_{r} GROUP BY p, e) m USING (p, e))""")
    return ",".join(steps)


CODES = f"""
WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, x) AS n FROM whole WHERE len(x) = (SELECT max(len(x)) FROM whole)),
pieces AS (
  SELECT n, p, x[p * len(x) // 8 + 1:(p + 1) * len(x) // 8] AS x FROM numbered, (SELECT unnest(range(8)) AS p)),
books_0 AS (
  SELECT p, n - 1 AS e, x AS c FROM pieces WHERE n <= 16),{_codebooks(6)},
coded AS (
  SELECT n, string_agg(lpad(lower(hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(error)::BIGINT AS error FROM codes_6 GROUP BY n)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM books_6) AS codebooks_sha256
FROM coded JOIN numbered USING (n)
"""

ORACLE = {
    "op4_cap_filters": VECTORS,
    "op1_mix_sources": MIX,
    "op5_chat_format": CHAT,
    "op11_vector_codes": CODES,
    "op13_url_filter": URLS,
}
