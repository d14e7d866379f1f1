"""SQL for DuckDB that states queries of this subpackage another way."""

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

REACH = """
p AS (SELECT a, b FROM linked UNION SELECT b, a FROM linked),
reach(node, other) AS (
  SELECT a, a FROM p UNION SELECT r.node, p.b FROM reach r JOIN p ON r.other = p.a),
low AS (SELECT node, min(other) AS component FROM reach GROUP BY node)"""

NEAR_DEDUP = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
linked AS (
  SELECT x.a, x.b FROM (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL) x
  JOIN n na ON na.doc_id = x.a JOIN n nb ON nb.doc_id = x.b WHERE 100 * shared >= 80 * (na.n + nb.n - shared)),{REACH}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.component, d.doc_id) AS component_id, coalesce(low.component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.node = d.doc_id"""

NEAR_VECTORS = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
linked AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),{REACH}
SELECT e.vec_id, (SELECT count(*) FROM p WHERE p.a = e.vec_id) AS n_links, coalesce(low.component, e.vec_id) AS component_id,
       coalesce(low.component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN low ON low.node = e.vec_id"""


def _places(name: str, pattern: str, group: int) -> str:
    """Start, end and value of each match, from the lengths of the pieces between matches."""
    return rf"""
{name}_m AS (
  SELECT doc_id, string_split_regex(t, {pattern}) AS gap, regexp_extract_all(t, {pattern}) AS hit, regexp_extract_all(t, {pattern}, {group}) AS part
  FROM d WHERE regexp_matches(t, {pattern})),
{name} AS (
  SELECT doc_id, list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hit[1:i - 1], lambda x: length(x))), 0) AS a,
         a + length(hit[i]) AS b, part[i] AS v
  FROM (SELECT *, unnest(range(1, len(hit) + 1)) AS i FROM {name}_m))"""


ASSIGN = r"""'(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""

SECRETS = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{_places('m0', ASSIGN, 2)},
{_places('m1', "'AKIA[A-Z0-9]+'", 0)},
{_places('m2', "'[0-9a-f]{32,}'", 0)},
{_places('m3', "'[A-Za-z0-9+/_=-]{20,}'", 0)},
base AS (
  SELECT doc_id, a, 0 AS r, b, 'assign' AS kind FROM m0 WHERE length(v) >= 8
  UNION ALL SELECT doc_id, a, 1, b, 'access' FROM m1 WHERE length(v) >= 16
  UNION ALL SELECT doc_id, a, 2, b, 'hex' FROM m2),
windows AS (
  SELECT *, regexp_full_match(v, '[0-9a-f]+|[0-9A-F]+') AS is_hex,
         list_min(list_transform(range(1, length(v) - 18), lambda i: list_sum(list_transform(
           map_values(list_histogram(string_split(substr(v, i, 20), ''))), lambda c: round(1048576 * c * log2(c)))))) AS least
  FROM m3 WHERE regexp_matches(v, '[0-9]') AND NOT regexp_full_match(v, '[0-9+/_=-]+')
    AND NOT regexp_full_match(v, '[0-9A-Fa-f]{{8}}-([0-9A-Fa-f]{{4}}-){{3}}[0-9A-Fa-f]{{12}}')
    AND NOT regexp_full_match(v, '([A-Za-z]+|[0-9]+)([/_=-]+([A-Za-z]+|[0-9]+))+')),
every AS (
  SELECT * FROM base
  UNION ALL
  SELECT doc_id, a, CASE WHEN is_hex THEN 3 ELSE 4 END, b, CASE WHEN is_hex THEN 'entropy_hex' ELSE 'entropy_base64' END
  FROM windows WHERE least <= floor(1048576 * 20 * (log2(20) - CASE WHEN is_hex THEN 3.05 ELSE 3.75 END))),
g AS (
  SELECT doc_id, count(*) FILTER (r = 0) AS n0, count(*) FILTER (r = 1) AS n1, count(*) FILTER (r = 2) AS n2,
         string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY a, r) FILTER (r < 3) AS base,
         string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY a, r) AS spans
  FROM every GROUP BY doc_id)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN g USING (doc_id)"""


def _dearer(value: str, cost: str, letter: str) -> str:
    """A state's ``cost audit`` with more cost and one more letter; null stays null."""
    return f"lpad(CAST(CAST({value}[1:8] AS BIGINT) + {cost} AS VARCHAR), 8, '0') || {value}[9:] || '{letter}'"


def _inserted(u: str, a: str, rest: tuple[str, ...]) -> tuple[str, str]:
    """States u and a after at most one inserted row."""
    return (f"least({', '.join([u, *[_dearer(x, '3', 'I') for x in (a, *rest)]])})", f"least({a}, {_dearer(u, '3', 'I')})")


# Left to right over the rows: the least cost and audit that end in nothing (b), after s (y), after user (u), after assistant (a).
REPAIR = rf"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda c, x: list_reduce(list_concat([xor(c, x)], range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 20 AS kind
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS again
  FROM k WHERE kind <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (
  SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again_seen,
         NOT regexp_matches(text, '[.!?][ 	-
]*$') AS unended, role[1:1] || lead(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS pair
  FROM n),
c AS (
  SELECT *, blank OR again_seen AS gone, CASE WHEN unended THEN 3 ELSE 0 END AS more, role[1:1] AS initial FROM f),
s AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again_seen) AS duplicate,
         count(*) FILTER (NOT gone AND unended) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS rows
  FROM c GROUP BY conv_id),
walk(conv_id, i, b, y, u, a) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '00000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM s
  UNION ALL
  SELECT w.conv_id, w.i + 1, {_dearer('b', '4', 'D')},
         least({_dearer('y', '4', 'D')}, CASE WHEN initial = 's' AND NOT gone THEN {_dearer('b', 'more', 'K')} END),
         least({_dearer('u2', '4', 'D')}, CASE WHEN NOT gone THEN least({', '.join(f"CASE WHEN initial = 'u' THEN {_dearer(x, 'more', 'K')} ELSE {_dearer(x, '3 + more', 'R')} END" for x in ('b', 'y', 'a2'))}) END),
         least({_dearer('a2', '4', 'D')}, CASE WHEN NOT gone THEN CASE WHEN initial = 'a' THEN {_dearer('u2', 'more', 'K')} ELSE {_dearer('u2', '3 + more', 'R')} END END)
  FROM (SELECT *, {_inserted('u1', 'a1', ('b', 'y'))[0]} AS u2, {_inserted('u1', 'a1', ())[1]} AS a2
        FROM (SELECT *, {_inserted('u', 'a', ('b', 'y'))[0]} AS u1, {_inserted('u', 'a', ())[1]} AS a1 FROM walk)) w
  JOIN c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.i = w.i + 1),
ended AS (
  SELECT s.*, least(w.b, a, {_dearer('u', '3', 'I')}, {_dearer('(' + _dearer('y', '3', 'I') + ')', '3', 'I')}) AS best
  FROM s JOIN walk w ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.i = s.rows),
letters AS (
  SELECT conv_id, CAST(best[1:8] AS BIGINT) AS cost, best[9:] AS audit, unnest(string_split(best[9:], '')) AS letter, unnest(range(1, length(best) - 7)) AS spot FROM ended),
l AS (
  SELECT *, sum((letter <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY spot) AS i, sum((letter <> 'D')::INT) OVER (PARTITION BY conv_id ORDER BY spot) AS k
  FROM letters),
o AS (
  SELECT l.conv_id, l.spot, l.letter, c.role, c.text, l.k - (min(CASE WHEN k = 1 AND letter = 'K' AND initial = 's' THEN 1 ELSE 2 END) OVER (PARTITION BY l.conv_id) = 1)::INT AS k
  FROM l LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM l.conv_id AND c.i = l.i AND l.letter <> 'I'),
t AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN k % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY spot) AS lines
  FROM o WHERE letter IN ('I', 'K', 'R') GROUP BY conv_id)
SELECT q.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(CAST(best[1:8] AS BIGINT), 0) AS cost, coalesce(best[9:], '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) q
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM q.conv_id"""


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
c AS (SELECT count(*) AS N, CAST(sum(len(terms)) AS BIGINT) AS L FROM d WHERE len(terms) > 0),
o AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(N) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM o, c GROUP BY term),
m AS (SELECT row, doc_id, 50 + (50 * len(terms) * N) // L AS m FROM d, c WHERE len(terms) > 0),
s AS (
  SELECT item_id, row, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN o USING (term) JOIN m USING (row) GROUP BY item_id, row),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50"""
