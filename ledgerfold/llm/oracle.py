"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(text: str = "text", pattern: str = WORD) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '{pattern}')"


SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {words()} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM d, unnest(range(1, len(w) - 18)) AS t(i)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, p FROM later, unnest(range(i, i + 20)) AS t(p)),
each AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (SELECT doc_id, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS said
         FROM each LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(said, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

JACCARD_JOIN = f"""
WITH RECURSIVE d AS (SELECT doc_id, {words(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s AS x JOIN s AS y ON x.k = y.k AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id
FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) AS m USING (doc_id)"""

_ORDER = 4
URL_FILTER = f"""
WITH raw AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
cut AS (SELECT page_id, coalesce(rest, '') AS rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS h FROM raw),
parts AS (SELECT page_id, {LOWER.format("h")} AS host, regexp_extract(substring(rest, length(h) + 1), '^[^?#]*') AS path FROM cut),
rules(name, rule_host, rule_path, allow) AS (VALUES ('com/', 'com', '/', true), ('example.com/en/', 'example.com', '/en/', false),
    ('www.example.com/en/', 'www.example.com', '/en/', true), ('net/es/', 'net', '/es/', false), ('net/fr/', 'net', '/fr/', false)),
ruled AS (SELECT page_id, host, path, max_by(name, length(name)) AS rule, max_by(allow, length(name)) AS allow
    FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY ALL),
urls AS (SELECT host || path AS said, count(*) FILTER (allow) AS n_allow, count(*) FILTER (NOT allow) AS n_block FROM ruled GROUP BY 1),
g AS (SELECT said, n_allow, n_block, substring(repeat(chr(2), {_ORDER}) || said || chr(3), i, {_ORDER + 1}) AS gram FROM urls, unnest(range(1, length(said) + 2)) AS t(i)),
counts AS (SELECT gram, sum(n_allow) AS n_allow, sum(n_block) AS n_block FROM g GROUP BY 1),
size AS (SELECT count(DISTINCT right(gram, 1)) AS size FROM counts),
tails AS (SELECT gram, right(gram, k) AS tail, k, n_allow, n_block FROM counts, unnest(range(1, {_ORDER + 2})) AS t(k)),
seen AS (SELECT tail, left(tail, length(tail) - 1) AS context, sum(n_allow) AS n_allow, sum(n_block) AS n_block FROM tails GROUP BY 1),
aft AS (SELECT context, sum(n_allow) AS all_allow, sum(n_block) AS all_block, count(*) FILTER (n_allow > 0) AS kinds_allow, count(*) FILTER (n_block > 0) AS kinds_block FROM seen GROUP BY 1),
known AS (SELECT * FROM seen JOIN aft USING (context)),
steps AS (SELECT gram, {", ".join(f"max(CASE WHEN k = {k} THEN {c}_{s} END)::DOUBLE AS {c}_{s}{k}" for k in range(1, _ORDER + 2) for s in ("allow", "block") for c in ("n", "all", "kinds"))}
    FROM (SELECT gram, tail, k FROM tails) JOIN known USING (tail) GROUP BY gram),
p0 AS (SELECT *, 1.0::DOUBLE / size AS p_allow0, 1.0::DOUBLE / size AS p_block0 FROM steps, size),
{", ".join(f"p{k} AS (SELECT *, " + ", ".join(f"CASE WHEN all_{s}{k} > 0 THEN (n_{s}{k} + kinds_{s}{k} * p_{s}{k - 1}) / (all_{s}{k} + kinds_{s}{k}) ELSE p_{s}{k - 1} END AS p_{s}{k}" for s in ("allow", "block")) + f" FROM p{k - 1})" for k in range(1, _ORDER + 2))},
scores AS (SELECT gram, round((ln(p_allow{_ORDER + 1}) - ln(p_block{_ORDER + 1})) * 1000000)::BIGINT AS score FROM p{_ORDER + 1}),
scored AS (SELECT said, n_allow, n_block, floor(sum(score)::DOUBLE / (count(*) * 1000))::BIGINT AS mean FROM g JOIN scores USING (gram) GROUP BY ALL),
hist AS (SELECT mean AS step, sum(n_allow) AS a, sum(n_block) AS b FROM scored WHERE n_allow + n_block > 0 GROUP BY 1),
total AS (SELECT sum(a)::DOUBLE AS a, sum(b)::DOUBLE AS b FROM hist),
swept AS (SELECT step, lag(step) OVER o AS last, coalesce(sum(h.b) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / t.b
    + (t.a - coalesce(sum(h.a) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / t.a AS rate FROM hist AS h, total AS t WHERE t.a > 0 AND t.b > 0 WINDOW o AS (ORDER BY step)),
best AS (SELECT floor((coalesce(last, step) + step) / 2)::BIGINT AS least FROM swept ORDER BY rate DESC, step LIMIT 1)
SELECT page_id, host, path, rule, CASE WHEN coalesce(allow, mean >= (SELECT least FROM best), true) THEN 'allow' ELSE 'block' END AS verdict,
    CASE WHEN allow IS NULL THEN mean END AS score
FROM ruled LEFT JOIN scored ON scored.said = host || path"""

_KINDS = (
    ("assign", "((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"'']?\\x20*[:=]\\x20*[\"'']?)([A-Za-z0-9+/_.=-]+)", 12),
    ("access", "()(AKIA[A-Z0-9]+)", 18), ("hex", "()([0-9a-f]+)", 16), ("live", "()([A-Za-z0-9+/_=-]+)", 24))
SECRET_SCAN = f"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS owner, translate(coalesce(text, ''), chr(1) || chr(2) || chr(4), chr(5) || chr(5) || chr(5)) AS text FROM documents),
marked AS ({" UNION ALL ".join(f"SELECT doc_id, owner, {k} AS kind, {n} AS least, string_split(regexp_replace(text, '{p}', chr(1) || '\\1' || chr(4) || '\\2' || chr(2), 'g'), chr(1)) AS parts FROM t" for k, (_, p, n) in enumerate(_KINDS))}),
pieces AS (SELECT doc_id, owner, kind, least, i, parts[i] AS part, split_part(parts[i], chr(2), 1) AS body FROM marked, unnest(range(1, len(parts) + 1)) AS u(i) WHERE len(parts) > 1),
sized AS (SELECT *, split_part(body, chr(4), 2) AS value, CASE WHEN i = 1 THEN 0 ELSE length(body) - 1 END AS size,
    CASE WHEN i = 1 THEN length(part) ELSE length(part) - length(body) - 1 END AS rest FROM pieces),
placed AS (SELECT *, sum(size + rest) OVER (PARTITION BY doc_id, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)::BIGINT AS start FROM sized),
found AS (SELECT doc_id, owner, kind, start, start + size AS stop, value FROM placed WHERE i > 1 AND length(value) >= least
    AND (kind < 3 OR (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')))),
owned AS (SELECT value, count(DISTINCT owner) AS n_owners, count(DISTINCT coalesce(doc_id::VARCHAR, '')) AS n_repositories FROM found GROUP BY 1),
base AS (SELECT * FROM found JOIN owned USING (value) WHERE kind < 3),
live AS (SELECT f.* FROM found AS f JOIN owned USING (value) WHERE kind = 3 AND n_owners <= 1 AND n_repositories <= 10
    AND NOT EXISTS (SELECT 1 FROM base AS b WHERE b.doc_id = f.doc_id AND b.start < f.stop AND f.start < b.stop)),
spans AS (SELECT doc_id, kind, start, stop, n_owners FROM base UNION ALL SELECT doc_id, kind, start, stop, 1 FROM live),
named AS (SELECT *, (['assign', 'access', 'hex', 'live'])[kind + 1] || ':' || start || ':' || stop AS line FROM spans),
grouped AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (kind = 3) AS n_live,
    count(*) FILTER (kind < 3 AND n_owners >= 3) AS n_example, string_agg(line, ',' ORDER BY start, kind) AS spans, string_agg(line, ',' ORDER BY start, kind) FILTER (kind < 3) AS base FROM named GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example
FROM documents LEFT JOIN grouped USING (doc_id)"""

_BOILERPLATE = r"\ball rights reserved\b|\bclick here\b|\b(accept|uses?|use of) (all )?cookies\b|\benable javascript\b|\bprivacy policy\b|\bsubscribe to (our|the) newsletter\b|\bterms of (use|service)\b"
LINE_RULES = f"""
WITH d AS (SELECT doc_id, text, {words()} AS w, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
three AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM d, unnest(range(1, len(w) - 1)) AS t(i)),
again AS (SELECT doc_id, k FROM three GROUP BY 1, 2 HAVING count(*) > 1),
tri AS (SELECT doc_id, i FROM three JOIN again USING (doc_id, k)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM tri, unnest(range(i, i + 3)) AS t(p) GROUP BY 1),
lines AS (SELECT doc_id, i, l[i] AS line, {words("l[i]")} AS w FROM d, unnest(range(1, len(l) + 1 - (l[-1] = '')::INT)) AS t(i)),
seen AS (SELECT *, len(w) > 0 AS spoken, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again FROM lines),
judged AS (SELECT *, spoken AND again AS dup, length(array_to_string(w, '')) AS chars, spoken AND (again
    OR (len(w) >= 4 AND NOT regexp_matches(w[-1], '[.!?:;"'')\\x{{80}}-\\x{{10FFFF}}]$'))
    OR 4 * len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&|<>]'))) > len(w)
    OR (len(regexp_extract_all(line, '[|>]')) + 1 >= 4 AND len(w) <= 3.0 * (len(regexp_extract_all(line, '[|>]')) + 1))
    OR regexp_matches(line, '(?i){_BOILERPLATE}')) AS bad FROM seen),
sums AS (SELECT doc_id, count(*) FILTER (dup) AS n_dup, count(*) FILTER (bad) AS n_bad, coalesce(sum(chars) FILTER (NOT bad), 0) AS chars_left, string_agg(line, chr(10) ORDER BY i) FILTER (NOT bad) AS said FROM judged GROUP BY 1),
base AS (SELECT d.doc_id, d.text, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(coalesce(d.text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(n_bad, 0)::BIGINT AS n_bad_lines, coalesce(chars_left, 0) AS chars_left, said
    FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN sums USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND 100 * chars_left >= 50 * word_chars AS kept, n_bad_lines,
    sha256(CASE WHEN n_bad_lines > 0 THEN coalesce(said, '') ELSE text END) AS kept_text_sha256 FROM failed"""

_ESCAPED = "replace(replace(replace({}, '~', '~0'), '<|', '<~1'), '|>', '|~2')"
CHAT_FORMAT = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length(replace({_ESCAPED.format("role")}, '/', '~3')) + length({_ESCAPED.format("text")}) + 15)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""

_TEST_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATE = f"""
WITH b AS (SELECT item_id, {words(LOWER.format("coalesce(text, '')"), _TEST_WORD)} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, len(w[i:i + 9]) AS n, array_to_string(w[i:i + 9], ' ') AS k FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
d AS (SELECT doc_id, {words(LOWER.format("coalesce(text, '')"), _TEST_WORD)} AS w FROM documents),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM d, (SELECT DISTINCT n FROM bw) AS s, unnest(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
hw AS (SELECT doc_id, count(DISTINCT p) AS n FROM hit, unnest(range(i, i + hit.n)) AS t(p) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(hw.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(hw.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN it USING (doc_id)"""

def _round(k: int) -> str:
    """Assignment of all parts to the codebooks c{k}, and the codebooks after it."""
    return f"""
a{k} AS MATERIALIZED (SELECT id, x.p, min(struct_pack(d := list_dot_product(c.v, c.v) - 2 * list_dot_product(x.v, c.v), e := e)) AS m FROM x JOIN c{k} AS c USING (p) GROUP BY ALL),
m{k} AS (SELECT p, e, list(y ORDER BY i) AS v FROM (SELECT p, m.e AS e, i, floor(sum(v[i]) / count(*)) AS y FROM a{k} JOIN x USING (id, p), unnest(range(1, len(v) + 1)) AS t(i) GROUP BY ALL) GROUP BY ALL),
c{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.v, c.v) AS v FROM c{k} AS c LEFT JOIN m{k} AS m USING (p, e)),"""


VECTOR_CODES = f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings WHERE len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
x AS MATERIALIZED (SELECT id, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS v FROM kept, unnest(range(4)) AS t(p)),
c0 AS (SELECT p, id - 1 AS e, v FROM x WHERE id <= 256),{"".join(map(_round, range(4)))}
final AS (SELECT id, x.p, min(struct_pack(d := list_dot_product(c.v, c.v) - 2 * list_dot_product(x.v, c.v), e := e)) AS m, any_value(list_dot_product(x.v, x.v)) AS n FROM x JOIN c4 AS c USING (p) GROUP BY ALL),
coded AS (SELECT id, string_agg(format('{{:02x}}', m.e), '' ORDER BY p) AS code, sum(n + m.d)::BIGINT AS error FROM final GROUP BY id),
books AS (SELECT sha256(string_agg(v[i]::BIGINT, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM c4, unnest(range(1, len(v) + 1)) AS t(i))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN coded USING (id), books"""

_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SOURCE_DIVERGENCE = f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {words(LOWER.format("coalesce(text, '')"), _TERM)} AS w FROM documents),
t AS MATERIALIZED (SELECT lang, source, id, term, count(*) AS n FROM (SELECT *, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS total FROM t GROUP BY ALL HAVING count(*) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY 1),
c AS (SELECT lang, source, term, sum(n) AS n, any_value(total) AS total FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(langs.v, 0) AS v, langs.n AS lang_n, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN langs USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) AS c USING (lang, source)),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (g.n + 5 * g.v) AS p, 1 + 1000000000::HUGEINT * (k.total + 5) // (g.lang_n + 5 * g.v) AS q
    FROM g JOIN kept AS k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(s.value, 0) AS value FROM g AS x JOIN g AS y ON x.lang = y.lang AND x.source <> y.source
    LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) AS s
    ON s.lang = x.lang AND s.source = x.source AND s.item = y.source),
own AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM (FROM pairs UNION ALL FROM own)
QUALIFY part = 'pair' OR rank <= 50"""

TOPK_SEARCH = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS (SELECT q.id, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM v AS q JOIN v AS c ON q.id <> c.id WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s QUALIFY rank <= 10"""

ORACLE = {
    "op2_substring_dedup": SUBSTRING_DEDUP, "op3_jaccard_join": JACCARD_JOIN, "op4_url_filter": URL_FILTER, "op6_secret_scan": SECRET_SCAN,
    "op7_line_rules": LINE_RULES, "op8_chat_format": CHAT_FORMAT, "op10_decontaminate": DECONTAMINATE,
    "op11_vector_codes": VECTOR_CODES, "op12_source_divergence": SOURCE_DIVERGENCE, "op13_topk_search": TOPK_SEARCH}
