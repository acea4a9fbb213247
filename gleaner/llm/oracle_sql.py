"""SQL for DuckDB of the corpus queries that SQL can state: set similarity, line frequency, fingerprints."""

LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: Pairs by an inverted index of shingles, components by reachability.
JACCARD = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '[^\x20\x09-\x0D]+') AS words FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')] ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')))) END AS shingles FROM w),
 n AS (SELECT doc_id, len(shingles) AS n, md5(array_to_string(shingles, chr(10))) AS class FROM s),
 heads AS (SELECT class, min(doc_id) AS head, any_value(n) AS n FROM n WHERE n > 0 GROUP BY class),
 x AS (SELECT doc_id, unnest(shingles) AS shingle FROM s WHERE doc_id IN (SELECT head FROM heads)),
 p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
 l AS (SELECT a, b FROM p JOIN heads h ON h.head = a JOIN heads k ON k.head = b WHERE 100 * common >= 85 * (h.n + k.n - common)),
 e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l), r AS (SELECT head AS a, head AS b FROM heads UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
 c AS (SELECT a AS head, min(b) AS component FROM r GROUP BY a), d AS (SELECT a AS head, count(*) AS links FROM e GROUP BY a)
 SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, coalesce(c.component, n.doc_id) AS component_id, coalesce(d.links, 0) AS n_links FROM n LEFT JOIN heads ON heads.class = n.class AND n.n > 0 LEFT JOIN c ON c.head = heads.head LEFT JOIN d ON d.head = heads.head"""

SPACES = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
#: Base counts of whole texts; lines of more than 50 distinct documents of a host; what they leave.
QUALITY = rf"""WITH t AS (SELECT doc_id, source, text, coalesce(text, '') AS whole FROM documents),
 w AS (SELECT *, regexp_extract_all(whole, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(whole, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS own_lines FROM t),
 g AS (SELECT doc_id, i, array_to_string(words[i:i + 2], ' ') AS three FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
 twice AS (SELECT doc_id, three FROM g GROUP BY 1, 2 HAVING count(*) > 1),
 places AS (SELECT DISTINCT g.doc_id, g.i + k AS at FROM g JOIN twice USING (doc_id, three) CROSS JOIN (VALUES (0), (1), (2)) v(k)),
 again AS (SELECT doc_id, count(*) AS n FROM places GROUP BY doc_id),
 base AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(whole, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(own_lines) - len(list_distinct(own_lines)) AS BIGINT) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words FROM w LEFT JOIN again USING (doc_id)),
 d AS (SELECT DISTINCT source, text FROM t WHERE text IS NOT NULL),
 z AS (SELECT source, text, unnest(list_filter(string_split(lower(regexp_replace(trim(text, {SPACES}), '[\x20\x09\x0B-\x0D]+', ' ', 'g')), chr(10)), lambda x: trim(x, {SPACES}) <> '')) AS line FROM d),
 y AS (SELECT source, text, trim(line, {SPACES}) AS h, length(line) AS n FROM z),
 frequent AS (SELECT source, h FROM y GROUP BY 1, 2 HAVING count(DISTINCT text) > 50),
 lost AS (SELECT y.source, y.text, sum(n) AS total, sum(CASE WHEN f.h IS NOT NULL THEN n ELSE 0 END) AS gone FROM y LEFT JOIN frequent f ON f.h = y.h AND f.source IS NOT DISTINCT FROM y.source GROUP BY 1, 2)
 SELECT base.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT coalesce(gone > 0 AND total - gone < 0.2 * total, false) AS kept FROM base JOIN t USING (doc_id) LEFT JOIN lost ON lost.text = t.text AND lost.source IS NOT DISTINCT FROM t.source"""


def fingerprint(leaves: str, sections: str) -> str:
    return f"concat_ws(':', sha256(array_to_string({sections}, ',')), array_to_string({sections}, ','), array_to_string({leaves}, ','))"


def tree(name: str, source: str) -> str:
    """Leaves, sections and fingerprint of `text` of a table."""
    return rf"""{name}l AS (SELECT *, list_transform(regexp_extract_all(text, '[^\n.!?]{{1,200}}[\n.!?]*|[\n.!?]{{1,200}}'), lambda p: substring(md5(p), 1, 12)) AS leaves FROM {source}),
 {name}s AS (SELECT *, list_transform(range(0, (len(leaves) + 7) // 8), lambda i: substring(md5(array_to_string(leaves[8 * i + 1:8 * i + 8], ',')), 1, 16)) AS sections FROM {name}l),
 {name} AS (SELECT *, {fingerprint("leaves", "sections")} AS print, list_distinct(leaves) AS parts FROM {name}s)"""


def likeness(a: str, b: str) -> str:
    return f"CASE WHEN split_part({a}.print, ':', 1) = split_part({b}.print, ':', 1) THEN 1.0 WHEN len({a}.parts) + len({b}.parts) = 0 THEN 0.0 ELSE 2.0 * len(list_intersect({a}.parts, {b}.parts)) / (len({a}.parts) + len({b}.parts)) END"


FINGERPRINTS = rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id) AS i, count(*) OVER () AS n FROM documents), {tree("o", "t")},
 e0 AS (SELECT a.i, concat(substring(a.text, 1, length(a.text) - length(a.text) // 2), substring(b.text, 1, length(a.text) // 2)) AS text FROM t a JOIN t b ON b.i = a.i % a.n + 1), {tree("e", "e0")},
 f AS (SELECT o.doc_id, o.text, o.print, o.sections, e.text AS edited, e.print AS edited_print, e.sections AS edited_sections, {likeness("o", "e")} AS near_edited, {likeness("o", "x")} AS near_next FROM o JOIN e ON e.i = o.i JOIN o x ON x.i = o.i % o.n + 1),
 g AS (SELECT *, CASE WHEN split_part(print, ':', 1) = split_part(edited_print, ':', 1) THEN [] ELSE list_filter(range(0, len(sections)), lambda i: NOT list_contains(edited_sections, sections[i + 1])) END AS places FROM f)
 SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, print AS fingerprint, edited_print AS edited_fingerprint, CAST(near_edited AS DOUBLE) AS near_edited, CAST(near_next AS DOUBLE) AS near_next, CAST(places[1] AS INT) AS first_edited_section, CAST(len(places) AS INT) AS n_edited_sections FROM g"""

ORACLE_SQL = {"op2_ngram_join": JACCARD, "op6_quality": QUALITY, "op9_fingerprints": FINGERPRINTS}
