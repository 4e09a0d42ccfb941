"""SQL that checks the queries, written apart from the operators."""

from __future__ import annotations


def url_filter(rules: tuple[tuple[str, str, str], ...]) -> str:
    return f"""
WITH cut AS (
  SELECT row_number() OVER () AS n, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT n, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path
  FROM cut
), rules(r_host, r_path, verdict) AS (VALUES {', '.join(map(str, rules))}
), ranked AS (
  SELECT n, page_id, host, path, r_host || r_path AS rule, verdict,
         row_number() OVER (PARTITION BY n ORDER BY length(r_host || r_path) DESC NULLS LAST) AS place
  FROM parts LEFT JOIN rules
    ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM ranked WHERE place = 1
"""


_WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(x: str) -> str:
    return f"translate({x}, '{_UPPER}', '{_UPPER.lower()}')"


def line_frequency(
    host: str, min_docs: int, max_share: float, max_docs: int, max_removed: float,
    min_words: int, max_repeated: int,
) -> str:
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, {host} AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '{_WORD}')) AS lines
  FROM documents
), triples AS (
  SELECT n, j, w[j] || ' ' || w[j + 1] || ' ' || w[j + 2] AS triple
  FROM docs, unnest(range(1, len(w) - 1)) AS t(j)
), again AS (
  SELECT n, j FROM triples QUALIFY count(*) OVER (PARTITION BY n, triple) > 1
), repeated AS (
  SELECT n, count(DISTINCT j + k) AS n_repeat_words
  FROM again, unnest([0, 1, 2]) AS t(k) GROUP BY n
), normal AS (
  SELECT n, host, regexp_extract_all({_lower('line')}, '{_WORD}') AS lw
  FROM (SELECT n, host, unnest(lines) AS line FROM docs)
), held AS (
  SELECT host, array_to_string(lw, ' ') AS line, count(DISTINCT n) AS n_docs
  FROM normal GROUP BY ALL
), hosts AS (SELECT host, count(*) AS docs FROM docs GROUP BY host
), frequent AS (
  SELECT held.host, line FROM held JOIN hosts ON held.host IS NOT DISTINCT FROM hosts.host
  WHERE n_docs > {max_docs} OR (n_docs > {min_docs} AND n_docs > {max_share} * hosts.docs)
), lost AS (
  SELECT n, CAST(sum(len(lw)) AS BIGINT) AS lost
  FROM normal JOIN frequent ON normal.host IS NOT DISTINCT FROM frequent.host
    AND array_to_string(lw, ' ') = frequent.line
  GROUP BY n
), counted AS (
  SELECT doc_id, len(w) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS n_line_words_removed
  FROM docs LEFT JOIN repeated USING (n) LEFT JOIN lost USING (n)
)
SELECT *, n_words < {min_words} OR 100 * n_repeat_words > {max_repeated} * n_words AS base_failed,
       NOT (n_words < {min_words} OR 100 * n_repeat_words > {max_repeated} * n_words)
         AND n_line_words_removed <= {max_removed} * n_words AS kept
FROM counted
"""


def window_dedup(width: int) -> str:
    return f"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(w[s : s + {width - 1}], ' ') AS words
  FROM docs, unnest(range(1, len(w) - {width - 2})) AS t(s)
), later AS (
  SELECT doc_id, s FROM windows
  QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id, s) > 1
), gone AS (
  SELECT DISTINCT doc_id, s + k AS i FROM later, unnest(range(0, {width})) AS t(k)
), numbered AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM docs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words, count(*) AS n
  FROM numbered ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


def contained_items(words: int, percent: int) -> str:
    def shingles(table: str, key: str) -> str:
        found = f"regexp_extract_all({_lower('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
        return f"""SELECT DISTINCT {key}, array_to_string(w[s : s + {words - 1}], ' ') AS shingle
  FROM (SELECT {key}, {found} AS w FROM {table}), unnest(range(1, len(w) - {words - 2})) AS t(s)"""

    return f"""
WITH items AS ({shingles('benchmark', 'item_id')}
), docs AS ({shingles('documents', 'doc_id')}
), sizes AS (SELECT item_id, count(*) AS n_shingles FROM items GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_shingles, count(*) / n_shingles AS containment
FROM docs JOIN items USING (shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING 100 * count(*) >= {percent} * n_shingles
"""


def ngram_join(words: int, percent: int) -> str:
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_WORD}') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s : s + {words - 1}], ' ') AS shingle
  FROM docs, unnest(range(1, greatest(len(w) - {words - 2}, least(len(w), 1) + 1))) AS t(s)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= {percent} * (x.n + y.n - shared)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM docs
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM docs LEFT JOIN sizes USING (doc_id) JOIN least USING (doc_id)
"""
