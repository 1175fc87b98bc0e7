"""DuckDB SQL with the same results as the queries of the subpackage that SQL can express."""

from __future__ import annotations

from corpuslens.llm.licenses import TEMPLATES, THRESHOLD, template_bigrams
from corpuslens.llm.ngram_join import SIMILARITY, WORDS
from corpuslens.llm.substrings import WIDTH

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: Words of every text; none for null.
_WORDS = r"(SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)"


def _runs(n: int) -> str:
    return f"list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))"


_URLS = f"""
    WITH rules(verdict, rule, host, path) AS (VALUES
      ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
      ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
    parts AS (SELECT page_id, coalesce(translate(regexp_extract(url, '{_URL}', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
      coalesce(regexp_extract(url, '{_URL}', 2), '') AS path FROM pages),
    best AS (SELECT p.*, (SELECT max_by({{'rule': r.rule, 'verdict': r.verdict}}, length(r.rule))
      FROM rules r WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host))
        AND starts_with(p.path, r.path)) AS b FROM parts p)
    SELECT page_id, host, path, b.rule AS rule, coalesce(b.verdict, 'allow') AS verdict FROM best
"""

_NEAR = f"""
    WITH RECURSIVE sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WORDS}
        THEN [array_to_string(w, ' ')] ELSE list_sort(list_distinct({_runs(WORDS)})) END AS g
      FROM {_WORDS}),
    texts AS (SELECT g, min(doc_id) AS text_id, count(*) AS n FROM sets WHERE len(g) > 0 GROUP BY g),
    grams AS (SELECT text_id, len(g) AS size, unnest(g) AS gram FROM texts),
    pairs AS (SELECT a.text_id AS a, b.text_id AS b
      FROM grams a JOIN grams b ON a.gram = b.gram AND a.text_id < b.text_id
      GROUP BY a.text_id, b.text_id, a.size, b.size
      HAVING count(*) >= {SIMILARITY}::DOUBLE * (a.size + b.size - count(*)) - 1e-9),
    ends AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
    reach AS (SELECT text_id AS x, text_id AS y FROM texts
      UNION SELECT r.x, e.b FROM reach r JOIN ends e ON e.a = r.y),
    classes AS (SELECT x AS text_id, min(y) AS class_id FROM reach GROUP BY x),
    links AS (SELECT e.a AS text_id, sum(t.n) AS n_docs FROM ends e JOIN texts t ON t.text_id = e.b
      GROUP BY e.a)
    SELECT s.doc_id, coalesce(c.class_id, s.doc_id) AS class_id, coalesce(t.text_id, s.doc_id) AS text_id,
      coalesce(t.n, 1)::BIGINT AS n_copies, coalesce(t.n - 1 + coalesce(l.n_docs, 0), 0)::BIGINT AS n_links
    FROM sets s LEFT JOIN texts t ON t.g = s.g LEFT JOIN classes c USING (text_id)
    LEFT JOIN links l USING (text_id)
"""

_REPEATS = f"""
    WITH words AS {_WORDS},
    windows AS (SELECT doc_id, unnest({_runs(WIDTH)}) AS t, unnest(range(1, len(w) - {WIDTH - 2})) AS s
      FROM words WHERE len(w) >= {WIDTH}),
    later AS (SELECT doc_id, s FROM (SELECT doc_id, s,
        row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS r FROM windows) WHERE r > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + {WIDTH})) AS p FROM later),
    each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words),
    kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.p) FILTER (g.p IS NULL) AS t,
        count(g.p) AS n FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.p = e.p
      GROUP BY e.doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
      sha256(coalesce(t, '')) AS kept_sha256
    FROM words LEFT JOIN kept USING (doc_id)
"""


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEMPLATES = ", ".join(
    f"({_quote(name)}, [{', '.join(map(_quote, template_bigrams(t)))}])" for name, t in TEMPLATES.items()
)
_LICENSES = rf"""
    WITH templates(name, grams) AS (VALUES {_TEMPLATES}),
    plain AS (SELECT doc_id,
        regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS t FROM documents),
    parts AS (SELECT doc_id, unnest(list_concat(string_split(t, chr(10)),
        list_filter(regexp_split_to_array(t, '\n *\n'), lambda x: contains(trim(x), chr(10))),
        CASE WHEN contains(t, chr(10)) THEN [t] ELSE [] END)) AS part FROM plain),
    segments AS (SELECT DISTINCT doc_id, trim(replace(part, chr(10), ' ')) AS segment FROM parts),
    split AS (SELECT doc_id, segment, regexp_split_to_array(segment, ' +') AS w FROM segments),
    bigrams AS (SELECT doc_id, segment, list_distinct({_runs(2)}) AS b FROM split WHERE len(w) >= 2),
    hits AS (SELECT doc_id, segment, name,
        len(list_intersect(b, grams)) * 2.0::DOUBLE / (len(b) + len(grams)) AS dice
      FROM bigrams JOIN templates ON list_has_any(b, grams))
    SELECT doc_id, count(h.name)::INTEGER AS n_licenses, arg_min(name, rank) AS license,
      arg_min(dice, rank) AS dice, arg_min(segment, rank) AS license_text
    FROM documents LEFT JOIN (SELECT *, row_number() OVER (ORDER BY dice DESC, name, segment) AS rank
      FROM hits WHERE dice >= {THRESHOLD}::DOUBLE) h USING (doc_id) GROUP BY doc_id
"""

LLM_SQL: dict[str, str] = {
    "op2_ngram_join": _NEAR,
    "op5_licenses": _LICENSES,
    "op9_urls": _URLS,
    "op10_substrings": _REPEATS,
}
