"""DuckDB SQL with the same results as the registered queries, over the same whole tables."""

from __future__ import annotations

import string
from collections.abc import Sequence

from corpuslens.functions.countries import SURNAME_COUNTRY, SURNAME_PATTERNS
from corpuslens.functions.lexicon import (
    CATEGORY_KEYWORDS,
    DOMAIN_STOPWORDS,
    ENGLISH_STOPWORDS,
    GENERIC_STOPWORDS,
)
from corpuslens.operators.tfidf import known_terms
from corpuslens.operators.trends import OTHER_JOURNALS
from corpuslens.plans.inputs import (
    AT_LINE,
    BLOCK_IDS,
    DEEP_HEAD,
    KEYWORDS,
    TREND_TYPES,
    VECTOR_WIDTH,
)

_WORD = r"[\p{L}\p{M}\p{N}_]{2,}"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _items(words: Sequence[str]) -> str:
    return ", ".join(_quote(w) for w in words)


def _tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{_WORD}')"


def _ngrams(tokens: str, n: int) -> str:
    if n == 1:
        return tokens
    joined = " || ' ' || ".join(f"{tokens}[i + {k}]" for k in range(n))
    return f"list_transform(range(1, len({tokens}) - {n - 2}), lambda i: {joined})"


# ---- keywords and terms

_KEYWORD_HITS = """
    (length(d.text) - length(replace(lower(d.text), lower(k.keyword), ''))) // length(k.keyword)
"""


def _frequency(keyword_table: str) -> str:
    return f"""
    SELECT k.keyword, count(*) FILTER ({_KEYWORD_HITS} > 0) AS doc_freq,
           sum({_KEYWORD_HITS})::BIGINT AS abs_freq,
           round_even(count(*) FILTER ({_KEYWORD_HITS} > 0)::DOUBLE / count(*) * 100, 2) AS pct
    FROM {keyword_table} k CROSS JOIN documents d GROUP BY k.keyword
    """


_KNOWN = f"(SELECT unnest([{_items(KEYWORDS)}]) AS keyword)"
_KEYWORD_FREQUENCY = _frequency(_KNOWN)
_CATEGORY = _frequency(f"(SELECT unnest([{_items(CATEGORY_KEYWORDS)}]) AS keyword)")


def _weights(
    source: str, text: str, stop: Sequence[str], min_df: int, max_df: float, cap: int | None
) -> str:
    """CTEs ending in ``weights(doc_id, term, w)`` for sublinear uni- and bigram TF-IDF."""
    tokens = _tokens(text)
    if stop:
        tokens = f"list_filter({tokens}, lambda t: t NOT IN ({_items(stop)}))"
    order = f"ORDER BY cf DESC, term LIMIT {cap}" if cap else ""
    return f"""
    toks AS (SELECT doc_id, {tokens} AS t FROM {source}),
    grams AS (SELECT doc_id, unnest(list_concat(t, {_ngrams("t", 2)})) AS term FROM toks),
    counts AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY ALL),
    total AS (SELECT count(*) AS n FROM {source}),
    vocab AS (
      SELECT term, ln((n + 1)::DOUBLE / (df + 1)) + 1 AS idf FROM (
        SELECT term, count(*) AS df, sum(tf) AS cf FROM counts GROUP BY term), total
      WHERE df >= {min_df} AND df <= {max_df}::DOUBLE * n {order}),
    raw AS (SELECT doc_id, term, (ln(tf) + 1) * idf AS r FROM counts JOIN vocab USING (term)),
    weights AS (
      SELECT doc_id, term, r / sqrt(sum(r * r) OVER (PARTITION BY doc_id)) AS w FROM raw)
    """


_ALPHA = r"regexp_replace(lower(text), '[^a-zA-Z\s]', ' ', 'g')"

_NEW_TERMS = f"""
    WITH docs AS (SELECT doc_id, {_ALPHA} AS text FROM documents WHERE trim(text) <> ''),
    {_weights("docs", "text", ENGLISH_STOPWORDS, 2, 0.95, 300)},
    scores AS (SELECT term, sum(w) / (SELECT n FROM total) AS score FROM weights GROUP BY term)
    SELECT term, round_even(score, 5) AS tfidf_score FROM scores
    WHERE length(term) >= 4 AND NOT regexp_matches(term, '^[0-9 ]+$')
      AND term NOT IN ({_items(known_terms(KEYWORDS))})
      AND NOT list_has_any(string_split(term, ' '), [{_items(GENERIC_STOPWORDS)}])
    ORDER BY round(score, 12) DESC, term LIMIT 15
"""

_GROUP_COMPARISON = f"""
    SELECT keyword, doc_freq, 'Originales' AS grupo FROM ({_KEYWORD_FREQUENCY})
    UNION ALL
    SELECT keyword, doc_freq, 'Nuevas (TF-IDF)' AS grupo
    FROM ({_frequency(f"(SELECT term AS keyword FROM ({_NEW_TERMS}))")})
"""

_CORPUS_TFIDF = f"""
    WITH {_weights("documents", "text", (), 1, 1.0, None)}
    SELECT term, count(*) AS docs, round(sum(w), 6) AS total_weight FROM weights GROUP BY term
"""

# ---- text

_NO_DIGITS = r"regexp_replace(lower(text), '\d+', ' ', 'g')"
_CLEAN = (
    r"trim(regexp_replace(translate(" + _NO_DIGITS + f", {_quote(string.punctuation)}, ''), "
    r"'\s+', ' ', 'g'))"
)
_STOP = sorted({*ENGLISH_STOPWORDS, *DOMAIN_STOPWORDS})

_FILTERED = f"""
    list_filter(string_split({_CLEAN}, ' '), lambda t: length(t) > 2 AND t NOT IN ({_items(_STOP)}))
"""

_PREPROCESS = f"""
    SELECT doc_id, coalesce(array_to_string({_FILTERED}, ' '), '') AS preprocessed FROM documents
"""

_LEMMATIZED = f"""
    WITH plurals AS (SELECT list(DISTINCT w) AS known FROM (
      SELECT unnest({_tokens("text")}) AS w FROM documents) WHERE length(w) > 3 AND w LIKE '%s'),
    words AS (SELECT doc_id, unnest({_FILTERED}) AS t,
      generate_subscripts({_FILTERED}, 1) AS pos FROM documents),
    lemmas AS (SELECT unnest(known) AS t FROM plurals),
    joined AS (SELECT doc_id, pos, CASE WHEN l.t IS NULL THEN w.t
        ELSE left(w.t, length(w.t) - 1) END AS lemma
      FROM words w LEFT JOIN lemmas l ON l.t = w.t)
    SELECT d.doc_id, coalesce(string_agg(lemma, ' ' ORDER BY pos), '') AS preprocessed
    FROM documents d LEFT JOIN joined j ON j.doc_id = d.doc_id GROUP BY d.doc_id
"""


_NGRAM_COUNTS = f"""
    WITH toks AS (SELECT {_tokens("text")} AS t FROM documents)
    SELECT ngram, count(*) AS n FROM (
      SELECT unnest(list_concat(t, {_ngrams("t", 2)}, {_ngrams("t", 3)})) AS ngram FROM toks)
    GROUP BY ngram
"""

_WORDS = r"(SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents)"

_FOLDED = f"""
    SELECT trim(strip_accents(lower(word))) AS folded, count(*) AS n FROM {_WORDS} GROUP BY 1
"""

# ---- selection

_VALID = """
    SELECT lang, count(*) FILTER (trim(text) <> '') AS with_abstract,
           count(*) FILTER (trim(text) <> '') AS with_both,
           count(*) FILTER (length(trim(text, chr(32) || chr(9) || chr(10) || chr(13)))
             > 50) AS clusterable
    FROM documents GROUP BY lang
"""


def _label(limit: int) -> str:
    return f"CASE WHEN length(text) > {limit} THEN left(text, {limit}) || '…' ELSE text END"


_TRUNCATE = f"SELECT doc_id, {_label(45)} AS label45, {_label(55)} AS label55 FROM documents"

_SELECTABLE = """
    (SELECT doc_id AS ord, source || ' ' || lang || ' ' || doc_id AS title FROM documents
     WHERE length(trim(text, chr(32) || chr(9) || chr(10) || chr(13))) > 50)
"""

# ---- pair similarities

_DOC_PAIRS = """
    (SELECT a.doc_id AS a_id, b.doc_id AS b_id, a.text AS text_a, b.text AS text_b
     FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1)
"""


def _lcs(a: str, b: str) -> str:
    zero = f"list_transform(range(0, length({b}) + 1), lambda z: 0::BIGINT)"
    step = (
        f"list_reduce(range(1, length({b}) + 1), lambda line, j: list_append(line, "
        f"CASE WHEN {a}[i] = {b}[j] THEN prev[j] + 1 ELSE greatest(prev[j + 1], line[j]) END), "
        f"[0::BIGINT])"
    )
    return f"list_reduce(range(1, length({a}) + 1), lambda prev, i: {step}, {zero})[-1]"


_NAMES = "(SELECT p_partkey AS doc_id, p_name AS text FROM part)"
_NAME_PAIRS = """
    (SELECT a.p_partkey AS a_id, b.p_partkey AS b_id, a.p_name AS text_a, b.p_name AS text_b
     FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1)
"""


def _indel(pairs: str) -> str:
    return f"""
    SELECT a_id, b_id, (CASE WHEN length(a) + length(b) = 0 THEN 1.0
      ELSE 2.0 * {_lcs("a", "b")} / (length(a) + length(b)) END)::DOUBLE AS levenshtein
    FROM (SELECT a_id, b_id, lower(text_a) AS a, lower(text_b) AS b FROM {pairs})
    """


def _short_indel(names: str, pairs: str) -> str:
    """As ``_indel``, for texts of up to 120 characters: a row of the table in one 128-bit word."""
    mask = "coalesce(x.masks[c], 0::HUGEINT)"
    step = f"((v + (v & {mask})) | (v - (v & {mask}))) & x.full"
    return f"""
    SELECT a_id, b_id, (CASE WHEN n = 0 THEN 1.0 ELSE 2.0 * lcs / n END)::DOUBLE AS levenshtein FROM (
      SELECT a_id, b_id, length(x.t) + length(p.text_b) AS n, length(x.t) - bit_count(
        list_reduce(string_split(lower(p.text_b), ''), lambda v, c: {step}, x.full)) AS lcs
      FROM {pairs} p JOIN (
        SELECT doc_id, any_value(t) AS t, map_from_entries(list({{'k': c, 'v': m}})) AS masks,
          (1::HUGEINT << length(any_value(t))::INTEGER) - 1 AS full
        FROM (SELECT doc_id, t, t[i] AS c, bit_or(1::HUGEINT << (i - 1)::INTEGER) AS m FROM (
            SELECT doc_id, lower(text) AS t, unnest(range(1, length(text) + 1)) AS i FROM {names})
          GROUP BY ALL) GROUP BY doc_id) x ON x.doc_id = p.a_id)
    """


def _wordset(text: str) -> str:
    return (
        rf"list_distinct(list_filter(regexp_split_to_array(lower({text}), '\s+'), "
        "lambda t: t <> ''))"
    )


def _jaccard(pairs: str) -> str:
    return f"""
    SELECT a_id, b_id, (CASE WHEN len(a) + len(b) = 0 THEN 0.0 ELSE
      len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))) END)::DOUBLE
      AS jaccard
    FROM (SELECT a_id, b_id, {_wordset("text_a")} AS a, {_wordset("text_b")} AS b FROM {pairs})
    """


def _pair_tfidf(docs: str, pairs: str) -> str:
    return f"""
    WITH toks AS (SELECT doc_id, unnest({_tokens("text")}) AS term FROM {docs}),
    tf AS (SELECT doc_id, term, count(*)::DOUBLE AS n FROM toks GROUP BY ALL),
    ids AS (SELECT a_id, b_id FROM {pairs}),
    sides AS (
      SELECT a_id, term, n AS x, 0.0::DOUBLE AS y FROM ids JOIN tf ON doc_id = a_id
      UNION ALL SELECT a_id, term, 0.0::DOUBLE, n FROM ids JOIN tf ON doc_id = b_id),
    terms AS (SELECT a_id, term, sum(x) AS x, sum(y) AS y FROM sides GROUP BY ALL),
    sums AS (SELECT a_id, sum(x * y) AS dot, sum(x * x * k) AS aa, sum(y * y * k) AS bb FROM (
      SELECT *, CASE WHEN x > 0 AND y > 0 THEN 1.0::DOUBLE ELSE pow(1 + ln(1.5::DOUBLE), 2) END
        AS k FROM terms) GROUP BY a_id),
    scored AS (SELECT *, CASE WHEN aa > 0 AND bb > 0 THEN dot / sqrt(aa * bb) ELSE 0.0 END AS c
      FROM sums)
    SELECT a_id, b_id, coalesce(c, 0.0)::DOUBLE AS cosine,
      (CASE WHEN c IS NULL THEN 0.0 WHEN aa > 0 AND bb > 0
        THEN 1 / (1 + sqrt(greatest(0.0, 2 - 2 * c))) ELSE 0.5 END)::DOUBLE AS euclidean
    FROM ids LEFT JOIN scored USING (a_id)
    """


def _cos(a: str, b: str) -> str:
    return f"greatest(0.0, least(1.0, list_cosine_similarity({a}::DOUBLE[], {b}::DOUBLE[])))"


_EMBEDDING = f"""
    SELECT a.vec_id AS a_id, b.vec_id AS b_id,
           round({_cos("a.embedding", "b.embedding")}, 6)::DOUBLE AS embedding
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
"""

_DIGEST = ", ".join(
    f"('0x' || substr(md5(token), {1 + 4 * i}, 4))::BIGINT::DOUBLE / 65535 - 0.5"
    for i in range(VECTOR_WIDTH)
)
_MEANS = ", ".join(f"sum(v[{i + 1}] * n)" for i in range(VECTOR_WIDTH))


def _word_vectors(docs: str, pairs: str) -> str:
    return f"""
    WITH toks AS (SELECT doc_id, unnest({_tokens("text")}) AS token FROM {docs}),
    counts AS (SELECT doc_id, token, count(*)::DOUBLE AS n FROM toks GROUP BY ALL),
    vectors AS (SELECT token, [{_DIGEST}] AS v FROM (SELECT DISTINCT token FROM counts)),
    docs AS (SELECT doc_id, [{_MEANS}] AS v FROM counts JOIN vectors USING (token)
             GROUP BY doc_id)
    SELECT p.a_id, p.b_id, coalesce({_cos("a.v", "b.v")}, 0.0)::DOUBLE AS word_vectors
    FROM {pairs} p LEFT JOIN docs a ON a.doc_id = p.a_id LEFT JOIN docs b ON b.doc_id = p.b_id
    """


def _measured(sql: str, *names: str) -> str:
    columns = ", ".join(f"round({n}, 6) AS {n}" for n in names)
    return f"SELECT a_id, b_id, {columns} FROM ({sql})"


_REPORT_PARTS = (
    _short_indel(_NAMES, _NAME_PAIRS),
    _jaccard(_NAME_PAIRS),
    _pair_tfidf(_NAMES, _NAME_PAIRS),
    f"""
    WITH vectors AS (SELECT p_partkey AS id, embedding AS v FROM part JOIN embeddings
      ON vec_id = p_partkey % (SELECT count(*) FROM embeddings))
    SELECT p.a_id, p.b_id, CASE WHEN trim(text_a) = '' OR trim(text_b) = '' THEN 0.0
      ELSE {_cos("a.v", "b.v")}::DOUBLE END AS embedding
    FROM {_NAME_PAIRS} p LEFT JOIN vectors a ON a.id = p.a_id LEFT JOIN vectors b ON b.id = p.b_id
    """,
    _word_vectors(_NAMES, _NAME_PAIRS),
)
_MEASURES = ("levenshtein", "jaccard", "cosine", "euclidean", "embedding", "word_vectors")
_REPORT = (
    "SELECT a_id, b_id, "
    + ", ".join(f"round_even({m} * 100, 2) AS {m}" for m in _MEASURES)
    + f" FROM ({_REPORT_PARTS[0]}) "
    + " ".join(f"JOIN ({p}) USING (a_id, b_id)" for p in _REPORT_PARTS[1:])
)

_REQUIRED = """
    SELECT 'documents' AS table_name, count(*) AS n_rows,
      count(*) FILTER (text IS NOT NULL AND lang IS NOT NULL) AS n_given FROM documents
    UNION ALL SELECT name, 0, 0 FROM (VALUES ('benchmark'), ('pages')) t(name)
"""

# ---- term precision

_PRECISION = f"""
    SELECT term, round_even(s, 4) AS precision, round_even(s * 100, 2) AS pct,
      CASE WHEN s >= 0.70 THEN 'Alta' WHEN s >= 0.40 THEN 'Media' ELSE 'Baja' END AS label
    FROM (SELECT 'term' || e.vec_id AS term, {_cos("e.embedding", "c.embedding")}::DOUBLE AS s
          FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) c)
"""

_PRECISION_SUMMARY = f"""
    SELECT round_even(avg(precision), 4) AS average_precision,
      count(*) FILTER (precision >= 0.70) AS high,
      count(*) FILTER (precision >= 0.40 AND precision < 0.70) AS medium,
      count(*) FILTER (precision < 0.40) AS low
    FROM ({_PRECISION})
"""

# ---- geography

_DICTIONARY = ", ".join(f"({_quote(n)}, {_quote(c)}, {i})" for i, (n, c) in enumerate(SURNAME_COUNTRY))


def _country(surnames: str, extra: str = "") -> str:
    """``surnames`` must yield ``surname`` and the columns named in ``extra``."""
    chain = " ".join(
        f"WHEN regexp_matches(s.surname, {_quote('(?i)' + p)}) THEN {_quote(c)}"
        for p, c in SURNAME_PATTERNS
    )
    return f"""
    SELECT s.surname, {extra} CASE WHEN s.surname = '' THEN 'Unknown'
      WHEN x.place IS NOT NULL THEN x.place {chain} ELSE 'United States' END AS country
    FROM {surnames} s LEFT JOIN (
      SELECT strip_accents(lower(name)) AS name, arg_min(place, n) AS place
      FROM (VALUES {_DICTIONARY}) t(name, place, n) GROUP BY 1) x
    ON x.name = strip_accents(lower(s.surname))
    """


_FIRST = r"""
    (SELECT doc_id, CASE WHEN contains(f, ',') THEN trim(split_part(f, ',', 1)) ELSE f END
      AS surname
     FROM (SELECT doc_id, trim(split_part(regexp_replace(text, '\s+', '; ', 'g'), ';', 1)) AS f
           FROM documents))
"""
_COUNTRY_COUNTS = f"""
    SELECT country, count(*) AS count FROM ({_country(_FIRST)}) WHERE country <> 'Unknown'
    GROUP BY country
"""

# ---- trends

_PUBLICATIONS = """
    (SELECT year(o_orderdate)::INTEGER AS year,
       CASE WHEN n_name = 'CANADA' THEN 'Desconocida' ELSE n_name END AS journal,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Article' ELSE c_mktsegment END AS document_type
     FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     WHERE year(o_orderdate) <> 1993)
"""
_TYPES = _items([t.lower() for t in TREND_TYPES])
_OF_TYPES = f"""
    (SELECT lower(document_type) AS document_type, year, journal FROM {_PUBLICATIONS}
     WHERE lower(document_type) IN ({_TYPES}))
"""


def _display(top: str, name: str = "journal") -> str:
    return f"""CASE WHEN {top} THEN CASE WHEN length({name}) > 55 THEN left({name}, 55) || '…'
               ELSE {name} END ELSE '{OTHER_JOURNALS}' END"""


_TOP_TEN = f"""
    (SELECT journal, count(*) AS count FROM {_PUBLICATIONS} GROUP BY journal
     ORDER BY count DESC, journal LIMIT 10)
"""
_YEAR_TOP = f"""
    SELECT year, {_display(f"journal IN (SELECT journal FROM {_TOP_TEN})")} AS journal_display,
           count(*) AS count
    FROM {_PUBLICATIONS} GROUP BY 1, 2
"""
_TYPE_KPIS = f"""
    WITH p AS {_OF_TYPES},
    y AS (SELECT document_type, year, count(*) AS n FROM p GROUP BY ALL),
    j AS (SELECT document_type, journal, count(*) AS n FROM p GROUP BY ALL),
    yr AS (SELECT *, row_number() OVER (PARTITION BY document_type ORDER BY n DESC, year) AS r,
           sum(n) OVER (PARTITION BY document_type) AS total FROM y),
    jr AS (SELECT *, row_number() OVER (PARTITION BY document_type ORDER BY n DESC, journal) AS r
           FROM j)
    SELECT document_type, total::BIGINT AS total, year AS peak_year,
      CASE WHEN length(journal) > 45 THEN left(journal, 45) || '…' ELSE journal END AS top_journal
    FROM yr JOIN jr USING (document_type) WHERE yr.r = 1 AND jr.r = 1
"""
_PER_TYPE = f"""
    WITH p AS {_OF_TYPES},
    top AS (SELECT document_type, journal FROM (
      SELECT document_type, journal, row_number() OVER (
        PARTITION BY document_type ORDER BY count(*) DESC, journal) AS r
      FROM p GROUP BY document_type, journal) WHERE r <= 5)
    SELECT p.document_type, year, {_display("t.journal IS NOT NULL", "p.journal")} AS journal_display, count(*) AS count
    FROM p LEFT JOIN top t ON t.document_type = p.document_type AND t.journal = p.journal
    GROUP BY 1, 2, 3
"""

# ---- deduplication


def _near_pairs(titles: str) -> str:
    """CTEs ending in ``near(a_id, b_id, score)`` over ``titles(ord, title)``.

    Titles of up to 120 characters are compared in one 128-bit word per row of the table, longer
    ones cell by cell.
    """
    row = "(v + (v & m)) | (v - (v & m))"
    mask = "coalesce(x.masks[c], 0::HUGEINT)"
    step = f"({row}) & x.full".replace("v & m", f"v & {mask}")
    return f"""
    names AS (SELECT trim(lower(title)) AS t, min(ord) AS id FROM {titles} GROUP BY 1),
    places AS (SELECT id, t, unnest(range(1, length(t) + 1)) AS p FROM names
      WHERE length(t) <= 120),
    masked AS (SELECT id, map_from_entries(list({{'k': c, 'v': m}})) AS masks FROM (
      SELECT id, t[p] AS c, bit_or(1::HUGEINT << (p - 1)::INTEGER) AS m FROM places
      GROUP BY id, t[p]) GROUP BY id),
    packed AS (SELECT n.*, masks, (1::HUGEINT << length(t)::INTEGER) - 1 AS full
      FROM names n JOIN masked USING (id)),
    common AS (
      SELECT x.id AS a_id, y.id AS b_id, x.t AS a, y.t AS b, length(x.t) - bit_count(
        list_reduce(string_split(y.t, ''), lambda v, c: {step}, x.full)) AS lcs
      FROM packed x JOIN names y ON x.id < y.id
      UNION ALL
      SELECT x.id, y.id, x.t, y.t, {_lcs("x.t", "y.t")}
      FROM names x JOIN names y ON x.id < y.id AND (length(x.t) > 120 OR x.t = '')),
    near AS (
      SELECT a_id, b_id, round_even(200.0 * lcs / (length(a) + length(b)), 0)::INTEGER AS score
      FROM common WHERE round_even(200.0 * lcs / (length(a) + length(b)), 0) >= 85)
    """


def _dedup_labels(titles: str) -> str:
    """The sequential scan over distinct titles, one recursion step per title."""
    return f"""
    WITH RECURSIVE {_near_pairs(titles)},
    earlier AS (SELECT b_id AS id, list(a_id) AS ids FROM near GROUP BY b_id),
    queue AS (
      SELECT n.id, row_number() OVER (ORDER BY n.id) AS k,
        coalesce(ids, []::BIGINT[]) AS earlier
      FROM names n LEFT JOIN earlier USING (id)),
    scan AS (
      SELECT 0::BIGINT AS k, []::BIGINT[] AS kept
      UNION ALL
      SELECT q.k, CASE WHEN list_has_any(s.kept, q.earlier) THEN s.kept
                       ELSE list_append(s.kept, q.id) END
      FROM scan s JOIN queue q ON q.k = s.k + 1),
    kept AS (SELECT unnest(kept) AS id FROM (SELECT kept FROM scan ORDER BY k DESC LIMIT 1)),
    removed AS (SELECT b_id AS id, min(a_id) AS kept_id, arg_min(score, a_id) AS score
      FROM near WHERE a_id IN (SELECT id FROM kept) AND b_id NOT IN (SELECT id FROM kept)
      GROUP BY b_id)
    SELECT r.ord, r.title, d.id IS NOT NULL OR r.ord > n.id AS is_duplicate,
      coalesce(d.kept_id, CASE WHEN r.ord > n.id THEN n.id END) AS kept_ord,
      coalesce(d.score, CASE WHEN r.ord > n.id THEN 100 END)::INTEGER AS score
    FROM {titles} r JOIN names n ON n.t = trim(lower(r.title)) LEFT JOIN removed d ON d.id = n.id
    """


_PARTS = "(SELECT p_partkey AS ord, p_name AS title FROM part)"
_PAGES = "(SELECT page_id AS ord, url AS title FROM pages)"
_PART_LABELS = _dedup_labels(_PARTS)

# ---- corpus similarity

_CORPUS_WEIGHTS = f"""
    cleaned AS (SELECT doc_id, preprocessed AS text FROM ({_LEMMATIZED})),
    toks AS (SELECT doc_id, unnest({_tokens("text")}) AS term FROM cleaned),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY ALL),
    total AS (SELECT count(*) AS n FROM documents),
    idf AS (SELECT term, ln((n + 1)::DOUBLE / (count(*) + 1)) + 1 AS idf FROM tf, total
            GROUP BY term, n HAVING count(*) <= 0.95::DOUBLE * n),
    raw AS (SELECT doc_id, term, (ln(tf) + 1) * idf AS r FROM tf JOIN idf USING (term)),
    names AS (SELECT text, min(doc_id) AS doc_id, count(*) AS copies FROM cleaned GROUP BY text),
    w AS (SELECT doc_id, term, r / sqrt(sum(r * r) OVER (PARTITION BY doc_id)) AS w FROM raw
          WHERE doc_id IN (SELECT doc_id FROM names))
"""
_SIMILAR = f"""
    WITH {_CORPUS_WEIGHTS},
    pairs AS (SELECT a.doc_id AS a_id, b.doc_id AS b_id, sum(a.w * b.w) AS s
      FROM w a JOIN w b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY ALL
      HAVING sum(a.w * b.w) >= 0.8::DOUBLE)
    SELECT a_id, b_id, round(s, 6)::DOUBLE AS similarity, x.copies AS a_copies,
      y.copies AS b_copies
    FROM pairs JOIN names x ON x.doc_id = a_id JOIN names y ON y.doc_id = b_id
"""
_TOP_SIMILAR = f"""
    WITH found AS ({_SIMILAR})
    SELECT * FROM (SELECT id, partner, similarity,
      row_number() OVER (PARTITION BY id ORDER BY similarity DESC, partner)::INTEGER AS rank
      FROM (SELECT a_id AS id, b_id AS partner, similarity FROM found
            UNION ALL SELECT b_id, a_id, similarity FROM found))
    WHERE rank <= 3
"""

_NEAREST = f"""
    WITH {_CORPUS_WEIGHTS},
    pairs AS (SELECT a.doc_id AS id, b.doc_id AS partner, round(sum(a.w * b.w), 9) AS s
      FROM w a JOIN w b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY ALL),
    ends AS (SELECT id, partner, s FROM pairs UNION ALL SELECT partner, id, s FROM pairs),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, partner)::INTEGER AS rank FROM ends)
    SELECT id, partner, round(s, 6)::DOUBLE AS similarity, rank, copies
    FROM ranked JOIN names ON names.doc_id = partner WHERE rank <= 3
"""

_SIM_TOPK = """
    SELECT id, partner, round(s, 6)::DOUBLE AS similarity, rank FROM (
      SELECT id, partner, s, row_number() OVER (PARTITION BY id ORDER BY s DESC, partner)::INTEGER AS rank
      FROM (SELECT a.vec_id AS id, b.vec_id AS partner,
          round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS s
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id))
    WHERE rank <= 5
"""

# ---- clustering

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(13)"
_SELECTION = f"""
    (SELECT doc_id // {BLOCK_IDS} AS block, doc_id, source || ' ' || lang || ' ' || doc_id AS title
     FROM documents WHERE length(trim(text, {_BLANKS})) > 50)
"""
_DISTANCES = f"""
    sel AS {_SELECTION},
    cleaned AS (SELECT block, doc_id, preprocessed AS text
      FROM sel JOIN ({_LEMMATIZED}) USING (doc_id)),
    toks AS (SELECT block, doc_id, {_tokens("text")} AS t FROM cleaned),
    grams AS (SELECT block, doc_id, unnest(list_concat(t, {_ngrams("t", 2)})) AS term FROM toks),
    counts AS (SELECT block, doc_id, term, count(*) AS tf FROM grams GROUP BY ALL),
    total AS (SELECT block, count(*) AS n FROM sel GROUP BY block),
    terms AS (SELECT block, term, count(*) AS df, sum(tf) AS cf FROM counts GROUP BY block, term),
    vocab AS (SELECT block, term, ln((n + 1)::DOUBLE / (df + 1)) + 1 AS idf,
        row_number() OVER (PARTITION BY block ORDER BY cf DESC, term) AS rank
      FROM terms JOIN total USING (block) WHERE df <= 0.95::DOUBLE * n),
    raw AS (SELECT block, doc_id, term, (ln(tf) + 1) * idf AS r
      FROM counts JOIN (SELECT * FROM vocab WHERE rank <= 3000) v USING (block, term)),
    w AS (SELECT block, doc_id, term, r / sqrt(sum(r * r) OVER (PARTITION BY block, doc_id)) AS w
      FROM raw),
    cos AS (SELECT a.block, a.doc_id AS i, b.doc_id AS j, sum(a.w * b.w) AS c
      FROM w a JOIN w b ON a.block = b.block AND a.term = b.term AND a.doc_id < b.doc_id
      GROUP BY ALL),
    dist AS (SELECT a.block, a.doc_id AS i, b.doc_id AS j,
        round(greatest(0.0::DOUBLE, 1 - coalesce(c, 0.0)), 12)::DOUBLE AS d
      FROM sel a JOIN sel b ON a.block = b.block AND a.doc_id < b.doc_id
      LEFT JOIN cos ON cos.block = a.block AND cos.i = a.doc_id AND cos.j = b.doc_id)
"""

# One merge of every block and method per step of the recursion: s absorbs t, Lance-Williams gives
# the distances of the others (v) to their union.
_MERGES = f"""
    {_DISTANCES},
    state AS (
      SELECT block, method, 0 AS k, i AS a, j AS b, d, 1::BIGINT AS na, 1::BIGINT AS nb
      FROM dist, (VALUES ('ward'), ('complete'), ('average')) m(method)
      UNION ALL
      SELECT block, method, k + 1, lo, hi,
        round(CASE WHEN NOT bool_or(touched) OR method = 'complete' THEN max(d)
          WHEN method = 'average' THEN (max(ns) * max(d) FILTER (from_s)
            + max(nt) * max(d) FILTER (NOT from_s)) / (max(ns) + max(nt))
          ELSE sqrt(greatest(0.0::DOUBLE, ((max(nv) + max(ns)) * pow(max(d) FILTER (from_s), 2)
            + (max(nv) + max(nt)) * pow(max(d) FILTER (NOT from_s), 2) - max(nv) * pow(max(h), 2))
            / (max(ns) + max(nt) + max(nv)))) END, 12),
        CASE WHEN bool_or(touched) AND lo = max(s) THEN max(ns) + max(nt) ELSE max(nlo) END,
        CASE WHEN bool_or(touched) AND hi = max(s) THEN max(ns) + max(nt) ELSE max(nhi) END
      FROM (SELECT *, least(x, y) AS lo, greatest(x, y) AS hi,
          CASE WHEN x < y THEN nx ELSE ny END AS nlo, CASE WHEN x < y THEN ny ELSE nx END AS nhi
        FROM (SELECT e.block, e.method, e.k, e.d, m.d AS h, m.a AS s, m.na AS ns, m.nb AS nt,
            e.a IN (m.a, m.b) OR e.b IN (m.a, m.b) AS touched, m.a IN (e.a, e.b) AS from_s,
            CASE WHEN e.a = m.b THEN m.a ELSE e.a END AS x,
            CASE WHEN e.b = m.b THEN m.a ELSE e.b END AS y, e.na AS nx, e.nb AS ny,
            CASE WHEN e.a IN (m.a, m.b) THEN e.nb ELSE e.na END AS nv
          FROM state e JOIN (SELECT block, method, unnest(arg_min(
              {{'a': a, 'b': b, 'd': d, 'na': na, 'nb': nb}}, (d, a, b)))
            FROM state GROUP BY block, method) m USING (block, method)
          WHERE NOT (e.a = m.a AND e.b = m.b)))
      GROUP BY block, method, k, lo, hi),
    merges AS (SELECT *, ns + nt AS size, count(*) OVER (PARTITION BY block, method) + 1 AS n,
        row_number() OVER (PARTITION BY block, method ORDER BY round(height, 9), ns + nt, s) - 1
          AS step
      FROM (SELECT block, method, k, unnest(arg_min(
          {{'s': a, 't': b, 'height': d, 'ns': na, 'nt': nb}}, (d, a, b)))
        FROM state GROUP BY block, method, k)),
    sides AS (
      SELECT block, method, k, step, n, 'i' AS side, s AS id FROM merges
      UNION ALL SELECT block, method, k, step, n, 'j', t FROM merges),
    leaves AS (SELECT block, id, row_number() OVER (PARTITION BY block ORDER BY id) - 1 AS number
      FROM (SELECT block, i AS id FROM dist UNION SELECT block, j FROM dist)),
    numbered AS (SELECT x.*, coalesce(x.n + m.step, l.number) AS number
      FROM sides x JOIN leaves l USING (block, id) ASOF LEFT JOIN merges m
      ON m.block = x.block AND m.method = x.method AND m.s = x.id AND x.k > m.k),
    parents AS (SELECT m.block, m.method, m.k, m.s, x.k AS up FROM merges m ASOF JOIN sides x
      ON x.block = m.block AND x.method = m.method AND x.id = m.s AND m.k < x.k),
    climb AS (
      SELECT block, method, id AS leaf, min(k) AS k, id FROM sides GROUP BY ALL
      UNION ALL
      SELECT c.block, c.method, c.leaf, p.up, p.s FROM climb c JOIN parents p
      ON p.block = c.block AND p.method = c.method AND p.k = c.k),
    tree AS (SELECT c.block, c.method, c.leaf, m.k, m.step, m.s, m.height,
        CASE WHEN c.id = m.s THEN 'i' ELSE 'j' END AS side
      FROM climb c JOIN merges m USING (block, method, k)),
    coph AS (SELECT x.block, x.method, least(x.leaf, y.leaf) AS i, greatest(x.leaf, y.leaf) AS j,
        x.height FROM tree x JOIN tree y
      ON x.block = y.block AND x.method = y.method AND x.k = y.k AND x.side < y.side),
    scores AS (SELECT block, method, CASE WHEN var_pop(d) > 1e-9 AND var_pop(height) > 1e-9
        THEN corr(d, height) END AS ccc
      FROM coph JOIN dist USING (block, i, j) GROUP BY block, method),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY block ORDER BY round(ccc, 9) DESC NULLS LAST,
        list_position(['ward', 'complete', 'average'], method)) = 1 AS is_best FROM scores)
"""


def _of_tree(select: str) -> str:
    return f"WITH RECURSIVE {_MERGES} {select}"


_LINKAGE = _of_tree("""
    SELECT m.block, m.method, m.step, least(a.number, b.number) AS left,
      greatest(a.number, b.number) AS right, round(m.height, 6) AS height, m.size
    FROM merges m
    JOIN numbered a ON a.block = m.block AND a.method = m.method AND a.k = m.k AND a.side = 'i'
    JOIN numbered b ON b.block = m.block AND b.method = m.method AND b.k = m.k AND b.side = 'j'
""")
_CUT = _of_tree("""
    SELECT block, method, leaf, coalesce(
      arg_max(s, k) FILTER (height < 0.7::DOUBLE * top), leaf) AS cluster
    FROM tree JOIN (SELECT block, method, max(height) AS top FROM merges GROUP BY ALL)
    USING (block, method) GROUP BY block, method, leaf
""")
_LEAF_ORDER = _of_tree("""
    SELECT block, method, leaf,
      row_number() OVER (PARTITION BY block, method ORDER BY path) - 1 AS position
    FROM (SELECT t.block, t.method, t.leaf, string_agg(
        CASE WHEN x.number < y.number THEN '0' ELSE '1' END, '' ORDER BY t.step DESC) AS path
      FROM tree t
      JOIN numbered x ON x.block = t.block AND x.method = t.method AND x.k = t.k
        AND x.side = t.side
      JOIN numbered y ON y.block = t.block AND y.method = t.method AND y.k = t.k
        AND y.side <> t.side
      GROUP BY t.block, t.method, t.leaf)
""")

# ---- word weights

_CLOUD = r"regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_][\p{L}\p{M}\p{N}_'']+')"


def _plural_stem(word: str) -> str:
    return (
        f"CASE WHEN {word} LIKE '%s' AND {word} NOT LIKE '%ss' "
        f"THEN left({word}, length({word}) - 1) END"
    )


def _likelihood(k: str, n: str, x: str) -> str:
    return f"(ln(greatest({x}, 1e-10)) * {k} + ln(greatest(1 - {x}, 1e-10)) * ({n} - {k}))"


_CLOUD_SCORE = " ".join(
    [
        "-2 * (",
        _likelihood("c12", "c1", "(c2 / m)"),
        "+",
        _likelihood("(c2 - c12)", "(m - c1)", "(c2 / m)"),
        "-",
        _likelihood("c12", "c1", "(c12 / c1)"),
        "-",
        _likelihood("(c2 - c12)", "(m - c1)", "((c2 - c12) / (m - c1))"),
        ")",
    ]
)
_ENGLISH = _items(ENGLISH_STOPWORDS)
_WORD_WEIGHTS = f"""
    WITH toks AS (SELECT list_filter(list_transform({_CLOUD},
        lambda t: regexp_replace(t, '''s$', '')),
        lambda t: NOT regexp_matches(t, '^[0-9]+$')) AS t
      FROM (SELECT text FROM documents UNION ALL SELECT text FROM benchmark)),
    uni AS (SELECT word, count(*) AS n FROM (SELECT unnest(t) AS word FROM toks)
      WHERE word NOT IN ({_ENGLISH}) GROUP BY word),
    words AS (SELECT u.word, u.n, coalesce(s.word, u.word) AS standard
      FROM uni u LEFT JOIN uni s ON s.word = {_plural_stem("u.word")}),
    unigrams AS (SELECT standard, sum(n)::BIGINT AS n FROM words GROUP BY standard),
    bi AS (SELECT p[1] || ' ' || p[2] AS word, count(*) AS n FROM (
        SELECT unnest(list_transform(range(1, len(t)), lambda i: [t[i], t[i + 1]])) AS p FROM toks)
      WHERE p[1] NOT IN ({_ENGLISH}) AND p[2] NOT IN ({_ENGLISH}) GROUP BY 1),
    pairs AS (SELECT coalesce(s.word, b.word) AS pair, sum(b.n)::BIGINT AS n
      FROM bi b LEFT JOIN bi s ON s.word = {_plural_stem("b.word")} GROUP BY 1),
    named AS (SELECT word, standard, unigrams.n FROM words JOIN unigrams USING (standard)),
    strong AS (SELECT pair, w1, w2, n FROM (
      SELECT pair, x.standard AS w1, y.standard AS w2, p.n, p.n::DOUBLE AS c12,
        x.n::DOUBLE AS c1, y.n::DOUBLE AS c2, (SELECT sum(n) FROM uni)::DOUBLE AS m
      FROM pairs p JOIN named x ON x.word = split_part(pair, ' ', 1)
      JOIN named y ON y.word = split_part(pair, ' ', 2))
      WHERE m > c1 AND m > c2 AND {_CLOUD_SCORE} > 30),
    taken AS (SELECT w, sum(n)::BIGINT AS n FROM (
      SELECT w1 AS w, n FROM strong UNION ALL SELECT w2, n FROM strong) GROUP BY w),
    entries AS (
      SELECT standard AS word, unigrams.n - coalesce(taken.n, 0) AS count
      FROM unigrams LEFT JOIN taken ON taken.w = standard
      UNION ALL SELECT pair, n FROM strong),
    heavy AS (SELECT word, count FROM entries WHERE count > 0 ORDER BY count DESC, word LIMIT 150)
    SELECT word, count, round(count::DOUBLE / (SELECT max(count) FROM heavy), 6) AS weight
    FROM heavy
"""

# ---- ingest

def _ingested(abstract: str, source: str, kind: str, journal: str) -> str:
    return f"""
    SELECT source || ' ' || lang || ' ' || doc_id AS title,
      upper(left(lang, 1)) || substr(lang, 2) || ', A.; ' || source AS authors,
      lang || '; ' || source AS keywords, {abstract} AS abstract, {journal} AS journal,
      (1990 + doc_id % 30)::INTEGER AS year, '10.1/' || doc_id AS doi, {source} AS source,
      'http://x/' || doc_id AS url, {kind} AS document_type
    FROM documents
    """


def _one_line(text: str) -> str:
    return rf"trim(regexp_replace({text}, '\s*\n\s*', ' ', 'g'))"


_DEEP = _one_line(f"{_quote(DEEP_HEAD)} || text || {_quote(AT_LINE)}")
_KIND = "CASE doc_id % 4 WHEN 1 THEN 'Conference' WHEN 2 THEN 'Periodical' ELSE 'Article' END"


# All documents, a third in each format, in the order of the files.
_MIXED = rf"""
    (SELECT *, row_number() OVER (ORDER BY doc_id % 3, doc_id) AS ord FROM (
      SELECT *, trim(regexp_replace(left(text, 60), '\s+', ' ', 'g')) AS title FROM documents)
     WHERE title <> '')
"""


def _unified(wanted: str) -> str:
    return f"""
    SELECT CASE doc_id % 3 WHEN 0 THEN {_KIND} WHEN 1 THEN 'Article' ELSE 'JOUR' END
        AS document_type, title, upper(left(lang, 1)) || substr(lang, 2) || ', A.; ' || source AS authors,
      lang || '; ' || source AS keywords,
      CASE doc_id % 3 WHEN 0 THEN trim(text, {_BLANKS}) WHEN 1 THEN {_DEEP}
        ELSE {_one_line("text")} END AS abstract,
      CASE WHEN doc_id % 3 < 2 THEN source END AS journal, (1990 + doc_id % 30)::INTEGER AS year,
      '10.1/' || doc_id AS doi,
      CASE doc_id % 3 WHEN 0 THEN 'EBSCO' WHEN 1 THEN 'ACM' ELSE source END AS source,
      'http://x/' || doc_id AS url, NULL::VARCHAR AS "publisherLocations"
    FROM {_MIXED} JOIN (SELECT ord, is_duplicate FROM ({_dedup_labels(_MIXED)})) USING (ord)
    WHERE {wanted}
    """


ORACLE_SQL: dict[str, str] = {
    "keyword_frequency": _KEYWORD_FREQUENCY,
    "new_terms_tfidf": _NEW_TERMS,
    "keyword_group_comparison": _GROUP_COMPARISON,
    "category_keywords": _CATEGORY,
    "corpus_tfidf": _CORPUS_TFIDF,
    "clean_texts": f"SELECT doc_id, {_CLEAN} AS cleaned FROM documents",
    "preprocess_tokens": _PREPROCESS,
    "alpha_texts": f"SELECT doc_id, {_ALPHA} AS normalized FROM documents",
    "word_ngrams": _NGRAM_COUNTS,
    "folded_words": _FOLDED,
    "valid_abstracts": _VALID,
    "min_rows": f"""
        SELECT block, count(*) AS rows, count(*) >= 5 AS enough FROM {_SELECTION} GROUP BY block""",
    "label_truncate": _TRUNCATE,
    "first_n": f"SELECT ord, title FROM {_SELECTABLE} ORDER BY ord LIMIT 40",
    "seeded_sample": f"SELECT ord, title FROM {_SELECTABLE} ORDER BY md5('42:' || ord), ord LIMIT 40",
    "title_lookup": """
        SELECT p_name AS title, arg_min(p_type || ' ' || p_brand, p_partkey) AS abstract
        FROM part GROUP BY p_name""",
    "display_rename": f"""
        SELECT keyword AS palabra, doc_freq AS articulos, abs_freq AS ocurrencias,
               pct AS porcentaje FROM ({_KEYWORD_FREQUENCY})""",
    "sim_indel": _measured(_indel(_NAME_PAIRS), "levenshtein"),
    "sim_jaccard": _measured(_jaccard(_DOC_PAIRS), "jaccard"),
    "sim_tfidf": _measured(_pair_tfidf("documents", _DOC_PAIRS), "cosine", "euclidean"),
    "sim_embedding": _EMBEDDING,
    "sim_word_vectors": _measured(_word_vectors("documents", _DOC_PAIRS), "word_vectors"),
    "similarity_report": _REPORT,
    "required_columns": _REQUIRED,
    "term_precision": _PRECISION,
    "precision_summary": _PRECISION_SUMMARY,
    "infer_country": _country(f"(SELECT DISTINCT word AS surname FROM {_WORDS})"),
    "first_surname": f"SELECT doc_id, surname FROM {_FIRST}",
    "country_from_authors": _country(_FIRST, "s.doc_id,"),
    "country_counts": _COUNTRY_COUNTS,
    "country_kpis": f"""
        SELECT sum(count)::BIGINT AS articles, count(*) AS countries,
          (SELECT country FROM ({_COUNTRY_COUNTS}) ORDER BY count DESC, country LIMIT 1)
            AS top_country
        FROM ({_COUNTRY_COUNTS})""",
    "trend_kpis": f"""
        SELECT count(*) AS total, count(DISTINCT year) AS years,
          count(DISTINCT journal) AS journals, count(DISTINCT document_type) AS types
        FROM {_PUBLICATIONS}""",
    "distinct_years": f"SELECT DISTINCT year FROM {_PUBLICATIONS}",
    "year_range": f"""
        SELECT year, document_type, count(*) AS count FROM {_PUBLICATIONS}
        WHERE year BETWEEN 1994 AND 1996 GROUP BY ALL""",
    "top_journals": f"SELECT journal, count FROM {_TOP_TEN}",
    "year_trend_top_n": _YEAR_TOP,
    "display_order": f"SELECT DISTINCT journal_display FROM ({_YEAR_TOP})",
    "type_kpis": _TYPE_KPIS,
    "year_journal_table": f"""
        SELECT year, journal, count(*) AS count FROM {_PUBLICATIONS}
        WHERE lower(document_type) = 'machinery' GROUP BY ALL""",
    "year_type_counts": f"""
        SELECT year, document_type, count(*) AS count FROM {_PUBLICATIONS} GROUP BY ALL""",
    "year_detail": f"""
        SELECT year, document_type, journal, count(*) AS count FROM {_PUBLICATIONS}
        GROUP BY ALL""",
    "per_type_trend": _PER_TYPE,
    "dedup_labels": _PART_LABELS,
    "dedup_report": f"""
        SELECT ord, left(title, 50) AS title_head, score, kept_ord FROM ({_PART_LABELS})
        WHERE is_duplicate""",
    "dedup_summary": f"""
        SELECT count(*) AS original, count(*) FILTER (NOT is_duplicate) AS "unique",
          count(*) FILTER (is_duplicate) AS duplicates FROM ({_PART_LABELS})""",
    "dedup_page_labels": _dedup_labels(_PAGES),
    "near_duplicate_pairs": f"WITH {_near_pairs(_PAGES)} SELECT a_id, b_id, score FROM near",
    "similarity_join": _SIMILAR,
    "top_similar": _TOP_SIMILAR,
    "nearest_articles": _NEAREST,
    "sim_topk": _SIM_TOPK,
    "distance_edges": f"WITH {_DISTANCES} SELECT block, i, j, round(d, 6) AS d FROM dist",
    "linkage": _LINKAGE,
    "cophenetic_distances": _of_tree(
        "SELECT block, method, i, j, round(height, 6) AS height FROM coph"
    ),
    "compare_methods": _of_tree("""
        SELECT block, method, round(ccc, 6) AS ccc, CASE WHEN ccc >= 0.85 THEN 'Excelente'
          WHEN ccc >= 0.75 THEN 'Bueno' WHEN ccc >= 0.65 THEN 'Moderado' ELSE 'Bajo' END AS band,
          is_best FROM ranked"""),
    "best_method": _of_tree(
        "SELECT block, method, round(ccc, 6) AS ccc FROM ranked WHERE is_best"
    ),
    "cut_clusters": _CUT,
    "leaf_order": _LEAF_ORDER,
    "cluster_labels": f"""
        SELECT block, doc_id, CASE WHEN length(title) > 45 THEN left(title, 45) || '…'
          ELSE title END AS label FROM {_SELECTION}""",
    "word_weights": _WORD_WEIGHTS,
    "lemmatized": _LEMMATIZED,
    "csv_ingest": _ingested(f"trim(text, {_BLANKS})", "'EBSCO'", _KIND, "source"),
    "bibtex_ingest": _ingested(_DEEP, "'EBSCO'", "'Article'", "source"),
    "ris_ingest": _ingested(_one_line("text"), "source", "'JOUR'", "NULL::VARCHAR"),
    "unified_articles": _unified("NOT is_duplicate"),
    "removed_articles": _unified("is_duplicate"),
    "unified_sources": f"""
        SELECT document_type, count(*) AS articles, count(*) AS positions
        FROM ({_unified("NOT is_duplicate")}) GROUP BY document_type""",
}
