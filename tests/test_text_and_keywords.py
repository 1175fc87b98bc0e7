from collections import Counter
import math
import re

import numpy as np
import pytest
from corpuslens.functions import termcounts
from corpuslens.functions import text as T
from corpuslens.operators import keywords, precision, preprocess, selection, tfidf
from corpuslens.schema import MissingColumnsError
from pyspark.sql import functions as F


def apply(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "n int, s string")
    return [r[0] for r in df.orderBy("n").select(expression(F.col("s")).alias("x")).collect()]


def test_clean_text(spark):
    values = ["Human-AI  in 2023!\n(GPT4)", "  A1b ", "", "Ça va; ÉCOLE x"]
    assert apply(spark, values, T.clean_text) == ["humanai in gpt", "a b", "", "ça va école x"]


def test_tokens_and_stopwords(spark):
    tokens = apply(spark, ["the deep deep study of ai nets"], lambda c: T.remove_stopwords(T.tokenize(c)))
    assert tokens == [["deep", "deep", "nets"]]
    assert apply(spark, [" a\tb \n"], T.tokenize) == [["a", "b"]]


def test_word_tokens_and_ngrams(spark):
    words = apply(spark, ["A né-3 x_1, Ünder", ""], T.word_tokens)
    assert words == [["né", "x_1", "ünder"], []]
    grams = apply(spark, ["aa bb cc", "aa", ""], lambda c: T.ngram_range(T.word_tokens(c), 1, 3))
    assert grams == [["aa", "bb", "cc", "aa bb", "bb cc", "aa bb cc"], ["aa"], []]


def test_fold_strip_truncate(spark):
    assert apply(spark, ["Pătruț", " GONZÁLEZ ", "إيمان"], T.accent_fold) == ["patrut", "gonzalez", "ايمان"]
    assert apply(spark, [" \t x \n"], T.strip) == ["x"]
    cut = apply(spark, ["a" * 45, "a" * 46, None], lambda c: T.truncate_label(c, 45))
    assert cut == ["a" * 45, "a" * 45 + "…", None]
    assert apply(spark, ["Éa-1 b"], T.alpha_normalize) == [" a   b"]


def test_lemmatize_keeps_order_and_repeats(spark):
    docs = spark.createDataFrame([(1, "networks beat networks, students"), (2, "")], "doc_id int, text string")
    out = preprocess.preprocess(docs, lemmas=preprocess.seed_lemmas(spark)).orderBy("doc_id").collect()
    assert [r.text for r in out] == ["network beat network student", ""]


def brute_frequency(words, texts):
    rows = []
    for w in words:
        hits = [len(re.findall(re.escape(w.strip()), t, re.IGNORECASE)) for t in texts]
        df = sum(h > 0 for h in hits)
        rows.append((w, df, sum(hits), round(df / len(texts) * 100, 2)))
    return sorted(rows, key=lambda r: -r[1])


def test_keyword_frequency(spark):
    texts = ["Ethics bioethics ETHICS", "c++ and C++ (x)", "aaaa", "nothing", "straße\nethics"]
    words = ["none", "ethics", " C++ ", "aa", "(x)", "a\\Eb"]
    corpus = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [tuple(r) for r in keywords.keyword_frequency(corpus, words).collect()]
    assert found == brute_frequency(words, texts)
    empty = keywords.keyword_frequency(corpus.limit(0), ["x"]).first()
    assert tuple(empty) == ("x", 0, 0, 0.0)
    assert keywords.keyword_frequency(corpus, []).count() == 0
    with pytest.raises(ValueError):
        keywords.keyword_frequency(corpus, [" "])


def brute_tfidf(texts, min_df, max_df, cap, sublinear):
    docs = [re.findall(r"\b\w\w+\b", t.lower()) for t in texts]
    docs = [d + [f"{a} {b}" for a, b in zip(d, d[1:])] for d in docs]
    n = len(docs)
    df = {t: sum(t in d for d in docs) for d in docs for t in d}
    cf = {t: sum(d.count(t) for d in docs) for t in df}
    kept = [t for t in df if min_df <= df[t] <= max_df * n]
    kept = set(sorted(kept, key=lambda t: (-cf[t], t))[:cap])
    out = {}
    for i, d in enumerate(docs):
        w = {
            t: (1 + math.log(d.count(t)) if sublinear else d.count(t))
            * (math.log((1 + n) / (1 + df[t])) + 1)
            for t in set(d) & kept
        }
        norm = math.sqrt(sum(x * x for x in w.values()))
        out.update({(i, t): x / norm for t, x in w.items()})
    return out


@pytest.mark.parametrize("cap", [None, 4])
@pytest.mark.parametrize("by", [None, "block"])
def test_tfidf(spark, cap, by):
    texts = ["deep nets learn deep nets", "deep trees", "nets and trees learn", "", "same deep words"]
    options = tfidf.TfidfOptions((1, 2), 1, 0.7, cap, True)
    docs = spark.createDataFrame([("b", i, t) for i, t in enumerate(texts)], "block string, doc_id int, text string")
    if by:  # a second block must not influence the first
        docs = docs.unionAll(spark.createDataFrame([("c", 9, "deep deep other")], docs.schema))
    found = tfidf.tfidf(docs, options, by=by).filter("doc_id < 9").collect()
    expected = brute_tfidf(texts, 1, 0.7, cap, True)
    assert {(r.doc_id, r.term) for r in found} == expected.keys()
    assert all(abs(r.w - expected[r.doc_id, r.term]) < 1e-12 for r in found)


def test_new_keywords_filters(spark):
    texts = ["Machine learning study café tool neural nets"] * 3 + ["neural nets grow", "only once here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = [r.term for r in tfidf.extract_new_keywords(docs, ["Machine learning"]).collect()]
    assert "neural nets" in found and "nets" in found
    banned = {"machine", "learning", "machine learning", "study", "caf", "once", "caf tool"}
    assert not banned & set(found) and all(len(t) >= 4 for t in found)
    assert not any("tool" in t.split() or "study" in t.split() for t in found)


def test_precision_bands_and_summary(spark):
    terms = spark.createDataFrame(
        [("same", [1.0, 0.0]), ("edge", [0.7, math.sqrt(0.51)]), ("neg", [-1.0, 0.0]), ("zero", [0.0, 0.0])],
        "term string, embedding array<double>",
    )
    rows = {r.term: r for r in precision.term_precision(terms, [2.0, 0.0]).collect()}
    assert (rows["same"].precision, rows["same"].pct, rows["same"].label) == (1.0, 100.0, "Alta")
    assert rows["edge"].precision == 0.7
    assert (rows["neg"].precision, rows["neg"].label, rows["zero"].precision) == (0.0, "Baja", 0.0)
    summary = precision.precision_summary(precision.term_precision(terms, [2.0, 0.0])).first()
    assert tuple(summary) == (0.425, 2, 0, 2)
    assert precision.precision_summary(precision.term_precision(terms.limit(0), [1.0])).first()[0] == 0.0


def test_selection(spark):
    rows = [(i, f"t{i % 3}" if i else " ", "x" * (45 + i)) for i in range(12)]
    df = spark.createDataFrame(rows + [(12, None, None)], "ord int, title string, abstract string").repartition(3)
    assert selection.valid_abstracts(df).count() == 12
    assert selection.clusterable(df).agg(F.min("ord")).first()[0] == 6
    assert sorted(r.ord for r in selection.first_n(df, 5).collect()) == [0, 1, 2, 3, 4]
    by = selection.first_n(df.filter("ord > 0 and ord < 12"), 5, by="title").collect()
    assert sorted(r.ord for r in by) == list(range(1, 12))
    sample = sorted(r.ord for r in selection.seeded_sample(df, 6).collect())
    assert sample == sorted(r.ord for r in selection.seeded_sample(df.repartition(7), 6).collect())
    assert len(sample) == 6 and selection.has_min_rows(df) and not selection.has_min_rows(df.limit(4))
    with pytest.raises(ValueError):
        selection.first_n(df, 0)
    with pytest.raises(MissingColumnsError):
        selection.clusterable(df.drop("title"))
    looked = selection.title_lookup(df, df.filter("ord = 4")).collect()
    assert [tuple(r) for r in looked] == [("t1", "x" * 46)]


def test_lemmatize_sends_no_occurrences(spark):
    """Occurrences stay with their document; rows with one key are one document, a null key too."""
    docs = spark.createDataFrame([(1, ["cats", "cats", "dog"]), (2, None), (None, ["dogs"]), (3, ["b", "d"]), (3, ["a"])], "doc_id int, tokens array<string>")
    lemmas = spark.createDataFrame([("cats", "cat"), ("dogs", "dog"), ("dog", None)], "token string, lemma string")
    found = preprocess.lemmatize(docs, lemmas, "doc_id", "tokens")
    assert "posexplode" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id: r.tokens for r in found.collect()} == {1: ["cat", "cat", "dog"], 2: [], None: ["dog"], 3: ["a", "b", "d"]}


def test_terms_are_counted_some_documents_at_a_time(spark, monkeypatch):
    """Occurrences never become rows: a task's distinct n-grams do, each with its count."""
    monkeypatch.setattr(termcounts, "_SLICE_TOKENS", 7)
    texts = ["Aa bb aa bb aa", "", None, "x aa", "bb aa bb né Né", "aa bb", "cc", "aa bb cc dd ee ff gg hh ii"]
    rows = [(i % 5, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    words = [re.findall(r"\w\w+", (t or "").lower()) for t in texts]
    grams = [[" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)] for w in words]
    counted = tfidf.ngram_counts(docs, 1, 3)
    assert "Generate" not in counted._jdf.queryExecution().executedPlan().toString()
    assert {r.ngram: r.n for r in counted.collect()} == Counter(g for some in grams for g in some)
    found = tfidf.term_counts(docs, tfidf.TfidfOptions((1, 3))).collect()
    expected = [(d, g, n) for (d, t), some in zip(rows, grams) for g, n in Counter(some).items()]
    expected += [(d, None, 0) for d, t in rows if t is not None]
    assert Counter(map(tuple, found)) == Counter(expected)


def test_terms_of_one_document_are_not_sent_back(spark, monkeypatch):
    """Chunks get the weights of shared terms only; rows with one id, or none, have one norm."""
    monkeypatch.setattr(tfidf, "_CHUNK_LEAST", 40)
    texts = [(i % 9, f"shared own{i} own{i} alone{i} common{i % 3}") for i in range(12)] + [(None, "shared xx"), (None, "xx yy"), (50, None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    options = tfidf.TfidfOptions((1, 1), 1, 0.95, None, True)
    chunked, terms, alone = tfidf._by_chunks(docs, options, "doc_id", "text", False)
    assert chunked.select("chunk").distinct().count() > 2 and alone == pytest.approx(math.log(15 / 2) + 1)
    assert {r.term for r in terms.collect()} == {"shared", "common0", "common1", "common2", "xx"}
    n, df = 14, Counter(t for _, x in texts if x for t in set(x.split()))
    raw = [(d, t, (math.log(c) + 1) * (math.log((n + 1) / (df[t] + 1)) + 1)) for d, x in texts if x for t, c in Counter(x.split()).items() if df[t] <= 0.95 * n]
    norm = Counter()
    for d, _, w in raw:
        norm[d] += w * w
    found = sorted(((r.doc_id or -1, r.term, r.w) for r in tfidf.tfidf(docs, options).collect()))
    expected = sorted((d or -1, t, w / norm[d] ** 0.5) for d, t, w in raw)
    assert [x[:2] for x in found] == [x[:2] for x in expected]
    assert all(x[2] == pytest.approx(y[2], abs=1e-12) for x, y in zip(found, expected))
    vectors = {r.doc_id: {round(x, 9) for x in np.frombuffer(r.ws)} for r in tfidf.tfidf_vectors(docs, options).collect()}
    assert None not in vectors and len(vectors) == 9 and all(vectors[d] <= {round(x[2] * k, 9) for x in expected if x[0] == (d or -1) for k in (1, 2)} for d in vectors)
