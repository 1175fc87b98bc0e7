"""TF-IDF tables over a whole corpus and the discovery of new terms."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.functions.lexicon import (
    CATEGORY_KEYWORDS,
    ENGLISH_STOPWORDS,
    GENERIC_STOPWORDS,
)
from corpuslens.functions.termcounts import all_terms, coded_terms, pack, row_terms
from corpuslens.functions.text import alpha_normalize, strip, word_tokens
from corpuslens.operators.selection import valid_abstracts
from corpuslens.storage import release, stage

# Executors receive the kernel by value, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of an Arrow batch that a task gives back.
_BATCH_ROWS = 1 << 17
# Characters of a chunk of documents, whose terms are weighed together, at most and at least.
_CHUNK_CHARS, _CHUNK_LEAST = 1 << 23, 1 << 19


@dataclass(frozen=True)
class TfidfOptions:
    ngrams: tuple[int, int] = (1, 1)
    min_df: int = 1
    max_df: float = 1.0
    max_features: int | None = None
    sublinear_tf: bool = False
    stopwords: Sequence[str] = ()


DISCOVERY = TfidfOptions((1, 2), 2, 0.95, 300, True, ENGLISH_STOPWORDS)
CLUSTERING = TfidfOptions((1, 2), 1, 0.95, 3000, True)
# The same weights without the cap.
ALL_TERMS = TfidfOptions((1, 2), 1, 1.0, None, True)


def term_counts(
    docs: DataFrame,
    options: TfidfOptions,
    doc_id: str = "doc_id",
    text: str = "text",
    by: str | None = None,
) -> DataFrame:
    """``([by,] doc_id, term, tf)``, and for each document a row of a null term.

    A row is a whole document, so its terms are counted inside it, some documents at a time in
    numpy: neither texts nor term occurrences are shuffled. The rows of null terms count the
    documents; one without a text has none.
    """
    keys = [by, doc_id] if by else [doc_id]
    tokens = word_tokens(F.col(text), options.stopwords).alias("tokens")
    low, high = options.ngrams
    given = docs.filter(F.col(text).isNotNull()).select(*keys, tokens)
    names = [*keys, "term", "tf"]
    schema = T.StructType([*given.schema.fields[: len(keys)], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.columns[: len(keys)]
            nothing = pa.nulls(batch.num_rows, pa.string()), pa.array(np.zeros(batch.num_rows, np.int64))
            yield pa.RecordBatch.from_arrays([*ids, *nothing], names)
            for row, term, n in row_terms(batch.columns[-1], low, high):
                for first in range(0, len(row), _BATCH_ROWS):
                    at = slice(first, first + _BATCH_ROWS)
                    some = pa.array(row[at])
                    yield pa.RecordBatch.from_arrays([*[i.take(some) for i in ids], term[at].cast(pa.string()), pa.array(n[at])], names)

    return given.mapInArrow(counted, schema)


def ngram_counts(docs: DataFrame, low: int, high: int, text: str = "text") -> DataFrame:
    """``(ngram, n)``: how often each word n-gram stands in the texts.

    Some documents at a time are counted in numpy, and only their distinct n-grams are shuffled.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for term, n in all_terms(batch.column(0), low, high):
                for first in range(0, len(n), _BATCH_ROWS):
                    at = slice(first, first + _BATCH_ROWS)
                    yield pa.RecordBatch.from_arrays([term[at].cast(pa.string()), pa.array(n[at])], ["ngram", "n"])

    some = docs.select(word_tokens(F.col(text)).alias("tokens")).mapInArrow(counted, "ngram string, n bigint")
    return some.groupBy("ngram").agg(F.sum("n").alias("n"))


def corpus_size(counts: DataFrame, by: str | None = None) -> DataFrame:
    """Documents behind :func:`term_counts`, as ``([by,] n_docs)``."""
    n_docs = F.count(F.lit(1)).alias("n_docs")
    whole = counts.filter(F.col("term").isNull())
    return whole.groupBy(by).agg(n_docs) if by else whole.agg(n_docs)


def _idf(n_docs: Column) -> Column:
    return F.log((n_docs + 1) / (F.col("df") + 1)) + 1


def _kept(terms: DataFrame, n_docs: Column, options: TfidfOptions) -> DataFrame:
    """Those of ``terms (term, df, cf)`` that the options keep, with their idf."""
    terms = terms.filter((F.col("df") >= options.min_df) & (F.col("df") <= n_docs * options.max_df))
    if options.max_features is not None:
        terms = terms.orderBy(F.desc("cf"), "term").limit(options.max_features)
    return terms.withColumn("idf", _idf(n_docs))


def vocabulary(counts: DataFrame, options: TfidfOptions, by: str | None = None) -> DataFrame:
    """Kept terms with document frequency ``df``, total count ``cf`` and smoothed idf.

    With ``by``, every group is a corpus of its own: group size, bounds and the feature cap apply
    per group, the cap as a rank limit that Spark also evaluates before the shuffle.
    """
    keys = [by, "term"] if by else ["term"]
    terms = (
        counts.filter(F.col("term").isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    )
    if not by:
        return _kept(terms, corpus_size(counts).scalar(), options)
    terms = terms.join(corpus_size(counts, by), by)
    n_docs = F.col("n_docs")
    terms = terms.filter((F.col("df") >= options.min_df) & (F.col("df") <= n_docs * options.max_df))
    if options.max_features is not None:
        rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("cf"), "term"))
        terms = terms.withColumn("_rank", rank).filter(F.col("_rank") <= options.max_features)
    return terms.select(*keys, "df", "cf", _idf(n_docs).alias("idf"))


def weigh(counts: DataFrame, options: TfidfOptions, doc_id: str = "doc_id", by: str | None = None) -> DataFrame:
    """Weights from a stored table of :func:`term_counts`.

    The vocabulary is stored too: from its size Catalyst chooses to send it to every executor or to
    shuffle, in which case a term of many documents is split by adaptive execution. Its terms are
    distinct, so its partitions are hashed rather than both sides sorted by term.
    """
    keys = [by, doc_id] if by else [doc_id]
    on = [by, "term"] if by else ["term"]
    vocab = stage(vocabulary(counts, options, by), "vocabulary").select(*on, "idf")
    tf = F.log("tf") + 1 if options.sublinear_tf else F.col("tf").cast("double")
    raw = counts.join(vocab.hint("shuffle_hash") if by is None and options.max_features is None else vocab, on).select(*keys, "term", (tf * F.col("idf")).alias("raw"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(*keys)))
    return raw.select(*keys, "term", (F.col("raw") / norm).alias("w"))


def in_chunks(docs: DataFrame, options: TfidfOptions, doc_id: str, text: str, chunks: int) -> DataFrame:
    """``(chunk, doc, tokens)`` of the documents with a text, each chunk in one place.

    Rows with one id share a chunk. What is shuffled are texts: their tokens are made where they come to.
    """
    slots = docs.sparkSession.sparkContext.defaultParallelism
    given = docs.filter(F.col(text).isNotNull()).select(
        F.pmod(F.xxhash64(doc_id), F.lit(chunks)).alias("chunk"), F.col(doc_id).alias("doc"), F.col(text).alias("text")
    )
    placed = given.repartition(max(chunks, slots), "chunk").sortWithinPartitions("chunk")
    return placed.select("chunk", "doc", word_tokens(F.col("text"), options.stopwords).alias("tokens"))


def chunk_terms(chunked: DataFrame, low: int, high: int) -> DataFrame:
    """``(chunk, term, df, cf)``: every chunk's distinct n-grams, in how many of its rows each stands and how often."""

    def terms(group: pa.Table) -> pa.Table:
        parts = [pa.table({"term": pa.array([], pa.large_string()), "df": np.empty(0, np.int64), "cf": np.empty(0, np.int64)})]
        for _, code, n, names in coded_terms(group.column("tokens").combine_chunks(), low, high):
            df, cf = np.bincount(code, minlength=len(names)), np.bincount(code, n, len(names)).astype(np.int64)
            parts.append(pa.table({"term": names, "df": df, "cf": cf}).filter(pa.array(df > 0)))
        # Terms in order share their beginnings, which compresses what is shuffled.
        found = pa.concat_tables(parts).group_by("term").aggregate([("df", "sum"), ("cf", "sum")]).sort_by("term")
        chunk = pa.repeat(group.column("chunk")[0], found.num_rows)
        return pa.table({"chunk": chunk, "term": found["term"].cast(pa.string()), "df": found["df_sum"], "cf": found["cf_sum"]})

    return chunked.groupBy("chunk").applyInArrow(terms, "chunk bigint, term string, df bigint, cf bigint")


def _numbered(rows: DataFrame) -> DataFrame:
    """Stored ``rows`` with a number ``tid``, from 0 on without large gaps in all partitions."""
    rows = stage(rows.withColumn("tid", F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftright("tid", 33), F.col("tid").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = dict(rows.groupBy(part).agg(F.max(place) + 1).collect())
    before = [sum(sizes.get(i, 0) for i in range(p)) for p in range(max(sizes, default=0) + 1)]
    first = F.get(F.array(*[F.lit(x).cast("bigint") for x in before]), part.cast("int"))
    return rows.withColumn("tid", first + place)


def _weighed(
    rows: pa.Table, vocab: pa.Table, options: TfidfOptions, alone: float | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """``row, place, w, doc, names``: entries of a chunk's rows by their term's place in ``names``, and the rows' documents by number.

    ``names`` are the terms of ``vocab`` and then those that are not in it, whose idf is ``alone``; terms
    without an idf are left out. Rows with one id are one document, whose norm is that of all their entries.
    """
    names = [vocab.column("term").combine_chunks().cast(pa.large_string())]
    idf, known = vocab.column("idf").to_numpy(), len(names[0])
    doc = rows.column("doc").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    parts = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    for row, code, n, own in coded_terms(rows.column("tokens").combine_chunks(), *options.ngrams):
        at = pc.fill_null(pc.index_in(own, value_set=names[0]), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        value = np.where(at >= 0, np.append(idf, 0.0)[at], np.nan if alone is None else alone)
        new = np.flatnonzero(at < 0)
        at[new] = known + np.arange(len(new))
        names.append(own.take(pa.array(new)))
        known += len(new)
        kept = ~np.isnan(value[code])
        row, code, n = row[kept], code[kept], n[kept]
        parts.append((row, at[code], ((np.log(n) + 1) if options.sublinear_tf else n) * value[code]))
    row, place, raw = (np.concatenate(x) for x in zip(*parts))
    norm = np.sqrt(np.bincount(doc[row], raw * raw, len(doc)))
    return row, place, raw / norm[doc[row]], doc, pa.concat_arrays(names)


def _by_chunks(
    docs: DataFrame, options: TfidfOptions, doc_id: str, text: str, numbered: bool
) -> tuple[DataFrame, DataFrame, float | None]:
    """Documents in chunks, the terms of every chunk ``(chunk, term, idf[, tid, df])``, and the idf of those that come nowhere else.

    A chunk's distinct terms go to where documents are counted, and only those of several documents
    come back, without an idf if the options leave them out; texts are shuffled by chunk.
    """
    chars, n_docs = docs.agg(F.sum(F.length(text)), F.count(text)).first()
    slots = docs.sparkSession.sparkContext.defaultParallelism
    size = min(_CHUNK_CHARS, max(_CHUNK_LEAST, (chars or 0) // (4 * slots)))
    chunked = in_chunks(docs, options, doc_id, text, max(1, -(-(chars or 0) // size)))
    of_chunks = chunk_terms(chunked, *options.ngrams)
    alone = options.max_features is None and options.min_df <= 1 <= n_docs * options.max_df
    if not numbered and options.max_features is None:
        whole = of_chunks.select("chunk", "term", F.sum("df").over(Window.partitionBy("term")).alias("df"))
    else:
        of_chunks = stage(of_chunks, "chunk-terms")
        release(docs.sparkSession)
        whole = of_chunks.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    if alone:
        bounded = (F.col("df") >= options.min_df) & (F.col("df") <= n_docs * options.max_df)
        kept = whole.filter("df > 1").withColumn("idf", F.when(bounded, _idf(F.lit(n_docs))))
    else:
        kept = _kept(whole, F.lit(n_docs), options)
    if numbered:
        kept = _numbered(kept.select("term", "idf", "df"))
    if "chunk" not in kept.columns:
        kept = of_chunks.select("chunk", "term").join(kept, "term")
    columns = ["chunk", "term", "idf", *(("tid", "df") if numbered else ())]
    return chunked, kept.select(*columns), float(np.log((n_docs + 1) / 2) + 1) if alone else None


def tfidf_vectors(docs: DataFrame, options: TfidfOptions, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: its id and ``tids, dfs, ws`` of the terms that other rows have too.

    These are packed as numbers of 4, 4 and 8 bytes. Weights are those of :func:`tfidf`. Rows with one id, which a join by
    id would multiply out, are added up. Rows without an id or such a term are left out.
    """
    chunked, terms, alone = _by_chunks(docs, options, doc_id, text, True)
    kind = docs.schema[doc_id].dataType.simpleString()

    def vectors(rows: pa.Table, vocab: pa.Table) -> pa.Table:
        row, place, w, doc, _ = _weighed(rows, vocab, options, alone)
        ids = rows.column("doc").combine_chunks()
        df = vocab.column("df").to_numpy()
        row, place, w = row[place < len(df)], place[place < len(df)], w[place < len(df)]
        given = (df[place] > 1) & ids.is_valid().to_numpy(zero_copy_only=False)[row]
        key, at = np.unique(doc[row[given]].astype(np.int64) * max(1, len(df)) + place[given], return_inverse=True)
        w = np.bincount(at, w[given], len(key))
        own, place = key // max(1, len(df)), key % max(1, len(df))
        found, starts = np.unique(own, return_index=True)
        first = np.zeros(len(doc), np.int64)
        first[doc[::-1]] = np.arange(len(doc))[::-1]
        tid = vocab.column("tid").to_numpy()[place].astype(np.int32)
        columns = {"tids": pack(tid, starts), "dfs": pack(df[place].astype(np.int32), starts), "ws": pack(w, starts)}
        return pa.table({doc_id: ids.take(pa.array(first[found])), **columns})

    return chunked.groupBy("chunk").cogroup(terms.groupBy("chunk")).applyInArrow(
        vectors, f"`{doc_id}` {kind}, tids binary, dfs binary, ws binary"
    )


def tfidf(
    docs: DataFrame,
    options: TfidfOptions,
    doc_id: str = "doc_id",
    text: str = "text",
    by: str | None = None,
) -> DataFrame:
    """L2-normalised TF-IDF weights as a long table ``([by,] doc_id, term, w)`` of non-zeros.

    With ``by``, a document is known by both columns: one id may stand in several groups.
    """
    if by is not None:
        return weigh(stage(term_counts(docs, options, doc_id, text, by), "counts"), options, doc_id, by)
    chunked, terms, alone = _by_chunks(docs, options, doc_id, text, False)
    kind = docs.schema[doc_id].dataType.simpleString()

    def weights(rows: pa.Table, vocab: pa.Table) -> pa.Table:
        row, place, w, _, names = _weighed(rows, vocab, options, alone)
        ids = rows.column("doc").combine_chunks()
        parts = [pa.table({doc_id: ids[:0], "term": names[:0].cast(pa.string()), "w": np.empty(0)})]
        for first in range(0, len(row), _BATCH_ROWS):
            at = slice(first, first + _BATCH_ROWS)
            parts.append(pa.table({doc_id: ids.take(pa.array(row[at])), "term": names.take(pa.array(place[at])).cast(pa.string()), "w": w[at]}))
        return pa.concat_tables(parts)

    return chunked.groupBy("chunk").cogroup(terms.groupBy("chunk")).applyInArrow(weights, f"`{doc_id}` {kind}, term string, w double")


def mean_term_scores(weights: DataFrame, n_docs: Column) -> DataFrame:
    """Mean weight of each term over all documents, an absent term counting as zero."""
    return weights.groupBy("term").agg((F.sum("w") / n_docs).alias("score"))


def known_terms(keywords: Sequence[str]) -> list[str]:
    """Lower-cased phrases and their single words."""
    phrases = {k.lower().strip() for k in keywords}
    return sorted(phrases | {w for k in keywords for w in k.lower().split()})


def extract_new_keywords(
    corpus: DataFrame,
    keywords: Sequence[str] = CATEGORY_KEYWORDS,
    max_new: int = 15,
    doc_id: str = "doc_id",
    text: str = "text",
    options: TfidfOptions = DISCOVERY,
    generic: Sequence[str] = GENERIC_STOPWORDS,
) -> DataFrame:
    """The best-scoring terms that are not known, not generic and long enough."""
    docs = valid_abstracts(corpus, text).select(doc_id, alpha_normalize(F.col(text)).alias(text))
    counts = stage(term_counts(docs, options, doc_id, text), "counts")
    scored = mean_term_scores(weigh(counts, options, doc_id), corpus_size(counts).scalar())
    term = F.col("term")
    known = known_terms(keywords)
    eligible = (
        (F.length(strip(term)) >= 4)
        & ~term.rlike(r"^[\d ]+$")
        & ~F.exists(F.split(term, " "), lambda w: w.isin(*generic))
    )
    if known:
        eligible &= ~term.isin(*known)
    return (
        scored.filter(eligible)
        .orderBy(F.desc(F.round("score", 12)), "term")
        .limit(max_new)
        .select("term", F.bround("score", 5).alias("tfidf_score"))
    )
