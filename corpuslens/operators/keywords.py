"""Keyword frequencies over a corpus of abstracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.lexicon import CATEGORY_KEYWORDS


def _literal_pattern(keyword: str) -> str:
    trimmed = keyword.strip()
    if not trimmed:
        raise ValueError("keywords must not be blank")
    return "(?iu)\\Q" + trimmed.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def keyword_frequency(
    corpus: DataFrame, keywords: Sequence[str] = CATEGORY_KEYWORDS, text: str = "text"
) -> DataFrame:
    """Document frequency, occurrences and share of documents of each literal keyword.

    One scan answers every keyword: the counts are plain columns, partially aggregated on each
    map task, so the only shuffle carries a single row per task whatever the corpus size. Matching
    is a case-insensitive, non-overlapping substring search without word boundaries.
    """
    schema = "keyword string, doc_freq bigint, abs_freq bigint, pct double"
    if not keywords:
        return corpus.sparkSession.createDataFrame([], schema)
    hits = corpus.select(
        *[
            F.regexp_count(F.col(text), F.lit(_literal_pattern(k))).alias(f"h{i}")
            for i, k in enumerate(keywords)
        ]
    )
    totals = hits.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(f"h{i}") > 0).alias(f"d{i}") for i in range(len(keywords))],
        *[
            F.coalesce(F.sum(f"h{i}"), F.lit(0)).cast("bigint").alias(f"a{i}")
            for i in range(len(keywords))
        ],
    )
    records = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("kw_ord"),
                    F.lit(k).alias("keyword"),
                    F.col(f"d{i}").alias("doc_freq"),
                    F.col(f"a{i}").alias("abs_freq"),
                )
                for i, k in enumerate(keywords)
            ]
        )
    )
    return (
        totals.select("n", records.alias("r"))
        .select("r.*", share_percent(F.col("r.doc_freq"), F.col("n")).alias("pct"))
        .orderBy(F.desc("doc_freq"), "kw_ord")
        .drop("kw_ord")
    )


def share_percent(part: Column, whole: Column) -> Column:
    """Share in percent, two decimals, 0.0 for an empty whole."""
    return F.when(whole > 0, F.bround(part / whole * 100, 2)).otherwise(F.lit(0.0))


def group_comparison(original: DataFrame, discovered: DataFrame) -> DataFrame:
    """Both frequency tables in one, labelled by group."""
    tagged = [
        part.select("keyword", "doc_freq", F.lit(label).alias("grupo"))
        for part, label in ((original, "Originales"), (discovered, "Nuevas (TF-IDF)"))
    ]
    return tagged[0].unionByName(tagged[1])
