"""Country of the first author, inferred from the surname."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.countries import (
    DEFAULT_COUNTRY,
    SURNAME_COUNTRY,
    SURNAME_PATTERNS,
    UNKNOWN_COUNTRY,
)
from corpuslens.functions.text import accent_fold, strip
from corpuslens.schema import require_columns


def _folded_dictionary() -> dict[str, str]:
    """The surname dictionary under case- and accent-free keys; the first entry wins."""
    folded: dict[str, str] = {}
    for name, country in SURNAME_COUNTRY:
        bare = (c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
        folded.setdefault("".join(bare).lower().strip(), country)
    return folded


def first_surname(authors: Column) -> Column:
    """Surname of the first author of ``"Smith, John; Doe, Jane"``; empty when there is none."""
    first = strip(F.substring_index(authors, ";", 1))
    before_comma = strip(F.substring_index(first, ",", 1))
    first_word = F.element_at(F.split(first, r"(?U)[\s\x1c-\x1f]+"), 1)
    surname = F.when(F.contains(first, F.lit(",")), before_comma).otherwise(first_word)
    return F.coalesce(surname, F.lit(""))


def pattern_country(surname: Column) -> Column:
    """First matching surname rule, null when none matches."""
    chain = None
    for pattern, country in SURNAME_PATTERNS:
        hit = surname.rlike(f"(?iU){pattern}")
        chain = F.when(hit, country) if chain is None else chain.when(hit, country)
    return chain


def with_country(df: DataFrame, surname: str = "surname", country: str = "country") -> DataFrame:
    """Add the inferred country: dictionary, then ordered patterns, then the default.

    The dictionary is a constant of under a hundred rows, hence the broadcast. Patterns run only
    on rows the dictionary does not answer, because ``coalesce`` is lazy.
    """
    dictionary = df.sparkSession.createDataFrame(
        list(_folded_dictionary().items()), "_name_key string, _exact string"
    )
    trimmed = strip(F.col(surname))
    inferred = F.when(
        F.coalesce(F.col(surname), F.lit("")) == "", UNKNOWN_COUNTRY
    ).otherwise(F.coalesce("_exact", pattern_country(trimmed), F.lit(DEFAULT_COUNTRY)))
    return (
        df.withColumn("_key", accent_fold(F.col(surname)))
        .join(F.broadcast(dictionary), F.col("_key") == F.col("_name_key"), "left")
        .withColumn(country, inferred)
        .drop("_key", "_name_key", "_exact")
    )


def country_from_authors(df: DataFrame, authors: str = "authors") -> DataFrame:
    """Add ``surname`` and ``country`` of the first author to every row."""
    require_columns(df, authors)
    return with_country(df.withColumn("surname", first_surname(F.col(authors))))


def country_counts(df: DataFrame, authors: str = "authors") -> DataFrame:
    """Rows per inferred country, unknown ones left out, most frequent first.

    Rows are counted per surname first, so each distinct surname runs through the pattern rules
    once and a surname shared by a third of all rows crosses the shuffle as partial counts.
    """
    require_columns(df, authors)
    surnames = (
        df.filter(F.col(authors).isNotNull())
        .groupBy(first_surname(F.col(authors)).alias("surname"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        with_country(surnames)
        .filter(F.col("country") != UNKNOWN_COUNTRY)
        .groupBy("country")
        .agg(F.sum("n").alias("count"))
        .orderBy(F.desc("count"), "country")
    )


def country_kpis(counts: DataFrame) -> DataFrame:
    """Rows analysed, distinct countries and the most frequent one (ties: smaller name)."""
    return counts.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("articles"),
        F.count_distinct("country").alias("countries"),
        F.min_by("country", F.struct(-F.col("count"), "country")).alias("top_country"),
    )
