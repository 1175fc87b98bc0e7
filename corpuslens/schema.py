"""The article schema every reader produces and every operator accepts."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("ord", T.LongType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("authors", T.ArrayType(T.StringType()), True),
        T.StructField("keywords", T.ArrayType(T.StringType()), True),
        T.StructField("abstract", T.StringType(), True),
        T.StructField("journal", T.StringType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("doi", T.StringType(), True),
        T.StructField("source", T.StringType(), True),
        T.StructField("url", T.StringType(), True),
        T.StructField("document_type", T.StringType(), True),
        T.StructField("location", T.StringType(), True),
    ]
)

# Column order of the unified table on disk; lists are joined with "; ".
UNIFIED_SCHEMA = T.StructType(
    [
        T.StructField("document_type", T.StringType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("authors", T.StringType(), True),
        T.StructField("keywords", T.StringType(), True),
        T.StructField("abstract", T.StringType(), True),
        T.StructField("journal", T.StringType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("doi", T.StringType(), True),
        T.StructField("source", T.StringType(), True),
        T.StructField("url", T.StringType(), True),
        T.StructField("publisherLocations", T.StringType(), True),
    ]
)


class MissingColumnsError(ValueError):
    """An operator was given a DataFrame without the columns it needs."""


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail at plan time, before any job starts, when a column is absent."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise MissingColumnsError(f"missing columns {absent}; available: {df.columns}")
    return df


def rows_with_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df``, or no rows of it and a warning where a column is absent, which is then null.

    For reports over tables of any origin, which go on without what a table can't give;
    :func:`require_columns` fails instead.
    """
    absent = [n for n in names if n not in df.columns]
    if not absent:
        return df
    warnings.warn(f"no rows used: missing columns {absent}; available: {df.columns}", stacklevel=2)
    return df.withColumns({n: F.lit(None).cast("string") for n in absent}).filter(F.lit(False))
