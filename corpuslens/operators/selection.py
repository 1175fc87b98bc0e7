"""Row filters and selections shared by the analyses."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.text import strip
from corpuslens.schema import require_columns

# Defaults of the interactive selection; all are arguments.
CLUSTER_MIN_ROWS = 5
CLUSTER_DEFAULT_ROWS = 40
CLUSTER_MAX_ROWS = 120
CLUSTER_MIN_ABSTRACT = 50


def valid_abstracts(df: DataFrame, abstract: str = "abstract") -> DataFrame:
    """Rows whose abstract is neither null nor blank."""
    require_columns(df, abstract)
    return df.filter(strip(F.col(abstract)) != "")


def valid_abstract_titles(
    df: DataFrame, abstract: str = "abstract", title: str = "title"
) -> DataFrame:
    """Rows with a title and a non-blank abstract."""
    require_columns(df, abstract, title)
    return valid_abstracts(df, abstract).filter(F.col(title).isNotNull())


def clusterable(df: DataFrame, abstract: str = "abstract", title: str = "title") -> DataFrame:
    """Rows with a non-blank title and an abstract of more than 50 trimmed characters."""
    require_columns(df, abstract, title)
    return df.filter(
        (F.length(strip(F.col(abstract))) > CLUSTER_MIN_ABSTRACT) & (strip(F.col(title)) != "")
    )


def _checked_size(n: int) -> int:
    if n < 1:
        raise ValueError(f"selection size must be positive, got {n}")
    return n


def first_n(
    df: DataFrame,
    n: int = CLUSTER_DEFAULT_ROWS,
    ord_col: str = "ord",
    by: str | None = None,
) -> DataFrame:
    """The first ``n`` rows in ingest order, of the whole table or of each ``by`` group.

    Both forms keep at most ``n`` rows per map task (and group) before anything is shuffled.
    """
    if by is None:
        return df.orderBy(ord_col).limit(_checked_size(n))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(ord_col))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= _checked_size(n)).drop("_rank")


def seeded_sample(
    df: DataFrame, n: int = CLUSTER_DEFAULT_ROWS, seed: int = 42, ord_col: str = "ord"
) -> DataFrame:
    """Exactly ``n`` rows, the same ones for the same seed however the data is partitioned."""
    draw = F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.col(ord_col).cast("string")))
    return df.orderBy(draw, ord_col).limit(_checked_size(n))


def has_min_rows(df: DataFrame, minimum: int = CLUSTER_MIN_ROWS) -> bool:
    """Whether there are enough rows to cluster; reads at most ``minimum`` rows."""
    return df.limit(minimum).count() >= minimum


def groups_with_min_rows(
    df: DataFrame, by: str, minimum: int = CLUSTER_MIN_ROWS
) -> DataFrame:
    """Rows of each group and whether they are enough to cluster: ``(by, rows, enough)``."""
    rows = F.count(F.lit(1))
    return df.groupBy(by).agg(rows.alias("rows"), (rows >= minimum).alias("enough"))


def selection_counts(
    df: DataFrame, by: str, abstract: str = "abstract", title: str = "title"
) -> DataFrame:
    """Rows of each group that each of the three row filters keeps, from one scan."""
    require_columns(df, by, abstract, title)
    body, name = strip(F.col(abstract)), F.col(title)
    clusters = (F.length(body) > CLUSTER_MIN_ABSTRACT) & (strip(name) != "")
    return df.groupBy(by).agg(
        F.count_if(body != "").alias("with_abstract"),
        F.count_if((body != "") & name.isNotNull()).alias("with_both"),
        F.count_if(clusters).alias("clusterable"),
    )


def title_lookup(
    articles: DataFrame, wanted: DataFrame, title: str = "title", ord_col: str = "ord"
) -> DataFrame:
    """Abstract of the first article carrying each wanted title.

    The first row per title is picked by a pre-aggregated ``min_by``, so a title shared by a third
    of all rows shrinks to one row per map task before the shuffle.
    """
    first = articles.groupBy(title).agg(F.min_by("abstract", ord_col).alias("abstract"))
    return wanted.select(title).distinct().join(first, title, "inner")


def display_rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename result columns for presentation."""
    require_columns(df, *names)
    return df.withColumnsRenamed(dict(names))
