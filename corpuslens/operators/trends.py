"""Publication trends by year, journal and document type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.text import strip, truncate_label
from corpuslens.schema import require_columns

UNKNOWN_JOURNAL = "Desconocida"
DEFAULT_TYPE = "Article"
OTHER_JOURNALS = "Otras revistas / conferencias"
DOCUMENT_TYPES = ("conference", "periodical", "article")
_JOURNAL_LABEL = 55
_KPI_LABEL = 45


def trend_clean(df: DataFrame) -> DataFrame:
    """Dated rows with journal and type defaults filled in and trimmed."""
    require_columns(df, "year", "journal", "document_type")
    return df.filter(F.col("year").isNotNull()).withColumns(
        {
            "year": F.col("year").cast("int"),
            "journal": strip(F.coalesce("journal", F.lit(UNKNOWN_JOURNAL))),
            "document_type": strip(F.coalesce("document_type", F.lit(DEFAULT_TYPE))),
        }
    )


def year_range(df: DataFrame, low: int | None = None, high: int | None = None) -> DataFrame:
    """Rows between two years inclusive; an open end means the data's own extreme."""
    if low is not None:
        df = df.filter(F.col("year") >= low)
    if high is not None:
        df = df.filter(F.col("year") <= high)
    return df


def of_type(df: DataFrame, document_type: str) -> DataFrame:
    return df.filter(F.lower("document_type") == document_type.lower())


def distinct_years(df: DataFrame) -> DataFrame:
    return df.select("year").distinct().orderBy("year")


def year_type_journal_counts(df: DataFrame) -> DataFrame:
    """Counts by year, type and journal.

    The cube every other trend is derived from: partial aggregation shrinks a hot journal or year
    to one row per map task before anything is shuffled.
    """
    return df.groupBy("year", "document_type", "journal").agg(F.count(F.lit(1)).alias("count"))


def year_type_journal_table(df: DataFrame) -> DataFrame:
    return year_type_journal_counts(df).orderBy("year", "document_type", "journal")


def trend_kpis(df: DataFrame) -> DataFrame:
    """Rows, distinct years, journals and types."""
    return year_type_journal_counts(df).agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total"),
        F.count_distinct("year").alias("years"),
        F.count_distinct("journal").alias("journals"),
        F.count_distinct("document_type").alias("types"),
    )


def _checked_top(n: int) -> int:
    if n < 1:
        raise ValueError(f"top n must be positive, got {n}")
    return n


def top_journals(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` journals with most rows; ties by name."""
    return (
        df.groupBy("journal")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "journal")
        .limit(_checked_top(n))
    )


def year_journal_counts(df: DataFrame, n: int = 10) -> DataFrame:
    """Counts by year and display journal, journals outside the top ``n`` in one bucket."""
    top = top_journals(df, n).select("journal", F.lit(True).alias("_top"))
    cells = df.groupBy("year", "journal").agg(F.count(F.lit(1)).alias("count"))
    shown = cells.join(F.broadcast(top), "journal", "left").withColumn(
        "journal_display",
        F.when(F.col("_top"), truncate_label(F.col("journal"), _JOURNAL_LABEL)).otherwise(
            OTHER_JOURNALS
        ),
    )
    return shown.groupBy("year", "journal_display").agg(F.sum("count").alias("count"))


def display_order(timeline: DataFrame) -> DataFrame:
    """Display journals by name, the bucket of other journals last."""
    return (
        timeline.select("journal_display")
        .distinct()
        .orderBy(F.col("journal_display") == OTHER_JOURNALS, "journal_display")
    )


def year_journal_table(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("year", "journal")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("year", F.desc("count"), "journal")
    )


def year_type_counts(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("year", "document_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("year", "document_type")
    )


def _typed_cells(df: DataFrame, types: Sequence[str]) -> DataFrame:
    kind = F.lower("document_type")
    return (
        df.filter(kind.isin(*[t.lower() for t in types]))
        .groupBy(kind.alias("document_type"), "year", "journal")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def type_kpis(df: DataFrame, types: Sequence[str] = DOCUMENT_TYPES) -> DataFrame:
    """Per type: rows, year with most rows and most frequent journal; ties to the smaller."""
    cells = _typed_cells(df, types)
    years = cells.groupBy("document_type", "year").agg(F.sum("count").alias("n"))
    journals = cells.groupBy("document_type", "journal").agg(F.sum("count").alias("n"))
    peak = years.groupBy("document_type").agg(
        F.sum("n").alias("total"),
        F.min_by("year", F.struct(-F.col("n"), "year")).alias("peak_year"),
    )
    leading = journals.groupBy("document_type").agg(
        F.min_by("journal", F.struct(-F.col("n"), "journal")).alias("journal")
    )
    return peak.join(leading, "document_type").select(
        "document_type",
        "total",
        "peak_year",
        truncate_label(F.col("journal"), _KPI_LABEL).alias("top_journal"),
    )


def per_type_trend(
    df: DataFrame, n: int = 10, types: Sequence[str] = DOCUMENT_TYPES
) -> DataFrame:
    """Top-``n`` timeline of every document type in one pass.

    The rank limit is applied on each map task before the shuffle, so a type holding a third of
    all journals is never collected whole.
    """
    cells = _typed_cells(df, types)
    by_size = Window.partitionBy("document_type").orderBy(F.desc("n"), "journal")
    top = (
        cells.groupBy("document_type", "journal")
        .agg(F.sum("count").alias("n"))
        .withColumn("rank", F.row_number().over(by_size))
        .filter(F.col("rank") <= _checked_top(n))
        .select("document_type", "journal", F.lit(True).alias("_top"))
    )
    shown = cells.join(F.broadcast(top), ["document_type", "journal"], "left").withColumn(
        "journal_display",
        F.when(F.col("_top"), truncate_label(F.col("journal"), _JOURNAL_LABEL)).otherwise(
            OTHER_JOURNALS
        ),
    )
    return shown.groupBy("document_type", "year", "journal_display").agg(
        F.sum("count").alias("count")
    )
