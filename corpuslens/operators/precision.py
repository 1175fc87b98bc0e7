"""Semantic precision of discovered terms against a category vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.vectors import clip01, cosine

HIGH, MEDIUM = 0.70, 0.40


def precision_band(score: Column) -> Column:
    return (
        F.when(score >= HIGH, "Alta").when(score >= MEDIUM, "Media").when(score < MEDIUM, "Baja")
    )


def term_precision(
    terms: DataFrame,
    category: Column | Sequence[float],
    term: str = "term",
    vector: str = "embedding",
) -> DataFrame:
    """Clipped cosine of every term vector with the category vector, best first.

    ``category`` is one vector: a literal sequence, or a scalar subquery (``df.scalar()``), which
    reaches the tasks as a constant, so no join is involved.
    """
    if not isinstance(category, Column):
        category = F.array(*[F.lit(float(x)) for x in category])
    paired = terms.select(term, vector, category.alias("_category"))
    scored = paired.select(
        term, clip01(cosine(F.col(vector), F.col("_category"))).alias("_score")
    )
    return scored.select(
        term,
        F.bround("_score", 4).alias("precision"),
        F.bround(F.col("_score") * 100, 2).alias("pct"),
        precision_band(F.col("_score")).alias("label"),
    ).orderBy(F.desc("precision"), term)


def precision_summary(evaluations: DataFrame) -> DataFrame:
    """Average of the rounded precisions and the number of terms in each band."""
    p = F.col("precision")
    return evaluations.agg(
        F.coalesce(F.bround(F.avg(p), 4), F.lit(0.0)).alias("average_precision"),
        F.count_if(p >= HIGH).alias("high"),
        F.count_if((p >= MEDIUM) & (p < HIGH)).alias("medium"),
        F.count_if(p < MEDIUM).alias("low"),
    )
