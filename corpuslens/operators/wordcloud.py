"""Word-cloud weights: the heaviest words and word pairs of abstracts and keywords."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.lexicon import ENGLISH_STOPWORDS
from corpuslens.storage import stage

MAX_WORDS = 150
COLLOCATION_SCORE = 30.0


def cloud_tokens(text: Column) -> Column:
    """Lower-cased words with inner apostrophes, a final 's removed, numbers dropped, in order."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\w[\w']+"), F.lit(0))
    bare = F.transform(found, lambda t: F.regexp_replace(t, "'s$", ""))
    return F.filter(bare, lambda t: ~t.rlike(r"(?U)^\d+$"))


def _stem(word: Column) -> Column:
    """``word`` without a final single ``s``: words with one stem are a singular and its plural.

    A stem ends in no single ``s`` of its own, so no word is both a plural and another's singular.
    """
    plural = word.endswith("s") & ~word.endswith("ss")
    return F.when(plural, F.substring(word, F.lit(1), F.length(word) - 1)).otherwise(word)


def _standard() -> Column:
    """The word that a group by ``stem`` counts as: the singular, or the plural where it stands alone."""
    given = F.bool_or(F.col("word") == F.col("stem"))
    return F.when(given, F.col("stem")).otherwise(F.concat("stem", F.lit("s")))


def _log_likelihood(k: Column, n: Column, x: Column) -> Column:
    tiny = F.lit(1e-10)
    return F.log(F.greatest(x, tiny)) * k + F.log(F.greatest(1 - x, tiny)) * (n - k)


def _collocation_score(pair: Column, first: Column, second: Column, total: Column) -> Column:
    """Dunning's log-likelihood ratio that two words occur together more than by chance."""
    p = second / total
    p1 = pair / first
    p2 = (second - pair) / (total - first)
    ratio = (
        _log_likelihood(pair, first, p)
        + _log_likelihood(second - pair, total - first, p)
        - _log_likelihood(pair, first, p1)
        - _log_likelihood(second - pair, total - first, p2)
    )
    return F.when((total > first) & (total > second), -2 * ratio).otherwise(F.lit(0.0))


def word_weights(
    texts: Sequence[DataFrame],
    max_words: int = MAX_WORDS,
    stopwords: Sequence[str] = ENGLISH_STOPWORDS,
    threshold: float = COLLOCATION_SCORE,
) -> DataFrame:
    """The ``max_words`` heaviest entries: ``(word, count, weight)``, weight relative to the top.

    ``texts`` are one-column tables, abstracts and then keywords. Adjacent words that collocate
    strongly become an entry of their own and are taken off their two words. Everything runs on
    counted words and pairs, a table far smaller than the corpus.
    """
    tokens = None
    for part in texts:
        column = part.select(cloud_tokens(F.col(part.columns[0])).alias("t"))
        tokens = column if tokens is None else tokens.unionByName(column)
    stop = [w.lower() for w in stopwords]
    following = F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0)))
    # One exploded pass counts words (second is null) and adjacent pairs together.
    units = F.concat(
        F.transform("t", lambda w: F.struct(w.alias("first"), F.lit(None).cast("string").alias("second"))),
        F.filter(
            F.zip_with("t", following, lambda x, y: F.struct(x.alias("first"), y.alias("second"))),
            lambda u: u.second.isNotNull(),
        ),
    )
    allowed = F.col("first").isNotNull()
    if stop:
        allowed = ~F.col("first").isin(*stop) & ~F.coalesce(F.col("second"), F.lit("")).isin(*stop)
    counted = stage(
        tokens.select(F.explode(units).alias("u"))
        .select("u.first", "u.second")
        .filter(allowed)
        .groupBy("first", "second")
        .agg(F.count(F.lit(1)).alias("n")),
        "units",
    )
    single = counted.filter(F.col("second").isNull()).select(F.col("first").alias("word"), "n")
    # Where singular and plural both occur, both count as the singular.
    words = stage(
        single.withColumn("stem", _stem(F.col("word"))).groupBy("stem").agg(
            _standard().alias("standard"), F.sum("n").alias("n"), F.collect_list("word").alias("words")
        ),
        "words",
    )
    unigrams = words.select("standard", "n")
    total = words.agg(F.sum("n").cast("double")).scalar()
    # Distinct pairs placed once by their first word, for the grouping and the first join.
    pairs = (
        counted.filter(F.col("second").isNotNull())
        .repartition("first")
        .select("first", F.col("second").alias("word"), _stem(F.col("second")).alias("stem"), "n")
        .groupBy("first", "stem")
        .agg(_standard().alias("second"), F.sum("n").alias("n"))
        .select("first", "second", "n")
    )
    named = words.select(F.explode("words").alias("word"), "standard", F.col("n").alias("total_n"))
    for side in ("first", "second"):
        pairs = pairs.join(
            named.withColumnsRenamed(
                {"word": side, "standard": f"{side}_word", "total_n": f"{side}_n"}
            ),
            side,
        )
    score = _collocation_score(
        *(F.col(c).cast("double") for c in ("n", "first_n", "second_n")), total
    )
    strong = stage(
        pairs.filter(score > threshold).select(
            F.concat_ws(" ", "first", "second").alias("pair"), "first_word", "second_word", "n"
        ),
        "pairs",
    )
    taken = strong.select(
        F.explode(F.array("first_word", "second_word")).alias("standard"), "n"
    ).groupBy("standard").agg(F.sum("n").alias("taken"))
    left = unigrams.join(taken, "standard", "left").select(
        F.col("standard").alias("word"),
        (F.col("n") - F.coalesce("taken", F.lit(0))).alias("count"),
    )
    entries = left.unionByName(strong.select(F.col("pair").alias("word"), F.col("n").alias("count")))
    heaviest = (
        entries.filter(F.col("count") > 0).orderBy(F.desc("count"), "word").limit(max_words)
    )
    # A window over at most ``max_words`` rows.
    return heaviest.withColumn("weight", F.col("count") / F.max("count").over(Window.partitionBy()))
