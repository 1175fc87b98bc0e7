"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.expressions import let, window_hashes, words
from corpuslens.storage import stage

#: Words of a window whose repetition counts.
WINDOW = 5
#: A text is kept from this posterior probability of good quality on.
KEEP_FROM = 0.5
ROUNDS, PRIOR_GOOD = 50, 0.9
#: Rates at which a rule is taken to vote among good and among bad texts, before any are seen: bad
#: texts come in kinds, so most rules abstain on most of them, and a vote against is rarely wrong.
EXPECTED = {1: (0.5, 0.1), 0: (0.49, 0.6), -1: (0.01, 0.3)}
#: Weights of the expected rates and of the prior, as shares of the texts counted.
RATES_HELD, PRIOR_HELD = 0.2, 1.0

_SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _count_of(text: Column, characters: str) -> Column:
    rest = text
    for c in characters:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.char_length(text) - F.char_length(rest)


def repeated_words(w: Column, width: int = WINDOW) -> Column:
    """Words covered by windows of ``width`` words that occur twice or more in the array."""

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.cast("int").alias("i"))))

        def repeats(s: Column) -> Column:
            alike = lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
            starts = F.sort_array(F.transform(F.filter(s, lambda x, k: F.coalesce(alike(x, k), F.lit(False))), lambda x: x["i"]))
            return F.aggregate(
                starts,
                F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                lambda a, i: F.struct(
                    (a["n"] + i + width - F.greatest(a["end"], i)).alias("n"), (i + width).alias("end")
                ),
                lambda a: a["n"],
            )

        # Sorting with positions is needed only where some hash comes twice.
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(placed, repeats))

    return let(window_hashes(F.transform(w, lambda x: F.xxhash64(x)), width), covered)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts and with what the rules read beside them, in one pass."""
    t = F.coalesce(F.col(text), F.lit(""))
    has_word = lambda x: F.char_length(F.regexp_replace(x, r"[\x20\x09-\x0D]+", "")) > 0
    counted = let(
        words(t),
        lambda w: F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("bigint"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
            repeated_words(w).cast("bigint").alias("n_repeat_words"),
        ),
    )
    lines = let(
        F.filter(F.split(t, "\n"), has_word),
        lambda x: F.struct(
            F.size(x).cast("bigint").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        ),
    )
    fresh = [c for c in docs.columns if c not in {*BASE, "n_lines", "n_upper", "_counted", "_lines"}]
    return docs.select(
        *fresh,
        counted.alias("_counted"),
        lines.alias("_lines"),
        _count_of(t, _SYMBOLS).cast("bigint").alias("n_symbols"),
        F.char_length(F.regexp_replace(t, r"\P{Lu}+", "")).cast("bigint").alias("n_upper"),
    ).select(*fresh, "_counted.*", "_lines.*", "n_symbols", "n_upper")


def _vote(good: Column | None = None, bad: Column | None = None) -> Column:
    vote = F.lit(0) if good is None else F.when(good, 1).otherwise(0)
    return vote if bad is None else F.when(bad, -1).otherwise(vote)


def votes() -> dict[str, Column]:
    """Each rule's vote: 1 good, -1 bad, 0 abstains.

    A junk test that finds nothing abstains. What tells good prose is asked by one rule, as such
    signs come together. No rule asks what the base has asked, at the base's own limit.
    """
    w, chars, symbols = F.col("n_words"), F.col("word_chars"), F.col("n_symbols")
    plain = (symbols * 50 <= w) & (chars >= w * 3) & (chars <= w * 8) & (F.col("n_dup_lines") == 0)
    return {
        "symbols": _vote(bad=symbols * 10 > w),
        "word_size": _vote(bad=(chars < w * 2) | (chars > w * 12)),
        "lines": _vote(bad=F.col("n_dup_lines") * 4 > F.col("n_lines")),
        "repeats": _vote(bad=F.col("n_repeat_words") * 100 > w * 15),
        "case": _vote(bad=F.col("n_upper") * 2 > chars),
        "prose": _vote(good=(w >= 50) & plain),
    }


@dataclass(frozen=True)
class Accuracies:
    """Log likelihood ratios, good against bad, of each rule's votes, and of the classes."""

    prior: float
    good: tuple[float, ...]
    silent: tuple[float, ...]
    bad: tuple[float, ...]

    def log_odds(self, pattern: tuple[int, ...]) -> float:
        return self.prior + sum(
            (self.good if v > 0 else self.bad if v < 0 else self.silent)[j] for j, v in enumerate(pattern)
        )


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))


def estimate(patterns: list[tuple[tuple[int, ...], int]], rules: int = 0) -> Accuracies:
    """Accuracies of the rules, from the counts of vote patterns alone.

    Classes are latent; within a class rules vote or abstain independently, each at rates of its own.
    Rounds of expectation and maximisation start from EXPECTED and stay near it: the expected rates
    weigh as much as a share of the texts, and so does the prior, so that the classes keep their
    meaning whatever the mix, and at every size. A vote for good never counts against, nor the other
    way about. Without patterns the ``rules`` rules have the expected rates.
    """
    rules = len(patterns[0][0]) if patterns else rules
    total = sum(n for _, n in patterns)
    start = {v: math.log(g / b) for v, (g, b) in EXPECTED.items()}
    model = Accuracies(math.log(PRIOR_GOOD / (1 - PRIOR_GOOD)), *((start[v],) * rules for v in (1, 0, -1)))
    for _ in range(ROUNDS if total else 0):
        posterior = [_sigmoid(model.log_odds(p)) for p, _ in patterns]
        good = sum(n * q for (_, n), q in zip(patterns, posterior))
        bad = total - good
        held_good, held_bad = RATES_HELD * good, RATES_HELD * (bad + (1 - PRIOR_GOOD) * total)

        def ratio(j: int, vote: int) -> float:
            cast = [(n, q) for (p, n), q in zip(patterns, posterior) if p[j] == vote]
            among_good = sum(n * q for n, q in cast) + held_good * EXPECTED[vote][0]
            among_bad = sum(n * (1 - q) for n, q in cast) + held_bad * EXPECTED[vote][1]
            return math.log(among_good / (good + held_good)) - math.log(among_bad / (bad + held_bad))

        model = Accuracies(
            math.log((good + PRIOR_HELD * total * PRIOR_GOOD) / (bad + PRIOR_HELD * total * (1 - PRIOR_GOOD))),
            tuple(max(0.0, ratio(j, 1)) for j in range(rules)),
            tuple(ratio(j, 0) for j in range(rules)),
            tuple(min(0.0, ratio(j, -1)) for j in range(rules)),
        )
    return model


def judge_quality(
    docs: DataFrame,
    text: str = "text",
    carry: Sequence[str] | None = None,
    keep_from: float = KEEP_FROM,
) -> DataFrame:
    """``docs`` with base counts, ``votes``, ``base_failed``, ``quality`` (posterior) and ``kept``.

    ``carry`` names the input columns to return, by default all. Null text has no words. A text
    fails the base with under 10 words or with over a fifth of them in repeated windows; else its
    posterior decides. Texts with equal votes have equal posteriors, repeated rows included; input
    columns with names of the result are replaced. An empty table gives no rows.

    Texts are read once: their counts and the carried columns are written to the shared folder. All
    that pass the base are counted, by vote pattern; at most 3^rules counts reach the driver. Those
    that fail the base have a posterior too, from the accuracies found on the others.
    """
    made = ("votes", "base_failed", "quality", "kept")
    carried = [c for c in (docs.columns if carry is None else carry) if c not in (*BASE, *made)]
    # The text may be wanted for the counts alone, and a carried column may have its name.
    measured = measure(docs.select(*carried, F.col(text).alias("_text")), "_text").drop("_text")
    rules = votes()
    pattern = F.array(*[v.cast("tinyint") for v in rules.values()])
    measured = stage(measured.withColumn("votes", pattern), "quality")
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    counted = measured.filter(~failed).groupBy("votes").count().collect()
    model = estimate(sorted((tuple(r["votes"]), r["count"]) for r in counted), len(rules))
    log_odds = F.lit(model.prior)
    for j in range(len(rules)):
        vote = F.get("votes", F.lit(j))
        log_odds = log_odds + F.when(vote > 0, model.good[j]).when(vote < 0, model.bad[j]).otherwise(model.silent[j])
    return (
        measured.withColumn("base_failed", failed)
        .withColumn("quality", 1 / (1 + F.exp(-log_odds)))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep_from))
    )
