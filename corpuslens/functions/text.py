"""Text normalisation as JVM-side column expressions."""

from __future__ import annotations

import string
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslens.functions.lexicon import DOMAIN_STOPWORDS, ENGLISH_STOPWORDS

# Characters str.strip() and str.split() treat as whitespace, from the Unicode database.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def strip(text: Column) -> Column:
    """Trim every kind of whitespace (Spark's ``trim`` removes only U+0020)."""
    return F.btrim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    stripped = strip(text)
    return F.when(stripped != "", stripped)


def clean_text(text: Column) -> Column:
    """Lower-case; digit runs become spaces; ASCII punctuation is deleted; spaces collapse."""
    no_digits = F.regexp_replace(F.lower(text), r"(?U)\d+", " ")
    no_punct = F.translate(no_digits, string.punctuation, "")
    return F.trim(F.regexp_replace(no_punct, _SPACE_RUN, " "))


def tokenize(text: Column) -> Column:
    """Whitespace tokens, empty strings dropped."""
    return F.filter(F.split(text, _SPACE_RUN), lambda t: t != "")


def remove_stopwords(
    tokens: Column,
    english: Sequence[str] = ENGLISH_STOPWORDS,
    domain: Sequence[str] = DOMAIN_STOPWORDS,
) -> Column:
    """Keep tokens of three or more characters that are in neither list; repeats stay."""
    banned = sorted({*english, *domain})
    return F.filter(tokens, lambda t: (F.length(t) > 2) & ~t.isin(*banned))


def alpha_normalize(text: Column) -> Column:
    """Lower-case and turn everything but ASCII letters and whitespace into a space."""
    return F.regexp_replace(F.lower(text), r"(?U)[^a-zA-Z\s\x1c-\x1f]", " ")


def word_tokens(text: Column, stopwords: Sequence[str] = ()) -> Column:
    """Lower-cased runs of two or more word characters, minus ``stopwords``."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))
    if not stopwords:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(*stopwords))


def ngrams(tokens: Column, n: int) -> Column:
    """Word n-grams joined by one space, in order; shorter inputs give an empty array."""
    grams = tokens
    for step in range(1, n):
        tail = F.slice(tokens, step + 1, F.greatest(F.size(tokens) - step, F.lit(0)))
        grams = F.zip_with(grams, tail, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(grams, lambda g: g.isNotNull()) if n > 1 else grams


def ngram_range(tokens: Column, low: int, high: int) -> Column:
    return F.concat(*[ngrams(tokens, n) for n in range(low, high + 1)])


def _fold_table() -> tuple[str, str]:
    """Single-character NFKD foldings of the accented letter blocks, built from the Unicode data."""
    blocks = [(0xA0, 0x0530), (0x0600, 0x0700), (0x1E00, 0x2000), (0xFF01, 0xFF5F)]
    accented, plain = [], []
    for low, high in blocks:
        for code in range(low, high):
            char = chr(code)
            folded = "".join(
                c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
            )
            if folded != char and len(folded) == 1:
                accented.append(char)
                plain.append(folded)
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _fold_table()


def accent_fold(text: Column) -> Column:
    """Case- and accent-free key for equality joins."""
    bare = F.regexp_replace(F.translate(text, _ACCENTED, _PLAIN), r"\p{Mn}+", "")
    return strip(F.lower(bare))


def truncate_label(text: Column, limit: int) -> Column:
    """Cut to ``limit`` characters and mark the cut with an ellipsis."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("…"))
    ).otherwise(text)
