"""Column helpers shared by the operators that stay within DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space that separates words: space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it.

    A lambda variable is bound to its value, whereas Catalyst may inline a column used in a lambda
    and compute it again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that is no column of ``df``, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """Words of a text in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def window_hashes(hashes: Column, width: int) -> Column:
    """64-bit hash of each run of ``width`` neighbours in an array of hashes."""

    def run(a: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(a) - width)
        return F.when(F.size(a) < width, F.array().cast("array<bigint>")).otherwise(
            F.transform(starts, lambda i: F.xxhash64(*[F.get(a, i + k) for k in range(width)]))
        )

    return let(hashes, run)
