"""URL rules matched by host-suffix and path-prefix expressions over short hash prefixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.expressions import free_name

#: Hex digits of a digest that the join compares; full digests are confirmed after it.
PREFIX_DIGITS = 8
#: Up to so many rules (some 20 MB) are broadcast; longer lists are joined by shuffle.
BROADCAST_RULES = 100_000

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def url_expressions(host: Column, path: Column, path_lengths: Sequence[int]) -> Column:
    """Every host suffix followed by every path prefix of one of the given lengths."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    lengths = F.filter(
        F.array(*[F.lit(n) for n in path_lengths]), lambda n: n <= F.char_length(path)
    )
    return F.flatten(
        F.transform(
            suffixes,
            lambda s: F.transform(lengths, lambda n: F.concat(s, F.left(path, n))),
        )
    )


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url", default: str = "allow"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (in place of columns so named).

    ``rules`` are ``(verdict, "host/path")``. A rule fits its host and all subdomains where the path
    starts with the rule's. The longest wins; of equal rules, ``block`` wins over ``allow``. Without
    one, ``rule`` is null and ``verdict`` is ``default``. A null url, or one without ``://``, has an
    empty host and path, which no rule fits. Repeated rows and urls are judged alike, one row out
    for each row in; no rules or no rows give the default or no rows.

    Distinct urls are expanded, so a hot url costs one expansion, and joined to the rules on a
    32-bit digest prefix. The rules are a parameter, broadcast up to BROADCAST_RULES.
    """
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    session = pages.sparkSession
    table = session.createDataFrame(list(rules), "_verdict string, _rule string").select(
        "_verdict", "_rule", F.sha2("_rule", 256).alias("_rule_digest")
    )
    table = table.withColumn("_prefix", F.left("_rule_digest", F.lit(PREFIX_DIGITS)))
    if len(rules) <= BROADCAST_RULES:
        table = F.broadcast(table)
    lengths = sorted({len(r) - r.index("/") for _, r in rules}) or [0]
    hits = (
        pages.select(F.col(url).alias("_url"))
        .distinct()
        .select(
            "_url",
            F.explode(url_expressions(url_host(F.col("_url")), url_path(F.col("_url")), lengths)).alias("_expr"),
        )
        .withColumn("_digest", F.sha2("_expr", 256))
        .withColumn("_prefix", F.left("_digest", F.lit(PREFIX_DIGITS)))
        .join(table, "_prefix")
        .filter(F.col("_digest") == F.col("_rule_digest"))
    )
    order = F.struct(F.char_length("_rule"), "_rule", F.col("_verdict") == "block")
    best = hits.groupBy("_url").agg(F.max_by(F.struct("_rule", "_verdict"), order).alias("_best"))
    own, won = free_name(pages, "_url"), free_name(pages, "_best")
    best = best.withColumnsRenamed({"_url": own, "_best": won})
    return (
        pages.join(best, F.col(url) == F.col(own), "left")
        .select(
            *kept,
            url_host(F.col(url)).alias("host"),
            url_path(F.col(url)).alias("path"),
            F.col(won)["_rule"].alias("rule"),
            F.coalesce(F.col(won)["_verdict"], F.lit(default)).alias("verdict"),
        )
    )
