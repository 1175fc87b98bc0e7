"""Plain definitions that the operators are held against, and the rows that test odd cases."""

from __future__ import annotations

from collections import Counter, defaultdict
import hashlib
import re

DATA = "/root/testdata"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return WORD.findall(text or "")


def table(spark, rows, **extra):
    """Documents of (doc_id, text) with sources by turns and the named columns, constant."""
    from pyspark.sql import functions as F

    full = [(d, t, "en", ("a", "b", None)[i % 3], len(t or "")) for i, (d, t) in enumerate(rows)]
    df = spark.createDataFrame(full, DOCS)
    return df.withColumns({k: F.lit(v) for k, v in extra.items()}) if extra else df


def prose(n, start=0):
    return " ".join(f"word{(i * 7919 + start * 104729) % 99991}" for i in range(n))


def odd_rows():
    """Null, empty, blank, short, very long, repeated and near-equal texts; a null id."""
    long = prose(30_000)
    near = prose(120, 5).split()
    near[60] = "changed"
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (6, prose(120, 5)), (7, prose(120, 5)),
        (8, " ".join(near)), (9, long), (10, prose(40, 9) + "\n" + prose(120, 5) + "\n" + prose(30, 11)),
        (11, "naïve Ünïcode 😀 words " * 8), (11, "naïve Ünïcode 😀 words " * 8), (12, "one two three"), (13, prose(25, 9) + "\u00a0x\u2028y"),
    ]


def repeats(docs):
    """{doc_id: (n_words, n_removed, sha256)} of documents with distinct ids."""
    seen, out = {}, {}
    for doc_id, text in sorted(docs):
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            if seen.setdefault(" ".join(w[i : i + 20]), (doc_id, i)) != (doc_id, i):
                gone[i : i + 20] = [True] * 20
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[doc_id] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def near_classes(docs, width=5, similarity=0.8):
    """[(doc_id, class_id, n_links)] in the order given."""
    sets = []
    for _, text in docs:
        w = words(text)
        grams = [tuple(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [tuple(w)] * bool(w)
        sets.append(frozenset(grams))
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    links, parent = [0] * len(docs), list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in holders[g] if j > i).items():
            if n >= similarity * (len(s) + len(sets[j]) - n) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(j)] = root(i)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), d), d)
    return [(d, least[root(i)], links[i]) for i, (d, _) in enumerate(docs)]


def read(spark, sf, name="documents"):
    return spark.read.parquet(f"{DATA}/{sf}/{name}.parquet")
