from collections import Counter, defaultdict
import random
import re
import zlib

import numpy as np
import pytest
from brute import DATA, odd_rows, read, table

from corpuslens.llm import spellings
from corpuslens.llm.queries import LLM_QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{' ' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                n[run] += 1
    return n


def plain_neighbours(words):
    """{word: near words} by the words left when one letter goes, then by comparing those that share one."""
    by_rest = defaultdict(set)
    for w in words:
        by_rest[w].add(w)
        for i in range(len(w)):
            by_rest[w[:i] + w[i + 1 :]].add(w)
    out = defaultdict(set)

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    for some in by_rest.values():
        for a in some:
            out[a] |= {b for b in some if b != a and one_edit(a, b)}
    return out


def grouped(n):
    near = plain_neighbours(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), form[w] and n[form[w]]) for w in n}


def results(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, "sf0.01").collect()]
    n = {w: k for w, k in counts(rows).items() if k >= 5}
    found = LLM_QUERIES["op12_spellings"](spark, f"{DATA}/sf0.01")
    assert found.count() == len(n) and results(found) == grouped(n)


@pytest.mark.parametrize("node_words", [4096, 3])
def test_words_of_few_letters(spark, monkeypatch, node_words):
    """Dense neighbourhoods: short alphabets, words that begin, end and repeat each other."""
    monkeypatch.setattr(spellings, "NODE_WORDS", node_words)
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(700)}
    words |= {"a" * k for k in range(1, 12)} | {"x" * 3000, "x" * 2999 + "y", "x" * 1500 + "z" + "x" * 1500}
    n = {w: rng.choice((1, 1, 5, 25, 125, 700)) for w in words}
    given = spark.createDataFrame([(w, k, "s") for w, k in n.items()], "word string, n bigint, node string")
    assert results(spellings.group_spellings(given)) == grouped(n)


def test_counts_of_odd_texts(spark):
    rows = [*odd_rows(), (None, "Straße ÀÉÎõüÿ×÷ naïveté étoile"), (40, "ÀÀÀÀÀÀ " * 300), (41, "letters" * 4000), (42, "xÃ\u0083 Ãƒ\U0001f600abcdef")]
    rows += [(100 + i, f"Wordlike{chr(97 + i % 26)}ending Übergröße{i} çedillaÀ") for i in range(2000)]
    found = spellings.count_words(table(spark, rows, word="w", n=1).repartition(3)).collect()
    assert {r.word: r.n for r in found} == counts(rows) and len(found) == len({r.word for r in found})
    for empty in (table(spark, []), table(spark, [(1, None), (2, " ")])):
        assert spellings.spelling_variants(empty).count() == 0
    assert results(spellings.spelling_variants(table(spark, [(1, "lonelyword " * 5)]))) == grouped({"lonelyword": 5})


def test_crc32_of_runs():
    rng = np.random.default_rng(1)
    sizes = np.array([0, 1, 7, 64, 65, 300, 2, 2])
    data = rng.integers(0, 256, int(sizes.sum()) + 1).astype(np.uint8)
    starts = np.cumsum(sizes) - sizes
    begun = rng.integers(0, 1 << 32, len(sizes), dtype=np.uint64).astype(np.uint32)
    found = spellings.crc32_of(data, starts, sizes, begun)
    assert found.tolist() == [zlib.crc32(data[a : a + n].tobytes(), int(b)) for a, n, b in zip(starts, sizes, begun)]
