"""Spelling variants: neighbours at one edit, found by a frontier of states over a distributed trie."""

from __future__ import annotations

from collections.abc import Iterator
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.arrays import FOLD, buffer, mix, slices
from corpuslens.llm.tokens import keys
from corpuslens.storage import stage

#: Code points a word has at least, its occurrences at least, and how many times a form is as frequent.
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
#: One occurrence in so many loses a code point.
LOSSES = 199
#: Words below a node of the trie that meet in one place; more are dealt to copies of its edges.
NODE_WORDS = 4096

_PLACE, _LETTER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Runs of up to so many bytes have their crc32 made together.
_TOGETHER_BYTES = 64
_CODES = np.arange(256)
_LATIN = ((_CODES | 0x20) >= 0x61) & ((_CODES | 0x20) <= 0x7A)
_LEAD = 0xC3

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


def letter_runs(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of the runs of ``A-Z``, ``a-z`` and U+00C0 to U+00FF in UTF-8 texts.

    The latter are exactly the pairs of bytes led by 0xC3.
    """
    n = len(data)
    solid = _LATIN[data] | (data == _LEAD)
    solid[1:] |= data[:-1] == _LEAD
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    inner = edges[(edges > 0) & (edges < n)]
    opens[inner] = solid[inner]
    closes[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(edges, starts, "right") - 1


def crc32_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of each run of bytes after what ``begun`` is the crc32 of; all runs a byte at a time."""
    long = np.flatnonzero(sizes > _TOGETHER_BYTES)
    crc = ~begun.astype(np.uint32)
    order = np.argsort(-np.where(sizes > _TOGETHER_BYTES, 0, sizes), kind="stable")
    first, crc, left = starts[order], crc[order], len(order)
    falling = np.where(sizes > _TOGETHER_BYTES, 0, sizes)[order]
    for at in range(int(falling[0]) if len(falling) else 0):
        left = int(np.searchsorted(-falling[:left], -at, "left"))  # those longer than ``at``
        some = crc[:left]
        crc[:left] = _CRC[(some ^ data[first[:left] + at]) & 0xFF] ^ (some >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = ~crc
    for i in long.tolist():
        out[i] = zlib.crc32(data[starts[i] : starts[i] + sizes[i]].tobytes(), int(begun[i]))
    return out


def _code_points(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    before = np.concatenate([[0], np.cumsum(data == _LEAD)])
    return ends - starts - (before[ends] - before[starts])


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: the words of at least LEAST_LENGTH code points in whole texts, and their occurrences.

    A run of letters is lower-cased (A to Z alone) and, where LOSSES divides its crc32 with the id, loses
    the code point that the crc32 names. Null text has no words; a null id is one space in the crc32.
    Texts stay where they are; words are counted by slices of text, then in the JVM, then together.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffer(batch.column("text"))
            names = np.array([zlib.crc32(f"{' ' if d is None else d}:".encode()) for d in batch.column("doc_id").to_pylist()], np.uint32)
            for first, last in slices(offsets):
                some = FOLD[data[offsets[first] : offsets[last]]]
                starts, ends, doc = letter_runs(some, offsets[first : last + 1] - offsets[first])
                points = _code_points(some, starts, ends)
                # A word that loses a code point must have had one more.
                long = points >= LEAST_LENGTH
                starts, ends, doc, points = starts[long], ends[long], doc[long], points[long]
                if not len(starts):
                    continue
                crc = crc32_of(some, starts, ends - starts, names[first + doc])
                loses = crc % LOSSES == 0
                raw = some.tobytes()
                words: list[bytes] = []
                numbers: list[int] = []
                for a, b, h, n in zip(*(x[loses].tolist() for x in (starts, ends, crc, points))):
                    if n > LEAST_LENGTH:
                        word = raw[a:b].decode()
                        words.append((word[: h % n] + word[h % n + 1 :]).encode())
                        numbers.append(1)
                starts, ends = starts[~loses], ends[~loses]
                one, two = keys(some, starts, ends - starts)
                _, once, which, number = np.unique(one, return_index=True, return_inverse=True, return_counts=True)
                if (two[once][which] != two).any():  # words that share the first 64 bits of hash
                    once, number = np.arange(len(one)), np.ones(len(one), np.int64)
                words += [raw[a:b] for a, b in zip(starts[once].tolist(), ends[once].tolist())]
                numbers += number.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(numbers, pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = rows.mapInArrow(count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _names(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Depths of all beginnings of all words, one word after the other, and 128 bits that name each."""
    sizes = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    begins = np.cumsum(sizes + 1) - sizes - 1
    depth = np.arange(int((sizes + 1).sum())) - np.repeat(begins, sizes + 1)
    inner = depth > 0
    place = mix(depth[inner].astype(np.uint64) * _PLACE)
    names = np.zeros((len(depth), 2), "<u8")
    for k, letters in enumerate((mix(points + place), mix(points * _LETTER ^ place))):
        sums = np.zeros(len(depth), np.uint64)
        sums[inner] = letters
        sums = np.cumsum(sums)
        names[:, k] = mix(sums - np.repeat(sums[begins], sizes + 1))
    return depth, names


def _some(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
    for batch in batches:
        words, size = [], 0
        for w in batch.column("word").to_pylist():
            words.append(w)
            size += len(w)
            if size > 1 << 16:
                yield words
                words, size = [], 0
        if words:
            yield words


def _fixed(names: np.ndarray) -> pa.Array:
    raw = pa.py_buffer(np.ascontiguousarray(names).tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(names), [None, raw]).cast(pa.binary())


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every beginning of every word: the word's own name, depth, name, and the next letter."""
    for words in _some(batches):
        depth, names = _names(words)
        own = np.cumsum([len(w) + 1 for w in words]) - 1
        letters = [x for w in words for x in (*w, "")]
        arrays = [_fixed(np.repeat(names[own], depth[own] + 1, axis=0)), pa.array(depth, pa.int32()), _fixed(names), pa.array(letters)]
        yield pa.RecordBatch.from_arrays(arrays, names=["name", "depth", "node", "next"])


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word with its own name."""
    for words in _some(batches):
        _, names = _names(words)
        own = np.cumsum([len(w) + 1 for w in words]) - 1
        yield pa.RecordBatch.from_arrays([pa.array(words), _fixed(names[own])], names=["word", "name"])


def _paths(words: DataFrame) -> DataFrame:
    """``word, path``: the nodes of the words' compressed trie on each word's way, in order.

    Nodes are the beginnings at which words part or end, and the empty one, named by 128 bits of
    hash; of each ``path`` has ``depth``, ``node``, the words ``below`` it and whether one ``ends`` there.
    """
    prefixes = stage(words.select("word").mapInArrow(_prefixes, "name binary, depth int, node binary, next string"), "prefixes")
    nodes = prefixes.groupBy("node").agg(
        F.count(F.lit(1)).alias("below"), F.min("next").alias("_least"), F.max("next").alias("_most"), F.min("depth").alias("_depth")
    )
    # A word that ends has no next letter, which sorts first.
    kept = nodes.filter("_least <> _most OR _least = '' OR _depth = 0").select("node", "below", (F.col("_least") == "").alias("ends"))
    # Stored, so that the join deals both sides itself and may split those of a hot node.
    kept = stage(kept, "trie-nodes")
    paths = prefixes.join(kept, "node").groupBy("name").agg(
        F.array_sort(F.collect_list(F.struct("depth", "node", "below", "ends"))).alias("path")
    )
    named = words.select("word").mapInArrow(_named, "word string, name binary")
    return stage(paths.join(named, "name").select("word", "path"), "trie-paths")


def _edges(paths: DataFrame) -> DataFrame:
    """``node, deal, first, tail, n, child, ends, copies``: the trie's edges, hot nodes' in several copies.

    An edge's label is its ``first`` letter and its ``tail``, ``n`` letters in all; ``ends`` is the word
    that ends at ``child``, or null. A node with many words below, as the first ones have, has its
    edges in ``copies`` of NODE_WORDS words each, numbered by ``deal``.
    """
    steps = paths.select("word", "path", F.explode(F.sequence(F.lit(1), F.size("path") - 1)).alias("k"))
    a, b = F.get("path", F.col("k") - 1), F.get("path", F.col("k"))
    flat = steps.select(
        a["node"].alias("node"), b["node"].alias("child"), _copies(a).alias("_dealt"), _copies(b).alias("copies"),
        _letter(F.col("word"), a["depth"]).alias("first"),
        F.substring("word", a["depth"] + 2, b["depth"] - a["depth"] - 1).alias("tail"),
        (b["depth"] - a["depth"]).alias("n"),
        F.when(b["depth"] == F.length("word"), F.col("word")).alias("word"),
    )
    once = flat.groupBy("node", "child").agg(
        *[F.first(c).alias(c) for c in ("first", "tail", "n", "_dealt", "copies")], F.max("word").alias("ends")
    )
    dealt = once.withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("_dealt") - 1)))
    return stage(dealt.drop("_dealt"), "trie-edges")


def _copies(node: Column) -> Column:
    return F.ceil(node["below"] / NODE_WORDS).cast("int")


def _letter(word: Column, i: Column) -> Column:
    """Letter ``i`` of a word, counted from 0."""
    return F.substring(word, i + 1, F.lit(1))


def _deal(copies: Column) -> Column:
    return F.pmod(F.xxhash64("word"), copies).cast("int")


def _parted(words: DataFrame, least: Column) -> DataFrame:
    """``word, near``: pairs at one edit that part at depth ``least`` of the word or deeper.

    Near words are as long as the word, or shorter by one. States (word, position, node, edits) move
    along the trie's edges level by level. An unedited state stays on its own word's path, which is
    known; two words at one edit part where their common beginning ends, so the edit is made there:
    one of the word's letters is left out, or taken for the first of another edge. From then on a
    state follows what equals the rest of its word, one edge a level, so the join is on node and
    letter. States that end with their word where a word ends are neighbours.
    """
    paths = _paths(words)
    edges = _edges(paths)
    length, i = F.length("word"), F.col("i")
    start = paths.select("word", F.explode("path").alias("p")).select(
        "word", F.col("p.depth").alias("i"), F.col("p.node").alias("node"), F.col("p.ends").alias("at_end"), _copies(F.col("p")).alias("copies")
    )
    start = stage(start.filter((i >= least) & (i < length)), "frontier")
    found = start.filter((i == length - 1) & F.col("at_end")).select("word", F.left("word", length - 1).alias("near"))
    left_out = start.filter((i < length - 1) & (_letter(F.col("word"), i) != _letter(F.col("word"), i + 1))).select(
        "word", (i + 1).alias("i"), "node", "copies"
    )
    fits = (i + F.col("n") <= length) & (F.substring("word", i + 2, F.col("n") - 1) == F.col("tail"))
    asked = start.withColumn("deal", _deal(F.col("copies"))).select("word", "i", "node", "deal")
    other = asked.join(edges, ["node", "deal"]).filter((F.col("first") != _letter(F.col("word"), i)) & fits)

    def after(met: DataFrame) -> DataFrame:
        return stage(met.select("word", (i + F.col("n")).alias("i"), F.col("child").alias("node"), "ends", "copies"), "frontier")

    moved = after(other)
    frontier = left_out.unionByName(moved.filter(i < length).drop("ends"))
    while True:
        found = found.unionByName(moved.filter((i == length) & F.col("ends").isNotNull()).select("word", F.col("ends").alias("near")))
        asked = frontier.select("word", "i", "node", _deal(F.col("copies")).alias("deal"), _letter(F.col("word"), i).alias("first"))
        moved = after(asked.join(edges, ["node", "deal", "first"]).filter(fits))
        frontier = moved.filter(i < length).drop("ends")
        if moved.isEmpty():
            return found


def near_words(words: DataFrame) -> DataFrame:
    """``word, near``: all ordered pairs of the given distinct words at exactly one edit, each once.

    Of two words at one edit, the beginning or the end of at least half of the longer is common. The
    trie of the words gives those that part in their second half, the trie of the reversed words the
    others, so no state leaves its word's path near a root, where every letter has its edge. A letter
    put in is a letter left out, seen from the other word. Pairs are checked before they are returned.

    The frontier is written to the shared folder level by level; levels are as many as nodes on half
    a word's path at most.
    """
    half = F.floor(F.length("word") / 2).cast("int")
    ahead = _parted(words.select("word"), half)
    behind = _parted(words.select(F.reverse("word").alias("word")), F.length("word") - half)
    pairs = ahead.unionByName(behind.select(F.reverse("word").alias("word"), F.reverse("near").alias("near")))
    pairs = pairs.filter((F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1))
    shorter = F.length("near") < F.length("word")
    put_in = pairs.filter(shorter).select(F.col("near").alias("word"), F.col("word").alias("near"))
    return pairs.unionByName(put_in).distinct()


def group_spellings(counted: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word of ``counted`` (word, n; words distinct).

    Near words differ by one inserted, deleted or replaced code point. The form is the near word of
    largest n, the least in code-point order among equals, if it is TIMES as frequent; ``root`` is
    where forms lead, the word itself without one. Roots are found by doubling: a word points to its
    form, then to what that points to, until nothing moves; n grows by TIMES with each step, so
    rounds are few. An empty table gives no rows.
    """
    counted = stage(counted.select("word", F.col("n").cast("bigint").alias("n")), "words")
    near = stage(near_words(counted), "near-words")
    sizes = counted.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = near.join(sizes, "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("r"), F.col("near"))).alias("b")
    )
    joined = counted.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(-F.col("b.r") >= F.col("n") * TIMES, F.col("b")).alias("b"),
    )
    formed = stage(joined.select("word", F.col("b.near").alias("form"), "n", "n_near", (-F.col("b.r")).alias("form_n")), "forms")
    links = stage(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = stage(links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        links = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            break
    return formed.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, least_count: int = LEAST_COUNT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Words of all documents that occur ``least_count`` times, with their forms and roots."""
    return group_spellings(count_words(docs, doc_id, text).filter(F.col("n") >= least_count))
