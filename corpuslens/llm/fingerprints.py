"""Document fingerprints from closed syncmers of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.llm.expressions import let, window_hashes, words

#: A k-mer is WORDS words; its inner substrings are runs of INNER words.
WORDS, INNER = 5, 2
#: Smallest hashes that a fingerprint keeps.
SKETCH = 64
#: Documents to a run of neighbours, and the most runs, each of which has one bound on the driver.
RUN_ROWS, MOST_RUNS = 1024, 65_536


def syncmers(text: Column, width: int = WORDS, inner: int = INNER) -> Column:
    """Closed syncmers in text order: array of ``struct<position int, hash bigint>``.

    A k-mer of ``width`` words is chosen if the least hash of its runs of ``inner`` words is that of
    its first or last run: a property of the k-mer alone, so an edit changes only the anchors over
    it, and every ``width - inner`` neighbouring k-mers hold at least one. A text of 1 to
    ``width - 1`` words is one k-mer; one of none has no anchor.
    """
    runs = width - inner + 1

    def choose(w: Column) -> Column:
        def anchors(b: Column) -> Column:
            def at(i: Column) -> Column:
                ends = F.least(F.get(b, i), F.get(b, i + runs - 1))
                between = [F.get(b, i + k) for k in range(1, runs - 1)]
                lowest = F.least(*between) if len(between) > 1 else (between or [ends])[0]
                kmer = F.xxhash64(*[F.get(b, i + k) for k in (*range(0, runs - 1, inner), runs - 1)])
                return F.struct(
                    i.cast("int").alias("position"), F.when(ends <= lowest, kmer).alias("hash")
                )

            found = F.transform(F.sequence(F.lit(0), F.size(b) - runs), at)
            return F.filter(found, lambda x: x["hash"].isNotNull())

        short = F.array(
            F.struct(F.lit(0).alias("position"), F.xxhash64(F.array_join(w, " ")).alias("hash"))
        )
        none = F.filter(short, lambda x: F.lit(False))
        hashed = F.transform(w, lambda x: F.xxhash64(x))
        return (
            F.when(F.size(w) == 0, none)
            .when(F.size(w) < width, short)
            .otherwise(let(window_hashes(hashed, inner), anchors))
        )

    return let(words(text), choose)


def sketch(text: Column, size: int = SKETCH) -> Column:
    """The ``size`` least distinct anchor hashes, cut to 32 bits, ascending."""
    cut = F.transform(syncmers(text), lambda x: F.shiftright(x["hash"], 32).cast("int"))
    return F.slice(F.sort_array(F.array_distinct(cut)), 1, size)


def likeness(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Jaccard likeness of two sketches, 0 to 1; two empty sketches are alike."""

    def measured(u: Column) -> Column:
        both = F.array_intersect(F.array_intersect(u, a), b)
        return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(F.size(both) / F.size(u))

    return let(F.slice(F.sort_array(F.array_union(a, b)), 1, size), measured)


def digest(sketched: Column) -> Column:
    """A sketch as text: eight hex digits for each hash."""
    return F.array_join(
        F.transform(sketched, lambda h: F.lower(F.right(F.lpad(F.hex(h.cast("bigint")), 16, "0"), F.lit(8)))), ""
    )


def anchors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each anchor: ``doc_id, position, hash``, for positional matching by equi-join."""
    return docs.select(F.col(doc_id), F.inline(syncmers(F.col(text))))


def _runs(docs: DataFrame, key: str) -> tuple[Column, list]:
    """The run of neighbouring keys that a row belongs to, and the first key of each run but run 0.

    The bounds are keys of rows, about RUN_ROWS rows apart: at most MOST_RUNS numbers. Each row finds
    its run by bisection.
    """
    rows = docs.count()
    n = min(max(rows // RUN_ROWS, 1), MOST_RUNS)
    cuts = [i / n for i in range(1, n)]
    found = docs.agg(F.percentile_approx(key, cuts, max(10_000, 10 * n))).first()[0] if cuts else []
    bounds = sorted(set(found or []))
    if not bounds:
        return F.lit(0), bounds
    listed = F.array(*map(F.lit, bounds)) if len(bounds) < 100 else F.from_json(F.lit(str(bounds)), "array<bigint>")

    def halve(span: Column, _: Column) -> Column:
        middle = ((span["lo"] + span["hi"]) / 2).cast("int")
        right = F.get(listed, middle) <= F.col(key)
        open_ = span["lo"] < span["hi"]
        return F.struct(
            F.when(open_ & right, middle + 1).otherwise(span["lo"]).alias("lo"),
            F.when(open_ & ~right, middle).otherwise(span["hi"]).alias("hi"),
        )

    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    found_run = F.aggregate(steps, start, halve)["lo"]
    return F.coalesce(found_run, F.lit(0)), bounds


def fingerprint_neighbours(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SKETCH
) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and their likenesses.

    The edited text has the last floor(n_chars/2) code points replaced by the first as many (or all)
    of the next document in ascending ``doc_id``; after the last comes the first. Returns ``doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. Null text is
    empty. A null id comes first; rows of one id follow each other by text, repeated rows included,
    each with its row. A single row is its own next document. An empty table gives no rows.

    Each text is shuffled once, with its sketch: to a run of neighbouring ids, where the next row
    stands beside it. The first id of a run is copied to the end of the run before.
    """
    base = docs.select(
        F.col(doc_id).cast("bigint").alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")
    )
    run, bounds = _runs(base, "_id")
    last = len(bounds)
    first_keys = base.agg(F.min(F.struct(F.col("_id").isNotNull().alias("k"), "_id")).alias("m")).first()
    start = first_keys["m"] and first_keys["m"]["_id"]
    sketched = base.select("_id", "_text", sketch(F.col("_text"), size).alias("_sketch"), run.alias("_run"))
    opens = [*([F.lit(b) for b in bounds])]
    is_first = F.col("_id").eqNullSafe(F.lit(start).cast("bigint"))
    if opens:
        listed = F.from_json(F.lit(str(bounds)), "array<bigint>")
        is_first = is_first | F.coalesce(F.get(listed, F.col("_run") - 1) == F.col("_id"), F.lit(False))
    before = F.when(F.col("_id").eqNullSafe(F.lit(start).cast("bigint")), F.lit(last)).otherwise(
        F.col("_run") - 1
    )
    own = F.struct(F.col("_run").alias("run"), F.lit(False).alias("copy"))
    copied = F.struct(before.alias("run"), F.lit(True).alias("copy"))
    placed = sketched.select(
        "_id", "_text", "_sketch",
        F.explode(F.when(is_first, F.array(own, copied)).otherwise(F.array(own))).alias("_at"),
    ).select("_id", "_text", "_sketch", "_at.run", "_at.copy")
    order = Window.partitionBy("run").orderBy("copy", F.col("_id").asc_nulls_first(), "_text")
    n = F.char_length("_text")
    half = F.floor(n / 2).cast("int")
    edited = (
        placed.withColumn("_next", F.lead(F.struct("_text", "_sketch")).over(order))
        .filter(~F.col("copy"))
        .select(
            "_id", "_sketch", n.cast("bigint").alias("n_chars"),
            F.concat(F.left("_text", n - half), F.left("_next._text", half)).alias("_edited"),
            F.col("_next._sketch").alias("_next_sketch"),
        )
        .withColumn("_edited_sketch", sketch(F.col("_edited"), size))
    )
    return edited.select(
        F.col("_id").alias("doc_id"),
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        digest(F.col("_sketch")).alias("fingerprint"),
        digest(F.col("_edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("_sketch"), F.col("_edited_sketch"), size).alias("near_edited"),
        likeness(F.col("_sketch"), F.col("_next_sketch"), size).alias("near_next"),
    )
