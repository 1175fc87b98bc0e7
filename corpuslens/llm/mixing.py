"""Sources interleaved to target weights by proportionate-fair (Pfair) scheduling of blocks."""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Mapping
from fractions import Fraction
import heapq
from itertools import islice
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslens.storage import stage, work_path

#: Documents to a block.
BLOCK = 8
#: Rows of the plan that the driver holds before it writes them.
_PLAN_ROWS = 1 << 18
_PLAN = "_label string, block bigint, slot bigint, _early bigint, _late bigint, weight double"
_LAST = (1 << 62) - 1


def exact(weights: Mapping[str, float]) -> dict[str, int]:
    """Integers in the proportions of the weights, unrounded."""
    parts = {s: Fraction(w) for s, w in weights.items()}
    common = math.lcm(*(p.denominator for p in parts.values()))
    return {s: int(p * common) for s, p in parts.items()}


def rounded(weights: Mapping[str, float], grain: int) -> dict[str, int]:
    """Slots out of ``grain`` for each source, at least one each, by largest remainders."""
    names = sorted(weights)
    grain = max(grain, len(names))
    spare, total = grain - len(names), math.fsum(weights.values())
    exact = {n: Fraction(weights[n]) / Fraction(total) * spare for n in names}
    slots = {n: 1 + int(exact[n]) for n in names}
    rest = sorted(names, key=lambda n: (int(exact[n]) - exact[n], n))
    for n in rest[: grain - sum(slots.values())]:
        slots[n] += 1
    return slots


def steps(shares: Mapping[str, int]) -> Iterator[tuple[str, int, int, int]]:
    """``(source, release, deadline, index)`` for each slot in turn, without end.

    Block i of a source of weight w = share/total is released at floor(i/w) and due at ceil((i+1)/w).
    Of the released blocks the one with the earliest deadline is taken, ties by source. As the weights
    add up to one, every block meets its deadline, so at no time is a source a whole block ahead of or
    behind its weight.
    """
    total = sum(shares.values())
    waiting = [(0, s, 0) for s in sorted(shares)]
    ready: list[tuple[int, str, int, int]] = []
    now = 0
    while True:
        while waiting and waiting[0][0] <= now:
            release, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // shares[s]), s, i, release))
        due, s, i, release = heapq.heappop(ready)
        yield s, release, due, i
        heapq.heappush(waiting, ((i + 1) * total // shares[s], s, i + 1))
        now += 1


def schedule(slots: Mapping[str, int]) -> list[tuple[str, int, int, int]]:
    """The steps of one period, after which a schedule of these shares repeats."""
    return list(islice(steps(slots), sum(slots.values())))


def plan_blocks(
    blocks: Mapping[str, int], weights: Mapping[str, float], grain: int | None = None
) -> Iterator[tuple[str, int, int, int, int, float]]:
    """``(source, block, slot, release, deadline, weight)`` of all blocks, by slot.

    A phase lasts until the first of its sources has run out of blocks; the others go on at the same
    weights to each other, counted from there. So there are at most as many phases as sources.
    """
    left = {s: n for s, n in blocks.items() if n}
    used, start = dict.fromkeys(left, 0), 0
    while left:
        given = {s: weights[s] for s in left}
        shares = exact(given) if grain is None else rounded(given, grain)
        total = sum(shares.values())
        share_of = {s: n / total for s, n in shares.items()}
        for now, (s, release, due, _) in enumerate(steps(shares), start):
            yield s, used[s], now, start + release, start + due, share_of[s]
            used[s] += 1
            left[s] -= 1
            if not left[s]:
                del left[s]
                break
        start = now + 1


def _stored_plan(
    session: SparkSession, blocks: Mapping[str, int], weights: Mapping[str, float], grain: int | None
) -> DataFrame:
    """The plan as a stored table, written part by part, so the driver holds few rows of it.

    Catalyst broadcasts or shuffles it by its size. Release and deadline are kept as distances to the
    slot; a deadline past all slots that bigint can number is the last of them.
    """
    path = work_path(session, "mixing-plan")
    rows = plan_blocks(blocks, weights, grain)
    names, kinds = [f.split(" ")[0] for f in _PLAN.split(", ")], "qqqqd"
    while True:
        labels: list[str] = []
        columns = [array(k) for k in kinds]
        for s, block, slot, release, due, weight in islice(rows, _PLAN_ROWS):
            labels.append(s)
            for column, value in zip(columns, (block, slot, slot - release, min(due, _LAST) - slot, weight)):
                column.append(value)
        arrays = [pa.array(labels, pa.string())]
        arrays += [pa.array(c, pa.float64() if k == "d" else pa.int64()) for c, k in zip(columns, kinds)]
        part = session.createDataFrame(pa.Table.from_arrays(arrays, names=names), _PLAN)
        part.coalesce(1).write.mode("append").parquet(path)
        if len(labels) < _PLAN_ROWS:
            return session.read.schema(part.schema).parquet(path)


def source_blocks(docs: DataFrame, order: list[Column], source: str) -> DataFrame:
    """``docs`` with ``_index``, its place among its source's rows in the given order, from 0.

    The rows are put in order once, by ranges of source and order, and written with their place in
    their range; the places before a range come from one count for each range and source. So no
    source, however large, meets in one task.
    """
    ranged = docs.repartitionByRange(F.col(source), *order).sortWithinPartitions(F.col(source), *order)
    placed = stage(ranged.withColumn("_at", F.monotonically_increasing_id()), "mixing")
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(source, part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")
    )
    earlier = Window.partitionBy(source).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(source).alias("_from_source"), F.col("_part").alias("_range"), "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    joined = placed.join(
        starts, placed[source].eqNullSafe(starts["_from_source"]) & (part == starts["_range"])
    )
    index = F.col("_before") + F.col("_at") - F.col("_first")
    return joined.withColumn("_index", index).drop("_at", "_from_source", "_range", "_first", "_before")


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    temperature: float = 0.5,
    block: int = BLOCK,
    grain: int | None = None,
    doc_id: str = "doc_id",
    source: str = "source",
    carry: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``weight, block, release, deadline, slot, offset``: the mix is (slot, offset).

    A source's rows, in the order of a hash of ``doc_id``, form blocks of ``block`` rows. Blocks are
    released and due by the source's weight and taken earliest deadline first, so among the first n
    slots each source has its weight's share of n within one block. When a source has no block left
    the others go on at the same weights to each other; every row is placed once, none is repeated.

    ``weights`` gives a positive weight for each source, unlisted sources get the least listed one;
    without it a source weighs its number of rows to the power ``temperature``. Weights are taken as
    they are, as exact fractions; ``grain`` rounds them to multiples of 1/grain, at least one each, for
    a schedule that repeats. The number of sources is taken to fit the driver, as their weights are
    written by hand: each costs one count. The driver makes the schedule, step by step. A null
    source is a source; null ids come first in it, equal ids follow each other by their other carried
    columns, and repeated rows take places of their own. ``carry`` names the columns to return, by
    default all; those with names of the result are replaced. An empty table gives no rows.
    """
    made = ("weight", "block", "release", "deadline", "slot", "offset")
    names = [c for c in (docs.columns if carry is None else carry) if c not in made]
    comparable = [c for c in names if "map<" not in dict(docs.dtypes)[c]]
    rows = docs.select(*names, *[F.col(c).alias(f"_{c}") for c in (doc_id, source)])
    key, by = f"_{doc_id}", f"_{source}"
    rows = rows.withColumn("_mixed", F.xxhash64(key)).withColumn("_tie", F.xxhash64(key, *comparable))
    order = [F.col("_mixed"), F.col(key), F.col("_tie")]
    indexed = source_blocks(rows, order, by).withColumn(
        "block", F.expr(f"_index div {block}")
    )
    session = docs.sparkSession
    counts = {r[by]: r["n"] for r in rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()}
    label = {s: "0" if s is None else f"1{s}" for s in counts}
    blocks = {label[s]: -(-n // block) for s, n in counts.items()}
    if weights is None:
        target = {label[s]: float(n) ** temperature for s, n in counts.items()}
    else:
        least = min(weights.values(), default=1.0)
        target = {label[s]: float(weights.get(s, least)) for s in counts}
    plan = _stored_plan(session, blocks, target, grain)
    labelled = F.when(F.col(by).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(by).cast("string")))
    placed = indexed.withColumn("_label", labelled).join(plan, ["_label", "block"])
    return placed.select(
        *names,
        "weight",
        "block",
        (F.col("slot") - F.col("_early")).alias("release"),
        (F.col("slot") + F.col("_late")).alias("deadline"),
        "slot",
        F.expr(f"_index % {block}").alias("offset"),
    )
