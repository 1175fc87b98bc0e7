"""Repair of conversations: generalised LR over the grammar of roles, with weighted edits."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.expressions import WORD
from corpuslens.storage import stage

#: The grammar: nothing, or perhaps a system row, then pairs of a user's and an assistant's row.
#: Stack tops once reductions are done: nothing yet, a system row, an open pair, whole pairs. A pair
#: is reduced when its second row is shifted, and pairs join those before, so a top tells its stack.
START, SYSTEM, OPEN, PAIRS = range(4)
TOPS = (START, SYSTEM, OPEN, PAIRS)
SHIFT = {(START, "s"): SYSTEM, (START, "u"): OPEN, (SYSTEM, "u"): OPEN, (OPEN, "a"): PAIRS, (PAIRS, "u"): OPEN}
ACCEPT = (START, PAIRS)
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED_KEPT = 5
#: Distinct rows of a conversation that are parsed together; its segments are then joined.
SEGMENT_ROWS = 1024

#: Row kinds: initial, fault.
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)


def _inserted(top: int) -> Iterator[tuple[int, int]]:
    """Tops reached from ``top`` by inserting rows, and the number inserted; never back to ``top``."""
    yield top, 0
    first = SHIFT[top, "a"] if top == OPEN else SHIFT[top, "u"]
    yield first, 1
    second = SHIFT[first, "a"] if first == OPEN else SHIFT[first, "u"]
    if second != top:
        yield second, 2


@lru_cache(maxsize=None)
def actions(initial: str, fault: int) -> dict[int, list[tuple[int, int, str]]]:
    """For each stack top, what a row of this kind allows: new top, cost, edits.

    Inserts go before the row that needs them: before a deleted row they cost as much as after it and
    come later in the alphabet. A role is given where only one role can follow.
    """
    out: dict[int, list[tuple[int, int, str]]] = {}
    extra = TRUNCATED_KEPT if fault == TRUNCATED else 0
    for top in TOPS:
        found = [(top, DELETE, "D")]
        if fault not in (BLANK, DUPLICATE):
            for at, n in _inserted(top):
                if (at, initial) in SHIFT:
                    found.append((SHIFT[at, initial], INSERT * n + KEEP + extra, "I" * n + "K"))
                for role in ROLES:
                    if (at, role) in SHIFT:
                        found.append((SHIFT[at, role], INSERT * n + REROLE + extra, "I" * n + "R"))
        best: dict[int, tuple[int, str]] = {}
        for new, cost, edits in found:
            best[new] = min(best.get(new, (cost, edits)), (cost, edits))
        out[top] = [(new, *x) for new, x in best.items()]
    return out


@lru_cache(maxsize=1 << 15)
def parse(rows: tuple[tuple[str, int, int], ...], entry: int) -> dict[int, tuple[int, int, str]]:
    """Stack tops after the rows (initial, fault, copies) from ``entry``: cost, rank, edits.

    A graph-structured stack: after each row nodes of one top are merged, the one of least (cost,
    edits) stays. Edits up to a row end in that row's letter, so those of two nodes are neither equal
    nor one the beginning of the other, and their order, the rank, is all that later rows need. The
    copies of a row after its first are blank or duplicates, so they can only be deleted.
    """
    live = {entry: (0, 0)}
    back: list[dict[int, tuple[int, str]]] = []
    for initial, fault, copies in rows:
        allowed = actions(initial, fault)
        best: dict[int, tuple[tuple[int, int, str], int]] = {}
        for top, (cost, rank) in live.items():
            for new, more, edits in allowed[top]:
                key = (cost + more, rank, edits)
                if new not in best or key < best[new][0]:
                    best[new] = (key, top)
        order = sorted(best, key=lambda x: best[x][0][1:])
        again = copies - 1
        live = {new: (best[new][0][0] + DELETE * again, r) for r, new in enumerate(order)}
        back.append({new: (top, key[2] + "D" * again) for new, (key, top) in best.items()})
    out = {}
    for top, (cost, rank) in live.items():
        at, letters = top, []
        for step in reversed(back):
            at, edits = step[at]
            letters.append(edits)
        out[top] = (cost, rank, "".join(reversed(letters)))
    return out


def accepted(tops: dict[int, tuple[int, int]]) -> tuple[int, int, str]:
    """The top (cost, rank) that is accepted most cheaply: its top, cost, and what is inserted at the end."""
    found = []
    for top, (cost, rank) in tops.items():
        n = next(n for at, n in _inserted(top) if at in ACCEPT)
        found.append((cost + INSERT * n, rank, top, n))
    cost, _, top, n = min(found)
    return top, cost, "I" * n


def illegal_pairs(initials: Iterable[str]) -> int:
    before, n = None, 0
    for x in initials:
        n += before is not None and (before, x) not in (("s", "u"), ("u", "a"), ("a", "u"))
        before = x
    return n


def _order(turn: str, *more: str) -> list[Column]:
    return [F.col(turn).asc_nulls_first(), *(F.col(c) for c in more)]


def _judged(rows: DataFrame) -> DataFrame:
    """Distinct rows without their texts: ``_conv, _turn, _role, _text_key, _copies, _initial, _fault``.

    ``_fault`` is that of a row's first copy. Rows with an equal one in an earlier turn are few, so
    they alone are joined to; a hot key is split by the join, as one side has it once.
    """
    last = F.regexp_extract(F.col("_text"), r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*$", 1)
    small = rows.select(
        "_conv", "_turn", "_role", _text_key(),
        (~F.col("_text").rlike(WORD)).alias("_blank"),
        (~last.isin(".", "!", "?")).alias("_cut"),
    )
    keys = ["_conv", "_turn", "_role", "_text_key"]
    distinct = small.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"), F.first("_blank").alias("_blank"), F.first("_cut").alias("_cut")
    )
    distinct = stage(distinct, "turns")
    firsts = distinct.groupBy("_conv", "_role", "_text_key").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_turn").alias("_least"), F.max(F.col("_turn").isNull()).alias("_unplaced")
    )
    firsts = firsts.filter("_n > 1").select(
        F.col("_conv").alias("_c"), F.col("_role").alias("_r"), F.col("_text_key").alias("_t"), "_least", "_unplaced"
    )
    same = F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_role") == F.col("_r")) & (F.col("_text_key") == F.col("_t"))
    earlier = F.col("_turn").isNotNull() & (F.coalesce("_unplaced", F.lit(False)) | (F.col("_least") < F.col("_turn")))
    fault = (
        F.when(F.col("_blank"), BLANK).when(F.coalesce(earlier, F.lit(False)), DUPLICATE)
        .when(F.col("_cut"), TRUNCATED).otherwise(NO_FAULT)
    )
    joined = distinct.join(firsts, same, "left")
    return joined.select(*keys, "_copies", F.left("_role", F.lit(1)).alias("_initial"), fault.alias("_fault"))


def _text_key() -> Column:
    """128 bits of a text, by which equal ones are told."""
    return F.md5(F.col("_text")).alias("_text_key")


_SEGMENT = (
    "_part int, _number int, _entry int, _whole boolean, _faults array<bigint>, _ends array<string>, _illegal bigint, "
    "_tops array<int>, _costs array<bigint>, _ranks array<int>, _edits array<string>"
)


def _segments(judged: DataFrame, kind: str) -> DataFrame:
    """Rows parsed in ranges of their order, in segments of SEGMENT_ROWS, without regard to the others.

    A segment that does not begin its conversation, as far as its range tells, is parsed from every
    top. One that is all of its conversation, by the same rule, is finished and marked whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        rows: list[tuple[str, int, int]] = []
        conv, number, first_of_range = None, 0, True

        def close(ends: bool, last_of_range: bool) -> None:
            nonlocal number
            faults = [0, 0, 0, 0]
            for _, fault, copies in rows:
                faults[fault] += 1
                faults[BLANK if fault == BLANK else DUPLICATE] += copies - 1
            begins = number == 0 and not first_of_range
            whole = begins and ends and not last_of_range
            # Two copies side by side are never legal.
            illegal = illegal_pairs(i for i, _, _ in rows) + sum(copies - 1 for _, _, copies in rows)
            for entry in (START,) if begins else TOPS:
                tops = parse(tuple(rows), entry)
                if whole:
                    top, cost, more = accepted({t: x[:2] for t, x in tops.items()})
                    tops = {top: (cost, 0, tops[top][2] + more)}
                out.append((
                    conv, part, number, entry, whole, faults[1:], [rows[0][0], rows[-1][0]], illegal, list(tops),
                    [x[0] for x in tops.values()], [x[1] for x in tops.values()], [x[2] for x in tops.values()],
                ))
            rows.clear()
            number += 1

        for batch in batches:
            for c, initial, fault, copies in zip(*(batch.column(n).to_pylist() for n in ("_conv", "_initial", "_fault", "_copies"))):
                if rows and c != conv:
                    close(True, False)
                    number, first_of_range = 0, False
                elif len(rows) == SEGMENT_ROWS:
                    close(False, False)
                conv = c
                rows.append((initial, fault, copies))
            if len(out) >= 1024:
                yield _batch(out, schema)
                out = []
        if rows:
            close(True, True)
        if out:
            yield _batch(out, schema)

    fields = f"_conv {kind}, {_SEGMENT}"
    schema = _arrow(judged, fields)
    ordered = judged.repartitionByRange(F.col("_conv").asc_nulls_first(), *_order("_turn", "_role", "_text_key"))
    ordered = ordered.sortWithinPartitions(F.col("_conv").asc_nulls_first(), *_order("_turn", "_role", "_text_key"))
    return stage(ordered.select("_conv", "_initial", "_fault", "_copies").mapInArrow(run, fields), "segments")


def _arrow(df: DataFrame, fields: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(fields))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_PARSED = "_faults array<bigint>, _illegal bigint, _cost bigint, _audit string"


def _joined(segments: DataFrame, kind: str) -> DataFrame:
    """``_conv, _faults, _illegal, _cost, _audit``: the segments of each conversation parsed as one.

    Costs and ranks of all its segments come first, a few numbers for a thousand rows, and settle how
    each is entered and left; then the edits come, of which the chosen are taken one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, live, back = None, {START: (0, 0)}, []
        stats: dict = {"faults": [0, 0, 0], "illegal": 0, "last": None}
        entries: dict[int, list] = {}
        at, taken, path, began = None, [], [], False

        def advance() -> None:
            nonlocal live
            best: dict[int, tuple[tuple[int, int, int], int]] = {}
            for top, (cost, rank) in live.items():
                for new, more, inner in entries.get(top, ()):
                    key = (cost + more, rank, inner)
                    if new not in best or key < best[new][0]:
                        best[new] = (key, top)
            order = sorted(best, key=lambda x: best[x][0][1:])
            live = {new: (best[new][0][0], r) for r, new in enumerate(order)}
            back.append({new: top for new, (_, top) in best.items()})
            entries.clear()

        def settle() -> None:
            nonlocal path
            if entries:
                advance()
            top, stats["cost"], stats["more"] = accepted(live)
            path = []
            for step in reversed(back):
                path.append((step[top], top))
                top = step[top]
            path.reverse()

        def close() -> None:
            if not began:
                return
            out.append((conv, stats["faults"], stats["illegal"], stats["cost"], "".join([*taken, stats["more"]])))

        for batch in batches:
            for row in batch.to_pylist():
                if not began or row["_conv"] != conv:
                    close()
                    conv, live, back, began = row["_conv"], {START: (0, 0)}, [], True
                    stats = {"faults": [0, 0, 0], "illegal": 0, "last": None}
                    entries, at, taken, path = {}, None, [], []
                place = (row["_part"], row["_number"])
                if row["_kind"] == 0:
                    if place != at:
                        if entries:
                            advance()
                        at = place
                        stats["faults"] = [a + b for a, b in zip(stats["faults"], row["_faults"])]
                        first, last = row["_ends"]
                        stats["illegal"] += row["_illegal"] + (stats["last"] is not None and illegal_pairs((stats["last"], first)))
                        stats["last"] = last
                    entries[row["_entry"]] = list(zip(row["_tops"], row["_costs"], row["_ranks"]))
                    continue
                if not path:
                    settle()
                    at = None
                if place != at:
                    at, chosen = place, path[len(taken)]
                if row["_entry"] == chosen[0]:
                    taken.append(row["_edits"][row["_tops"].index(chosen[1])])
            if len(out) >= 1024:
                yield _batch(out, schema)
                out = []
        close()
        if out:
            yield _batch(out, schema)

    fields = f"_conv {kind}, {_PARSED}"
    schema = _arrow(segments, fields)
    open_ones = segments.filter(~F.col("_whole")).drop("_whole")
    no_edits = F.lit(None).cast("array<string>").alias("_edits")
    both = open_ones.select(F.lit(0).alias("_kind"), *[c for c in open_ones.columns if c != "_edits"], no_edits).unionByName(
        open_ones.withColumn("_kind", F.lit(1))
    )
    slots = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = both.repartition(slots, "_conv").sortWithinPartitions(F.col("_conv").asc_nulls_first(), "_kind", "_part", "_number", "_entry")
    whole = segments.filter("_whole").select(
        "_conv", "_faults", "_illegal", F.get("_costs", F.lit(0)).alias("_cost"), F.get("_edits", F.lit(0)).alias("_audit")
    )
    return whole.unionByName(by.mapInArrow(run, fields))


_RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_REPAIRED = "place bigint, role string, text string, edit string"


def _marked(
    rows: DataFrame, conv: str, turn: str, role: str, text: str, all_ids: DataFrame | None
) -> tuple[DataFrame, str]:
    """Each conversation's result, then its rows in order, as one stream for each conversation."""
    kind = rows.schema[conv].dataType.simpleString()
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    named = rows.select(
        F.col(conv).alias("_conv"), F.col(turn).cast("bigint").alias("_turn"), blank(role).alias("_role"), blank(text).alias("_text")
    )
    parsed = _joined(_segments(_judged(named), kind), kind)
    nothing = {"_faults": "array<bigint>", "_illegal": "bigint", "_cost": "bigint", "_audit": "string"}
    given = {"_turn": "bigint", "_role": "string", "_text": "string", "_text_key": "string"}
    null = lambda kinds: [F.lit(None).cast(k).alias(c) for c, k in kinds.items()]
    parts = [
        parsed.select("_conv", F.lit(1).alias("_kind"), *null(given), *nothing),
        named.select("_conv", F.lit(2).alias("_kind"), "_turn", "_role", "_text", _text_key(), *null(nothing)),
    ]
    if all_ids is not None:
        ids = all_ids.select(F.col(conv).cast(kind).alias("_conv")).distinct()
        parts.append(ids.select("_conv", F.lit(0).alias("_kind"), *null(given), *null(nothing)))
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    slots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = both.repartition(slots, "_conv").sortWithinPartitions(
        F.col("_conv").asc_nulls_first(), "_kind", *_order("_turn", "_role", "_text_key")
    )
    return ordered, kind


class _Replay:
    """Applies a conversation's edits to its rows as they come: (role, text, edit) of what stays."""

    def __init__(self, audit: str):
        self._audit, self._at, self._top = audit, 0, START

    def _insert(self) -> Iterator[tuple[str, str, str]]:
        while self._audit[self._at : self._at + 1] == "I":
            yield self._role(), "", "I"
            self._at += 1

    def _role(self) -> str:
        letter = "a" if self._top == OPEN else "u"
        self._top = SHIFT[self._top, letter]
        return ROLES[letter]

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._insert()
        edit = self._audit[self._at]
        self._at += 1
        if edit == "K":
            self._top = SHIFT[self._top, role[0]]
            yield role, text, "K"
        elif edit == "R":
            yield self._role(), text, "R"

    def rest(self) -> Iterator[tuple[str, str, str]]:
        yield from self._insert()


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, object]]:
    """Events of the marked rows: ("conversation", id), ("parsed", row), ("row", row), ("end", id)."""
    began, conv = False, None
    for batch in batches:
        for row in batch.to_pylist():
            if not began or row["_conv"] != conv:
                if began:
                    yield "end", conv
                began, conv = True, row["_conv"]
                yield "conversation", conv
            if row["_kind"]:
                yield ("parsed" if row["_kind"] == 1 else "row"), row
    if began:
        yield "end", conv


def judge_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    all_ids: DataFrame | None = None,
) -> DataFrame:
    """One row for each conversation: its faults, the cheapest repair and the digest of what it gives.

    Rows are taken by turn, nulls first, then by role and a hash of the text; a null role or text is
    one space. Each row's first fault counts: blank, duplicate (equal role and text earlier, so of
    repeated rows all but the first), truncated (no final ``.``, ``!`` or ``?``). ``cost`` and
    ``audit`` are those of the cheapest edits that leave the grammar's roles, by the letters' order where
    several cost the least; ``repaired_sha256`` is that of its ``role:text`` lines. Ids of ``all_ids``
    that have no rows get zeros, an empty audit and the digest of nothing; a null id is an id. Other
    columns are not read. An empty table gives the ids of ``all_ids`` alone.

    A conversation may be of any length: rows are parsed in segments, wherever they lie, and the
    segments' few stack tops joined. Only its digest, which goes over the texts one after the other,
    passes them through one task, as a stream.
    """
    ordered, kind = _marked(rows, conv, turn, role, text, all_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        parsed, replay, digest, lines = None, None, hashlib.sha256(), 0
        low = high = last = None
        turns = 0

        def add(found: Iterator[tuple[str, str, str]]) -> None:
            nonlocal lines
            for r, t, _ in found:
                digest.update(f"\n{r}:{t}".encode() if lines else f"{r}:{t}".encode())
                lines += 1

        for event, x in _streams(batches):
            if event == "conversation":
                parsed, replay, digest, lines = None, None, hashlib.sha256(), 0
                low = high = last = None
                turns = 0
            elif event == "parsed":
                parsed, replay = x, _Replay(x["_audit"])
            elif event == "row":
                add(replay.row(x["_role"], x["_text"]))
                t = x["_turn"]
                if t is not None and t != last:
                    low, high, last, turns = t if low is None else low, t, t, turns + 1
            else:
                if parsed is None:
                    out.append((x, 0, 0, 0, 0, 0, 0, "", digest.hexdigest()))
                else:
                    add(replay.rest())
                    gaps = 0 if low is None else high - low + 1 - turns
                    out.append((x, gaps, *parsed["_faults"], parsed["_illegal"], parsed["_cost"], parsed["_audit"], digest.hexdigest()))
                if len(out) >= 1024:
                    yield _batch(out, schema)
                    out = []
        if out:
            yield _batch(out, schema)

    fields = f"`{conv}` {kind}, {_RESULT}, repaired_sha256 string"
    schema = _arrow(rows, fields)
    return ordered.mapInArrow(run, fields)


def repair_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The repaired rows: the id, ``place`` from 0, ``role``, ``text`` and ``edit`` (K, R or I).

    The edits are those of judge_conversations; what they delete is left out.
    """
    ordered, kind = _marked(rows, conv, turn, role, text, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        replay, place = None, 0
        for event, x in _streams(batches):
            found: Iterable[tuple[str, str, str]] = ()
            if event == "parsed":
                replay, place, current = _Replay(x["_audit"]), 0, x["_conv"]
            elif event == "row":
                found = replay.row(x["_role"], x["_text"])
            elif event == "end":
                found = replay.rest()
            for r, t, e in found:
                out.append((current, place, r, t, e))
                place += 1
            if len(out) >= 1024:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    fields = f"`{conv}` {kind}, {_REPAIRED}"
    schema = _arrow(rows, fields)
    return ordered.mapInArrow(run, fields)


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with the faults that crc32 of ``conv_id:turn`` mod 20 names.

    0 drops the row, 1 empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it, 4 makes
    its role user. A null is one space.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(case == 1, "").when(case == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    times = F.when(case == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    changed = conversations.select(
        "conv_id", "turn", F.when(case == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"),
        times.alias("_times"), case.alias("_case"),
    )
    kept = changed.filter("_case <> 0")
    return kept.select("conv_id", "turn", "role", "text", F.explode("_times").alias("_copy")).drop("_copy")
