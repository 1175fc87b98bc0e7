from collections import defaultdict
import hashlib
import itertools
import re
import zlib

import pytest
from brute import DATA, read

from corpuslens.llm import conversations
from corpuslens.llm.queries import LLM_QUERIES

ROWS = "conv_id bigint, turn bigint, role string, text string"
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    for conv, turn, role, text in rows:
        conv_s, turn_s, role, text = (" " if x is None else str(x) for x in (conv, turn, role, text))
        case = zlib.crc32(f"{conv_s}:{turn_s}".encode()) % 20
        if case:
            text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
            yield from [(conv, turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)


def in_order(rows):
    """{conv: [(turn, role, text)]} by turn, nulls first, then role and the hash of the text."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append((turn, " " if role is None else role, " " if text is None else text))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest())
    return {c: sorted(v, key=key) for c, v in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = SOLID.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


FITS = re.compile("(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit, lines): the least over all ways to edit, by (cost, audit) of whole beginnings."""
    states = {(): (0, "", ())}  # initials, shortened to what matters: () , s, u, a

    def step(state, letter):
        allowed = {(): "su", ("s",): "u", ("u",): "a", ("a",): "u"}[state]
        return (letter,) if letter and letter in allowed else None

    def closure(states):
        todo = list(states.items())
        while todo:
            state, (cost, audit, lines) = todo.pop()
            for letter, role in (("u", "user"), ("a", "assistant")):
                new = step(state, letter)
                found = (cost + 5, audit + "I", (*lines, f"{role}:"))
                if new and (new not in states or found[:2] < states[new][:2]):
                    states[new] = found
                    todo.append((new, found))
        return states

    for (_, role, text), fault in zip(rows, faults(rows)):
        new_states = {}

        def offer(state, found):
            if state is not None and (state not in new_states or found[:2] < new_states[state][:2]):
                new_states[state] = found

        extra = 5 if fault == "truncated" else 0
        for state, (cost, audit, lines) in closure(dict(states)).items():
            offer(state, (cost + 2, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                offer(step(state, role[:1]), (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
                for letter, name in (("u", "user"), ("a", "assistant")):
                    offer(step(state, letter), (cost + 1 + extra, audit + "R", (*lines, f"{name}:{text}")))
        states = new_states
    cost, audit, lines = min((x for s, x in closure(dict(states)).items() if s in ((), ("a",))), key=lambda x: x[:2])
    return cost, audit, "\n".join(lines)


def expected(rows, ids):
    out = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in ids}
    for conv, kept in in_order(rows).items():
        found = faults(kept)
        turns = {t for t, _, _ in kept if t is not None}
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, text = cheapest(kept)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def results(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def odd_conversations():
    roles = ["user", "assistant", "system", None, "", "tool", "u", "Übung"]
    texts = ["Fine.", "cut", "", None, " \n", "Really?", "é!", "a\nb."]
    rows = [(1, t, r, x) for t, (r, x) in enumerate(itertools.product(roles, texts))]
    rows += [(2, None, "user", "Hi."), (2, None, "user", "Hi."), (2, 3, "user", "Hi."), (2, 1, "assistant", "Yes."), (2, -4, "system", "Be.")]
    rows += [(None, 0, "user", "no id."), (None, 1, "assistant", "still none."), (3, None, "user", None), (4, 9, "user", "x " * 100_000 + ".")]
    rows += [(5, t, "user", f"only users {t}.") for t in range(41)] + [(6, t, "system", f"{t}") for t in range(9)]
    rows += [(7, 5, "user", "same turn."), (7, 5, "assistant", "same turn."), (7, 5, "assistant", "another."), (7, 6, "user", "same turn.")]
    rows += [(8, t // 2, ("user", "assistant")[t % 2], "over and over.") for t in range(60)]
    return rows


@pytest.mark.parametrize("segment", [1024, 3, 1])
def test_repairs_of_odd_conversations(spark, monkeypatch, segment):
    monkeypatch.setattr(conversations, "SEGMENT_ROWS", segment)
    rows = odd_conversations()
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], ROWS + ", cost int, _turn string")
    found = results(conversations.judge_conversations(table.repartition(5)))
    assert found == expected(rows, {c for c, *_ in rows})
    lines = defaultdict(list)
    for r in conversations.repair_conversations(table).orderBy("place").collect():
        lines[r.conv_id].append(f"{r.role}:{r.text}")
        assert r.place == len(lines[r.conv_id]) - 1
    assert {c: hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() for c in found} == {c: x[-1] for c, x in found.items()}
    for c, x in lines.items():
        assert FITS.fullmatch("".join(line[:1] for line in x)), c
    empty = spark.createDataFrame([], ROWS)
    assert conversations.judge_conversations(empty).count() == 0
    assert results(conversations.judge_conversations(empty, all_ids=table)) == expected([], {c for c, *_ in rows})


def test_damaged_tables(spark):
    rows = [tuple(r) for r in read(spark, "sf0.01", "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = results(LLM_QUERIES["op13_conversations"](spark, f"{DATA}/sf0.01"))
    assert found == expected(damaged(rows), {c for c, *_ in rows})
    odd = odd_conversations()
    table = spark.createDataFrame([(*r, 7) for r in odd], ROWS + ", _case int")
    changed = sorted(map(repr, map(tuple, conversations.damage(table).collect())))
    assert changed == sorted(map(repr, damaged(odd)))


def test_one_long_conversation(spark):
    """A conversation far longer than a segment, over many ranges, with a tie at its first row."""
    rows = [(1, t, ("user", "assistant", "user")[t % 3], f"row {t % 5000}" + ".!x"[t % 3]) for t in range(9000)]
    found = results(conversations.judge_conversations(spark.createDataFrame(rows, ROWS).repartition(8)))
    assert found == expected(rows, {1})
