import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwright.llm import repair

GRAMMAR = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit, turns) by relaxing a table of all (rows, state) until nothing changes: no agenda, whole strings."""
    table = {(0, "S"): (0, "", ())}
    step = {"S": {"s": "T", "u": "U"}, "T": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}
    while True:
        before = dict(table)
        for (i, q), (cost, audit, turns) in before.items():
            ways = [((i, step[q][x]), (cost + 5, audit + "I", (*turns, (r, "")))) for x, r in (("u", "user"), ("a", "assistant")) if x in step[q]]
            if i < len(rows):
                role, text, fault = rows[i]
                ways.append(((i + 1, q), (cost + 2, audit + "D", turns)))
                if fault not in ("blank", "duplicate"):
                    c = cost + 5 * (fault == "truncated")
                    ways += [((i + 1, step[q][x]), (c + 1, audit + "R", (*turns, (r, text)))) for x, r in (("u", "user"), ("a", "assistant")) if x in step[q]]
                    if role[:1] in step[q]:
                        ways.append(((i + 1, step[q][role[:1]]), (c, audit + "K", (*turns, (role, text)))))
            for item, way in ways:
                if item not in table or way < table[item]:
                    table[item] = way
        if table == before:
            return min(table[len(rows), q] for q in ("S", "A") if (len(rows), q) in table)


def listed(rows):
    """(cost, audit) by trying every string of edits over few rows, with one inserted turn at each place."""
    best = None
    for edits in itertools.product("KRD", repeat=len(rows)):
        for gaps in itertools.product((0, 1), repeat=len(rows) + 1):
            cost, roles, audit = 0, [], ""
            for k, e in enumerate([*edits, ""]):
                roles += ["?"] * gaps[k]
                audit += "I" * gaps[k] + e
                cost += 5 * gaps[k]
                if e:
                    role, _, fault = rows[k]
                    if e == "D":
                        cost += 2
                        continue
                    cost += (5 if fault == "truncated" else 0) + (1000 if fault in ("blank", "duplicate") else 0) + (e == "R")
                    roles.append((role[:1] or "-") if e == "K" else "?")
            fits = any(GRAMMAR.fullmatch("".join(r if r != "?" else next(free) for r in roles)) for free in map(iter, itertools.product("ua", repeat=roles.count("?"))))
            if fits and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        words = [c for c in text if c not in " \t\n\x0b\x0c\r"]
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute(rows):
    """rows: (conv_id, turn, role, text), undamaged."""
    groups = {}
    for conv, turn, role, text in rows:
        own = groups.setdefault(conv, [])
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        own += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        marked = faults([r[1:] for r in own])
        cost, audit, turns = cheapest(marked)
        there = [t for t, *_ in own if t is not None]
        initials = [r[1][:1] for r in own]
        kinds = [f for *_, f in marked]
        out[conv] = (max(there) - min(there) + 1 - len(set(there)) if there else 0, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def run(spark, folder, rows, extra=None):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    (df if extra is None else df.withColumns(extra)).write.mode("overwrite").parquet(f"{folder}/conversations.parquet")
    return {r.conv_id: tuple(r[c] for c in (*repair.COUNTS, "audit", "repaired_sha256")) for r in repair.op13_conversation_repair(spark, str(folder)).collect()}


ODD = [
    (None, 0, "user", "Hi."), (None, 1, None, None), (1, None, "user", "One."), (1, None, "user", "One."), (1, None, None, "x"), (1, 5, "assistant", None), (2, 0, "", "Empty role."), (2, 1, "", "Other."), (2, 1, "assistant", "b. \n\t"),
    *((3, t, "user" if t % 3 else "assistant", f"Text {t}." if t % 4 else "again") for t in range(30)), (4, 0, "system", " \n"), (5, 0, "tool", "x" * 100_000), (5, 1, "tool", "y."), (6, 0, "assistant", "No question."), (7, -3, "user", "A ."), (7, 9, "assistant", "B\x1c"),
    *((k, t, r, f"{k} {t}.") for k in range(100, 140) for t, r in enumerate(("system", "user", "assistant", "user", "assistant"))), *((k, 0, "user", "alone.") for k in range(200, 240)),
]


def test_odd_rows(spark, tmp_path):
    got = run(spark, tmp_path, ODD)
    assert got == brute(ODD)
    assert any(v[6] == "" and v[7] == hashlib.sha256(b"").hexdigest() for v in got.values())
    assert run(spark, tmp_path / "extra", ODD, {c: F.lit("kept?") for c in ("fault", "gone", "k", "audit", "cost", "_text", "blank", "n")}) == got
    assert run(spark, tmp_path / "none", []) == {}


def test_query_against_brute_force(spark, sf, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r[c] for c in (*repair.COUNTS, "audit", "repaired_sha256")) for r in repair.op13_conversation_repair(spark, sf).collect()}
    assert got == brute(rows)


def test_long_conversations_in_blocks(spark, tmp_path):
    """The same through blocks of four rows: many blocks in a task, conversations over several tasks, one with most rows."""
    long = [(9, None if t % 11 == 0 else t // 2, ("user", "assistant", "system", "tool")[t * t % 4 if t % 5 else t % 2], f"Row {t % 37}" + "." * (t % 3)) for t in range(400)]
    want = brute(ODD + long)
    whole = run(spark, tmp_path / "whole", ODD + long)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(repair, "BLOCK", 4)
        assert run(spark, tmp_path / "blocks", ODD + long) == want == whole
        turns = repair.repaired_turns(spark.createDataFrame(ODD + long, SCHEMA)).orderBy("conv_id", "position").collect()
    assert all(GRAMMAR.fullmatch("".join(r.role[:1] for r in own)) for _, own in itertools.groupby(turns, key=lambda r: r.conv_id))
    assert turns == repair.repaired_turns(spark.createDataFrame(ODD + long, SCHEMA)).orderBy("conv_id", "position").collect()


ROWS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.sampled_from(["a.", "b.", "c", "d", " ", "e!"])), max_size=6)
CODE = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}


@settings(max_examples=150, deadline=None)
@given(ROWS)
def test_agenda_against_relaxation(rows):
    marked = faults(rows)
    items = [(role[:1], CODE[f]) for role, _, f in marked]
    ((cost, audit),) = repair.lightest(items).values()
    assert (cost, audit) == cheapest(marked)[:2]
    # any cut into blocks joins to the same
    for cut in range(1, len(rows)):
        best = {0: (0, "")}
        for part in (items[:cut], items[cut:]):
            ways = [(b, (c + best[a][0], best[a][1] + w)) for a in best for b, (c, w) in repair.lightest(part, a, (0, 1, 2, 3), True).items()]
            best = {b: min(w for x, w in ways if x == b) for b, _ in ways}
        assert min(best[g] for g in repair.GOALS if g in best) == (cost, audit)


@settings(max_examples=60, deadline=None)
@given(ROWS.filter(lambda x: len(x) <= 4))
def test_agenda_against_all_edits(rows):
    marked = faults(rows)
    ((cost, audit),) = repair.lightest([(role[:1], CODE[f]) for role, _, f in marked]).values()
    assert (cost, audit) == listed(marked)
